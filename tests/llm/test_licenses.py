import re

import duckdb

from factloom.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    return len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_base_against_brute_force_and_sql(spark, documents, make):
    mit = dict((label, p) for p, label in licenses.OWN)["mit-text"]
    cut = mit.split()
    rows = [
        (0, None), (1, ""), (2, "..."), (3, "MIT"), (4, "Released under the MIT License."), (5, "CC-BY cc by CC BY-NC 4.0; Apache\nLicense, apache license"),
        (6, make(80) + " GNU General Public License, " + make(30) + " gnu general public public license"), (7, "über mit license é mit licenses"),
        (8, make(30) + " " + mit.title() + " " + make(30)), (9, " ".join(cut[:9] + ["inserted", "words"] + cut[9:])), (10, " ".join(cut[:6])), (11, make(5000) + " cc by"),
        (12, "gnu general public license " * 50), (13, "m\u0130t license, this wor\u212a is licensed under the gnu general public license version 3"),
    ]
    got = {r.doc_id: r for r in licenses.scan(documents(rows, extra=True)).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t), i
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    assert "mit-text" in got[8].labels and "mit-text" in got[9].labels and "mit-text" not in got[10].labels
    assert "cc-by-nc" in got[5].labels
    c = duckdb.connect()
    import pandas as pd

    c.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]))
    for row in c.sql(licenses.ORACLE_SQL).fetchall():
        r = got[row[0]]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == row[1:7]


def test_repeated_null_and_empty(spark, documents):
    rows = [(1, "mit license"), (1, "mit license"), (None, "cc by"), (None, None)]
    got = sorted((str(r.doc_id), r.n_base) for r in licenses.scan(documents(rows)).collect())
    assert got == [("1", 1), ("1", 1), ("None", 0), ("None", 1)]
    assert licenses.scan(documents([])).count() == 0


def test_stays_in_the_engine(spark, documents):
    plan = licenses.scan(documents([(1, "a b")]))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_every_gram_has_a_mark():
    marks = set(licenses.marks())
    for phrase, _ in (*licenses.BASE, *licenses.OWN):
        w = phrase.split()
        k = licenses.SHORT if len(w) <= licenses.PHRASE_WORDS else licenses.LONG
        assert all(marks & set(w[i : i + k]) for i in range(len(w) - k + 1))

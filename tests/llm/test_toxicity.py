import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from factloom.llm import toxicity as tox


def test_composed_grammar_against_a_plain_reading():
    rules, rng = tox.grammar(), random.Random(4)
    for _ in range(300):
        symbols = [rng.randrange(7) for _ in range(12)]
        state, got = 0, []
        for s in symbols:
            got.append(tox.pattern_of(rules.outputs[state, s]))
            state = rules.moves[state, s]
        want = []
        for k, s in enumerate(symbols):
            begin = max([j + 1 for j in range(k) if symbols[j] == tox.END], default=0)
            own = symbols[begin : k + 1]
            negated = any(x == tox.NEGATION for x in own[:-1][-tox.NEGATION_REACH :])
            flags = (int(s == tox.THREAT), int(tox.TARGET in own[:-1]), int(negated), int(tox.REPORT in own[:-1]))
            want.append(tox.PATTERNS.index(flags) if s in (tox.INSULT, tox.THREAT) else None)
        assert got == want


def test_clauses_are_matched_not_words():
    texts = ["You are a fool.", "you are not a fool", "he said you fool, yes", "fool. You", None, "", "foolish"]
    got = tox.matches(pa.array(texts, pa.string()), {"fool": 2.0}, tox.grammar())
    named = [{tox.PATTERNS[k]: v for k, v in enumerate(row) if v} for row in got.tolist()]
    assert named == [{(0, 1, 0, 0): 2.0}, {(0, 1, 1, 0): 2.0}, {(0, 1, 0, 1): 2.0}, {(0, 0, 0, 0): 2.0}, {}, {}, {(0, 0, 0, 0): 2.0}]


def corpus(rng, make, n=400):
    rows, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        words = make(rng.randint(20, 80)).split(" ")
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(("grobble", "snarfette", "snarfing", "blurk")))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_rows_and_edges(spark, documents, rng, make):
    rows, labels = corpus(rng, make)
    docs = documents(rows + [(1000, None), (1001, ""), (None, "grobble"), (None, "grobble")], extra=True)
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    model = tox.fit(docs, lab.where("doc_id % 5 <> 0"))
    got = tox.score(docs, model).collect()
    assert len(got) == len(rows) + 4
    truth = {i: t for i, _, t in labels}
    tested = [r for r in got if r.doc_id in truth and r.doc_id % 5 == 0]
    assert sum((r.score >= 0.5) == bool(truth[r.doc_id]) for r in tested) >= 0.97 * len(tested)
    assert all(0 <= r.score <= 1 for r in got)
    assert all(r.score < 0.5 for r in got if r.doc_id in (1000, 1001)) and all(r.score >= 0.5 for r in got if r.doc_id is None)


def test_nothing_to_learn_from(spark, documents):
    lab = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    model = tox.fit(documents([(1, "a b c")]), lab)
    assert all(r.score < 0.5 for r in tox.score(documents([(1, "a b c"), (2, None)]), model).collect())
    assert tox.fit(documents([]), lab.limit(0)).lexicon == {}
    assert tox.score(documents([]), model).count() == 0


EDGE = ".,;:!?\"'()[]{}«»“”„‘’¡¿*#$%&|<>-_"


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_word(w):
    return w.lower().strip(EDGE)


def entries_of(words):
    return {w[:n] for w in map(plain_word, words) if w.isalpha() for n in range(4, 9) if len(w) >= n} | {w for w in map(plain_word, words) if w.isalpha() and len(w) < 4}


def brute_score(text, model):
    """Clause by clause, by the words of the docstring."""
    strength, clause = [0.0] * len(tox.PATTERNS), []
    for w in [*split_words(text), None]:
        if w is not None:
            clause.append(w)
        if clause and (w is None or re.search("[.,;:!?]$", w)):
            seen = []
            for raw in clause:
                x = plain_word(raw)
                best = max([model.lexicon.get(x[:n], 0.0) for n in range(4, 9) if len(x) >= n] + [model.lexicon.get(x, 0.0) if len(x) < 4 else 0.0])
                kind = "threat" if x in tox.THREATS else "report" if x in tox.REPORTS else "negation" if x in tox.NEGATIONS else "target" if x in tox.TARGETS else "other"
                if best > 0:
                    kind = "insult"
                if kind in ("insult", "threat"):
                    flags = (int(kind == "threat"), int("target" in seen), int("negation" in seen[-tox.NEGATION_REACH :]), int("report" in seen))
                    strength[tox.PATTERNS.index(flags)] += best or 1.0
                seen.append(kind)
            clause = []
    z = sum(math.log1p(s) * w for s, w in zip(strength, model.weights, strict=True)) + model.bias
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def write_tables(spark, path, rows, labels):
    spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").repartition(3).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))


def test_query_against_brute_force(spark, tmp_path, rng, make):
    """The whole query on a small table: the lexicon from plain counts, and every score from a plain reading of the clauses."""
    rows, labels = corpus(rng, make, 300)
    mixed = ["He said you are not a grobble, you", "kill you", "Not a snarfing! they blurk, xu.", "xu xu, du", "never ever a blurk"]
    rows = [(i, t + (" xu" if y else "")) for (i, t), (_, _, y) in zip(rows, labels, strict=True)]
    rows += [(1000 + k, f"{make(10)} {t} {make(4)}") for k, t in enumerate(mixed)] + [(2000, None), (2001, ""), (None, "grobble"), (2002, " ".join(make(3000) for _ in range(3)) + " you blurk"), rows[3], rows[3]]
    write_tables(spark, tmp_path, rows, [*labels, (5000, 1, 1)])
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = tox.fit(docs, spark.createDataFrame([x for x in labels if not held(x[0])], "doc_id long, quality int, toxic int"))
    truth, texts = {i: y for i, _, y in labels if not held(i)}, dict(rows)
    counts = {}
    for i, y in truth.items():
        for e in entries_of(split_words(texts[i])):
            counts.setdefault(e, [0, 0])[0 if y else 1] += 1
    toxic = sum(truth.values())
    strong = [(w, a, b) for w, (a, b) in counts.items() if a >= max(tox.MIN_TOXIC, tox.MIN_SHARE * toxic)]
    assert model.lexicon == tox.learn_lexicon(strong, toxic, len(truth) - toxic)
    assert "xu" in model.lexicon and any(w.startswith("grob") for w in model.lexicon)
    got = tox.query(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_score(texts[r.doc_id], model)
        assert abs(r.score - want) < 1e-9 and r.predicted == int(want >= 0.5) and r.held_out == held(r.doc_id)


def test_sample_is_bounded_by_rows_and_repeats_count_once(spark, make):
    rows = [(1, "grobble you " + make(20))] * 500 + [(2, make(30)), (3, make(30))] + [(4, make(30)) for _ in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 0), (1, 0)], "doc_id long, toxic int")
    seen, kept = [], tox.train_weights
    try:
        tox.train_weights = lambda strength, toxic, **k: seen.append((len(toxic), int(np.sum(toxic)))) or kept(strength, toxic, steps=2)
        for n in (2, 5, 100):
            tox.fit(docs, labels, max_documents=n)
        assert all(n <= most for (n, _), most in zip(seen, (2, 5, 100), strict=False)) and seen[-1] == (53, 1)
    finally:
        tox.train_weights = kept


def test_empty_tables_through_the_query(spark, tmp_path):
    write_tables(spark, tmp_path, [], [])
    assert tox.query(spark, str(tmp_path)).collect() == []

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from factloom.llm import line_dedup as ld


def corpus(make, rng):
    shared = [make(n) for n in (20, 40, 60, 90)]
    docs = []
    for i in range(60):
        text = make(rng.randint(0, 150))
        for _ in range(rng.choice((0, 1, 2))):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice((" ", "\n")) + rng.choice(shared) + rng.choice((" ", "\n")) + text[at:]
        docs.append((i, text))
    docs += [(60, docs[3][1]), (61, docs[5][1] + "\n" + make(40)), (62, ""), (63, "a b"), (64, "x. " * 90), (65, "\x01 \x01 w. " + shared[2])]
    return docs


def test_text_is_kept_but_for_the_runs(spark, documents, make):
    passage = " ".join(f"w{k}." if k % 6 == 5 else f"w{k}" for k in range(60))
    a, b = "First  part here.\n" + passage + "\nlast.", "Other\ttext now.  " + passage + " Tail  words."
    plain = "Nothing   repeats \n here. "
    rows = [(2, b), (1, a), (3, plain), (4, None), (4, None), (None, passage), (5, passage)]
    docs = documents(rows, extra=True)
    got = {(r.doc_id, r.text) for r in ld.dedup_runs(docs).select(*docs.columns).collect()}
    assert got == {(1, a), (2, "Other\ttext now.  Tail  words."), (3, plain), (4, None), (None, ""), (5, "")}
    kept = ld.stage(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id: r.n_chars for r in kept.collect()} == {1: len(a), 2: len("Other\ttext now.  Tail  words."), 3: len(plain), 4: 0}


def test_repeated_rows_and_empty_table(spark, documents, make):
    t = make(120)
    got = ld.dedup_runs(documents([(1, t), (1, t), (2, t)])).collect()
    assert sorted((r.doc_id, r.text == t) for r in got) == [(1, True), (1, True), (2, False)]
    assert ld.dedup_runs(documents([])).count() == 0


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def merged(ranges, least):
    """Unions of overlapping or adjoining ranges that have enough words."""
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return [(a, b) for a, b in out if b - a >= least]


def cut_words(text, ranges):
    """The text without the words in the ranges and the white space after them."""
    out = []
    for k, m in enumerate(re.finditer(r"([^\x20\x09-\x0D]+)([\x20\x09-\x0D]*)", text)):
        if k == 0:
            out.append(text[: m.start()])
        if not any(a <= k < b for a, b in ranges):
            out.append(m.group())
    joined = "".join(out) if words(text) else text
    return joined.rstrip(" \t\n\v\f\r") if ranges and ranges[-1][1] == len(words(text)) else joined


def test_words_are_cut_as_by_a_plain_reading(rng):
    texts, ranges = [], []
    for _ in range(300):
        n = rng.randint(0, 12)
        t = rng.choice(("", " ", "\n\t")) + "".join(rng.choice(("a", "bé", "漢字", "x.")) + rng.choice((" ", "  ", "\n", "\x0b ")) for _ in range(n))
        texts.append(t.rstrip(" ") if rng.random() < 0.5 else t)
        ranges.append([tuple(sorted(rng.sample(range(n + 1), 2))) for _ in range(rng.randint(0, 3))] if n else [])
    doc = np.array([k for k, rs in enumerate(ranges) for _ in rs])
    low, high = (np.array([r[i] for rs in ranges for r in rs]) for i in (0, 1))
    for least in (1, 3):
        d, a, b = ld.merge_ranges(doc, low, high, least)
        want = [merged(rs, least) for rs in ranges]
        assert list(zip(d.tolist(), a.tolist(), b.tolist(), strict=True)) == [(k, *r) for k, rs in enumerate(want) for r in rs]
        assert ld.without(pa.array(texts), d, a, b).to_pylist() == [cut_words(t, rs) for t, rs in zip(texts, want, strict=True)]


def brute_windows(docs, run):
    """The word ranges whose windows of ``run`` words stand earlier, by comparing all windows."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = words(text)
        found = []
        for k in range(len(w) - run + 1):
            if (x := tuple(w[k : k + run])) in seen:
                found.append((k, k + run))
            seen.add(x)
        out[i] = merged(found, run)
    return out


def test_runs_against_brute_force(spark, documents, make, rng):
    docs = corpus(make, rng)
    for gram, run in ((16, 32), (5, 12)):
        want = brute_windows(docs, run)
        got = {r.doc_id: [(x["from"], x["to"]) for x in r._runs] for r in ld.dedup_runs(documents(docs), gram_words=gram, run_words=run).collect()}
        assert got == want
        assert any(want.values())


def test_passages_of_over_50_words_go_wherever_they_begin(spark, documents, rng):
    plain = lambda tag, n: [f"{tag}{k}" for k in range(n)]
    passage = plain("p", 51)
    dotted = [f"{x}." if k in (13, 33) else x for k, x in enumerate(plain("q", 60))]  # 20 words of whole lines inside
    docs = [(i, " ".join([*plain(f"a{i}-", rng.randint(0, 40)), *(passage if i % 2 else dotted), *plain(f"z{i}-", rng.randint(0, 40))])) for i in range(1, 13)]
    left = {r.doc_id: words(r.text) for r in ld.dedup_runs(documents(docs)).collect()}
    assert left[1] == words(docs[0][1]) and left[2] == words(docs[1][1])
    for i, text in docs[2:]:
        assert left[i] == [x for x in words(text) if x not in passage and x not in dotted]


def test_stage_drops_later_exact_copies_whole(spark, documents, make):
    tail = [make(60).rstrip(". \n") + f". End of{i} this." for i in range(4)]
    docs = [(i + 10 * k, t) for i, t in enumerate(tail) for k in range(3)]
    assert sorted(r.doc_id for r in ld.stage(documents(docs)).collect()) == [0, 1, 2, 3]


def test_rows_without_an_id_whose_short_hashes_are_equal(spark, documents, make):
    # found by search: Spark's 32-bit hash of both texts is the same
    passage = " ".join(f"w{k}" for k in range(40))
    rows = spark.range(300_000).select(F.concat(F.lit(passage + " "), F.md5(F.col("id").cast("string"))).alias("text"))
    clash = rows.groupBy(F.hash("text").alias("h")).agg(F.collect_list("text").alias("t")).where("size(t) > 1").orderBy("h").first()
    texts = [clash.t[0], clash.t[1], clash.t[0] + " " + make(80)]
    got = ld.dedup_runs(documents([(None, t) for t in texts])).collect()
    assert sum(bool(r._runs) for r in got) == 2


def test_parts_that_stand_in_two_places_are_no_run(spark, documents, make):
    a, b = " ".join(f"a{k}" for k in range(16)), " ".join(f"b{k}" for k in range(16))
    got = {r.doc_id: r.text for r in ld.dedup_runs(documents([(1, f"{a}. {make(30)}"), (2, f"{make(30)} {b}."), (3, f"{a} {b}")])).collect()}
    assert got[3] == f"{a} {b}"


def test_planted_runs_are_found(spark, documents, make, rng):
    """Recall of planted passages of 51 to 90 words in all their later places: all of them."""
    passages = [[f"p{j}x{k}" for k in range(rng.randint(51, 90))] for j in range(25)]
    docs = []
    for i in range(150):
        w = words(make(rng.randint(0, 200)))
        at = rng.randrange(len(w) + 1)
        docs.append((i, " ".join([*w[:at], *rng.choice(passages), *w[at:]])))
    seen, late = set(), 0
    got = {r.doc_id: set(words(r.text)) for r in ld.dedup_runs(documents(docs)).collect()}
    for i, t in docs:
        p = next(x for x in words(t) if x.startswith("p") and "x" in x and x[1 : x.index("x")].isdigit())
        own = set(passages[int(p[1 : p.index("x")])])
        assert got[i] & own == (set() if p in seen else own)
        late += p in seen
        seen.add(p)
    assert late > 100


def test_long_repetitive_text(spark, documents):
    got = ld.dedup_runs(documents([(1, "a " * 200_000), (2, "b c " * 50_000)])).collect()
    assert {r.doc_id: len(words(r.text)) for r in got} == {1: 1, 2: 2}

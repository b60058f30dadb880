import random
import re

import numpy as np
import pytest
import xxhash

from factloom.llm import simhash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def rows_for(rng, make):
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "ONE"), (5, "two words"), (6, "İstanbul ÉTÉ K x y")]
    base = [make(rng.randint(3, 700)) for _ in range(40)]
    for t in base:
        for _ in range(rng.choice((1, 1, 2, 5))):
            w = t.split(" ")
            if len(w) > 200 and rng.random() < 0.7:
                w[rng.randrange(len(w))] = "edit" + str(rng.random())
            rows.append((len(rows), " ".join(w)))
    rows.append((len(rows), make(30_000)))
    return rows


def test_against_brute_force(spark, documents, rng, make):
    rows = rows_for(rng, make)
    fps = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(fps)
    smallest = {}
    for (i, _), r in zip(rows, roots, strict=True):
        smallest[r] = min(smallest.get(r, i), i)
    got = {r.doc_id: r for r in simhash.near_duplicates(documents(rows, extra=True)).collect()}
    assert len(got) == len(rows)
    for (i, _), fp, r in zip(rows, fps, roots, strict=True):
        assert got[i].fp % 2**64 == fp
        assert got[i].component_id == smallest[r]


@pytest.mark.parametrize("limit", [2, 20_000])
def test_links_lose_nothing(spark, limit):
    rng = random.Random(3)
    fps = {0, 2**64 - 1}
    for _ in range(60):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(rng.choice((0, 0, 3, 12))):
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in fps], "fp long")
    edges = simhash.links(df, group_limit=limit)
    roots = {r.node % 2**64: r.root % 2**64 for r in simhash.components(edges).collect()}
    want = brute_components(fps)
    groups = {}
    for x, r in zip(fps, want, strict=True):
        groups.setdefault(r, set()).add(roots.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_empty_repeated_and_null_ids(spark, documents, make):
    assert simhash.near_duplicates(documents([])).count() == 0
    t = make(80)
    got = simhash.near_duplicates(documents([(7, t), (7, t), (None, t), (None, "alone here now"), (3, make(90))])).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(False, 3, 3), (False, 7, 7), (False, 7, 7)]
    assert {r.component_id for r in got if r.doc_id is None} == {7, None}


def test_keep_one(spark, documents, make):
    a, b = make(200), make(200)
    rows = [(5, a), (2, a), (2, a), (9, b), (None, b), (None, "x y z"), (11, None), (12, "")]
    kept = simhash.keep_one(documents(rows, extra=True))
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 2, 9, 11]


def test_hashes_of_spans_are_xxh64(rng):
    data = bytes(rng.randrange(256) for _ in range(5000))
    size = [*range(300), *(rng.randint(0, 400) for _ in range(500))]
    begin = [rng.randint(0, len(data) - n) for n in size]
    got = simhash.xxh64_spans(data, np.array(begin), np.array(size))
    assert got.tolist() == [xxhash.xxh64_intdigest(data[a : a + n], 42) for a, n in zip(begin, size, strict=True)]
    assert len(simhash.xxh64_spans(b"", np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0

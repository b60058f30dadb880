import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from factloom.llm import decontaminate as d


def distance_within(item, text):
    """Fewest edits that turn ``item`` into some substring of ``text``."""
    t = np.frombuffer(text, np.uint8)
    steps = np.arange(len(t) + 1)
    row = np.zeros(len(t) + 1, np.int64)
    for c in item:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (t != c))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row.min())


def test_distance_by_the_textbook(rng):
    for _ in range(100):
        item, text = (bytes(rng.choice(b"ab") for _ in range(rng.randint(0, n))) for n in (6, 12))
        assert distance_within(item, text) == best_on_diagonals(item, text, -len(item), len(text) + 1)


def best_on_diagonals(item, text, low, high):
    """Fewest edits of an alignment whose every cell lies on one of the diagonals."""
    far = len(item) + len(text) + 1
    row = [0 if low <= j < high else far for j in range(len(text) + 1)]
    for i, c in enumerate(item, 1):
        new = [far] * (len(text) + 1)
        for j in range(len(text) + 1):
            if low <= j - i < high:
                new[j] = min(row[j] + 1, new[j - 1] + 1 if j else far, row[j - 1] + (c != text[j - 1]) if j else far)
        row = new
    return min(row)


def test_align_finds_the_best_place(rng):
    for _ in range(400):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randint(3, 14)))
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(3, 30)))
        low = rng.randint(-8, 25)
        high = low + rng.randint(1, 12)
        want = best_on_diagonals(item, text, low, high)
        got = d.align(item, text, len(item), low, high)
        assert (got is None and want > len(item)) or got[0] == want
        if got:
            assert distance_within(item, text[got[1] : got[2]]) <= got[0]
        assert d.align(item, text, want - 1, low, high) is None if 0 < want <= len(item) else True
        assert d.align(item, text, len(item), -len(item), len(text) + 1)[0] == distance_within(item, text)


def edited(rng, s, edits):
    s = list(s)
    for _ in range(edits):
        k = rng.randrange(len(s))
        op = rng.randrange(3)
        if op == 0:
            s[k] = "q"
        elif op == 1:
            s.insert(k, "z")
        else:
            del s[k]
    return "".join(s)


@pytest.mark.parametrize("block_bytes", [600, 1 << 20])
def test_against_brute_force(spark, documents, make, rng, block_bytes):
    items = [(k, make(rng.randint(5, 50))) for k in range(20)] + [(20, "tiny"), (21, None), (None, make(30)), (22, "exactly12ch"), (23, "ab"), (24, "Nine char"), (25, " "), (26, "tiny")]
    rows = []
    for i in range(40):
        text = make(rng.randint(20, 150))
        if rng.random() < 0.7:
            _, item = items[rng.randrange(20)]
            budget = int(0.05 * len(" ".join(item.split()).encode()))
            text += " " + edited(rng, item.upper() if rng.random() < 0.3 else item, rng.randint(0, budget + 3)) + "\n " + make(10)
        rows.append((i, text))
    rows += [(100, None), (101, ""), (101, ""), (102, "has EXACTLY12ch \t in it"), (103, "Tiny ab"), (104, "cab abc tinyé"), (105, "a nine\nchar, tiny."), (106, "nine char")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: sorted({s.item_id for s in r._spans}) for r in d.find_leaks(documents(rows, extra=True), bench, block_bytes=block_bytes).collect()}
    index = d.Items.build([-1 if i is None else i for i, _ in items], [d.normalise(pa.array([t], pa.string()))[0].as_py().encode() for _, t in items], d.Q, d.EDIT_RATE, d.MIN_SHARED)
    for i, t in rows:
        text = d.normalise(pa.array([t], pa.string()))[0].as_py().encode()
        whole = lambda item: re.search(rb"(?<![0-9A-Za-z\x80-\xff])" + re.escape(item) + rb"(?![0-9A-Za-z\x80-\xff])", text)  # noqa: E731, B023
        want = sorted(int(index.ids[k]) for k, item in enumerate(index.data) if (distance_within(item, text) <= index.budget[k] if len(item) >= d.Q else whole(item)))
        assert got[i] == want, (i, text)


def test_stage_and_empty_tables(spark, documents, make):
    leak, clean = make(40), make(60)
    bench = spark.createDataFrame([(1, leak)], "item_id long, text string")
    docs = documents([(1, "see " + leak + " there"), (2, clean), (None, clean), (3, None)], extra=True)
    kept = d.stage(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {2, None, 3}
    assert d.stage(documents([]), bench).count() == 0
    assert d.stage(docs, bench.limit(0)).count() == 4
    assert np.array_equal(d.codes(np.frombuffer(b"abcdefghijklm", np.uint8), 10)[:1], d.codes(np.frombuffer(b"abcdefghij", np.uint8), 10)[:1])


def arrow_text(*texts):
    rows = [t.encode() for t in texts]
    return np.frombuffer(b"".join(rows), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in rows])])


@pytest.mark.parametrize("chunk", [1, 50, 1 << 19])
def test_small_chunks_of_counts_change_nothing(make, rng, chunk):
    items = [make(rng.randint(4, 40)) for _ in range(6)] + ["ab" * 60, "a" * 150]
    index = d.Items.build(list(range(len(items))), [x.encode() for x in items], d.Q, d.EDIT_RATE, d.MIN_SHARED)
    texts = []
    for k in range(10):
        item = rng.choice(items)
        texts.append(make(20) + edited(rng, item, rng.randint(0, int(0.06 * len(item)))) + ("a" * 200 if k % 5 == 0 else "") + make(10))
    data, offsets = arrow_text(*texts)
    got = d.search(data, offsets, index, d.Q, chunk)
    assert sorted(got) == sorted(d.search(data, offsets, index, d.Q))
    assert {(x[0], x[1]) for x in got} == {(t, i) for t, text in enumerate(texts) for i, item in enumerate(items) if distance_within(item.encode(), text.encode()) <= index.budget[i]}


def test_repetitive_text_takes_bounded_memory_and_time():
    item = "a" * 1000 + "b" + "a" * 999
    index = d.Items.build([7, 8], [item.encode(), b"a" * 2000], d.Q, d.EDIT_RATE, d.MIN_SHARED)
    data, offsets = arrow_text("a" * 1_000_000)
    tracemalloc.start()
    got = d.search(data, offsets, index, d.Q)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {x[1] for x in got} == {0, 1} and peak < 500e6
    assert all(edits == (0 if i else 1) for _, i, _, _, edits in got)


def test_long_item_with_edits(make, rng):
    item = make(4000).replace("\n", " ")
    index = d.Items.build([3], [item.encode()], d.Q, d.EDIT_RATE, d.MIN_SHARED)
    data, offsets = arrow_text(make(50) + edited(rng, item, 300) + make(50), make(500))
    got = d.search(data, offsets, index, d.Q)
    assert [x[:2] for x in got] == [(0, 0)] and 0 < got[0][4] <= 300

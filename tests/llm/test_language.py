import random
import zlib

import numpy as np
import pyarrow as pa

from factloom.llm import language as lang

SYLLABLES = {"aa": "ka to mi ne su ra".split(), "bb": "ßch ürg ent auf ver zeit".split(), "cc": "eau que été oui ment tion".split()}


def text(rng, name, n):
    return " ".join("".join(rng.choice(SYLLABLES[name]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_edge_rows(spark):
    rng = random.Random(2)
    rows = [(i, text(rng, n, rng.randint(5, 200)), n, 0.0) for i in range(400) for n in [rng.choice(list(SYLLABLES))]]
    schema = "doc_id long, text string, lang string, score double"
    docs = spark.createDataFrame(rows, schema)
    net = lang.fit(docs.where("doc_id % 2 = 0"), max_documents=150)
    extra = [(1000, None, None, 0.0), (1001, "", None, 0.0), (1002, "12 34 !!", None, 0.0), (None, rows[0][1], None, 0.0), (None, rows[0][1], None, 0.0), (1003, "é", None, 0.0)]
    got = lang.identify(spark.createDataFrame(rows + extra, schema), net).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: n for i, _, n, _ in rows}
    tested = [r for r in got if r.doc_id in truth and r.doc_id % 2]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in tested]) > 0.97
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (1000, 1001, 1002)} == {(lang.UNKNOWN, 0.0)}
    assert all(0 <= r.score <= 1 for r in got)
    assert lang.identify(docs.limit(0), net).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, "x")], "doc_id long, text string, lang string")
    assert lang.fit(docs) is None
    assert {r.lang_pred for r in lang.identify(docs, None).collect()} == {lang.UNKNOWN}


def test_pooling_equals_a_plain_convolution():
    rng = np.random.default_rng(1)
    net = lang.train(rng.integers(0, 256, (20, 32), dtype=np.uint8), rng.integers(0, 2, 20), ["a", "b"], epochs=1)
    windows = rng.integers(0, 256, (5, 32), dtype=np.uint8)
    want = [[max(sum(t[j, w[i + j], f] for j in range(len(t))) for i in range(32 - len(t) + 1)) for t in net.taps for f in range(t.shape[2])] for w in windows]
    assert np.allclose(net.pooled(windows)[0] - net.bias, want, atol=1e-4)


def test_windows_cover_whole_texts():
    texts = ["a" * 300, "", "bé" * 70, None, "c" * 128]
    data, offsets = lang.text_bytes(pa.array(texts, pa.string()))
    windows, ends = lang.cut_windows(data, offsets)
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        own = windows[ends[k] : ends[k + 1]].tobytes()
        assert own[: len(raw)] == raw and not any(own[len(raw) :]) and len(own) % lang.WINDOW == 0


def brute_prediction(net, text):
    """The network read plainly: every window of the text, every filter at every place."""
    if text is None or not any(c.isalpha() for c in text):
        return lang.UNKNOWN, 0.0
    raw, total = text.encode(), np.zeros(len(net.labels))
    for lo in range(0, len(raw), lang.WINDOW):
        window = raw[lo : lo + lang.WINDOW].ljust(lang.WINDOW, b"\0")
        hidden = []
        for taps in net.taps:
            for f in range(taps.shape[2]):
                hidden.append(max(sum(float(taps[j, window[i + j], f]) for j in range(len(taps))) for i in range(lang.WINDOW - len(taps) + 1)))
        act = np.maximum(np.array(hidden) + net.bias, 0)
        z = act @ net.dense + net.dense_bias
        e = np.exp(z - z.max())
        letters = sum(b >= 128 or chr(b).isalpha() for b in window)
        total += e / e.sum() * letters
    mean = total / total.sum()
    return net.labels[int(mean.argmax())], float(mean.max())


def test_query_against_brute_force(spark, tmp_path):
    """The whole query on a small table: who is held out, what is predicted, and how sure."""
    rng = random.Random(12)
    rows = [(i, text(rng, n, rng.randint(3, 60)), n, "s") for i in range(60) for n in [rng.choice(list(SYLLABLES))]]
    rows += [(100, None, "aa", "s"), (101, "", "bb", "s"), (102, "12 !", "cc", "s"), (103, rows[0][1], None, "s"), (None, rows[1][1], "aa", "s"), (104, rows[2][1] * 40, "aa", "s"), (5, rows[5][1], rows[5][2], "s")]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1
    net = lang.fit(spark.createDataFrame([r for r in rows if r[0] is not None and not held(r[0])], schema))
    got = lang.query(spark, str(tmp_path)).collect()
    want = sorted((str(i), held(i), *brute_prediction(net, t)) for i, t, _, _ in rows)
    assert len(got) == len(want)
    for r, (i, h, label, sure) in zip(sorted(got, key=lambda r: (str(r.doc_id), r.held_out, r.lang_pred)), want, strict=True):
        assert (str(r.doc_id), r.held_out, r.lang_pred) == (i, h, label) and abs(r.score - sure) < 1e-3


def test_sample_is_bounded_by_rows(spark):
    rng = random.Random(3)
    same, seen = text(rng, "aa", 30), []
    rows = [(7, same, "aa")] * 2000 + [(7, text(rng, "bb", 30), "bb"), (8, text(rng, "cc", 30), "cc")] + [(9, text(rng, "cc", 5), "cc") for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    kept = lang.train
    try:
        lang.train = lambda windows, target, labels, **k: seen.append(len(windows)) or kept(windows, target, labels, epochs=1)
        for n in (1, 2, 40):
            lang.fit(docs, max_documents=n)
            assert seen[-1] <= n * lang.WINDOWS_PER_DOCUMENT
        lang.fit(docs.where("doc_id < 9"))
        assert seen[-1] <= 3 * lang.WINDOWS_PER_DOCUMENT, "a row that is repeated counts once"
    finally:
        lang.train = kept


def test_equal_classes_and_empty_query(spark, tmp_path):
    net = lang.Network(["aa", "bb"], [np.zeros((2, 256, 1), np.float32)], np.zeros(1, np.float32), np.zeros((1, 2), np.float32), np.zeros(2, np.float32))
    docs = spark.createDataFrame([(1, "abc"), (2, "abc " * 50_000)], "doc_id long, text string")
    assert {(r.lang_pred, round(r.score, 6)) for r in lang.identify(docs, net).collect()} == {("aa", 0.5)}
    spark.createDataFrame([], "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    assert lang.query(spark, str(tmp_path)).collect() == []

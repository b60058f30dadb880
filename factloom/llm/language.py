"""Language identification by a byte-level convolutional network, written in numpy.

A text's bytes are cut into windows of ``window`` bytes. Filters of several widths run over a
window's bytes (a filter is a table of a number per byte value and tap, so a convolution is a sum
of look-ups), are max-pooled over the window, rectified, and classified by softmax. A text's
prediction is the mean of its windows' distributions, weighted by their letters; every window of a
text counts. The network is trained on the driver on a bounded sample: ``max_documents`` different
labelled rows in hash order, and ``windows_per_document`` windows of each, spread over its text.

Defined cases: a null text, or one without letters, is ``und`` with score 0; a null language label is
not learned from; a null doc_id is neither held out nor learned from; repeated rows give equal rows and
count once in the sample, ids that are repeated with other texts or labels once for each; of classes
that are equally likely the first by name is given;
an empty table gives no rows; without any usable label every text is ``und``; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import column, map_arrow, prepare, slices, table

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
MAX_DOCUMENTS = 4000
WINDOWS_PER_DOCUMENT = 3
EPOCHS = 8
BATCH = 64
UNKNOWN = "und"


@dataclass
class Network:
    labels: list[str]
    taps: list[np.ndarray]  # per width: (width, 256, filters)
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def pooled(self, windows: np.ndarray, where: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max-pooled filter responses of (n, window) bytes, and the places of the maxima."""
        out, places = [], []
        for taps in self.taps:
            width, size = len(taps), windows.shape[1] - len(taps) + 1
            total = taps[0][windows[:, :size]]
            for j in range(1, width):
                total += taps[j][windows[:, j : j + size]]
            if where:
                at = total.argmax(axis=1)
                places.append(at)
                out.append(np.take_along_axis(total, at[:, None, :], axis=1)[:, 0])
            else:
                out.append(total.max(axis=1))
        return np.concatenate(out, axis=1) + self.bias, places

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        hidden = np.maximum(self.pooled(windows)[0], 0)
        return softmax(hidden @ self.dense + self.dense_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, target: np.ndarray, labels: list[str], widths: tuple[int, ...] = WIDTHS, filters: int = FILTERS, epochs: int = EPOCHS, batch: int = BATCH, rate: float = 0.01, seed: int = 11) -> Network:
    """Adam on cross entropy; classes weigh by the root of their rarity."""
    rng = np.random.default_rng(seed)
    taps = [rng.normal(0, 0.1, (w, 256, filters)).astype(np.float32) for w in widths]
    hidden = filters * len(widths)
    net = Network(labels, taps, np.zeros(hidden, np.float32), rng.normal(0, 0.3, (hidden, len(labels))).astype(np.float32), np.zeros(len(labels), np.float32))
    weight = np.sqrt(len(target) / (len(labels) * np.maximum(np.bincount(target, minlength=len(labels)), 1))).astype(np.float32)
    params = [*net.taps, net.bias, net.dense, net.dense_bias]
    moment, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(target))
        for lo in range(0, len(order), batch):
            rows = order[lo : lo + batch]
            x, y = windows[rows], target[rows]
            raw, places = net.pooled(x, where=True)
            act = np.maximum(raw, 0)
            grad = softmax(act @ net.dense + net.dense_bias)
            grad[np.arange(len(y)), y] -= 1
            grad *= weight[y][:, None] / len(y)
            back = (grad @ net.dense.T) * (raw > 0)
            grads = []
            for k, t in enumerate(net.taps):
                g, own = np.zeros_like(t), back[:, k * filters : (k + 1) * filters]
                for j in range(len(t)):
                    byte = np.take_along_axis(x, places[k] + j, axis=1)
                    np.add.at(g[j], (byte, np.arange(filters)[None, :]), own)
                grads.append(g)
            grads += [back.sum(axis=0), act.T @ grad, grad.sum(axis=0)]
            step += 1
            for p, g, m, v in zip(params, grads, moment, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def cut_windows(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of texts that stand in a row, padded with zero bytes, and each text's offsets into them."""
    size = np.diff(offsets)
    count = -(-size // window)
    ends = np.concatenate([[0], np.cumsum(count)])
    padded = np.zeros((int(ends[-1]), window), np.uint8)
    flat = padded.reshape(-1)
    shift = ends[:-1] * window - offsets[:-1]
    flat[np.arange(len(data)) + np.repeat(shift, size)] = data
    return padded, ends


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data = pc.fill_null(text, "").cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    raw = data.buffers()[2]
    return np.zeros(0, np.uint8) if raw is None or not len(offsets) else np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


_LETTER = np.zeros(256, np.float32)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def predict(net: Network, text: pa.Array, window: int = WINDOW) -> tuple[list[str], np.ndarray]:
    """Label and score of each text."""
    rows = len(text)
    data, offsets = text_bytes(text)
    lettered = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
    mean = np.zeros((rows, len(net.labels)))
    if len(data):
        windows, ends = cut_windows(data, offsets, window)
        weight = _LETTER[windows].sum(axis=1)
        total = np.zeros((len(windows) + 1, len(net.labels)))
        for lo in range(0, len(windows), 512):
            part = slice(lo, lo + 512)
            total[lo + 1 : lo + 513] = net.probabilities(windows[part]) * weight[part, None]
        total = np.cumsum(total, axis=0)
        mean = total[ends[1:]] - total[ends[:-1]]
        mean /= np.maximum(mean.sum(axis=1, keepdims=True), 1e-9)
    best = mean.argmax(axis=1)
    labels = [net.labels[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
    return labels, np.where(lettered, np.clip(mean[np.arange(rows), best], 0, 1), 0.0)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", order_col: str = "doc_id", max_documents: int = MAX_DOCUMENTS, windows_per_document: int = WINDOWS_PER_DOCUMENT, window: int = WINDOW) -> Network | None:
    """Train on a bounded sample of the rows given: the first ``max_documents`` different ones by the hash of ``order_col``.

    What reaches the driver are at most ``max_documents * windows_per_document`` windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            data, offsets = text_bytes(column(b, "text"))
            windows, ends = cut_windows(data, offsets, window)
            n = np.diff(ends)
            take = np.concatenate([ends[:-1] + (n * k) // windows_per_document for k in range(windows_per_document)])
            doc = np.tile(np.arange(b.num_rows), windows_per_document)
            ok = np.concatenate([(n > 0) & ((n * k) // windows_per_document > (n * (k - 1)) // windows_per_document if k else n > 0) for k in range(windows_per_document)])
            take, doc = take[ok], doc[ok]
            lang, key = column(b, "lang").take(pa.array(doc)), column(b, "key").take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([lang, key, pa.array([w.tobytes() for w in windows[take]], pa.binary())], ["lang", "key", "bytes"])

    known = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(order_col).isNotNull())
    known = known.select(F.col(order_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    own = ["id", "lang", "digest"]
    # rows are chosen without their texts; those that are chosen are then joined back, each once however often it is repeated
    chosen = known.select(F.xxhash64("id").alias("key"), *own).distinct().orderBy("key", *own).limit(max_documents)
    small = F.broadcast(chosen)  # at most max_documents rows of four short values
    sample = known.join(small, own).dropDuplicates(own).select("lang", "key", "text")
    rows = map_arrow(sample, run, "lang string, key long, bytes binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.key, r.lang, bytes(r.bytes)))
    labels = sorted({r.lang for r in rows})
    windows = np.frombuffer(b"".join(bytes(r.bytes) for r in rows), np.uint8).reshape(len(rows), window)
    return train(windows, np.array([labels.index(r.lang) for r in rows]), labels)


def identify(docs: DataFrame, net: Network | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score), one row per document."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if net is None:
        return src.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # about 60 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            labels, scores = predict(shared.value, column(b, "text"))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(labels, pa.string()), pa.array(scores.astype(np.float64))], ["doc_id", "lang_pred", "score"])

    return map_arrow(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    net = fit(docs.where(~held_out))
    return identify(docs, net).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")

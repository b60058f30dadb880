"""Quality rules with suffix-array repetition.

Base rules count words, their characters, symbols, repeated lines and words in repeated 3-word
windows of a whole text. The method's verdict comes from a suffix array over words: intervals of
the longest-common-prefix array give the maximal repeated word strings; strings of at least
``min_repeat`` words are united, and a document is rejected if they cover more than ``max_covered``
of its words or if the longest has more than ``max_longest`` words. The array is built over the
suffixes that can take part (their first three words occur again in the text), for all texts of a
slice at once, with the text as the first key, by prefix doubling.

Defined cases: a null text has no words; empty texts and texts below ``min_words`` words fail the
base rules; a null doc_id is kept; repeated rows give equal rows; an empty table gives no rows;
other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ._shared import column, map_arrow, mix64, prepare, sealed, segment_ids, segment_sum, slices, table, words_of

WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
#: A repeated string counts from this many words on.
MIN_REPEAT = 6
#: Largest share of a document's words inside repeated strings.
MAX_COVERED = 0.3
#: Most words of the longest repeated string.
MAX_LONGEST = 40


def _symbols(text: pa.Array) -> np.ndarray:
    data = pc.fill_null(text, "").cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    if not len(data) or offsets[-1] == offsets[0]:
        return np.zeros(len(data), np.int64)
    is_symbol = np.zeros(256, np.int8)
    is_symbol[list(SYMBOLS)] = 1
    raw = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return segment_sum(is_symbol[raw], offsets - offsets[0])


def _dup_lines(text: pa.Array) -> np.ndarray:
    split = pc.split_pattern(pc.fill_null(text, ""), "\n")
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    lines = split.flatten()
    doc = np.repeat(np.arange(len(counts)), counts)
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0).to_numpy(zero_copy_only=False)
    coded = lines.dictionary_encode()
    n = max(1, len(coded.dictionary))
    keys = doc[worded] * n + np.asarray(coded.indices)[worded]
    distinct = np.unique(keys) // n
    size = len(counts)
    return np.bincount(doc[worded], minlength=size)[:size] - np.bincount(distinct, minlength=size)[:size]


def _repeated_windows(word: np.ndarray, doc: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the 3-word window at each word occurs twice or more in its text."""
    n = len(word)
    out = np.zeros(n, bool)
    if n < WINDOW:
        return out
    whole = np.flatnonzero(doc[: n - 2] == doc[2:])
    key = mix64(mix64(mix64(word.astype(np.uint64) + (doc.astype(np.uint64) << np.uint64(32)))[whole] + word[whole + 1].astype(np.uint64)) + word[whole + 2].astype(np.uint64))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    out[whole[twice]] = True
    return out


def _dense(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of key tuples (first key leads), and the sorting order."""
    order = np.lexsort(keys[::-1])
    step = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        step[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(step)
    return rank, order


def longest_repeats(word: np.ndarray, doc: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """For each word position, the length of the longest repeated string (of 3 words or more) that starts there.

    ``seeds``: positions whose 3-word window is repeated. Suffixes are sorted over the seeds and the
    positions three words after them, which decide the order of the seeds.
    """
    n = len(word)
    out = np.zeros(n, np.int64)
    start = np.flatnonzero(seeds)
    if not len(start):
        return out
    take = np.zeros(n, bool)
    take[start] = True
    nxt = start + WINDOW
    nxt = nxt[nxt < n]
    take[nxt[doc[nxt] == doc[nxt - WINDOW]]] = True
    pos = np.flatnonzero(take)
    at = np.full(n + 1, -1, np.int64)
    at[pos] = np.arange(len(pos))

    def word_at(p: np.ndarray, home: np.ndarray) -> np.ndarray:
        q = np.minimum(p, n - 1)
        return np.where((p < n) & (doc[q] == home), word[q].astype(np.int64), -1)

    home = doc[pos]
    rank, order = _dense(home, word_at(pos, home), word_at(pos + 1, home), word_at(pos + 2, home))
    levels, k = [(WINDOW, rank)], WINDOW
    while rank.max() + 1 < len(rank):
        far = np.minimum(pos + k, n)
        j = at[far]
        ok = (j >= 0) & (doc[np.minimum(far, n - 1)] == home)
        second = np.where(ok, rank[np.maximum(j, 0)], -1)
        new, order = _dense(rank, second)
        if new.max() == rank.max():
            break
        rank, k = new, 2 * k
        levels.append((k, rank))
    a, b = pos[order[:-1]], pos[order[1:]]
    common = np.zeros(len(a), np.int64)
    for size, r in reversed(levels):
        ja, jb = at[np.minimum(a + common, n)], at[np.minimum(b + common, n)]
        equal = (ja >= 0) & (jb >= 0)
        equal &= r[np.maximum(ja, 0)] == r[np.maximum(jb, 0)]
        common += np.where(equal, size, 0)
    live = np.flatnonzero((common > 0) & (doc[a] == doc[b]))
    for _ in range(WINDOW):  # what is left is shorter than a window
        live = live[np.maximum(a, b)[live] + common[live] < n]
        x, y = word_at(a[live] + common[live], doc[a[live]]), word_at(b[live] + common[live], doc[b[live]])
        live = live[(x == y) & (x >= 0)]
        common[live] += 1
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    out[~seeds] = 0
    return out


def measure(text: pa.Array, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """Counts for each text of a slice."""
    flat, offsets = words_of(text)
    rows = len(text)
    n_words = np.diff(offsets)
    out = {"n_words": n_words, "n_symbols": _symbols(text), "n_dup_lines": _dup_lines(text)}
    if not len(flat):
        zero = np.zeros(rows, np.int64)
        return out | {"word_chars": zero, "n_repeat_words": zero, "n_covered": zero, "longest_repeat": zero}
    coded = flat.dictionary_encode()
    word = np.asarray(coded.indices)
    out["word_chars"] = segment_sum(pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)[word], offsets)
    doc = segment_ids(offsets)
    seeds = _repeated_windows(word, doc, offsets)
    inside = seeds.copy()
    inside[1:] |= seeds[:-1]
    inside[2:] |= seeds[:-2]
    out["n_repeat_words"] = segment_sum(inside, offsets)
    length = longest_repeats(word, doc, seeds)
    length[length < min_repeat] = 0
    reach = np.maximum.accumulate(np.where(length > 0, np.arange(len(word)) + length, 0))
    out["n_covered"] = segment_sum(reach > np.arange(len(word)), offsets)
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, doc, length)
    return out | {"longest_repeat": longest}


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")
VERDICTS = ("base_failed", "covered_failed", "longest_failed", "kept")


def _judged(docs: DataFrame, text_col: str, carry: list[str], min_words: int = MIN_WORDS, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST, min_repeat: int = MIN_REPEAT) -> DataFrame:
    """Counts and verdicts of each document, after the columns of ``docs`` to carry along."""
    src = docs.select(*carry, F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            m = measure(column(b, "text"), min_repeat)
            n = m["n_words"]
            failed = (n < min_words) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
            covered, longest = m["n_covered"] > max_covered * n, m["longest_repeat"] > max_longest
            arrays = [*(pa.array(m[c].astype(np.int64)) for c in COLUMNS), *map(pa.array, (failed, covered, longest, ~(failed | covered | longest)))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(b.num_columns - 1)), *arrays], [*carry, *COLUMNS, *VERDICTS])

    fields = [*(StructField(c, LongType()) for c in COLUMNS), *(StructField(c, BooleanType()) for c in VERDICTS)]
    return map_arrow(src, run, StructType([*src.schema.fields[:-1], *fields]))


def rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: the counts, base_failed, what each of the method's limits says, and kept."""
    inner, (i, t), _ = sealed(docs, id_col, text_col)
    return _judged(inner, t, [i], **options).withColumnRenamed(i, "doc_id")


def filter_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that pass, with their columns, in one pass."""
    inner, (t,), restore = sealed(docs, text_col)
    return restore(_judged(inner, t, inner.columns, **options).where("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(table(prepare(spark), sf_dir, "documents"))

"""Line dedup by winnowing: repeated runs of words stay where they come first and go elsewhere.

A passage may begin and end anywhere, inside a sentence or line as well, so windows of words count:
every window of ``run_words`` words that has an earlier place, in the order of doc_id (null last) and
position, is deleted. That is each match extended word by word both ways, then held to the limit.

Windows are not compared one by one. The smallest hash over the grams of ``gram_words`` words inside
a window is its fingerprint; neighbouring windows with the same one at the same place (the leftmost) make
a segment, in which no window stands twice. Equal windows
have equal fingerprints, so only segments whose fingerprint stands in two places matter (the guarantee
of winnowing). A segment that stands whole at an earlier place is repeated whole; only where segments
of one fingerprint differ are their windows written out and matched, once for each different segment.

Hot segments are pre-aggregated by hash and then joined, never paired with each other.

Defined cases: null texts stay null; texts without a repeated run stay as they are, to the byte;
rows with equal doc_id and text are one place, so neither deletes from the other; rows without a
doc_id come last, by the hash of their text; a text may lose all its words and is then empty; a run
that repeats itself in place (as one word over and over) keeps its start up to the first repetition; an
empty table gives no rows; other columns are kept, whatever their names.

Rows are told apart by doc_id and a 64-bit hash of the text; those without a doc_id by 96 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import column, forget, hash_strings, map_arrow, materialize, mix64, prepare, sealed, segment_ids, slices, table, words_of

GRAM_WORDS = 8
RUN_WORDS = 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _rolling(flat: pa.Array):
    """Hashes of spans of words, by first word and length."""
    coded = flat.dictionary_encode()
    word = hash_strings(coded.dictionary)[np.asarray(coded.indices)]
    powers, back = _powers(int(_ODD), len(word)), _powers(pow(int(_ODD), -1, 2**64), len(word))
    total = np.concatenate([[np.uint64(0)], np.cumsum(word * powers, dtype=np.uint64)])
    return lambda at, size: mix64((total[at + size] - total[at]) * back[at])


def segments_of(text: pa.Array, gram_words: int, run_words: int) -> dict[str, np.ndarray]:
    """Segments of all texts in a row: doc, print, segment (hash of its words), from (word position in the text) and windows."""
    flat, offsets = words_of(text)
    doc = segment_ids(offsets)
    n = len(doc)
    start = np.flatnonzero(doc[: max(0, n - run_words + 1)] == doc[run_words - 1 :])
    if not len(start):
        return {k: np.zeros(0, np.int64) for k in ("doc", "print", "segment", "from", "windows")}
    span = _rolling(flat)
    gram, width, held = span(np.arange(n - gram_words + 1), gram_words), run_words - gram_words + 1, 1
    least = np.arange(len(gram))  # where the smallest gram of each window stands, the leftmost one if it is there twice
    while held < width:
        step = min(held, width - held)
        a, b = least[:-step], least[step:]
        least = np.where(gram[b] < gram[a], b, a)
        held += step
    least = least[start]
    value = gram[least]
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    windows = np.diff(np.concatenate([first, [len(start)]]))
    begin = start[first]
    return {"doc": doc[begin], "print": value[first].view(np.int64), "segment": span(begin, windows + run_words - 1).view(np.int64), "from": begin - offsets[doc[begin]], "windows": windows}


def merge_ranges(doc: np.ndarray, low: np.ndarray, high: np.ndarray, run_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or adjoining ranges [low, high) of each document that have at least ``run_words`` words."""
    if not len(doc):
        return doc, low, high
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    wide = int(high.max()) + 1  # places of one document lie within its stretch
    reach = np.maximum.accumulate(doc * wide + high)
    first = np.flatnonzero(np.append(True, doc[1:] * wide + low[1:] > reach[:-1]))
    last = np.append(first[1:], len(doc)) - 1
    doc, low, high = doc[first], low[first], reach[last] - doc[first] * wide
    long = high - low >= run_words
    return doc[long], low[long], high[long]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def without(text: pa.Array, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """Texts (none null) without the words in the ranges and the white space after them; at a text's end, also before them."""
    data = text.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    if not len(doc):
        return text
    raw, offsets = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]
    space = _SPACE[raw]
    edge = np.ones(len(raw) + 1, bool)  # whether a word may begin here: after white space, or where a text does
    edge[1:] = space
    edge[offsets] = True
    word = np.flatnonzero(~space & edge[:-1])
    zero = np.searchsorted(word, offsets[:-1])  # the first word of each text
    count = np.append(zero[1:], len(word)) - zero
    starts = np.append(word, len(raw))
    begin = starts[zero[doc] + low]
    to_end = high >= count[doc]
    end = np.where(to_end, offsets[doc + 1], starts[np.minimum(zero[doc] + high, len(word))])
    # at the end of a text the white space before the first word that goes, goes too
    solid = np.maximum.accumulate(np.where(space, -1, np.arange(len(raw))))
    before = np.append(-1, solid)[begin] + 1
    begin = np.where(to_end, np.maximum(before, offsets[doc]), begin)
    change = np.zeros(len(raw) + 1, np.int32)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    kept = np.cumsum(change[:-1]) == 0
    sums = np.append(0, np.cumsum(kept))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(text), [None, pa.py_buffer(sums[offsets].astype(np.int64)), pa.py_buffer(raw[kept])]).cast(pa.string())


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """(doc_id, key, key2, ranges): word ranges [from, to) of each document whose windows of ``run_words`` words all stand earlier, as from * 2**32 + length."""
    src = docs.select(F.col(id_col).alias("doc_id"), *_keys(id_col, text_col), F.col(text_col).alias("text"))
    own = ["doc_id", "key", "key2"]
    schema = f"doc_id {src.schema['doc_id'].dataType.simpleString()}, key long, key2 int"

    def of(b: pa.RecordBatch, at: np.ndarray) -> list[pa.Array]:
        return [column(b, c).take(pa.array(at)) for c in own]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            g = segments_of(column(b, "text"), gram_words, run_words)
            numbers = [pa.array(g[k], t) for k, t in (("print", pa.int64()), ("segment", pa.int64()), ("from", pa.int32()), ("windows", pa.int32()))]
            yield pa.RecordBatch.from_arrays([*of(b, g["doc"]), *numbers], [*own, "print", "segment", "from", "windows"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            flat, offsets = words_of(column(b, "text"))
            listed = column(b, "open")
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
            one = listed.flatten()
            count = one.field("windows").to_numpy(zero_copy_only=False).astype(np.int64)
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = np.repeat(one.field("from").to_numpy(zero_copy_only=False).astype(np.int64), count) + inner
            row = np.repeat(row, count)
            value = _rolling(flat)(offsets[row] + start, run_words)
            marks = one.field("print").take(pa.array(np.repeat(np.arange(len(count)), count)))
            yield pa.RecordBatch.from_arrays([*of(b, row), marks, pa.array(value.view(np.int64)), pa.array(start, pa.int32())], [*own, "print", "window", "from"])

    place = F.struct(F.col("doc_id").isNull().alias("no_id"), *own, F.col("from"))
    every = materialize(map_arrow(src, segments, f"{schema}, print long, segment long, `from` int, windows int"), "winnow")
    # tables of their own on one side of the joins, so that the skew of the other side can be split
    shared = materialize(every.groupBy("print").count().where("count > 1").select("print"), "winnow-shared")
    hits = materialize(every.join(shared, "print", "left_semi"), "winnow-hits")
    forget(every, shared)
    first = materialize(hits.groupBy("print", "segment", "windows").agg(F.min(place).alias("first")), "winnow-first")
    whole = hits.join(first.select("print", "segment", "first"), ["print", "segment"]).where(place != F.col("first"))
    several = materialize(first.groupBy("print").count().where("count > 1").select("print"), "winnow-several")
    unlike = first.join(several, "print", "left_semi").select("first.*", "print", "windows").groupBy(*own).agg(F.collect_list(F.struct("from", "windows", "print")).alias("open"))
    unlike = materialize(unlike.select(*[F.col(c).alias(f"o_{c}") for c in own], "open"), "winnow-open")
    read = src.join(unlike, _same("o_"), "inner").select(*own, "text", "open")
    rows = materialize(map_arrow(read, windows, f"{schema}, print long, window long, `from` int"), "winnow-windows")
    forget(several, unlike)
    # the fingerprint is part of the key: windows must agree in two hashes of 64 bits
    earliest = rows.groupBy("print", "window").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("print", "window", "first")
    earliest = materialize(earliest, "winnow-earliest")
    part = rows.join(earliest, ["print", "window"]).where(place != F.col("first"))
    # start and length in one number; start and end would give a set's hash (upper half xor lower half) the same value over and over
    span = lambda n: F.shiftleft(F.col("from").cast("long"), 32) + n + F.lit(run_words - 1)
    ranges = whole.select(*own, span(F.col("windows")).alias("range")).unionByName(part.select(*own, span(F.lit(1)).alias("range")))
    found = materialize(ranges.groupBy(*own).agg(F.collect_set("range").alias("ranges")), "winnow-ranges")
    forget(hits, first, rows, earliest)
    return found


def _keys(id_col: str, text_col: str) -> list[Column]:
    """Columns that tell rows of one doc_id apart; the second one only where there is none."""
    return [F.xxhash64(F.col(text_col)).alias("key"), F.when(F.col(id_col).isNull(), F.hash(F.col(text_col))).alias("key2")]


def _same(prefix: str, id_col: str = "doc_id") -> Column:
    return F.col(id_col).eqNullSafe(F.col(f"{prefix}doc_id")) & (F.col("key") == F.col(f"{prefix}key")) & F.col("key2").eqNullSafe(F.col(f"{prefix}key2"))


def _deduped(docs: DataFrame, id_col: str, text_col: str, gram_words: int, run_words: int) -> tuple[DataFrame, Callable[..., DataFrame], str]:
    """``docs``, sealed, with repeated runs deleted from the text, and columns cut (or null) and runs."""
    found = repeated_windows(docs, id_col, text_col, gram_words, run_words)
    found = found.select(*[F.col(c).alias(f"f_{c}") for c in ("doc_id", "key", "key2", "ranges")])
    inner, (i, t), restore = sealed(docs, id_col, text_col)

    @F.arrow_udf("struct<text: string, runs: array<struct<`from`: int, `to`: int>>>")
    def delete(text: pa.Array, ranges: pa.Array) -> pa.Array:
        rows = np.flatnonzero(pc.and_(pc.is_valid(text), pc.is_valid(ranges)).to_numpy(zero_copy_only=False))
        own, listed = text.take(pa.array(rows)), ranges.take(pa.array(rows))
        one = listed.flatten()
        row = np.repeat(np.arange(len(rows)), pc.list_value_length(listed).to_numpy(zero_copy_only=False))
        low, size = np.divmod(one.to_numpy(zero_copy_only=False).astype(np.int64), 1 << 32)
        doc, low, high = merge_ranges(row, low, low + size, run_words)
        cut = without(own, doc, low, high)
        sizes = np.append(0, np.cumsum(np.bincount(doc, minlength=len(rows)))).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], ["from", "to"])
        runs = pa.ListArray.from_arrays(pa.array(sizes), pairs)
        at = np.full(len(text), -1)
        at[rows] = np.arange(len(rows))
        back = pa.array(at, mask=at < 0)
        return pa.StructArray.from_arrays([cut.take(back), runs.take(back)], ["text", "runs"])

    delete = delete.asNondeterministic()  # or Spark may evaluate it once for each use of its result
    joined = inner.select("*", *_keys(i, t)).join(found, _same("f_", i), "left")
    cut = joined.withColumn("cut", delete(F.when(F.col("f_ranges").isNotNull(), F.col(t)), F.col("f_ranges")))
    runs = F.coalesce(F.col("cut.runs"), F.array().cast("array<struct<`from`: int, `to`: int>>"))
    text = F.when(F.size("cut.runs") > 0, F.col("cut.text")).otherwise(F.col(t))
    return cut.select(*[text.alias(c) if c == t else F.col(c) for c in inner.columns], runs.alias("runs")), restore, t


def dedup_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram_words: int = GRAM_WORDS, run_words: int = RUN_WORDS, runs_as: str = "_runs") -> DataFrame:
    """``docs`` with all repeated runs of ``run_words`` words or more deleted from the text, and a last column: what was deleted."""
    out, restore, _ = _deduped(docs, id_col, text_col, gram_words, run_words)
    return restore(out, ("runs", runs_as))


def stage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """Documents without repeated runs; those that have lost all their words go.

    A column ``chars_col``, if there is one, gets the number of characters of a text that has lost runs.
    """
    out, restore, t = _deduped(docs, id_col, text_col, GRAM_WORDS, RUN_WORDS)
    out = out.where((F.size("runs") == 0) | (F.length(t) > 0))
    if chars_col in docs.columns:
        n = f"c{docs.columns.index(chars_col)}"
        out = out.withColumn(n, F.when(F.size("runs") > 0, F.length(t).cast(out.schema[n].dataType)).otherwise(F.col(n)))
    return restore(out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the deleted runs as word ranges, and length and digest of what is left."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    out = dedup_runs(docs, runs_as="runs")
    words = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + (r["to"] - r["from"]))
    return out.select("doc_id", F.size("runs").alias("n_runs"), words.alias("n_words_deleted"), "runs", F.length("text").alias("n_chars_left"), F.md5("text").alias("text_md5"))

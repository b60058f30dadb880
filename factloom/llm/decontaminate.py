"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared with A-Z lowered and white space runs as one space, in UTF-8 bytes as
characters. A benchmark item of m characters may be found with up to k = floor(edit_rate * m)
edits. Such an occurrence shares at least m - q + 1 - k * q of its q-grams with the item, on
diagonals (document position minus item position) that lie within k of each other. So all shared
q-grams are counted in bands of 2(k + 1) diagonals that overlap by half, which hold any k + 1
neighbouring diagonals whole; bands that reach the bound are verified by banded alignment.
Before pairs are made, positions are dropped where the number of q-grams known to the benchmark
is below the lowest bound in every window that an occurrence could take up, which loses nothing.

The benchmark goes to the tasks in blocks of at most ``block_bytes`` characters (or one item, if that
is longer), one pass each, so what is sent has a fixed bound.

A document's position counts once in a band, however many places of the item hold its q-gram, and
places of one gram in an item are held by cells as wide as a band, so that repetitive texts cost a
few counts a position; counts are made ``CHUNK`` at a time, and a band is decided and forgotten as soon as the
text has passed it. Items of fewer than ``q`` characters have no edit budget and are looked up whole,
where they stand as whole words.

Rows: one per document: contaminated, item_ids (ascending), spans (item, from, to, edits; character
positions in the normalised text; places of an item that begin within an earlier one's reach are not
reported again). Defined cases: null and empty texts are clean; items without a character are never
found; items for which the bound would fall below ``min_shared`` get a smaller edit budget; null item ids
count as -1; repeated rows give equal rows; empty tables give no rows or clean rows; other columns are
kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ._shared import column, map_arrow, prepare, sealed, slices, table

Q = 10
EDIT_RATE = 0.05
MIN_SHARED = 4
BLOCK_BYTES = 2 << 20
#: Counts made at once.
CHUNK = 1 << 19
_FILTER_BITS = 22


def normalise(text: pa.Array) -> pa.Array:
    low = pc.ascii_lower(pc.fill_null(text, ""))
    return pc.ascii_trim_whitespace(pc.replace_substring_regex(low, r"[\t\n\v\f\r ]+", " "))


def codes(data: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit number for the q-gram at each byte (q of 8 to 16), padded at the end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.ndarray(len(data) + 8, dtype="<u8", buffer=padded.data, strides=(1,))
    n = len(data)
    a, b = eight[:n].copy(), eight[q - 8 : q - 8 + n].copy()
    return (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + (a >> np.uint64(29)))


def short_codes(data: np.ndarray, size: int) -> np.ndarray:
    """A number for the ``size`` bytes at each byte, fewer than 16."""
    if size >= 8:
        return codes(data, size)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data), dtype="<u8", buffer=padded.data, strides=(1,))
    return eight & np.uint64((1 << 8 * size) - 1)


@dataclass
class Items:
    """A block of benchmark items with its q-gram index: for each gram its cells, that is item and the first and last place within the cell."""

    ids: np.ndarray
    data: list[bytes]
    budget: np.ndarray
    bound: np.ndarray
    grams: np.ndarray  # sorted distinct codes
    first: np.ndarray  # their ranges in item, low and high
    item: np.ndarray
    low: np.ndarray
    high: np.ndarray
    maybe: np.ndarray  # filter by the codes' upper bits
    short: dict[int, dict[int, list[int]]]  # by size and code: items of fewer than q characters

    @classmethod
    def build(cls, ids: list[int], data: list[bytes], q: int, edit_rate: float, min_shared: int) -> Items | None:
        use = [(i, d) for i, d in zip(ids, data, strict=True) if d]
        if not use:
            return None
        m = np.array([len(d) for _, d in use])
        grams_in = np.maximum(m - q + 1, 0)
        least = np.minimum(min_shared, grams_in)
        budget = np.where(grams_in > 0, np.minimum((edit_rate * m).astype(np.int64), (grams_in - least) // q), 0)
        short: dict[int, dict[int, list[int]]] = {}
        for k in np.flatnonzero(grams_in == 0).tolist():
            code = int(short_codes(np.frombuffer(use[k][1], np.uint8), int(m[k]))[0])
            short.setdefault(int(m[k]), {}).setdefault(code, []).append(k)
        none = np.zeros(0, np.uint64)
        code = np.concatenate([none, *(codes(np.frombuffer(d, np.uint8), q)[: len(d) - q + 1] for _, d in use if len(d) >= q)])
        item = np.repeat(np.arange(len(use)), grams_in)
        pos = np.arange(len(code)) - np.repeat(np.cumsum(grams_in) - grams_in, grams_in)
        cell = pos // (budget[item] + 1)
        order = np.lexsort((pos, cell, item, code))
        code, item, pos, cell = code[order], item[order], pos[order], cell[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])
        start = np.flatnonzero(new)
        grams, first = np.unique(code[start], return_index=True)
        maybe = np.zeros(1 << _FILTER_BITS, bool)
        maybe[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        high = pos[np.append(start[1:], len(code)) - 1] if len(start) else pos
        small = lambda x: x.astype(np.int32)  # noqa: E731  a block's index takes about 24 bytes a character
        return cls(np.array([i for i, _ in use]), [d for _, d in use], budget, grams_in - budget * q, grams, small(np.append(first, len(start))), small(item[start]), small(pos[start]), small(high), maybe, short)


def align(item: bytes, text: bytes, budget: int, low: int, high: int) -> tuple[int, int, int] | None:
    """(edits, from, to) of the best place of ``item`` on the diagonals ``low`` to ``high - 1`` of ``text``, if it needs at most ``budget`` edits.

    Dynamic programming row by row over the item, a cell for each diagonal (place in the text minus place in the item), free at both ends of the text.
    """
    n, m = len(text), len(item)
    exact = text.find(item, max(0, low), max(0, high - 1 + m))
    if exact >= 0:
        return 0, exact, exact + m
    if not budget:
        return None
    width = high - low
    steps = np.arange(width)
    left = max(0, -low)
    t = np.full(left + max(n, high + m) + 1, -1, np.int16)
    t[left : left + n] = np.frombuffer(text, np.uint8)
    none = n + m + 1
    origin = low + steps
    cost = np.where((origin >= 0) & (origin <= n), 0, none)
    for i, ch in enumerate(item, 1):
        at = left + i - 1 + low
        diagonal = cost + (t[at : at + width] != ch)
        skipped = np.append(cost[1:] + 1, none)
        better = skipped < diagonal
        new, source = np.where(better, skipped, diagonal), np.where(better, np.append(origin[1:], 0), origin)
        # characters of the text that the item lacks run along the row: a running minimum of cost minus place
        ahead = np.minimum.accumulate(new - steps)
        at = np.maximum.accumulate(np.where(new - steps == ahead, steps, 0))
        cost, origin = ahead + steps, source[at]
        cost[max(0, n - i - low + 1) :] = none
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), m + low + end


_WORD = np.zeros(257, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def search_short(data: np.ndarray, offsets: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """Places of the items of fewer than q characters, as whole words."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    word = _WORD[data]
    inner = np.zeros(len(data) + 1, bool)  # whether a place parts two characters of one word
    inner[1:-1] = word[1:] & word[:-1] & (doc[1:] == doc[:-1])
    for size, listed in items.short.items():
        at = np.flatnonzero(~inner[: len(data) - size + 1] & ~inner[size:]) if size <= len(data) else np.zeros(0, np.int64)
        at = at[doc[at] == doc[at + size - 1]]
        code = short_codes(data, size)[at]
        for k in np.flatnonzero(np.isin(code, np.array(list(listed), np.uint64))).tolist():
            found, d = data[at[k] : at[k] + size].tobytes(), int(doc[at[k]])
            for i in listed[int(code[k])]:
                if items.data[i] == found:
                    begin = int(at[k] - offsets[d])
                    yield d, i, begin, begin + size, 0


def search(data: np.ndarray, offsets: np.ndarray, items: Items, q: int, chunk: int = CHUNK) -> list[tuple[int, int, int, int, int]]:
    """(document, item, from, to, edits) over texts that stand in a row, cut at ``offsets``."""
    n = len(data)
    out = list(search_short(data, offsets, items)) if n and items.short else []
    if n < q or not len(items.grams):
        return out
    code = codes(data, q)
    doc_end = np.repeat(offsets[1:], np.diff(offsets))
    at = np.flatnonzero(items.maybe[(code >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    at = at[at + q <= doc_end[at]]
    slot = np.searchsorted(items.grams, code[at])
    known = items.grams[np.minimum(slot, len(items.grams) - 1)] == code[at]
    at, slot = at[known], slot[known]
    if not len(at):
        return out
    # an occurrence of any item takes up at most the longest item and its budget: too few known q-grams around rule it out
    size = np.array([len(d) for d in items.data])
    reach = int(size.max() + items.budget.max())
    least = int(items.bound[size >= q].min())
    if least > 1:
        j = np.arange(len(at))
        ahead = np.minimum(j + least - 1, len(at) - 1)
        opens = (j + least - 1 < len(at)) & (at[ahead] - at <= reach)  # a window with enough of them begins here
        count = np.zeros(len(at) + 1, np.int64)
        last = np.searchsorted(at, at[opens] + reach, side="right")
        np.add.at(count, j[opens], 1)
        np.add.at(count, last, -1)
        dense = np.cumsum(count[:-1]) > 0
        at, slot = at[dense], slot[dense]
    times = items.first[slot + 1] - items.first[slot]
    upto = np.cumsum(times)
    shift = n + int(size.max())  # of diagonals, as they may be below zero
    n_items, n_bands = len(items.data), n + shift + 2
    texts: dict[int, bytes] = {}
    passed: dict[tuple[int, int], int] = {}  # where the last place found of an item in a document ends

    def verify(keys: np.ndarray) -> None:
        """Bands that reach the bound, in rising order."""
        for key in keys.tolist():
            key, b = divmod(key, n_bands)
            d, i = divmod(key, n_items)
            w, zero = int(items.budget[i]) + 1, int(offsets[d])
            low = (b - 1) * w - shift - zero
            if low + 2 * w <= passed.get((d, i), 0):
                continue
            if d not in texts:
                texts.clear()
                texts[d] = data[zero : int(offsets[d + 1])].tobytes()
            found = align(items.data[i], texts[d], w - 1, low, low + 2 * w)
            if found:
                edits, lo, hi = found
                out.append((d, i, lo, hi, edits))
                passed[d, i] = hi

    open_keys, open_counts, begin = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    while begin < len(at):
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + chunk, side="right")))
        reps = times[begin:end]
        place = np.repeat(items.first[slot[begin:end]] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
        own = np.repeat(np.arange(end - begin), reps)
        here, item = at[begin:end][own], items.item[place]
        width = items.budget[item] + 1
        # narrow bands of k + 1 diagonals; band b holds the narrow ones b - 1 and b
        upper, lower = (here - items.low[place] + shift) // width, (here - items.high[place] + shift) // width
        two = upper > lower
        band = np.concatenate([lower, lower + 1, upper[two] + 1])
        own, item = np.concatenate([own, own, own[two]]), np.concatenate([item, item, item[two]])
        base = (at[begin:end][own] + shift) // (items.budget[item] + 1) + 1  # the highest band of the position
        span = int((base - band).max()) + 1
        once = np.unique((own * n_items + item) * span + (base - band))
        pair, back = np.divmod(once, span)
        own, item = np.divmod(pair, n_items)
        here = at[begin:end][own]
        band = (here + shift) // (items.budget[item] + 1) + 1 - back
        doc = np.searchsorted(offsets, here, side="right") - 1
        keys, counts = np.unique((doc * n_items + item) * n_bands + band, return_counts=True)
        keys, counts = np.concatenate([open_keys, keys]), np.concatenate([open_counts, counts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        keys, counts = keys[start], np.add.reduceat(counts, start)
        pair, band = np.divmod(keys, n_bands)
        doc, item = np.divmod(pair, n_items)
        # what comes later lies on diagonals from the present place less the item's length on, or in later documents
        now = int(at[end - 1])
        done = (doc < np.searchsorted(offsets, now, side="right") - 1) | (band < (now - size[item] + shift) // (items.budget[item] + 1))
        if end == len(at):
            done[:] = True
        verify(keys[done & (counts >= items.bound[item])])
        open_keys, open_counts, begin = keys[~done], counts[~done], end
    return out


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[int], list[bytes]]]:
    """The benchmark's items, normalised, in blocks of bounded size; the driver holds one block at a time."""
    ids, data, size = [], [], 0
    for r in benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        d = normalise(pa.array([r.t], pa.string()))[0].as_py().encode()
        if ids and size + len(d) > block_bytes:
            yield ids, data
            ids, data, size = [], [], 0
        ids.append(-1 if r.i is None else int(r.i))
        data.append(d)
        size += len(d)
    if ids:
        yield ids, data


SPAN = StructType([StructField(c, LongType()) for c in ("item_id", "from", "to", "edits")])


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", q: int = Q, edit_rate: float = EDIT_RATE, min_shared: int = MIN_SHARED, block_bytes: int = BLOCK_BYTES, spans_as: str = "_spans") -> DataFrame:
    """``docs`` with a last column of the benchmark passages in each text."""
    inner, (t,), restore = sealed(docs, text_col)
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in SPAN.names]))
    names = [*inner.columns, "spans", "new"]
    schema = StructType([*inner.schema.fields, StructField("spans", ArrayType(SPAN)), StructField("new", ArrayType(SPAN))])
    out = inner.withColumn("spans", F.array().cast(ArrayType(SPAN)))
    for ids, data in blocks_of(benchmark, item_col, item_text, block_bytes):
        items = Items.build(ids, data, q, edit_rate, min_shared)
        if items is None:
            continue
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, "text"):
                text = normalise(column(b, "text")).cast(pa.large_binary())
                offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
                lists: list[list] = [[] for _ in range(b.num_rows)]
                if len(text) and offsets[-1] > offsets[0]:
                    data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
                    for d, i, lo, hi, edits in search(data, offsets - offsets[0], shared.value, q):
                        lists[d].append({"item_id": int(shared.value.ids[i]), "from": lo, "to": hi, "edits": edits})
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(b.num_columns - 1)), pa.array(lists, kind)], names)

        got = map_arrow(out.select(*inner.columns, "spans", F.col(t).alias("text")), run, schema)
        out = got.select(*inner.columns, F.array_sort(F.concat("spans", "new")).alias("spans"))
    return restore(out, ("spans", spans_as))


def stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark passage."""
    inner, (t,), restore = sealed(docs, "text")
    return restore(find_leaks(inner, benchmark, t, spans_as="spans").where(F.size("spans") == 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    out = find_leaks(docs, table(spark, sf_dir, "benchmark"), spans_as="spans")
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"])))
    return out.select("doc_id", (F.size("spans") > 0).alias("contaminated"), items.alias("item_ids"), "spans")

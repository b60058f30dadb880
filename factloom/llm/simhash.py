"""SimHash near-duplicates: 3-word shingles, XXH64 fingerprints, pivot distance tables, components.

Rows: one per document, with its fingerprint and the smallest doc_id that it reaches over links
of at most ``max_bits`` differing bits. Defined cases: null or empty text and text without words
have fingerprint zero, which links like any other; repeated rows keep one row each; a null doc_id
gets its group's smallest id (null if the group has none); other columns are never read; an empty
table gives an empty result.

How pairs are found. Equal fingerprints are collapsed first, so copies cost one row each. Two
fingerprints with at most 3 differing bits agree in one of 4 blocks of 16 bits (pigeonhole), so
rows meet by (block, value); pivot distances alone can't deal rows out to tasks without nearly
all pairs, as distances to a reference concentrate at 32 +- 4. Inside such a group the pivot table
does the work: Hamming distances to the pivots are precomputed, rows are sorted by the first and
compared only within ``max_bits`` of it, pairs whose largest coordinate difference is over
``max_bits`` are discarded, and survivors are verified bit by bit. A group hands on only a
spanning forest of its links, never its pairs. A group that is still too large is dealt again by
blocks of its remaining bits, which loses no pair either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import column, forget, map_arrow, materialize, prepare, sealed, slices, table, words_of

SEED = 42
SHINGLE = 3
MAX_BITS = 3
PIVOTS = 24
#: A (block, value) group with more distinct fingerprints is dealt out again by its other bits.
GROUP_LIMIT = 20_000


def _pivots(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(20_231).integers(0, 2**64, n, dtype=np.uint64)


#: Fixed values of XXH64: its five primes.
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Longer strings are hashed one by one.
_LONG = 256


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P2, 31) * _P1


def xxh64_spans(data: bytes, begin: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of ``data[begin : begin + size]`` for all spans, those of one size at once."""
    out = np.empty(len(begin), np.uint64)
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)])
    eight = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded.data, strides=(1,))
    kind = np.minimum(size, _LONG + 1).astype(np.int16)
    order = np.argsort(kind, kind="stable")
    cuts = np.flatnonzero(np.diff(kind[order])) + 1
    for own in np.split(order, cuts) if len(order) else ():
        n, at = int(kind[own[0]]), begin[own]
        if n > _LONG:
            ends = at + size[own]
            out[own] = [xxhash.xxh64_intdigest(data[a:b], seed) for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
            continue
        start = np.full(len(own), seed, np.uint64)
        if n >= 32:
            acc = [start + _P1 + _P2, start + _P2, start, start - _P1]
            for stripe in range(n // 32):
                acc = [_round(v, eight[at + (32 * stripe + 8 * k)]) for k, v in enumerate(acc)]
            h = sum((_turn(v, k) for v, k in zip(acc[1:], (7, 12, 18), strict=True)), _turn(acc[0], 1))
            for v in acc:
                h = (h ^ _round(np.uint64(0), v)) * _P1 + _P4
        else:
            h = start + _P5
        h = h + np.uint64(n)
        done = n - n % 32
        while n - done >= 8:
            h = _turn(h ^ _round(np.uint64(0), eight[at + done]), 27) * _P1 + _P4
            done += 8
        if n > done:
            rest = eight[at + done]
            if n - done >= 4:
                h = _turn(h ^ (rest & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
                rest = rest >> np.uint64(32)
                done += 4
            for _ in range(n - done):
                h = _turn(h ^ (rest & np.uint64(0xFF)) * _P5, 11) * _P1
                rest = rest >> np.uint64(8)
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        out[own] = h ^ (h >> np.uint64(32))
    return out


def shingle_hashes(text: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the k-word shingles of all texts in a row, repeats included (of the whole text if it has fewer words), and each text's offsets into them.

    Words joined by one space each make every shingle a span of the joined text.
    """
    flat, offsets = words_of(text, lower=True)
    n = np.diff(offsets)
    count = np.where(n, np.maximum(n - (k - 1), 1), 0)
    ends = np.concatenate([[0], np.cumsum(count)])
    if not len(flat):
        return np.zeros(0, np.uint64), ends
    joined = pc.binary_join(pa.LargeListArray.from_arrays(offsets, flat), " ").cast(pa.large_binary())
    texts = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1]
    size = pc.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(size) - size
    full = np.concatenate([[0], np.cumsum(n > 0)])[:-1]  # each text that has words has one space fewer than words
    begin = before + np.arange(len(size)) - np.repeat(full, n)
    first = np.repeat(offsets[:-1], count) + np.arange(int(ends[-1])) - np.repeat(ends[:-1], count)
    last = np.minimum(first + k, np.repeat(offsets[1:], count)) - 1
    assert texts[0] == 0
    return xxh64_spans(joined.buffers()[2].to_pybytes(), begin[first], begin[last] + size[last] - begin[first]), ends


def majority_bits(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A fingerprint per segment: a bit is set if it is set in over half of the segment's hashes."""
    n = np.diff(offsets)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    blocks = -(-n[full] // 255)  # eight counters in a 64-bit number hold up to 255 each
    first = np.cumsum(blocks) - blocks
    inner = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
    starts = np.repeat(offsets[:-1][full], blocks) + 255 * inner
    half = n[full].astype(np.int64)
    for lane in range(8):
        ones = (hashes >> np.uint64(lane)) & np.uint64(0x0101010101010101)
        per_block = np.add.reduceat(ones, starts).view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts = np.add.reduceat(per_block, first, axis=0)
        for byte in range(8):
            out[full] |= (2 * counts[:, byte] > half).astype(np.uint64) << np.uint64(8 * byte + lane)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): fp is the 64-bit fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            fp = majority_bits(*shingle_hashes(column(b, "text")))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "text_hash"), pa.array(fp.view(np.int64))], ["doc_id", "text_hash", "fp"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return map_arrow(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_hash long, fp long")


def _root(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = parent[up]


def pivot_forest(group: np.ndarray, fp: np.ndarray, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as index pairs, of the links within each group. Distinct fingerprints per group."""
    first = np.bitwise_count(fp ^ pivots[0])
    order = np.lexsort((fp, first, group))
    group, fp = group[order], fp[order]
    coords = np.stack([np.bitwise_count(fp ^ p) for p in pivots]).astype(np.int8)
    parent = np.arange(len(fp))
    a, b = [], []
    live, shift = np.arange(len(fp)), 1
    while len(live):
        live = live[live + shift < len(fp)]
        far = live + shift
        # rows are sorted by group and first coordinate: beyond either, no later row can match
        live = live[(group[live] == group[far]) & (coords[0, far] - coords[0, live] <= max_bits)]
        i, j = live, live + shift
        for c in coords[1:]:
            ok = np.abs(c[i] - c[j]) <= max_bits
            i, j = i[ok], j[ok]
        ok = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
        i, j = i[ok], j[ok]
        if len(i):
            ri, rj = _root(parent, i), _root(parent, j)
            for x, y in zip(i[ri != rj].tolist(), j[ri != rj].tolist(), strict=True):
                px, py = x, y
                while parent[px] != px:
                    px = parent[px]
                while parent[py] != py:
                    py = parent[py]
                if px != py:
                    parent[max(px, py)] = min(px, py)
                    a.append(x)
                    b.append(y)
        shift += 1
    return order[np.array(a, dtype=np.int64)], order[np.array(b, dtype=np.int64)]


def _blocks(bits: list[int]) -> list[list[int]]:
    """Four blocks of the given bit positions."""
    n = len(bits)
    return [bits[i * n // 4 : (i + 1) * n // 4] for i in range(4)]


def _keys(fp: str, level: int, max_bits: int) -> list:
    """Key expressions: (path of blocks, their values). A level adds a block among the bits not yet fixed."""

    def extend(path: str, fixed: int, free: list[int], left: int) -> list:
        if not left:
            return [F.struct(F.lit(path).alias("path"), (F.col(fp).bitwiseAND(F.lit(fixed))).alias("value"))]
        out = []
        for k, block in enumerate(_blocks(free)):
            mask = 0
            for bit in block:
                mask |= 1 << bit
            signed = (fixed & (2**64 - 1)) | mask
            signed -= 2**64 if signed >= 2**63 else 0
            out += extend(f"{path}{k}", signed, [x for x in free if x not in block], left - 1)
        return out

    assert max_bits <= 3, "four blocks find pairs of at most three differing bits"
    return extend("", 0, list(range(64)), level)


def links(fps: DataFrame, max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT, used: list[DataFrame] | None = None) -> DataFrame:
    """(a, b): links that connect, group by group, all distinct fingerprints ``fp`` within ``max_bits`` bits. ``used`` gets the scratch tables that this reads."""
    pivots = _pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, schema = 0, None
        for b in batches:
            schema = schema or b.schema
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows < 200_000:
                continue
            t = pa.Table.from_batches(held)
            last = t.num_rows - 1
            edge = (pc.field("path") == t["path"][last]) & (pc.field("value") == t["value"][last])
            done, rest = t.filter(~edge), t.filter(edge)  # sorted, so the last group is at the end
            if done.num_rows:
                yield solve(done)
            held, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield solve(pa.Table.from_batches(held))

    def solve(t: pa.Table) -> pa.RecordBatch:
        path = np.asarray(t["path"].combine_chunks().dictionary_encode().indices).astype(np.uint64)
        value, fp = t["value"].to_numpy().view(np.uint64), t["fp"].to_numpy().view(np.uint64)
        pairs = np.rec.fromarrays([path, value])
        _, group = np.unique(pairs, return_inverse=True)
        i, j = pivot_forest(group, fp, max_bits, pivots)
        return pa.RecordBatch.from_arrays([pa.array(fp[i].view(np.int64)), pa.array(fp[j].view(np.int64))], ["a", "b"])

    out, rest, level = None, fps.select("fp"), 1
    while True:
        keyed = rest.select("fp", F.explode(F.array(*_keys("fp", level, max_bits))).alias("k")).select("fp", "k.path", "k.value")
        hot = None
        if level < 3:
            sizes = keyed.groupBy("path", "value").count().where(F.col("count") > group_limit)
            hot = materialize(sizes.select("path", "value"), "simhash-hot")
            if hot.isEmpty():
                forget(hot)
                hot = None
            elif used is not None:
                used.append(hot)
        if hot is not None:
            small = F.broadcast(hot) if hot.count() <= 10_000 else hot
            rest = keyed.join(small, ["path", "value"], "left_semi").select("fp").distinct()
            keyed = keyed.join(small, ["path", "value"], "left_anti")
        found = map_arrow(keyed.repartition("path", "value").sortWithinPartitions("path", "value"), run, "a long, b long")
        out = found if out is None else out.unionByName(found)
        if hot is None:
            return out.distinct()
        level += 1


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node of each node's component, by alternating large and small stars.

    Every round only aggregates by node and joins by node; nothing is gathered.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = materialize(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc")
        state = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        forget(edges)
        edges = new
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per document: doc_id, fp and component_id (smallest doc_id reachable, itself included)."""
    fps = materialize(fingerprints(docs, id_col, text_col), "simhash")
    groups = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-groups")
    used: list[DataFrame] = []
    roots = components(links(groups, max_bits, group_limit, used))
    joined = groups.join(roots, groups["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = joined.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    found = materialize(fps.join(named, "fp", "left").select("doc_id", "fp", "component_id", "root", "text_hash"), "simhash-found")
    forget(fps, groups, roots, *used)
    return found


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group that with the smallest doc_id (null last), and of repeated rows one."""
    found = near_duplicates(docs, id_col, text_col, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    stay = materialize(found.groupBy("root").agg(F.min(order).alias("s")).select(F.col("s.doc_id").alias("stay_id"), F.col("s.text_hash").alias("stay_hash")), "simhash-stay")
    repeated = not found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    forget(found)
    inner, (i, t), restore = sealed(docs, id_col, text_col)
    marked = inner.withColumn("hash", F.xxhash64(t))
    out = marked.join(stay, F.col(i).eqNullSafe(F.col("stay_id")) & (F.col("hash") == F.col("stay_hash")), "left_semi")
    if repeated:
        out = out.dropDuplicates([i, "hash"])
    return restore(out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

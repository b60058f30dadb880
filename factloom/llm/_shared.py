"""Helpers that the training-data operators share: inputs, scratch tables and word arrays."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Texts are handled in slices of about so many bytes, which bounds a Python worker's memory.
SLICE_BYTES = 3_000_000
#: Settings that the queries and the pipeline run under. Batches for Python workers are small, as whole texts are in
#: them (Spark's default of 10,000 rows takes much memory); the WARC source's filters are pushed down; a join whose
#: partitions on one side are all small, as measured when it runs, hashes that side and sorts neither.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Put ``SETTINGS`` on a session: for the queries and the pipeline, which own theirs. Operators leave a session as it is."""
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    return spark


#: What a worker keeps between tasks, by the operator that it serves; another operator's task clears it.
CACHES: dict[str, Callable[[], None]] = {}


def give_back() -> None:
    """Hand memory that is free back to the system: a worker lives on, and its neighbours need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def map_arrow(df: DataFrame, run, schema, keeps: str | None = None) -> DataFrame:
    """``mapInArrow`` whose tasks leave no memory behind but the cache that they name."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, clear in CACHES.items():
            if name != keeps:
                clear()
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables, read by Spark alone (the path may be any Hadoop file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sealed(df: DataFrame, *used: str) -> tuple[DataFrame, list[str], Callable[..., DataFrame]]:
    """``df`` with its columns renamed c0, c1 and so on, so that none clashes with a column of an operator.

    Also the new names of the columns ``used``, and a function that gives a result its columns' old names
    back (any further columns it has are named after them, in its ``more``).
    """
    names = df.columns
    inner = df.toDF(*[f"c{k}" for k in range(len(names))])

    def restore(out: DataFrame, *more: tuple[str, str]) -> DataFrame:
        return out.select(*inner.columns, *[c for c, _ in more]).toDF(*names, *[n for _, n in more])

    return inner, [f"c{names.index(u)}" for u in used], restore


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is made and set if all runs in one process; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="factloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the application's scratch folder, which goes when the application ends."""
    root = f"{shared_dir(spark).rstrip('/')}/factloom-{spark.sparkContext.applicationId}"
    p, fs = _path(spark, root)
    if not fs.exists(p):
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def forget(*tables: DataFrame) -> None:
    """Delete the files of materialized tables once nothing reads them any more."""
    for df in tables:
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            drop_path(df.sparkSession, folder)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice take about ``max_bytes`` (one long text stays whole)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(column(batch, text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // max_bytes
        cuts = np.flatnonzero(np.diff(part)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(lo, hi - lo)


def words_of(text: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and each text's offsets into them (null: none)."""
    text = pc.fill_null(text, "")
    if lower:
        text = pc.ascii_lower(text)
    split = pc.ascii_split_whitespace(text)
    flat = split.flatten()
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    full = pc.greater(pc.binary_length(flat), 0)
    if pc.all(full).as_py() is False:
        keep = full.to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        flat = flat.filter(full)
    return flat, offsets


def segment_ids(offsets: np.ndarray) -> np.ndarray:
    """The row that each element belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def segment_sum(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (Stafford's variant 13)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_strings(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of every string: a polynomial over its bytes and its length, mixed."""
    data = values.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    size = np.diff(offsets)
    out = mix64(size.astype(np.uint64) + np.uint64(0x51ED270B))
    full = np.flatnonzero(size)
    if len(full):
        raw = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        begin = offsets[:-1] - offsets[0]
        power = np.full(int(size.max()), 0x9FB21C651E98DF25, np.uint64)
        power[0] = 1
        power = np.cumprod(power, dtype=np.uint64)
        inner = np.arange(len(raw)) - np.repeat(begin, size)
        out[full] = mix64(out[full] ^ np.add.reduceat((raw + np.uint64(1)) * power[inner], begin[full]))
    return out

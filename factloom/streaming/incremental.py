"""Incremental loading: what is new, state of what is loaded, sessions, run windows, gaps, retention."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.lineage import drop_path, in_blocks, scratch_path


def new_items(items: DataFrame, *states: DataFrame, key: str = "name", offset: int = 0, limit: int | None = None) -> DataFrame:
    """Items whose name is in none of the states; a slice of them in the order of names on request."""
    for s in states:
        items = items.join(s.select(key), key, "left_anti")
    if offset or limit is not None:
        items = items.orderBy(key).offset(offset)
        items = items if limit is None else items.limit(limit)
    return items


def loaded(spark: SparkSession, state_path: str, key: str = "name") -> DataFrame:
    """Names that the state has; none before the first run."""
    try:
        return spark.read.schema(f"{key} string").parquet(state_path).distinct()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{key} string")


@contextmanager
def single_writer(spark: SparkSession, state_path: str):
    """Holds the state for one writer: a file beside it that only one can create. A second one gets an error; a lock that a dead writer left is removed by hand."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(state_path.rstrip("/") + ".lock")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path.getParent())
    try:
        fs.create(path, False).close()
    except Exception as e:
        raise RuntimeError(f"{state_path} has another writer, or a dead one has left {path}") from e
    try:
        yield
    finally:
        fs.delete(path, False)


def load_batch(items: DataFrame, load: Callable[[DataFrame, str], None], state_path: str, key: str = "name") -> int:
    """Load what is new and commit its names after the load; the number of new items.

    ``load`` gets the rows and the run's id, a digest of their names: writing to a folder of that name, and
    over what is there, makes the load idempotent. A run that failed between load and commit is done again
    under the same id, so nothing is loaded twice. One writer at a time.
    """
    spark = items.sparkSession
    with single_writer(spark, state_path):
        new = new_items(items, loaded(spark, state_path, key), key=key).dropDuplicates([key]).persist()
        try:
            run = new.agg(F.count("*").alias("n"), F.hex(F.bit_xor(F.xxhash64(key))).alias("id")).first()
            if run.n:
                load(new, f"{run.id}-{run.n}")
                new.select(F.col(key).cast("string").alias(key)).coalesce(1 + run.n // 1_000_000).write.mode("append").parquet(state_path)
            return run.n
        finally:
            new.unpersist()


def compact_state(spark: SparkSession, state_path: str, key: str = "name") -> None:
    """The state's many small files as few: written beside it, then put in its place."""
    names = loaded(spark, state_path, key)
    fresh = state_path.rstrip("/") + ".new"
    with single_writer(spark, state_path):
        names.repartition(1 + names.count() // 1_000_000).write.mode("overwrite").parquet(fresh)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = path(fresh).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path(state_path), True)
        fs.rename(path(fresh), path(state_path))


def load_in_batches(items: DataFrame, load: Callable[[DataFrame, str], None], state_path: str, size: int = 12, key: str = "name", workers: int = 1) -> list[tuple[int, int, str | None]]:
    """(batch, items, error) of each batch of about ``size`` new items. A batch that fails is reported and not committed, and the next one is loaded; a rerun takes it up again.

    What is new is found once, under a lock that is held to the end, and staged in a folder a batch, so that a batch costs
    the same however many there are. ``workers``: batches that are loaded at a time, from as many threads; ``load`` must
    allow for that. Names are committed after their batch's load, those of batches that end together in one write. If
    the process dies, up to ``workers`` batches are loaded and not committed, and come again in batches with other ids.
    """
    spark = items.sparkSession
    with single_writer(spark, state_path):
        new = new_items(items, loaded(spark, state_path, key), key=key).dropDuplicates([key]).persist()
        staged = scratch_path(spark, "new-items")
        try:
            batches = -(-new.count() // size)
            numbered = new.withColumn("_batch", F.pmod(F.xxhash64(key), F.lit(max(1, batches))))
            runs = {r["_batch"]: r for r in numbered.groupBy("_batch").agg(F.count("*").alias("n"), F.hex(F.bit_xor(F.xxhash64(key))).alias("id")).collect()}  # a row a batch
            if batches:
                numbered.repartition("_batch").write.partitionBy("_batch").parquet(staged)
            new.unpersist()
            commit = _Commits(lambda some: _rows_of(spark, items, staged, some).select(F.col(key).cast("string").alias(key)).coalesce(1 + sum(runs[b].n for b in some) // 1_000_000).write.mode("append").parquet(state_path))

            def one(b: int) -> tuple[int, int, str | None]:
                if b not in runs:
                    return b, 0, None
                try:
                    load(_rows_of(spark, items, staged, [b]), f"{runs[b].id}-{runs[b].n}")
                    commit(b)
                    return b, runs[b].n, None
                except Exception as e:
                    return b, runs[b].n, f"{type(e).__name__}: {e}".splitlines()[0][:200]

            if workers == 1:
                return [one(b) for b in range(batches)]
            pool = ThreadPoolExecutor(workers)
            try:
                return list(pool.map(inheritable_thread_target(spark)(one), range(batches)))
            finally:
                pool.shutdown(cancel_futures=True)
        finally:
            new.unpersist()
            drop_path(spark, staged)


def _rows_of(spark: SparkSession, items: DataFrame, staged: str, batches: list[int]) -> DataFrame:
    return spark.read.schema(items.schema).parquet(*[f"{staged}/_batch={b}" for b in batches])


class _Commits:
    """Commits from several threads: one writes at a time, and what came in the meantime goes with the next write."""

    def __init__(self, write: Callable[[list[int]], None]):
        self.write, self.turn, self.waiting, self.outcome = write, Lock(), deque(), {}

    def __call__(self, batch: int) -> None:
        self.waiting.append(batch)
        with self.turn:
            if batch not in self.outcome:  # else another one's write had it
                some = [self.waiting.popleft() for _ in range(len(self.waiting))]
                try:
                    self.write(some)
                    self.outcome |= dict.fromkeys(some)
                except Exception as e:
                    self.outcome |= dict.fromkeys(some, e)
        if self.outcome[batch] is not None:
            raise self.outcome[batch]


def incremental_load(source: DataFrame, load: Callable[[DataFrame, str], None], state_path: str, checkpoint: str, key: str = "name") -> StreamingQuery:
    """The nightly load as a stream: all that has come, once; loads are idempotent by name."""

    def batch(df: DataFrame, _: int) -> None:
        load_batch(df, load, state_path, key)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, gap: str = "2 hours", key: str = "user_id", ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """(key, start, end, events): sessions that close after a gap. Works on tables and, with a watermark, on streams."""
    if watermark:
        events = events.withWatermark(ts, watermark)
    by = events.groupBy(key, F.session_window(ts, gap).alias("s"))
    return by.agg(F.count("*").alias("events")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events")


def daily(events: DataFrame, ts: str = "ts", watermark: str | None = None, *keys: str) -> DataFrame:
    """(day, keys, events, total value) in tumbling windows of a day."""
    if watermark:
        events = events.withWatermark(ts, watermark)
    out = events.groupBy(F.window(ts, "1 day").alias("w"), *keys).agg(F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
    return out.select(F.col("w.start").alias("day"), *keys, "events", "total")


def closed_only(items: DataFrame, now: Column, hours: float = 2, last: str = "last_ts") -> DataFrame:
    """Items that nothing was added to for so many hours."""
    return items.where(F.col(last) < now - F.make_dt_interval(hours=F.lit(int(hours)), mins=F.lit(int(hours * 60) % 60)))


def changed_items(items: DataFrame, state: DataFrame, key: str = "sid", digest: str = "hash") -> DataFrame:
    """Items that are new, or whose content hash differs from the state's."""
    return items.join(state.select(key, digest), [key, digest], "left_anti")


def gaps(events: DataFrame, seconds: int = 600, key: str = "user_id", ts: str = "ts", order: str = "event_id") -> DataFrame:
    """Events that come more than ``seconds`` after the one before of their key, with the gap. A key with most of the events is dealt out in blocks."""
    rows = in_blocks(events, key, ts, order)
    ends = rows.groupBy(key, "_block").agg(F.max(ts).alias("_last"))
    over = Window.partitionBy(key).orderBy("_block")
    ends = ends.select(F.col(key).alias("_k"), F.col("_block").alias("_b"), F.lag("_last").over(over).alias("_before"))
    joined = rows.join(ends, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_block") == F.col("_b")))
    before = F.coalesce(F.lag(ts).over(Window.partitionBy(key, "_block").orderBy(ts, order)), F.col("_before"))
    out = joined.withColumn("gap", F.timestamp_diff("SECOND", before, F.col(ts))).where(F.col("gap") > seconds)
    return out.drop("_k", "_b", "_before", "_block")


def moving_average(df: DataFrame, value: str, key: str, order: list[str], n: int = 10) -> DataFrame:
    """Mean of the last n values, per key."""
    return df.withColumn("mean", F.avg(value).over(Window.partitionBy(key).orderBy(*order).rowsBetween(-(n - 1), 0)))


def keep_newest(df: DataFrame, n: int, key: str, order: list[Column]) -> DataFrame:
    """``df`` with keep: whether the row is among the n newest of its key."""
    return df.withColumn("keep", F.row_number().over(Window.partitionBy(key).orderBy(*order)) <= n)


def retry(run: Callable[[int], None], sizes: tuple[int, ...] = (12, 12, 6)) -> int:
    """Run with a batch size, again after a failure, with smaller batches at last; the attempt that succeeded."""
    for attempt, size in enumerate(sizes, 1):
        try:
            run(size)
            return attempt
        except Exception:
            if attempt == len(sizes):
                raise
    return 0


def run_errors(log: DataFrame, marker: int, pattern: str = r"(?i)error|traceback", seq: str = "seq", line: str = "line") -> DataFrame:
    """One row: error lines after a marker."""
    return log.where(F.col(seq) > marker).agg(F.count_if(F.col(line).rlike(pattern)).alias("errors"))


def stateful_digests(rows: DataFrame, key: str = "sid", digest: str = "hash") -> DataFrame:
    """A stream's rows whose hash differs from the last one of their key; state is one hash per key."""
    from collections.abc import Iterator

    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        out = []
        for frame in frames:
            for h in frame[digest]:
                if h != last:
                    out.append((k[0], h))
                    last = h
        if last is not None:
            state.update((last,))
        if out:
            yield pd.DataFrame(out, columns=[key, digest])

    kind = rows.schema[key].dataType.simpleString()
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, {digest} string", f"{digest} string", "append", GroupStateTimeout.NoTimeout)


def register_sql_views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Tables of a folder as temporary views."""
    for n in names:
        spark.read.parquet(f"{sf_dir}/{n}.parquet").createOrReplaceTempView(n)

"""Sinks: episodes, state, undo logs, communities, snapshots, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_episodes(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_state(names: DataFrame, path: str, key: str = "name") -> None:
    """Names that a load has taken, after it succeeded."""
    names.select(key).distinct().write.mode("append").parquet(path)


def append_usage(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_notes(df: DataFrame, path: str) -> None:
    """Clean copies of notes, with name and time as columns; stale ones go."""
    df.select("file", "modified_at", "text").write.mode("overwrite").parquet(path)


def write_note_files(df: DataFrame, folder: str) -> int:
    """Clean copies of notes as files of their names, with their times; stale copies go. The number of files.

    The driver writes them one by one, through the folder's file system, and holds one partition of notes.
    """
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    fs.delete(root, True)
    fs.mkdirs(root)
    rows = df.select("file", F.unix_timestamp("modified_at").alias("at"), "text")
    n = 0
    for r in rows.toLocalIterator():  # a partition at a time: notes are files of a person's making, a few thousand at most
        path = jvm.org.apache.hadoop.fs.Path(root, r.file)
        out = fs.create(path, True)
        out.write(bytearray((r.text or "").encode()))
        out.close()
        if r.at is not None:
            fs.setTimes(path, r.at * 1000, -1)
        n += 1
    return n


def write_undo(df: DataFrame, path: str, run: str) -> None:
    """Old values of what a run will overwrite, by run."""
    df.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(path)


def replace_group(df: DataFrame, path: str, group: str = "group_id") -> None:
    """Rows of the groups in ``df`` replace what the folder has of them; other groups stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(group).parquet(path)


def rebuild(df: DataFrame, path: str) -> None:
    """The whole output again from all stored rows."""
    df.write.mode("overwrite").parquet(path)


def regroup(df: DataFrame, group: str) -> DataFrame:
    """A copy of a graph's table under another group."""
    return df.withColumn("group_id", F.lit(group))


def dump_clusters(clusters: DataFrame, path: str, names: int = 50) -> None:
    """Clusters, largest first, with their first names."""
    from ..operators.patterns import members_sample

    rows = clusters.select(F.col("cluster").alias("community"), F.col("node").alias("entity"), "name")
    out = members_sample(rows.select("community", "entity"), rows.select(F.col("entity").alias("uuid"), "name").distinct(), names)
    out.orderBy(F.desc("n_members"), "community").write.mode("overwrite").json(path)


def snapshot(df: DataFrame, root: str, version: str) -> None:
    df.write.mode("error").parquet(f"{root}/{version}")


def stale_snapshots(versions: list[str], keep: int) -> list[str]:
    """Versions to delete: all but the newest ``keep`` by name."""
    return sorted(versions)[: max(0, len(versions) - keep)]


def alert_flags(errors: DataFrame, secrets: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: whether a run calls for attention, and why. Each input is bounded: one row or one row per alert."""
    e = errors.agg(F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"))
    s = secrets.agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("secrets"))
    a = alerts.agg(F.count("*").alias("alerts"))
    return e.crossJoin(s).crossJoin(a).withColumn("attention", (F.col("errors") > 0) | (F.col("secrets") > 0) | (F.col("alerts") > 0))

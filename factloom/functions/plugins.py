"""Extension surface: extraction, judges, digests, embeddings, each with a deterministic default.

Model calls are left to plug-ins: any callable with the same contract may take a default's place.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DIMENSIONS = 256
EMBED_BATCH = 32
JUDGE_BATCH = 20
CARD_BATCH = 15


def relation_types(spark: SparkSession, kinds: dict[str, str]) -> DataFrame:
    """(name, kind) of a deployment's relation types: EXCLUSIVE, CUMULATIVE or TEMPORAL."""
    return spark.createDataFrame(list(kinds.items()), "name string, kind string")


def embed_texts(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed words and letter trigrams, unit length; the order of texts is kept."""
    out = np.zeros((len(texts), dimensions), np.float32)
    for i, t in enumerate(texts):
        low = (t or "").lower()
        for w in low.split():
            for g in (w, *(f"#{w[k : k + 3]}" for k in range(max(0, len(w) - 2)))):
                h = zlib.crc32(g.encode())
                out[i, h % dimensions] += 1 if h >> 31 else -1
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def embedder(embed: Callable[[list[str]], np.ndarray] = embed_texts, batch: int = EMBED_BATCH) -> Callable[[Column], Column]:
    """A column function that embeds in batches of at most ``batch`` texts."""

    @F.pandas_udf("array<float>")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            values = s.fillna("").tolist()
            parts = [np.asarray(embed(values[k : k + batch]), np.float32) for k in range(0, len(values), batch)]
            yield pd.Series([row for part in parts for row in part], dtype=object)  # rows stay arrays, as a list has an object a number

    return run


def scrub(df: DataFrame, column: str, clean: Column, embedding: str | None = None, embed: Callable[[Column], Column] | None = None) -> DataFrame:
    """Write back cleaned text, and a new embedding where the text has changed."""
    marked = df.withColumn("_clean", clean).withColumn("_changed", ~F.col("_clean").eqNullSafe(F.col(column)))
    if embedding:
        marked = marked.withColumn("_e", (embed or embedder())(F.when(F.col("_changed"), F.col("_clean"))))
        marked = marked.withColumn(embedding, F.when(F.col("_changed"), F.col("_e")).otherwise(F.col(embedding))).drop("_e")
    return marked.withColumn(column, F.col("_clean")).drop("_clean", "_changed")


def judge(pairs: DataFrame, ask: Callable[[list[tuple[str, str]]], dict[int, bool]], batch: int = JUDGE_BATCH, cut: int = 300, default: bool = True) -> DataFrame:
    """(uuid, contradiction) of (uuid, old_fact, new_fact) rows, asked in batches; without an answer a pair contradicts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), batch):
                part = frame.iloc[k : k + batch]
                asked = [((o or "")[:cut], (n or "")[:cut]) for o, n in zip(part.old_fact, part.new_fact, strict=True)]
                try:
                    got = ask(asked)
                except Exception:
                    got = {}
                yield pd.DataFrame({"uuid": part.uuid, "contradiction": [bool(got.get(i, default)) for i in range(len(part))]})

    return pairs.select("uuid", "old_fact", "new_fact").mapInPandas(run, "uuid string, contradiction boolean")


def judge_entities(pairs: DataFrame, ask: Callable[[list[tuple[str, str]]], list[bool]], batch: int = JUDGE_BATCH) -> DataFrame:
    """(a, b, merge) of (a, b, name_a, name_b) rows, asked in batches. A batch that fails or doesn't have one answer a pair merges nothing."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), batch):
                part = frame.iloc[k : k + batch]
                try:
                    got = list(ask(list(zip(part.name_a, part.name_b, strict=True))))
                except Exception:
                    got = []
                yield pd.DataFrame({"a": part.a, "b": part.b, "merge": [bool(x) for x in got] if len(got) == len(part) else [False] * len(part)})

    return pairs.select("a", "b", "name_a", "name_b").mapInPandas(run, "a string, b string, merge boolean")


def mixed_cards(entities: DataFrame, ask: Callable[[list[tuple[str, str]]], dict[int, str]], min_summary: int = 400, cut: int = 900, batch: int = CARD_BATCH) -> DataFrame:
    """(uuid, why) of entities whose summary is about more than one thing, by the judge given."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in range(0, len(frame), batch):
                part = frame.iloc[k : k + batch]
                got = ask([(n, s[:cut]) for n, s in zip(part.name, part.summary, strict=True)])
                yield pd.DataFrame([(part.uuid.iloc[i], why) for i, why in got.items() if 0 <= i < len(part)], columns=["uuid", "why"])

    return entities.where(F.length("summary") >= min_summary).select("uuid", "name", "summary").mapInPandas(run, "uuid string, why string")


def extract(episodes: DataFrame, names: list[str], relations: dict[str, str]) -> DataFrame:
    """(episode, src, name, dst, fact) by rule: sentences with two known names and a relation's phrase between them."""
    listed = F.array(*[F.lit(n) for n in names])
    said = episodes.select(F.col("uuid").alias("episode"), F.explode(F.split("content", r"(?<=[.!?])\s+")).alias("fact"))
    found = said.withColumn("in", F.array_sort(F.transform(F.filter(listed, lambda n: F.contains(F.col("fact"), n)), lambda n: F.struct(F.instr(F.col("fact"), n).alias("at"), n.alias("n")))))
    pair = found.where(F.size("in") >= 2).select("episode", "fact", F.col("in")[0]["n"].alias("src"), F.col("in")[1]["n"].alias("dst"))
    phrase = F.lit(None).cast("string")
    for text, name in reversed(list(relations.items())):
        phrase = F.when(F.contains(F.lower("fact"), F.lit(text.lower())), F.lit(name)).otherwise(phrase)
    return pair.withColumn("name", phrase).where("name is not null").select("episode", "src", "name", "dst", "fact")


def digest(turn_rows: DataFrame, per_role: int = 3, max_chars: int = 4500, min_chars: int = 800) -> DataFrame:
    """(session, digest): the first turns of each role, cut; sessions below ``min_chars`` have none."""
    by = Window.partitionBy("session", "role").orderBy("line_no")
    first = turn_rows.withColumn("r", F.row_number().over(by)).where(F.col("r") <= per_role)
    size = turn_rows.groupBy("session").agg(F.sum(F.length("text")).alias("n")).where(F.col("n") >= min_chars)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "role", "text"))), lambda t: F.concat(t["role"], F.lit(": "), F.left(t["text"], F.lit(400)))), "\n")
    return first.groupBy("session").agg(F.left(text, F.lit(max_chars)).alias("digest")).join(size.select("session"), "session", "left_semi")


class Registry:
    """Named extensions; one that fails to set itself up is reported and does not stop the others."""

    def __init__(self):
        self.failed: dict[str, str] = {}

    def apply(self, spark: SparkSession, extensions: dict[str, Callable[[SparkSession], None]]) -> list[str]:
        done = []
        for name, setup in extensions.items():
            try:
                setup(spark)
                done.append(name)
            except Exception as e:
                self.failed[name] = f"{type(e).__name__}: {e}"
        return done

"""License scans by diagonal voting, with DataFrame functions only.

Every rolling word k-gram of every text is hashed and joined to the grams of the license templates
(the words are compared as well, so a hash collision counts for nothing). A hit votes for its
diagonal, the text position minus the template position. Phrases of a few words use 2-grams and
must have all of them on one diagonal; longer templates use 4-grams, diagonals up to ``MERGE``
apart are merged, which bridges inserted or missing words, and a merged diagonal counts if its
distinct template grams reach ``MIN_SHARE`` of the template within a span of ``MAX_STRETCH`` times
its length. The templates are literals of this module, so what is broadcast has a fixed size;
hits, which are few, are all that is shuffled besides a row per document. Words of texts that may have a
hit are written once to the shared folder.

Rows: one per document. Defined cases: null and empty texts have no words, no places, labels '' and
score 0; null doc_ids keep their rows; repeated rows give equal rows; an empty table gives no rows;
other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import materialize, prepare, table

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed values of the contract: phrase and label.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
#: Templates of our own: phrase or text, and label.
OWN = (
    ("all rights reserved", "all-rights-reserved"),
    ("cc by nc", "cc-by-nc"),
    ("cc by sa", "cc-by-sa"),
    ("gnu lesser general public license", "lgpl"),
    ("mozilla public license", "mpl"),
    ("this work is licensed under the gnu general public license version 3", "gpl-grant"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd-text"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc-text"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-text"),
)
SHORT, LONG = 2, 4
#: Templates of up to so many words are phrases.
PHRASE_WORDS = 5
MERGE = 3
MIN_SHARE = 0.6
MAX_STRETCH = 1.6
FIELDS = ("t", "label", "base", "n_grams", "t_words", "tpos")


#: The letter outside A-Z that ``lower`` makes an ASCII letter of, the one that DuckDB does too, and one that stays what it is.
KELVIN, DOTTED, APART = "\u212a", "\u0130", "\u0138"


def words_expr(text: Column) -> Column:
    """Words with A-Z lowered (other letters as well, which no template has)."""
    low = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(KELVIN), F.lit(APART)))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _gram(k: int, words: str = "words", at: str = "pos") -> list[Column]:
    return [F.get(F.col(words), F.col(at) + i) for i in range(k)]


def templates(spark: SparkSession, k: int) -> DataFrame:
    """(t, label, base, n_grams, t_words, tpos, h, t0..): the k-grams of the templates that use them."""
    rows = [(p, label, True) for p, label in BASE] + [(p, label, False) for p, label in OWN]
    rows = [(n, *r) for n, r in enumerate(rows) if (len(r[0].split()) <= PHRASE_WORDS) == (k == SHORT)]
    one = F.array(*[F.struct(F.lit(n).alias("t"), F.lit(p).alias("phrase"), F.lit(label).alias("label"), F.lit(base).alias("base")) for n, p, label, base in rows])
    listed = spark.range(1).select(F.inline(one)).withColumn("words", F.split("phrase", " "))
    grams = listed.withColumn("tpos", F.explode(F.sequence(F.lit(0), F.size("words") - k)))
    parts = _gram(k, at="tpos")
    return grams.select("t", "label", "base", (F.size("words") - (k - 1)).alias("n_grams"), F.size("words").alias("t_words"), "tpos", F.xxhash64(*parts).alias(f"th{k}"), *[p.alias(f"t{k}_{i}") for i, p in enumerate(parts)])


def marks() -> list[str]:
    """A word of every gram of every template, the longest: a text without any of them has no hit."""
    out = set()
    for phrase, _ in (*BASE, *OWN):
        words = phrase.split()
        k = SHORT if len(words) <= PHRASE_WORDS else LONG
        out |= {max(words[i : i + k], key=lambda w: (len(w), w)) for i in range(len(words) - k + 1)}
    return sorted(out)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # what a row finds depends on its text alone: rows are told apart by id and two hashes of the text
    keyed = src.select("doc_id", F.xxhash64("text").alias("key"), F.hash("text").alias("key2"), words_expr(F.col("text")).alias("words"))
    key = ["doc_id", "key", "key2"]
    # texts are split once; those without a word of any gram are passed over before their positions are laid out
    likely = (F.size("words") >= SHORT) & F.arrays_overlap("words", F.array(*[F.lit(w) for w in marks()]))
    keyed = materialize(keyed.select(*key, F.size("words").cast("long").alias("n_words"), F.when(likely, F.col("words")).alias("words")), "license-words")
    placed = keyed.where("words is not null").select(*key, "words", F.explode(F.sequence(F.lit(0), F.size("words") - SHORT)).alias("pos"))
    hashed = placed.select(*key, "pos", *[p.alias(f"w{i}") for i, p in enumerate(_gram(LONG))])
    hashed = hashed.withColumn("h2", F.xxhash64("w0", "w1")).withColumn("h4", F.when(F.col("w3").isNotNull(), F.xxhash64("w0", "w1", "w2", "w3")))

    def joined(left: DataFrame, k: int) -> DataFrame:
        listed = templates(spark, k)
        t = F.broadcast(listed.select(*[F.col(c).alias(f"s{k}_{c}") if c in FIELDS else F.col(c) for c in listed.columns]))
        same = F.col(f"h{k}") == F.col(f"th{k}")
        for i in range(k):
            same &= F.col(f"w{i}") == F.col(f"t{k}_{i}")
        return left.join(t, same, "left")

    hits = joined(joined(hashed, SHORT), LONG).where("s2_t is not null or s4_t is not null")
    both = F.array(*[F.struct(F.lit(k).alias("k"), *[F.col(f"s{k}_{c}").alias(c) for c in FIELDS]) for k in (SHORT, LONG)])
    votes = hits.select(*key, "pos", F.explode(both).alias("v")).where("v.t is not null").select(*key, "pos", "v.*").distinct()
    diagonal = votes.groupBy(*key, "t", "label", "base", "k", "n_grams", "t_words", (F.col("pos") - F.col("tpos")).alias("diagonal")).agg(F.collect_set("tpos").alias("seen"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    by_diagonal = Window.partitionBy(*key, "t").orderBy("diagonal")
    apart = F.when(F.col("k") == SHORT, F.lit(1)).otherwise(F.when(F.col("diagonal") - F.lag("diagonal").over(by_diagonal) <= MERGE, 0).otherwise(1))
    grouped = diagonal.withColumn("apart", apart).withColumn("g", F.sum("apart").over(by_diagonal))
    merged = grouped.groupBy(*key, "t", "label", "base", "k", "n_grams", "t_words", "g").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("found"), F.min("diagonal").alias("start"), (F.max("high") + F.max("k") - F.min("low")).alias("span")
    )
    share = F.col("found") / F.col("n_grams")
    verified = F.when(F.col("k") == SHORT, F.col("found") == F.col("n_grams")).otherwise((share >= MIN_SHARE) & (F.col("span") <= MAX_STRETCH * F.col("t_words")))
    places = merged.where(verified).withColumn("share", share)
    found = places.groupBy(*key).agg(
        F.count_if("base").alias("n_base"),
        F.min(F.when(F.col("base"), F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("base"), F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    found = found.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("key2").alias("_key2"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rows = keyed.select(*key, "n_words")
    out = rows.join(found, rows["doc_id"].eqNullSafe(found["_id"]) & (rows["key"] == found["_key"]) & (rows["key2"] == found["_key2"]), "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(prepare(spark), sf_dir, "documents"))


def _values(rows) -> str:
    return ", ".join(f"({n}, '{p}', '{label}', {str(base).lower()})" for n, (p, label, base) in enumerate(rows))


#: The same in DuckDB SQL, with words in place of hashes.
ORACLE_SQL = f"""
WITH tokens AS (
  SELECT doc_id, regexp_extract_all(lower(replace(replace(coalesce(text, ''), '{KELVIN}', '{APART}'), '{DOTTED}', '{APART}')), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
), templates AS (
  SELECT t, string_split(phrase, ' ') AS tw, label, base, CASE WHEN len(string_split(phrase, ' ')) <= {PHRASE_WORDS} THEN {SHORT} ELSE {LONG} END AS k
  FROM (VALUES {_values([(p, x, True) for p, x in BASE] + [(p, x, False) for p, x in OWN])}) AS v(t, phrase, label, base)
), tgrams AS (
  SELECT t, label, base, k, len(tw) AS t_words, len(tw) - k + 1 AS n_grams, tpos, array_to_string(tw[tpos + 1 : tpos + k], ' ') AS gram
  FROM (SELECT *, unnest(range(0, len(tw) - k + 1)) AS tpos FROM templates)
), positions AS (
  SELECT doc_id, words, unnest(range(0, len(words) - 1)) AS pos FROM tokens WHERE len(words) >= 2
), grams AS (
  SELECT doc_id, pos, 2 AS k, words[pos + 1] || ' ' || words[pos + 2] AS gram FROM positions
  UNION ALL
  SELECT doc_id, pos, 4 AS k, array_to_string(words[pos + 1 : pos + 4], ' ') AS gram FROM positions WHERE pos + 4 <= len(words)
), diagonals AS (
  SELECT doc_id, t, label, base, g.k, n_grams, t_words, pos - tpos AS diagonal, list(DISTINCT tpos) AS seen, min(pos) AS low, max(pos) AS high
  FROM grams g JOIN tgrams USING (k, gram) GROUP BY ALL
), apart AS (
  SELECT *, CASE WHEN k = {SHORT} THEN 1 WHEN diagonal - lag(diagonal) OVER w <= {MERGE} THEN 0 ELSE 1 END AS apart FROM diagonals WINDOW w AS (PARTITION BY doc_id, t ORDER BY diagonal)
), numbered AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, t ORDER BY diagonal) AS g FROM apart
), merged AS (
  SELECT doc_id, t, label, base, k, n_grams, t_words, g, len(list_distinct(flatten(list(seen)))) AS found, min(diagonal) AS start, max(high) + max(k) - min(low) AS span
  FROM numbered GROUP BY ALL
), places AS (
  SELECT *, found / n_grams AS share FROM merged
  WHERE CASE WHEN k = {SHORT} THEN found = n_grams ELSE found / n_grams >= {MIN_SHARE} AND span <= {MAX_STRETCH} * t_words END
), found AS (
  SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(share) AS score
  FROM places GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM tokens LEFT JOIN found USING (doc_id)
"""

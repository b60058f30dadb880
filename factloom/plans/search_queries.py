"""Queries over vectors, keywords, neighbourhoods and communities, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import community as c
from ..operators import patterns as p
from ..operators import search as s
from . import graph as g
from .graph import table, with_sql

WORDS = "the license public tion"
LPA_ROUNDS = 10


def _vectors(spark, d):
    return table(spark, d, "embeddings").withColumnRenamed("vec_id", "uuid")


def _query(spark, d):
    """The query vector: one row, as a literal."""
    return s.vector_literal(table(spark, d, "embeddings").where("vec_id = 0").first().embedding)


def vector_topk(spark, d):
    return s.vector_topk(_vectors(spark, d), _query(spark, d), 20).select("uuid", F.round("score", 6).alias("score"))


def vector_topk_threshold(spark, d):
    return s.vector_topk(_vectors(spark, d), _query(spark, d), 50, min_score=0.1, where=F.col("label") < 5).select("uuid", "label", F.round("score", 6).alias("score"))


def vector_topk_overfetch(spark, d):
    return s.vector_topk(_vectors(spark, d), _query(spark, d), 10, where=F.col("label") < 5, overfetch=True).select("uuid", "label", F.round("score", 6).alias("score"))


def vector_topk_per_label(spark, d):
    return s.vector_topk_per_group(_vectors(spark, d), _query(spark, d), 3, "label").select("uuid", "label", "rank", F.round("score", 6).alias("score"))


def _docs(spark, d):
    return table(spark, d, "documents").withColumnRenamed("doc_id", "uuid")


def bm25_topk(spark, d):
    return s.bm25(_docs(spark, d), WORDS, 20).select("uuid", F.round("score", 6).alias("score"))


def bm25_scores(spark, d):
    return s.bm25(_docs(spark, d), "gnu apache mit").select("uuid", F.round("score", 6).alias("score"))


def hybrid_rrf(spark, d):
    """Documents by words, and by vector those whose ids are also vector ids."""
    docs = _docs(spark, d).join(_vectors(spark, d).select("uuid", "embedding"), "uuid", "left")
    return s.hybrid(docs, WORDS, _query(spark, d), 10).select("uuid", F.round("score", 9).alias("score"))


def bfs_two_hop(spark, d):
    edges = g.links(spark, d).where("name = 'R' and group_id = 'F'").select("src", "dst")
    origins = spark.range(1).select(F.lit("s1").alias("node"))
    return s.bfs(edges, origins, 2)


def center_rerank(spark, d):
    edges = g.links(spark, d).where("name = 'R' and group_id = 'F'").select("src", "dst")
    found = p.degree(g.links(spark, d)).where("degree >= 30").withColumn("score", F.col("degree").cast("double"))
    return s.rerank_by_distance(found, edges, spark.range(1).select(F.lit("s1").alias("node")), "uuid", 2).select("uuid", "distance", "score")


def _nation_graph(spark, d):
    """Nations, joined where a customer and a supplier of an order's line come from."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    cu = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("long").alias("src"))
    su = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("long").alias("dst"))
    return li.join(o, "l_orderkey").join(cu, "o_custkey").join(su, "l_suppkey").where("src <> dst").select("src", "dst")


def _adjacency(spark, d):
    return p.neighbour_counts(_nation_graph(spark, d))


def lpa_vote(spark, d):
    """The first round's votes over nations."""
    nodes = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_nationkey").cast("long").alias("label"))
    return c.vote(nodes, _adjacency(spark, d)).select("node", "new")


def lpa_rounds(spark, d):
    nodes = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_nationkey").cast("long").alias("label"))
    labels, _, _ = c.propagate(nodes, _adjacency(spark, d), rounds=LPA_ROUNDS)
    return labels


def _sizes(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_custkey").alias("label")).agg(F.count("*").alias("size"))


def cluster_size_histogram(spark, d):
    return c.histogram(_sizes(spark, d))


def size_gates(spark, d):
    gated = c.gates(_sizes(spark, d), 3, 15)
    return gated.groupBy("gate").agg(F.count("*").alias("clusters"), F.sum("size").alias("members"), (F.sum("size") * 0.0005).cast("decimal(18,4)").cast("double").alias("estimate"))


def hub_peel(spark, d):
    labels = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_regionkey").cast("long").alias("label"))
    return c.peel_hubs(labels, _adjacency(spark, d), 0.2)


def in_cluster_edges(spark, d):
    labels = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_regionkey").cast("long").alias("label"))
    return c.inside(labels, _adjacency(spark, d))


def split_clusters(spark, d):
    """Nations in clusters of at most ten."""
    labels = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.lit(0).cast("long").alias("label"))
    return c.split_large(labels, _adjacency(spark, d), 10)


def community_summaries(spark, d):
    parts = table(spark, d, "part").select(F.col("p_partkey").alias("uuid"), F.col("p_name").alias("name"), F.concat_ws(" ", "p_brand", "p_type").alias("summary"))
    clusters = table(spark, d, "part").select(F.col("p_partkey").alias("node"), F.col("p_brand").alias("cluster"))
    return c.summarise(c.members_with_summary(clusters, parts), 200)


QUERIES = {f.__name__: f for f in (
    vector_topk, vector_topk_threshold, vector_topk_overfetch, vector_topk_per_label, bm25_topk, bm25_scores, hybrid_rrf, bfs_two_hop, center_rerank, lpa_vote, lpa_rounds, cluster_size_histogram,
    size_gates, hub_peel, in_cluster_edges, split_clusters, community_summaries,
)}

_SCORED = """scored AS (SELECT vec_id AS uuid, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) AS score FROM embeddings)"""


def _bm25(words: str, docs: str = "documents") -> str:
    listed = ", ".join(f"'{w}'" for w in sorted(set(words.split())))
    return f"""docs AS (SELECT doc_id AS uuid, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM {docs}),
  stats AS (SELECT count(*) AS n, avg(len(t)) AS a FROM docs),
  tf AS (SELECT uuid, len, w, count(*) AS f FROM (SELECT uuid, len(t) AS len, unnest(t) AS w FROM docs) WHERE w IN ({listed}) GROUP BY ALL),
  idf AS (SELECT w, ln(1 + ((SELECT n FROM stats) - count(*) + 0.5) / (count(*) + 0.5)) AS i FROM tf GROUP BY 1),
  bm AS (SELECT uuid, sum(i * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len / (SELECT a FROM stats)))) AS score FROM tf JOIN idf USING (w) GROUP BY 1)"""


_NATIONS = """pairs AS (SELECT CAST(c_nationkey AS BIGINT) AS src, CAST(s_nationkey AS BIGINT) AS dst FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey),
  adj AS (SELECT src, dst, count(*) AS cnt FROM (SELECT src, dst FROM pairs UNION ALL SELECT dst, src FROM pairs) GROUP BY ALL)"""
_EDGES = "e AS (SELECT src, dst FROM links WHERE name = 'R' AND group_id = 'F' UNION SELECT dst, src FROM links WHERE name = 'R' AND group_id = 'F')"
_BFS = f"""{_EDGES}, d1 AS (SELECT DISTINCT dst AS node FROM e WHERE src = 's1' AND dst <> 's1'),
  d2 AS (SELECT DISTINCT e.dst AS node FROM e JOIN d1 ON e.src = d1.node WHERE e.dst <> 's1' AND e.dst NOT IN (SELECT node FROM d1)),
  near AS (SELECT 's1' AS node, 0 AS distance UNION ALL SELECT node, 1 FROM d1 UNION ALL SELECT node, 2 FROM d2)"""


def _rounds_sql(rounds: int) -> str:
    """Label propagation, round by round: l has the labels after a round, v the votes in it."""
    steps = ["l0 AS MATERIALIZED (SELECT CAST(n_nationkey AS BIGINT) AS node, CAST(n_nationkey AS BIGINT) AS label FROM nation)"]
    for r in range(1, rounds + 1):
        steps.append(f"""v{r} AS MATERIALIZED (SELECT src AS node, t.label AS new, row_number() OVER (PARTITION BY src ORDER BY sum(cnt) DESC, t.label = o.label DESC, t.label) AS place
        FROM adj JOIN l{r - 1} t ON t.node = dst JOIN l{r - 1} o ON o.node = src GROUP BY src, t.label, o.label)""")
        steps.append(f"""l{r} AS MATERIALIZED (SELECT l.node, CASE WHEN left(md5(l.node || ':{r}'), 1) < '8' THEN coalesce(new, label) ELSE label END AS label
        FROM l{r - 1} l LEFT JOIN v{r} v ON v.node = l.node AND place = 1)""")
    return f"WITH {_NATIONS}, " + ",\n".join(steps) + f" SELECT node, label FROM l{rounds}"


ORACLES = {
    "vector_topk": f"WITH {_SCORED} SELECT uuid, round(score, 6) AS score FROM scored ORDER BY scored.score DESC, uuid LIMIT 20",
    "vector_topk_threshold": f"WITH {_SCORED} SELECT uuid, label, round(score, 6) AS score FROM scored WHERE label < 5 AND scored.score > 0.1 ORDER BY scored.score DESC, uuid LIMIT 50",
    "vector_topk_overfetch": f"WITH {_SCORED}, near AS (SELECT * FROM scored ORDER BY score DESC, uuid LIMIT 40) SELECT uuid, label, round(score, 6) AS score FROM near WHERE label < 5 ORDER BY near.score DESC, uuid LIMIT 10",
    "vector_topk_per_label": f"""WITH {_SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, uuid) AS rank FROM scored)
        SELECT uuid, label, CAST(rank AS INTEGER) AS rank, round(score, 6) AS score FROM r WHERE rank <= 3""",
    "bm25_topk": f"WITH {_bm25(WORDS)} SELECT uuid, round(score, 6) AS score FROM bm ORDER BY bm.score DESC, uuid LIMIT 20",
    "bm25_scores": f"WITH {_bm25('gnu apache mit')} SELECT uuid, round(score, 6) AS score FROM bm",
    "hybrid_rrf": f"""WITH {_bm25(WORDS)}, {_SCORED},
  k AS (SELECT uuid, row_number() OVER (ORDER BY score DESC, uuid) AS r FROM bm ORDER BY r LIMIT 20),
  v AS (SELECT uuid, row_number() OVER (ORDER BY score DESC, uuid) AS r FROM scored WHERE uuid IN (SELECT doc_id FROM documents) ORDER BY r LIMIT 20),
  f AS (SELECT uuid, sum(1.0 / (60 + r)) AS score FROM (SELECT * FROM k UNION ALL SELECT * FROM v) GROUP BY 1)
  SELECT uuid, round(CAST(score AS DOUBLE), 9) AS score FROM f ORDER BY f.score DESC, uuid LIMIT 10""",
    "bfs_two_hop": with_sql("", "links").rstrip() + f", {_BFS} SELECT node, CAST(distance AS INTEGER) AS distance FROM near",
    "center_rerank": with_sql("", "links").rstrip()
    + f""", {_BFS}, deg AS (SELECT node, count(*) AS n FROM (SELECT src AS node FROM links UNION ALL SELECT dst FROM links) GROUP BY 1 HAVING count(*) >= 30)
  SELECT deg.node AS uuid, CAST(coalesce(distance, 3) AS INTEGER) AS distance, CAST(n AS DOUBLE) AS score FROM deg LEFT JOIN near ON near.node = deg.node""",
    "lpa_vote": f"""WITH {_NATIONS}, r AS (SELECT src, dst, cnt, row_number() OVER (PARTITION BY src ORDER BY cnt DESC, dst) AS r FROM adj)
        SELECT CAST(n_nationkey AS BIGINT) AS node, coalesce(dst, CAST(n_nationkey AS BIGINT)) AS new FROM nation LEFT JOIN r ON src = n_nationkey AND r = 1""",
    "lpa_rounds": _rounds_sql(LPA_ROUNDS),
    "cluster_size_histogram": """SELECT CASE WHEN n <= 1 THEN '<=1' WHEN n <= 3 THEN '<=3' WHEN n <= 10 THEN '<=10' WHEN n <= 30 THEN '<=30' WHEN n <= 100 THEN '<=100' ELSE '>100' END AS bucket,
        count(*) AS clusters, CAST(sum(n) AS BIGINT) AS members FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY 1""",
    "size_gates": """SELECT CASE WHEN n < 3 THEN 'dropped' WHEN n <= 15 THEN 'kept' ELSE 'split' END AS gate, count(*) AS clusters, CAST(sum(n) AS BIGINT) AS members,
        CAST(CAST(sum(n) * 0.0005 AS DECIMAL(18, 4)) AS DOUBLE) AS estimate FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) GROUP BY 1""",
    "hub_peel": f"""WITH {_NATIONS}, own AS (SELECT a.n_nationkey AS node, sum(cnt) AS degree FROM adj JOIN nation a ON src = a.n_nationkey JOIN nation b ON dst = b.n_nationkey
        WHERE a.n_regionkey = b.n_regionkey GROUP BY 1), r AS (SELECT n_nationkey, n_regionkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY coalesce(degree, 0) DESC, n_nationkey) AS r,
        greatest(1, floor(count(*) OVER (PARTITION BY n_regionkey) * 0.2)) AS h FROM nation LEFT JOIN own ON node = n_nationkey)
        SELECT CAST(n_nationkey AS BIGINT) AS node, CAST(n_regionkey AS BIGINT) AS label, r <= h AS is_hub FROM r""",
    "in_cluster_edges": f"""WITH {_NATIONS} SELECT src, dst, cnt, CAST(a.n_regionkey AS BIGINT) AS label FROM adj JOIN nation a ON src = a.n_nationkey JOIN nation b ON dst = b.n_nationkey WHERE a.n_regionkey = b.n_regionkey""",
    "community_summaries": """WITH enough AS (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) >= 3)
        SELECT p_brand AS cluster, arg_min(p_name, p_partkey) AS name, left(string_agg(p_brand || ' ' || p_type, ' ' ORDER BY p_partkey), 200) AS summary FROM part JOIN enough USING (p_brand) GROUP BY 1""",
}

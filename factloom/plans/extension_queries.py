"""Queries over the extension surface, run summaries, stored indexes and the search surface, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import plugins
from ..functions import text as tx
from ..functions.lineage import scratch_path
from ..operators import community as c
from ..operators import patterns as p
from ..operators import resolve as r
from ..operators import search as s
from ..operators import temporal as t
from . import graph as g
from . import resolve_queries, search_queries, temporal_queries
from .graph import table, with_sql

SINCE = temporal_queries.SINCE
KINDS = {"R": t.EXCLUSIVE, "A": t.CUMULATIVE, "N": t.TEMPORAL}


def extracted_facts(spark, d):
    nations, regions = table(spark, d, "nation"), table(spark, d, "region")
    said = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"])
    episodes = said.select(F.col("n_nationkey").cast("string").alias("uuid"), F.concat(F.lit("We saw that the land <"), "n_name", F.lit("> is part of <"), "r_name", F.lit(">. Nothing else. <"), "r_name", F.lit("> stands alone.")).alias("content"))
    names = [f"<{x[0]}>" for x in nations.select("n_name").collect() + regions.select("r_name").collect()]  # 30 names
    return plugins.extract(episodes, names, {"is part of": "PART_OF"})


def fact_judge(spark, d):
    """Verdicts on pairs; those that get none (status P) count as contradictions."""
    o = table(spark, d, "orders")
    pairs = o.select(F.col("o_orderkey").cast("string").alias("uuid"), F.col("o_orderpriority").alias("old_fact"), F.col("o_orderstatus").alias("new_fact"))

    def ask(asked):
        return {i: new == "F" for i, (_, new) in enumerate(asked) if new != "P"}

    return plugins.judge(pairs, ask)


def entity_judge(spark, d):
    """Duplicates by name, judged in batches."""
    e = g.entities(spark, d)
    pairs = r.dedupe_candidates(e).select("a", "b")
    named = pairs.join(e.select(F.col("uuid").alias("a"), F.col("name").alias("name_a")), "a").join(e.select(F.col("uuid").alias("b"), F.col("name").alias("name_b")), "b")
    verdicts = plugins.judge_entities(named, lambda asked: [len(x) % 2 == 0 for x, _ in asked])
    return r.dedupe_candidates(e, verdicts)


def mixed_cards(spark, d):
    def ask(cards):
        return {i: f"{text.count('x')} marks" for i, (_, text) in enumerate(cards) if text.count("x") > 30}

    return plugins.mixed_cards(g.entities(spark, d), ask, 60)


def long_summaries(spark, d):
    return g.entities(spark, d).where(F.length("summary") >= 60).select("uuid")


def session_digests(spark, d):
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("session"), F.col("turn").alias("line_no"), "role", "text")
    return plugins.digest(turns).select("session", F.length("digest").alias("chars"), F.md5("digest").alias("md5"))


def embedded_names(spark, d):
    """Both embeddings of a name are taken in one pass: a join of them would move, or broadcast, a vector a row. Names are dealt out first, as they are few bytes and much work."""
    names = table(spark, d, "part").select("p_partkey", "p_name").repartition("p_partkey")
    rows = names.select("p_partkey", plugins.embedder()(F.col("p_name")).alias("e"), plugins.embedder(batch=3)(F.col("p_name")).alias("f"))
    norm = F.round(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x), 4)
    return rows.select("p_partkey", F.size("e").alias("size"), norm.alias("norm"), (F.col("e") == F.col("f")).alias("same_in_other_batches"))


def extension_registry(spark, d):
    registry = plugins.Registry()
    done = registry.apply(spark, {"good": lambda s: s.range(1).count(), "bad": lambda s: 1 // 0, "other": lambda s: None})
    return spark.createDataFrame([(n, "set up") for n in done] + list(registry.failed.items()), "name string, outcome string")


def superseded_kinds(spark, d):
    """Facts that are closed, by relation and its kind."""
    kinds = plugins.relation_types(spark, KINDS)
    out = t.supersede(g.facts(spark, d).drop("invalid_at").withColumn("invalid_at", F.lit(None).cast("timestamp_ntz")), kinds)
    return out.groupBy("name").agg(F.count("*").alias("facts"), F.count_if("superseded").alias("closed"))


def merge_cycle_check(spark, d):
    """Merge plans that run in circles of five, and entities that lead into them: the circle's smallest id is kept."""
    n = F.col("s_suppkey")
    ring = table(spark, d, "supplier").select(n.alias("dup"), F.when(n % 5 == 4, n - 4).otherwise(n + 1).alias("keep"))
    tails = table(spark, d, "supplier").where("s_suppkey % 3 = 0").select((n + 1_000_000).alias("dup"), n.alias("keep"))
    return r.canonical(ring.unionByName(tails))


def merge_label_union(spark, d):
    mapping = resolve_queries._mapping(spark, d)
    labels = mapping.select("keep", F.array(F.lit("Merged"), F.lit("Entity")).alias("labels"))
    return r.merge_entities(g.entities(spark, d), mapping, labels).select("uuid", F.array_join("labels", ",").alias("labels"))


def triplet_added(spark, d):
    """A fact between a supplier that is there and an entity that isn't, added twice."""
    e, f = g.entities(spark, d), g.facts(spark, d).withColumns({"fact": F.lit(None).cast("string"), "group_id": F.lit("supply")})
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    for _ in range(2):
        e, f = r.add_triplet(e, f, "supplier#000000001", "USES", "New Thing", "one uses it", at, "supply")
    return f.where("fact is not null").join(e.select(F.col("uuid").alias("dst"), F.col("name").alias("dst_name")), "dst").select("src", "name", "dst_name", "fact")


def cleared_groups(spark, d):
    left = s.clear_groups({"facts": g.links(spark, d), "entities": g.entities(spark, d)}, ["F", "supply"])
    return p.counts(**left)


def fact_by_id(spark, d):
    first = g.links(spark, d).agg(F.min("uuid").alias("u")).first().u
    same = g.links(spark, d).where(F.col("uuid") == first).dropDuplicates(["uuid"])
    return s.get_fact(same, first).select("uuid", "src", "dst")


def facts_between(spark, d):
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    own = s.filter_facts(g.facts(spark, d), names=["R", "A"], created=(at(SINCE), at("1997-01-01")), invalid=(None, at("1996-12-01")))
    return own.groupBy("name").agg(F.count("*").alias("n"))


def edges_by_id_list(spark, d):
    """Vector search among listed ids alone."""
    v = table(spark, d, "embeddings").select(F.col("vec_id").alias("uuid"), F.col("embedding").alias("fact_embedding"), "label")
    ids = v.where("label = 1").select("uuid")
    return s.edge_search(v, search_queries._query(spark, d), 7, ids, -1.0).select("uuid", F.round("score", 6).alias("score"))


def indexed_words(spark, d):
    """The keyword search of ``bm25_topk`` from stored postings."""
    path = scratch_path(spark, "postings")
    s.build_postings(search_queries._docs(spark, d), path)
    return s.bm25_indexed(spark, path, search_queries.WORDS, 20).select("uuid", F.round("score", 6).alias("score"))


def indexed_vectors(spark, d):
    """Recall of the cell index against the exact search, over all vectors whose id is divisible by 100."""
    path = scratch_path(spark, "cells")
    v = search_queries._vectors(spark, d).select("uuid", "embedding")
    s.build_vector_index(v, path, cells=16)
    asked = v.where("uuid % 100 = 0").select(F.col("uuid").alias("query"), "embedding")
    exact = s.vector_topk_many(v, asked, 10)
    near = s.vector_topk_indexed_many(spark, path, asked, 10, probes=12)
    both = exact.join(near, ["query", "uuid"], "left_semi").agg(F.count("*").alias("n"))
    return asked.agg(F.count("*").alias("queries")).crossJoin(both).select("queries", (F.col("n") >= 0.9 * 10 * F.col("queries")).alias("recall_holds"))


def community_hits(spark, d):
    regions = table(spark, d, "region").select(F.col("r_regionkey").cast("string").alias("uuid"), F.col("r_name").alias("name"), F.concat(F.lit("lands of "), "r_name", F.lit(" and more")).alias("summary"))
    nations = table(spark, d, "nation")
    members = nations.select(F.col("n_regionkey").cast("string").alias("community"), F.col("n_nationkey").cast("string").alias("entity"))
    entities = nations.select(F.col("n_nationkey").cast("string").alias("uuid"), F.col("n_name").alias("name"))
    return s.community_search(regions, members, entities, "asia AMERICA east", None).select("uuid", F.round("score", 9).alias("score"), "n_members", "names")


def modularity_gain(spark, d):
    """The first round of modularity votes over nations in their regions."""
    labels = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("node"), F.col("n_regionkey").cast("long").alias("label"))
    return c.modularity_vote(labels, search_queries._adjacency(spark, d), 1.5).select("node", "new")


def split_bound(spark, d):
    """What splitting holds to: every nation once, and no cluster above ten."""
    out = search_queries.split_clusters(spark, d)
    sizes = out.groupBy("cluster").agg(F.count("*").alias("n"))
    return out.agg(F.count("*").alias("nodes"), F.count_distinct("node").alias("different")).crossJoin(sizes.agg((F.max("n") <= 10).alias("holds")))


def run_report(spark, d):
    e = g.entities(spark, d).withColumn("created_at", F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(cast(ord as int))"))
    cost = t.costs(temporal_queries._usage(spark, d), temporal_queries._prices(spark, d))
    return t.run_summary(g.facts(spark, d), e, cost, F.lit(SINCE).cast("timestamp_ntz"), tx.generic_name(F.col("name"), r"^[a-z][a-z\s-]{2,8}$", ["red ring"]))


QUERIES = {f.__name__: f for f in (
    extracted_facts, fact_judge, entity_judge, mixed_cards, long_summaries, session_digests, embedded_names, extension_registry, superseded_kinds, merge_cycle_check, merge_label_union, triplet_added, cleared_groups,
    fact_by_id, facts_between, edges_by_id_list, indexed_words, indexed_vectors, community_hits, modularity_gain, split_bound, run_report,
)}

_REGION_DOCS = "(SELECT CAST(r_regionkey AS VARCHAR) AS doc_id, r_name || ' lands of ' || r_name || ' and more' AS text FROM region)"

ORACLES = {
    "extracted_facts": "SELECT CAST(n_nationkey AS VARCHAR) AS episode, '<' || n_name || '>' AS src, 'PART_OF' AS name, '<' || r_name || '>' AS dst, 'We saw that the land <' || n_name || '> is part of <' || r_name || '>.' AS fact FROM nation JOIN region ON n_regionkey = r_regionkey",
    "fact_judge": "SELECT CAST(o_orderkey AS VARCHAR) AS uuid, o_orderstatus IN ('F', 'P') AS contradiction FROM orders",
    "entity_judge": with_sql("""SELECT a, e.uuid AS b, length(n.name) % 2 = 0 AS merge FROM entities e JOIN (SELECT lower(name) AS norm, arg_min(uuid, ord) AS a FROM entities GROUP BY 1 HAVING count(*) > 1) x
        ON norm = lower(e.name) JOIN entities n ON n.uuid = a WHERE e.uuid <> a""", "entities"),
    "mixed_cards": with_sql("SELECT uuid, length(summary) - length(replace(summary, 'x', '')) || ' marks' AS why FROM entities WHERE length(summary) >= 60 AND length(summary) - length(replace(summary, 'x', '')) > 30", "entities"),
    "long_summaries": with_sql("SELECT uuid FROM entities WHERE length(summary) >= 60", "entities"),
    "session_digests": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r, sum(length(text)) OVER (PARTITION BY conv_id) AS n FROM conversations),
        g AS (SELECT conv_id AS session, left(string_agg(role || ': ' || left(text, 400), chr(10) ORDER BY turn, role, text), 4500) AS g FROM r WHERE r <= 3 AND n >= 800 GROUP BY 1)
        SELECT session, CAST(length(g) AS INTEGER) AS chars, md5(g) AS md5 FROM g""",
    "embedded_names": "SELECT p_partkey, 256 AS size, CAST(1 AS DOUBLE) AS norm, true AS same_in_other_batches FROM part",
    "extension_registry": "SELECT * FROM (VALUES ('good', 'set up'), ('other', 'set up'), ('bad', 'ZeroDivisionError: integer division or modulo by zero')) v(name, outcome)",
    "superseded_kinds": temporal_queries._with("""ch AS (SELECT *, CASE WHEN lag(dst) OVER w IS NULL OR lag(dst) OVER w <> dst THEN valid_at END AS c FROM facts WINDOW w AS (PARTITION BY src, name ORDER BY valid_at, created_at, uuid)),
  cl AS (SELECT name, first(c IGNORE NULLS) OVER (PARTITION BY src, name ORDER BY valid_at, created_at, uuid ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM ch)""",
        "SELECT name, count(*) AS facts, count(*) FILTER (WHERE name = 'R' AND nx IS NOT NULL) AS closed FROM cl GROUP BY 1"),
    "merge_cycle_check": """SELECT s_suppkey AS dup, s_suppkey - s_suppkey % 5 AS keep FROM supplier WHERE s_suppkey % 5 <> 0
        UNION ALL SELECT s_suppkey + 1000000, s_suppkey - s_suppkey % 5 FROM supplier WHERE s_suppkey % 3 = 0""",
    "merge_label_union": resolve_queries._with("SELECT uuid, 'Entity,' || label || CASE WHEN uuid IN (SELECT keep FROM mapping) THEN ',Merged' ELSE '' END AS labels FROM entities WHERE uuid NOT IN (SELECT dup FROM mapping)", resolve_queries._MAP),
    "triplet_added": "SELECT 's1' AS src, 'USES' AS name, 'New Thing' AS dst_name, 'one uses it' AS fact",
    "cleared_groups": with_sql("SELECT 'facts' AS what, count(*) AS n FROM links WHERE group_id <> 'F' UNION ALL SELECT 'entities', count(*) FROM entities WHERE group_id <> 'supply'", "links", "entities"),
    "fact_by_id": with_sql("SELECT DISTINCT uuid, src, dst FROM links WHERE uuid = (SELECT min(uuid) FROM links)", "links"),
    "facts_between": with_sql(f"SELECT name, count(*) AS n FROM facts WHERE name IN ('R', 'A') AND created_at >= TIMESTAMP '{SINCE}' AND created_at < TIMESTAMP '1997-01-01' AND invalid_at < TIMESTAMP '1996-12-01' GROUP BY 1", "facts"),
    "edges_by_id_list": f"WITH {search_queries._SCORED} SELECT uuid, round(score, 6) AS score FROM scored WHERE label = 1 ORDER BY scored.score DESC, uuid LIMIT 7",
    "indexed_words": search_queries.ORACLES["bm25_topk"],
    "indexed_vectors": "SELECT count(*) AS queries, true AS recall_holds FROM embeddings WHERE vec_id % 100 = 0",
    "community_hits": f"""WITH {search_queries._bm25('asia america east', _REGION_DOCS)}, k AS (SELECT uuid, 1.0 / (60 + row_number() OVER (ORDER BY score DESC, uuid)) AS score FROM bm)
        SELECT k.uuid, round(CAST(max(k.score) AS DOUBLE), 9) AS score, count(*) AS n_members, array_to_string(list(n_name ORDER BY n_name, CAST(n_nationkey AS VARCHAR))[1:20], '|') AS names FROM k JOIN nation ON n_regionkey = CAST(k.uuid AS INTEGER) GROUP BY 1""",
    "modularity_gain": f"""WITH {search_queries._NATIONS}, deg AS (SELECT src AS node, sum(cnt) AS k FROM adj GROUP BY 1), lab AS (SELECT CAST(n_nationkey AS BIGINT) AS node, CAST(n_regionkey AS BIGINT) AS label FROM nation),
  own AS (SELECT node, label, k FROM lab JOIN deg USING (node)), mass AS (SELECT label, sum(k) AS mass FROM own GROUP BY 1), tot AS (SELECT sum(k) AS a FROM deg),
  links AS (SELECT src AS node, l.label AS their, sum(cnt) AS links FROM adj JOIN lab l ON l.node = dst GROUP BY 1, 2 UNION ALL SELECT node, label, 0 FROM own),
  votes AS (SELECT node, their, sum(links) AS links FROM links GROUP BY 1, 2),
  gain AS (SELECT v.node, own.label, their, links * a * 1000 - 1500 * k * (mass - CASE WHEN their = own.label THEN k ELSE 0 END) AS gain FROM votes v JOIN own USING (node) JOIN mass ON mass.label = their, tot),
  best AS (SELECT node, their, row_number() OVER (PARTITION BY node ORDER BY gain DESC, their = label DESC, their) AS r FROM gain)
  SELECT lab.node, coalesce(their, label) AS new FROM lab LEFT JOIN best ON best.node = lab.node AND r = 1""",
    "split_bound": "SELECT count(*) AS nodes, count(DISTINCT n_nationkey) AS different, true AS holds FROM nation",
    "run_report": temporal_queries._with(temporal_queries._METRICS + ",\n" + temporal_queries._USAGE + f""",
  ent AS ({g.SQL['entities']}), born AS (SELECT *, TIMESTAMP '1995-01-01' + to_days(CAST(ord AS INTEGER)) AS born_at FROM ent),
  nodes AS (SELECT count(*) AS new_nodes, count(*) FILTER (WHERE regexp_matches(name, '^[a-z][a-z\\s-]{{2,8}}$') AND name <> 'red ring' AND len(string_split(name, ' ')) <= 2) AS generic_nodes FROM born WHERE born_at >= TIMESTAMP '{SINCE}'),
  newt AS (SELECT string_agg(k || ':' || n, ',' ORDER BY n DESC, k) AS new_fact_types FROM (SELECT name AS k, count(*) AS n FROM facts WHERE created_at >= TIMESTAMP '{SINCE}' GROUP BY 1 ORDER BY n DESC, k LIMIT 8)),
  fastt AS (SELECT string_agg(k || ':' || n, ',' ORDER BY n DESC, k) AS fast_types FROM (SELECT name AS k, count(*) AS n FROM quick WHERE q GROUP BY 1 ORDER BY n DESC, k LIMIT 5)),
  top AS (SELECT string_agg(k || ':' || n, ',' ORDER BY n DESC, k) AS top_degree FROM (SELECT k, count(*) AS n FROM (SELECT src AS k FROM facts UNION ALL SELECT dst FROM facts) GROUP BY 1 ORDER BY n DESC, k LIMIT 10)),
  paid AS (SELECT CAST(round_even(CAST(sum(micro) AS DECIMAL(38, 6)) / 1000000, 3) AS DOUBLE) AS cost_usd FROM costs)""", "SELECT * FROM scored, nodes, newt, fastt, top, paid"),
}

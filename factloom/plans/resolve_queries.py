"""Queries over aliases, merges and splits, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import patterns as p
from ..operators import resolve as r
from . import graph as g
from .graph import table, with_sql


def _aliases(spark):
    """Canonical names and what else they are called; literals."""
    rows = (("Acme Supply", ("Company",), ("Supplier#000000001", "Supplier#000000002", "Supplier#000000003")), ("Supplier#000000005", ("Company",), ("Supplier#000000007",)), ("Nobody", (), ("Nothing",)))
    one = F.array(*[F.struct(F.lit(c).alias("canon"), F.array(*[F.lit(x) for x in ls]).cast("array<string>").alias("labels"), F.array(*[F.lit(x) for x in al]).alias("aliases")) for c, ls, al in rows])
    return spark.range(1).select(F.inline(one))


def _numbered(spark, d):
    """Suppliers under names that end in their number, whatever the table calls them."""
    name = F.concat(F.lit("Supplier#"), F.lpad((F.col("s_suppkey") % 40).cast("string"), 9, "0"))
    return table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("uuid"), name.alias("name"), F.repeat(F.lit("x"), (F.col("s_suppkey") * 7 % 13).cast("int")).alias("summary"), F.col("s_suppkey").alias("ord"))


def alias_plan(spark, d):
    return r.alias_plan(_numbered(spark, d), _aliases(spark)).select("canon", "keep", "dup", "rename_to")


def ip_port_rule(spark, d):
    n = F.col("s_suppkey")
    host = F.concat(F.lit("10.0."), (n % 7).cast("string"), F.lit("."), (n % 3).cast("string"))
    name = F.when(n % 5 == 0, F.concat(host, F.lit(":80"))).when(n % 5 == 1, F.concat(host, F.lit("/32"))).when(n % 5 == 2, F.concat(host, F.lit("/24"))).when(n % 5 == 3, F.lit("127.0.0.1:5")).otherwise(host)
    hosts = table(spark, d, "supplier").where("s_suppkey % 2 = 0 or s_suppkey % 7 < 5").select(n.cast("string").alias("uuid"), name.alias("name"), n.alias("ord"))
    return r.ip_port_plan(hosts)


def same_name_merge(spark, d):
    return r.same_name_plan(g.entities(spark, d))


def _mapping(spark, d):
    return r.same_name_plan(g.entities(spark, d))


def merge_apply_edges(spark, d):
    moved = r.merge_facts(g.links(spark, d), _mapping(spark, d))
    return moved.groupBy("src", "dst").agg(F.count("*").alias("n"))


def merge_bridges(spark, d):
    return r.merge_bridges(g.mentions(spark, d), _mapping(spark, d))


def merge_summary_concat(spark, d):
    out = r.merge_entities(g.entities(spark, d), _mapping(spark, d), limit=300)
    return out.select("uuid", "name", "summary")


def merge_chain_resolution(spark, d):
    """Chains n -> n/2 -> n/4 ... followed to their end."""
    n = F.col("s_suppkey")
    plan = table(spark, d, "supplier").where("s_suppkey > 1").select(n.cast("string").alias("dup"), F.floor(n / 2).cast("string").alias("keep"))
    return r.canonical(plan)


def merge_audit(spark, d):
    links, entities, mapping = g.links(spark, d), g.entities(spark, d), _mapping(spark, d)
    after = r.merge_facts(links, mapping)
    kept = entities.join(mapping.select(F.col("dup").alias("uuid")), "uuid", "left_anti")
    return r.merge_audit({"facts": links, "entities": entities}, {"facts": after, "entities": kept}, links.select(F.col("uuid").alias("ref")))


def split_by_provenance(spark, d):
    links = g.links(spark, d).withColumn("episodes", F.array("episode"))
    orders = table(spark, d, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("uuid"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("content"))
    mentions = g.links(spark, d).select("episode", F.col("src").alias("entity")).distinct()
    facts, _, _ = r.split_by_provenance(links, mentions, orders, "s1", "s1-urgent", "^1-urgent")
    return facts.where("src in ('s1', 's1-urgent')").select("uuid", "src", "dst")


def dedupe_candidates(spark, d):
    return r.dedupe_candidates(g.entities(spark, d))


def one_entity(spark, d):
    return p.one_by_id_or_name(g.entities(spark, d), "s1").select("uuid", "name")


QUERIES = {f.__name__: f for f in (
    alias_plan, ip_port_rule, same_name_merge, merge_apply_edges, merge_bridges, merge_summary_concat, merge_chain_resolution, merge_audit, split_by_provenance, dedupe_candidates, one_entity,
)}

_MAP = """named AS (SELECT *, lower(name) AS norm, coalesce(length(summary), 0) AS size FROM entities),
  best AS (SELECT norm, label, arg_max(uuid, {'a': size, 'b': -ord}) AS keep FROM named GROUP BY 1, 2 HAVING count(*) > 1),
  mapping AS (SELECT uuid AS dup, keep FROM named JOIN best USING (norm, label) WHERE uuid <> keep)"""
_MOVED = """moved AS (SELECT l.uuid, coalesce(a.keep, l.src) AS src, coalesce(b.keep, l.dst) AS dst, l.src AS s0, l.dst AS d0 FROM links l LEFT JOIN mapping a ON a.dup = l.src LEFT JOIN mapping b ON b.dup = l.dst),
  merged AS (SELECT * FROM moved WHERE src <> dst OR s0 = d0)"""


def _with(body: str, *more: str, tables: tuple[str, ...] = ("entities",)) -> str:
    return with_sql("", *tables).rstrip() + ",\n" + ",\n".join(more) + "\n" + body


ORACLES = {
    "alias_plan": """WITH e AS (SELECT CAST(s_suppkey AS VARCHAR) AS uuid, 'Supplier#' || lpad(CAST(s_suppkey % 40 AS VARCHAR), 9, '0') AS name, s_suppkey * 7 % 13 AS size, s_suppkey AS ord FROM supplier),
a AS (SELECT * FROM (VALUES ('Acme Supply', 'Acme Supply', true), ('Acme Supply', 'Supplier#000000001', false), ('Acme Supply', 'Supplier#000000002', false), ('Acme Supply', 'Supplier#000000003', false),
  ('Supplier#000000005', 'Supplier#000000005', true), ('Supplier#000000005', 'Supplier#000000007', false), ('Nobody', 'Nobody', true), ('Nobody', 'Nothing', false)) v(canon, called, is_canon)),
m AS (SELECT canon, uuid, name, is_canon, row_number() OVER (PARTITION BY canon ORDER BY is_canon DESC, size DESC, ord) AS r, count(*) OVER (PARTITION BY canon) AS n FROM e JOIN a ON lower(name) = lower(called))
SELECT m.canon, k.uuid AS keep, m.uuid AS dup, NULL AS rename_to FROM m JOIN m k ON k.canon = m.canon AND k.r = 1 WHERE m.r > 1
UNION ALL SELECT canon, uuid, NULL, canon FROM m WHERE r = 1 AND name <> canon AND (n > 1 OR NOT is_canon)""",
    "ip_port_rule": """WITH h AS (SELECT s_suppkey AS n, '10.0.' || s_suppkey % 7 || '.' || s_suppkey % 3 AS ip FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 7 < 5),
b AS (SELECT ip, min(n) AS base FROM h WHERE n % 5 = 4 GROUP BY 1), q AS (SELECT h.n, h.ip, base, min(h.n) OVER (PARTITION BY h.ip) AS first FROM h LEFT JOIN b USING (ip) WHERE h.n % 5 IN (0, 1))
SELECT CAST(coalesce(base, first) AS VARCHAR) AS keep, CASE WHEN coalesce(base, first) <> n THEN CAST(n AS VARCHAR) END AS dup, CASE WHEN coalesce(base, first) = n THEN ip END AS rename_to, 'Server' AS label FROM q""",
    "same_name_merge": _with("SELECT keep, dup FROM mapping", _MAP),
    "merge_apply_edges": _with("SELECT src, dst, count(*) AS n FROM merged GROUP BY ALL", _MAP, _MOVED, tables=("entities", "links")),
    "merge_bridges": _with("SELECT DISTINCT episode, coalesce(keep, entity) AS entity FROM mentions LEFT JOIN mapping ON dup = entity", _MAP, tables=("entities", "mentions")),
    "merge_summary_concat": _with("""SELECT e.uuid, e.name, CASE WHEN m IS NULL THEN e.summary ELSE left(coalesce(e.summary, '') || ' | ' || m, 300) END AS summary
        FROM entities e LEFT JOIN (SELECT keep, string_agg(summary, ' | ' ORDER BY ord, uuid) AS m FROM entities JOIN mapping ON uuid = dup WHERE coalesce(summary, '') <> '' GROUP BY 1) ON keep = e.uuid
        WHERE e.uuid NOT IN (SELECT dup FROM mapping)""", _MAP),
    "merge_chain_resolution": "SELECT CAST(s_suppkey AS VARCHAR) AS dup, '1' AS keep FROM supplier WHERE s_suppkey > 1",
    "merge_audit": _with("""SELECT (SELECT count(*) FROM links WHERE uuid NOT IN (SELECT uuid FROM merged)) AS dangling, (SELECT count(*) FROM links) AS facts_before, (SELECT count(*) FROM merged) AS facts_after,
        (SELECT count(*) FROM entities) AS entities_before, (SELECT count(*) FROM entities WHERE uuid NOT IN (SELECT dup FROM mapping)) AS entities_after""", _MAP, _MOVED, tables=("entities", "links")),
    "split_by_provenance": with_sql("""SELECT uuid, CASE WHEN o_orderpriority = '1-URGENT' THEN 's1-urgent' ELSE 's1' END AS src, dst FROM links JOIN orders ON episode = 'o' || o_orderkey WHERE src = 's1'""", "links"),
    "dedupe_candidates": with_sql("""SELECT a, uuid AS b, false AS merge FROM entities JOIN (SELECT lower(name) AS norm, arg_min(uuid, ord) AS a FROM entities GROUP BY 1 HAVING count(*) > 1)
        ON norm = lower(name) WHERE uuid <> a""", "entities"),
    "one_entity": with_sql("SELECT uuid, name FROM entities WHERE uuid = 's1'", "entities"),
}

"""Queries over graph patterns, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import patterns as p
from . import graph as g
from .graph import table, with_sql


def hub_degree(spark, d):
    return p.hubs(g.links(spark, d), g.entities(spark, d), 10)


def label_histogram(spark, d):
    return p.label_histogram(g.entities(spark, d))


def one_hop_directed(spark, d):
    hop = p.one_hop(g.links(spark, d), g.entities(spark, d))
    return hop.where(F.col("name") == "R").groupBy("src_name", "dst_name").agg(F.count("*").alias("n"))


def one_hop_undirected_counts(spark, d):
    both = p.both_ways(g.links(spark, d), "name")
    return both.groupBy("node", "name").agg(F.count("*").alias("n"))


def neighbor_projection(spark, d):
    return p.adjacency(g.entities(spark, d), g.links(spark, d))


def bridge_mentions(spark, d):
    m = g.mentions(spark, d)
    orders = table(spark, d, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("episode"), "o_orderpriority")
    labels = g.entities(spark, d).select(F.col("uuid").alias("entity"), F.element_at("labels", 2).alias("label"))
    return p.bridge(orders, m, labels, "episode", "entity").groupBy("o_orderpriority", "label").agg(F.count("*").alias("n"))


def bridge_no_duplicate_anti(spark, d):
    m = g.mentions(spark, d)
    existing = g.links(spark, d).where("name = 'R'").select("episode", F.col("dst").alias("entity"))
    return p.missing_bridges(m, existing, ["episode", "entity"])


def dangling_refs(spark, d):
    links = g.links(spark, d)
    refs = links.select(F.col("uuid").alias("ref"), "episode")
    return p.dangling(refs, links.where("group_id = 'O'")).groupBy("episode").agg(F.count("*").alias("n"))


def facts_by_id_list(spark, d):
    links = g.links(spark, d)
    wanted = table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("episode"))
    return p.by_ids(links, wanted, "episode").select("uuid", "src", "dst", "name")


def facts_in_groups(spark, d):
    return p.where_props(g.links(spark, d), name=["R", "A"], group_id="F").groupBy("name", "group_id").agg(F.count("*").alias("n"))


def community_members_collect20(spark, d):
    customers = table(spark, d, "customer")
    members = customers.select(F.col("c_mktsegment").alias("community"), F.col("c_custkey").cast("string").alias("entity"))
    return p.members_sample(members, customers.select(F.col("c_custkey").cast("string").alias("uuid"), F.col("c_name").alias("name")), 20)


def community_top_sizes(spark, d):
    return p.most_common(table(spark, d, "customer"), "c_nationkey", 10)


def graph_status(spark, d):
    return p.counts(entities=g.entities(spark, d), facts=g.links(spark, d), episodes=table(spark, d, "orders"))


def top_relation_types(spark, d):
    return p.most_common(table(spark, d, "events"), "event_type", 5)


def name_contains(spark, d):
    found = g.entities(spark, d).where(F.contains("name", F.lit("1")) & p.has_label("Company"))
    return found.select("uuid", "name")


QUERIES = {f.__name__: f for f in (
    hub_degree, label_histogram, one_hop_directed, one_hop_undirected_counts, neighbor_projection, bridge_mentions, bridge_no_duplicate_anti, dangling_refs,
    facts_by_id_list, facts_in_groups, community_members_collect20, community_top_sizes, graph_status, top_relation_types, name_contains,
)}

ORACLES = {
    "hub_degree": with_sql(
        """SELECT uuid, name, degree FROM (SELECT node AS uuid, count(*) AS degree FROM (SELECT src AS node FROM links UNION ALL SELECT dst FROM links) GROUP BY node
        ORDER BY degree DESC, uuid LIMIT 10) LEFT JOIN (SELECT uuid, name FROM entities) USING (uuid)""", "links", "entities"),
    "label_histogram": with_sql("SELECT CASE WHEN label < 'Entity' THEN label || ',Entity' ELSE 'Entity,' || label END AS labels, count(*) AS n FROM entities GROUP BY 1", "entities"),
    "one_hop_directed": with_sql(
        """SELECT s.name AS src_name, t.name AS dst_name, count(*) AS n FROM links l JOIN entities s ON l.src = s.uuid JOIN entities t ON l.dst = t.uuid
        WHERE l.name = 'R' GROUP BY ALL""", "links", "entities"),
    "one_hop_undirected_counts": with_sql("SELECT node, name, count(*) AS n FROM (SELECT src AS node, name FROM links UNION ALL SELECT dst, name FROM links) GROUP BY ALL", "links"),
    "neighbor_projection": with_sql(
        """SELECT e.uuid AS src, a.dst, a.cnt FROM entities e LEFT JOIN (SELECT src, dst, count(*) AS cnt FROM (SELECT src, dst FROM links UNION ALL SELECT dst, src FROM links) GROUP BY ALL) a
        ON a.src = e.uuid""", "links", "entities"),
    "bridge_mentions": with_sql(
        """SELECT o_orderpriority, e.label, count(*) AS n FROM orders JOIN mentions m ON m.episode = 'o' || o_orderkey JOIN entities e ON e.uuid = m.entity GROUP BY ALL""", "mentions", "entities"),
    "bridge_no_duplicate_anti": with_sql(
        "SELECT DISTINCT episode, entity FROM mentions m WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.name = 'R' AND l.episode = m.episode AND l.dst = m.entity)", "mentions", "links"),
    "dangling_refs": with_sql("SELECT episode, count(*) AS n FROM links WHERE uuid NOT IN (SELECT uuid FROM links WHERE group_id = 'O') GROUP BY episode", "links"),
    "facts_by_id_list": with_sql("SELECT uuid, src, dst, name FROM links WHERE episode IN (SELECT 'o' || o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')", "links"),
    "facts_in_groups": with_sql("SELECT name, group_id, count(*) AS n FROM links WHERE name IN ('R', 'A') AND group_id = 'F' GROUP BY ALL", "links"),
    "community_members_collect20": """SELECT c_mktsegment AS community, count(*) AS n_members, array_to_string((list(c_name ORDER BY c_name, CAST(c_custkey AS VARCHAR)))[1:20], '|') AS names
        FROM customer GROUP BY 1""",
    "community_top_sizes": "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 10",
    "graph_status": with_sql("SELECT 'entities' AS what, (SELECT count(*) FROM entities) AS n UNION ALL SELECT 'facts', (SELECT count(*) FROM links) UNION ALL SELECT 'episodes', (SELECT count(*) FROM orders)", "links", "entities"),
    "top_relation_types": "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 5",
    "name_contains": with_sql("SELECT uuid, name FROM entities WHERE contains(name, '1') AND label = 'Company'", "entities"),
}

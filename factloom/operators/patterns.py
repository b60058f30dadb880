"""Graph patterns as DataFrame joins and aggregates.

Entities: uuid, name, labels, ...; facts: uuid, src, dst, name, ...; bridges: two id columns. Endpoints
are columns of a fact, so a pattern joins entities only for what it returns of them. Aggregates come
before joins wherever a key allows it, so that hubs meet a join as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_label(label: str, labels: str = "labels") -> Column:
    """Label predicate."""
    return F.array_contains(labels, label)


def where_props(df: DataFrame, **props) -> DataFrame:
    """Property map equality; a list is membership, and None is no condition."""
    for name, value in props.items():
        if value is None:
            continue
        df = df.where(F.col(name).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    return df


def one_by_id_or_name(entities: DataFrame, key: str) -> DataFrame:
    """The entity whose uuid or name is ``key``; an error if there is not exactly one."""
    found = entities.where((F.col("uuid") == key) | (F.col("name") == key))
    n = found.limit(2).count()
    if n != 1:
        raise LookupError(f"{key!r}: {'no entity' if not n else 'more than one entity'}")
    return found


def one_hop(facts: DataFrame, entities: DataFrame) -> DataFrame:
    """(s)-[e]->(t) with the names of both ends."""
    names = entities.select("uuid", "name")
    s = names.select(F.col("uuid").alias("src"), F.col("name").alias("src_name"))
    t = names.select(F.col("uuid").alias("dst"), F.col("name").alias("dst_name"))
    return facts.join(s, "src").join(t, "dst")


def both_ways(facts: DataFrame, *carry: str) -> DataFrame:
    """(node, other): every fact from both ends; a self-loop once."""
    ends = F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("other")), F.struct(F.col("dst").alias("node"), F.col("src").alias("other")))
    return facts.select(*carry, F.inline(F.when(F.col("src") == F.col("dst"), F.slice(ends, 1, 1)).otherwise(ends)))


def degree(facts: DataFrame) -> DataFrame:
    """Facts at each node, either way."""
    return both_ways(facts).groupBy(F.col("node").alias("uuid")).agg(F.count("*").alias("degree"))


def hubs(facts: DataFrame, entities: DataFrame, k: int = 10) -> DataFrame:
    """The k most connected entities; ids break ties. Names are joined to k rows only."""
    top = degree(facts).orderBy(F.desc("degree"), "uuid").limit(k)
    return top.join(entities.select("uuid", "name"), "uuid", "left").select("uuid", "name", "degree")


def neighbour_counts(facts: DataFrame, undirected: bool = True) -> DataFrame:
    """(src, dst, cnt): facts between two nodes."""
    if not undirected:
        return facts.groupBy("src", "dst").agg(F.count("*").alias("cnt"))
    pair = facts.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.count("*").alias("cnt"))
    return both_ways(pair, "cnt").select(F.col("node").alias("src"), F.col("other").alias("dst"), "cnt")


def adjacency(entities: DataFrame, facts: DataFrame) -> DataFrame:
    """(src, dst, cnt) both ways; isolated entities with a null neighbour."""
    pairs = neighbour_counts(facts)
    return entities.select(F.col("uuid").alias("src")).join(pairs, "src", "left")


def label_histogram(entities: DataFrame) -> DataFrame:
    """Entities by label set."""
    return entities.groupBy(F.array_join(F.array_sort("labels"), ",").alias("labels")).agg(F.count("*").alias("n"))


def bridge(left: DataFrame, bridge_rows: DataFrame, right: DataFrame, on_left: str, on_right: str) -> DataFrame:
    """left-[bridge]->right by equality on both id columns."""
    return left.join(bridge_rows, on_left).join(right, on_right)


def missing_bridges(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Bridge rows that are not there yet, each once."""
    return rows.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def dangling(refs: DataFrame, facts: DataFrame, ref: str = "ref") -> DataFrame:
    """References (one per row) to facts that do not exist."""
    return refs.join(facts.select(F.col("uuid").alias(ref)), ref, "left_anti")


def by_ids(facts: DataFrame, ids: DataFrame, key: str = "uuid") -> DataFrame:
    """Facts whose id is in a list of ids; Spark broadcasts the list if it is small."""
    return facts.join(ids.select(key).distinct(), key, "left_semi")


def members_sample(members: DataFrame, entities: DataFrame, k: int = 20) -> DataFrame:
    """Per community: number of members, and the first k names in order.

    A group is cut to k names before they are collected, so a large community never meets in one row.
    """
    from pyspark.sql import Window

    named = members.join(entities.select(F.col("uuid").alias("entity"), "name"), "entity")
    sizes = named.groupBy("community").agg(F.count("*").alias("n_members"))
    first = named.withColumn("r", F.row_number().over(Window.partitionBy("community").orderBy("name", "entity"))).where(F.col("r") <= k)
    names = first.groupBy("community").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "name"))), lambda x: x["name"]), "|").alias("names"))
    return sizes.join(names, "community")


def counts(**tables: DataFrame) -> DataFrame:
    """A row per table: its name and number of rows."""
    out = None
    for name, df in tables.items():
        one = df.groupBy().agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def most_common(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values; values break ties."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(k)

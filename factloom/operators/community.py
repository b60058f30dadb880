"""Communities: label propagation, size gates, splitting of large clusters, summaries.

Label propagation works in rounds over all nodes at once, each a join and two aggregations on the
vote key. Plain rounds of that kind can swing between two states forever; a node therefore changes
only in about every other round (by a hash of its id and the round), which settles such pairs. This differs from
one-by-one updates in random order and is bounded in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut, in_blocks

MAX_ROUNDS = 30
MIN_SIZE, MAX_SIZE = 3, 100
HUB_SHARE = 0.05
MAX_DEPTH = 6


def vote(labels: DataFrame, adjacency: DataFrame) -> DataFrame:
    """(node, label, new): each node's weighted majority label; the current one if it ties, else the least."""
    near = adjacency.join(labels.select(F.col("node").alias("dst"), F.col("label").alias("their")), "dst")
    votes = near.groupBy(F.col("src").alias("node"), "their").agg(F.sum("cnt").alias("votes"))
    joined = votes.join(labels, "node")
    best = joined.groupBy("node", "label").agg(F.max(F.struct(F.col("votes"), (F.col("their") == F.col("label")).alias("own"), (-F.col("their")).alias("least"))).alias("b"))
    new = best.select("node", F.when(F.col("b.own"), F.col("label")).otherwise(-F.col("b.least")).alias("new"))
    return labels.join(new, "node", "left").withColumn("new", F.coalesce("new", "label"))


def modularity_vote(labels: DataFrame, adjacency: DataFrame, resolution: float = 1.0) -> DataFrame:
    """(node, label, new): the neighbouring community in which a node adds most to modularity; the current one if it ties, else the least.

    Gain of joining a community: links into it, less ``resolution`` times the node's degree times the
    community's other degrees over all degrees. Gains are whole numbers over a common factor, so ties are exact.
    """
    degrees = adjacency.groupBy(F.col("src").alias("node")).agg(F.sum("cnt").alias("degree"))
    total = degrees.agg(F.sum("degree").alias("all"))  # one row
    own = labels.join(degrees, "node")
    sums = own.groupBy(F.col("label").alias("their")).agg(F.sum("degree").alias("mass"))
    near = adjacency.join(labels.select(F.col("node").alias("dst"), F.col("label").alias("their")), "dst")
    links = near.where("src <> dst").groupBy(F.col("src").alias("node"), "their").agg(F.sum("cnt").alias("links"))
    stay = own.select("node", F.col("label").alias("their"), F.lit(0).cast("long").alias("links"))
    votes = links.unionByName(stay).groupBy("node", "their").agg(F.sum("links").alias("links")).join(own, "node").join(sums, "their").crossJoin(total)
    others = F.col("mass") - F.when(F.col("their") == F.col("label"), F.col("degree")).otherwise(F.lit(0))
    gain = (F.col("links") * F.col("all") * 1000 - F.lit(round(resolution * 1000)) * F.col("degree") * others).cast("decimal(38,0)")
    best = votes.withColumn("gain", gain).groupBy("node", "label").agg(F.max(F.struct("gain", (F.col("their") == F.col("label")).alias("own"), (-F.col("their")).alias("least"))).alias("b"))
    new = best.select("node", F.when(F.col("b.own"), F.col("label")).otherwise(-F.col("b.least")).alias("new"))
    return labels.join(new, "node", "left").withColumn("new", F.coalesce("new", "label"))


def propagate(nodes: DataFrame, adjacency: DataFrame, rounds: int = MAX_ROUNDS, damped: bool = True, vote=vote) -> tuple[DataFrame, int, int]:
    """((node, label), rounds run, nodes that would still change). ``nodes``: (node, label) with initial labels; adjacency: (src, dst, cnt) both ways."""
    labels, wanting, r = nodes, 0, 0
    for r in range(1, rounds + 1):
        moved = vote(labels, adjacency)
        may = (F.left(F.md5(F.concat(F.col("node").cast("string"), F.lit(f":{r}"))), F.lit(1)) < "8") if damped else F.lit(True)
        stepped = cut(moved.select("node", F.when(may, F.col("new")).otherwise(F.col("label")).alias("label"), (F.col("new") != F.col("label")).alias("wants")))
        wanting = stepped.where("wants").count()
        labels = stepped.select("node", "label")
        if not wanting:
            break
    return labels, r, wanting


def gates(sizes: DataFrame, min_size: int = MIN_SIZE, max_size: int = MAX_SIZE) -> DataFrame:
    """(label, size, gate): dropped, kept or split."""
    return sizes.withColumn("gate", F.when(F.col("size") < min_size, "dropped").when(F.col("size") <= max_size, "kept").otherwise("split"))


def histogram(sizes: DataFrame, bounds: tuple[int, ...] = (1, 3, 10, 30, 100)) -> DataFrame:
    """Clusters by size bucket (smallest bound that holds the size; the last bucket is open)."""
    bucket = F.lit(f">{bounds[-1]}")
    for b in reversed(bounds):
        bucket = F.when(F.col("size") <= b, F.lit(f"<={b}")).otherwise(bucket)
    return sizes.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("clusters"), F.sum("size").cast("long").alias("members"))


def weighted_degree(adjacency: DataFrame) -> DataFrame:
    return adjacency.groupBy(F.col("src").alias("node")).agg(F.sum("cnt").alias("degree"))


def inside(labels: DataFrame, adjacency: DataFrame) -> DataFrame:
    """Adjacency with both ends in one cluster."""
    a = labels.select(F.col("node").alias("src"), F.col("label").alias("ls"))
    b = labels.select(F.col("node").alias("dst"), F.col("label").alias("ld"))
    return adjacency.join(a, "src").join(b, "dst").where("ls = ld").select("src", "dst", "cnt", F.col("ls").alias("label"))


def ranked(rows: DataFrame, key: str, *order) -> DataFrame:
    """``rows`` with rank: the place of each row within its key. A key with most of the rows is ranked in blocks, on top of the sizes of the blocks before."""
    placed = in_blocks(rows, key, *order)
    sizes = placed.groupBy(key, "_block").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(F.col(key).alias("_k"), F.col("_block").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
    joined = placed.join(sizes, (F.col(key) == F.col("_k")) & (F.col("_block") == F.col("_b")))
    return joined.withColumn("rank", F.col("_before") + F.row_number().over(Window.partitionBy(key, "_block").orderBy(*order))).drop("_k", "_b", "_before", "_block")


def peel_hubs(labels: DataFrame, adjacency: DataFrame, share: float = HUB_SHARE) -> DataFrame:
    """(node, label, is_hub): per cluster the most connected share of its nodes, one at least."""
    degrees = inside(labels, adjacency).groupBy(F.col("src").alias("node")).agg(F.sum("cnt").alias("degree"))
    rows = labels.join(degrees, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    sizes = labels.groupBy("label").agg(F.greatest(F.lit(1), F.floor(F.count("*") * share)).alias("hubs"))
    return ranked(rows, "label", F.desc("degree"), "node").join(sizes, "label").select("node", "label", (F.col("rank") <= F.col("hubs")).alias("is_hub"))


def split_large(labels: DataFrame, adjacency: DataFrame, max_size: int = MAX_SIZE, depth: int = MAX_DEPTH, rounds: int = 10) -> DataFrame:
    """(node, cluster): clusters above ``max_size`` are split by modularity, at a resolution that rises with the pass; those that do not split by peeling hubs.

    Every pass works on all large clusters at once; cluster names are paths, so parts never clash. A cluster
    that modularity leaves in one piece loses its hubs, which become a part of their own, and goes to the next
    pass. What is above ``max_size`` after the last pass is dealt into parts of that size, by falling degree
    inside the cluster, named ``dealt``, so that the bound always holds and such parts can be told.
    """
    current = labels.select("node", F.col("label").cast("string").alias("cluster"))
    for level in range(depth + 1):
        sizes = current.groupBy("cluster").agg(F.count("*").alias("n"))
        large = current.join(sizes.where(F.col("n") > max_size), "cluster")
        if large.isEmpty():
            break
        number = cut(large.select("node", F.xxhash64("cluster").alias("label"), "cluster"))
        own = cut(inside(number.select("node", "label"), adjacency).select("src", "dst", "cnt"))
        start = cut(number.select("node", F.xxhash64("node").alias("label")))
        parts, _, _ = propagate(start, own, rounds=rounds, vote=lambda x, y, r=1 + level / 2: modularity_vote(x, y, r))
        named = number.join(parts.select("node", F.col("label").cast("string").alias("part")), "node")
        split = named.groupBy("cluster").agg(F.count_distinct("part").alias("parts"))
        hubs = peel_hubs(number.select("node", "label"), adjacency).select("node", "is_hub")
        named = named.join(split, "cluster").join(hubs, "node")
        part = F.when(F.col("parts") > 1, F.col("part")).when(F.col("is_hub"), F.lit("hubs")).otherwise(F.lit("rest"))
        small = current.join(sizes.where(F.col("n") <= max_size).select("cluster"), "cluster", "left_semi").select("node", "cluster")
        current = cut(small.unionByName(named.select("node", F.concat_ws("/", "cluster", part).alias("cluster"))))
    number = current.select("node", F.xxhash64("cluster").alias("label"), "cluster")
    degrees = inside(number.select("node", "label"), adjacency).groupBy("src").agg(F.sum("cnt").alias("degree")).withColumnRenamed("src", "node")
    large = current.groupBy("cluster").agg(F.count("*").alias("n"))
    dealt = number.join(large, "cluster").join(degrees, "node", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
    dealt = ranked(dealt, "cluster", F.desc("degree"), "node").withColumn("part", F.floor((F.col("rank") - 1) / max_size).cast("string"))
    return dealt.select("node", F.when(F.col("n") > max_size, F.concat_ws("/", "cluster", F.concat(F.lit("dealt"), F.col("part")))).otherwise(F.col("cluster")).alias("cluster"))


def members_with_summary(clusters: DataFrame, entities: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """Members that have a summary, of clusters that still have enough of them."""
    rows = clusters.join(entities.select(F.col("uuid").alias("node"), "name", "summary"), "node").where("coalesce(summary, '') <> ''")
    enough = rows.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") >= min_size).select("cluster")
    return rows.join(enough, "cluster", "left_semi")


def summarise(rows: DataFrame, limit: int = 3000) -> DataFrame:
    """(cluster, name, summary): the default summary, members' summaries in order, cut; members beyond the cut are not gathered."""
    order = Window.partitionBy("cluster").orderBy("node")
    # each takes up two characters at least, so later rows than that are dropped where they are read
    rows = rows.where("summary <> ''").withColumn("_row", F.row_number().over(order)).where(F.col("_row") <= limit // 2 + 1).drop("_row")
    before = F.coalesce(F.sum(F.length("summary") + 1).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = rows.withColumn("_b", before).where(F.col("_b") < limit)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "summary"))), lambda x: x["summary"]), " ")
    return kept.groupBy("cluster").agg(F.min_by("name", "node").alias("name"), F.left(text, F.lit(limit)).alias("summary"))

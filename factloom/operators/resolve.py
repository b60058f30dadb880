"""Entity resolution: alias plans, merges, splits by provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.lineage import cut
from .patterns import dangling

# Addresses that name the machine itself.
LOCAL_IPS = ("127.0.0.1", "172.17.0.1", "localhost", "0.0.0.0")


def _size() -> Column:
    return F.length(F.coalesce("summary", F.lit("")))


def alias_plan(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """(canon, keep, dup, rename_to, labels): rows to merge into the entity that is kept, and renames (dup null).

    ``aliases``: (canon, labels, aliases). Kept is the longest summary among the entities that carry the
    canonical name, else among those with an alias; the first created breaks ties.
    """
    one = entities.select("uuid", "name", "ord", _size().alias("size"), tx.norm(F.col("name")).alias("norm"))
    listed = aliases.select("canon", "labels", F.inline(F.concat(F.array(F.struct(F.col("canon").alias("called"), F.lit(True).alias("is_canon"))), F.transform("aliases", lambda a: F.struct(a.alias("called"), F.lit(False).alias("is_canon"))))))
    listed = listed.withColumn("norm", tx.norm(F.col("called"))).dropDuplicates(["canon", "norm"])
    met = cut(one.join(listed, "norm").groupBy("canon", "labels", "uuid", "name", "ord", "size").agg(F.max("is_canon").alias("is_canon")))
    # the kept one is found by aggregation and joined back, so that a name with many entities is never sorted in one task
    best = met.groupBy("canon").agg(F.max_by(F.struct("uuid", "name", "is_canon"), F.struct("is_canon", "size", -F.col("ord"))).alias("k"), F.count("*").alias("n"))
    kept = best.select("canon", F.col("k.uuid").alias("keep"), F.col("k.name").alias("keep_name"), F.col("k.is_canon").alias("keep_is_canon"), "n")
    met = met.join(kept, "canon")
    dups = met.where("uuid <> keep").select("canon", "keep", F.col("uuid").alias("dup"), F.lit(None).cast("string").alias("rename_to"), "labels")
    named = met.where("uuid = keep and name <> canon and (n > 1 or not is_canon)").select("canon", "keep", F.lit(None).cast("string").alias("dup"), F.col("canon").alias("rename_to"), "labels")
    return dups.unionByName(named)


def ip_port_plan(entities: DataFrame, local: tuple[str, ...] = LOCAL_IPS, label: str = "Server") -> DataFrame:
    """(keep, dup, rename_to, label): a.b.c.d:port and a.b.c.d/32 go to the bare address, or take its name if it is not there."""
    one = entities.select("uuid", "ord", tx.norm(F.col("name")).alias("norm")).withColumn("ip", tx.host_of(F.col("norm")))
    ported = one.where(F.col("ip").isNotNull() & ~F.col("ip").isin(*local))
    bare = one.where(F.col("ip").isNull()).groupBy("norm").agg(F.min_by("uuid", "ord").alias("base"))
    found = ported.join(bare.withColumnRenamed("norm", "ip"), "ip", "left")
    first = ported.groupBy("ip").agg(F.min_by("uuid", "ord").alias("first"))
    found = found.join(first, "ip").withColumn("keep", F.coalesce("base", "first"))
    same = F.col("keep") == F.col("uuid")
    return found.select("keep", F.when(~same, F.col("uuid")).alias("dup"), F.when(same, F.col("ip")).alias("rename_to"), F.lit(label).alias("label"))


def same_name_plan(entities: DataFrame, merged: DataFrame | None = None) -> DataFrame:
    """(keep, dup): entities with the same normalised name and label set; the longest summary, then the first, is kept."""
    labels = F.array_join(F.array_sort(F.array_remove("labels", "Entity")), ",")
    one = entities.select("uuid", "ord", _size().alias("size"), tx.norm(F.col("name")).alias("norm"), labels.alias("set"))
    if merged is not None:
        one = one.join(merged.select(F.col("dup").alias("uuid")), "uuid", "left_anti")
    # the kept one is found by aggregation and joined back, so a frequent name is never sorted in one task
    best = one.groupBy("norm", "set").agg(F.max_by("uuid", F.struct("size", -F.col("ord"))).alias("keep"), F.count("*").alias("n")).where("n > 1")
    return one.join(best, ["norm", "set"]).where("uuid <> keep").select("keep", F.col("uuid").alias("dup"))


def canonical(plan: DataFrame) -> DataFrame:
    """(dup, keep) with chains followed to their end, so that nothing is moved to an entity that goes itself.

    Where a plan runs in a circle, the smallest id of the circle is kept. Every round doubles the steps that
    are behind a row: ``keep`` is what it leads to after them, ``least`` the smallest id on the way.
    """
    plan = plan.where("dup is not null and dup <> keep").groupBy("dup").agg(F.min("keep").alias("keep")).withColumn("least", F.col("keep"))
    steps = 1
    while True:
        on = plan.select(F.col("dup").alias("k"), F.col("keep").alias("up"), F.col("least").alias("up_least"))
        step = plan.join(on, plan["keep"] == on["k"], "left")
        open_rows = step.where("up is not null").count()
        if not open_rows:
            return plan.select("dup", "keep")
        if steps >= open_rows:  # what is still open has reached its circle, and what it has reached has been all around
            return step.select("dup", F.coalesce("up_least", "keep").alias("keep")).where("dup <> keep")
        plan = cut(step.select("dup", F.coalesce("up", "keep").alias("keep"), F.least("least", F.coalesce("up_least", "least")).alias("least")))
        steps *= 2


def repoint(df: DataFrame, mapping: DataFrame, *columns: str) -> DataFrame:
    """Ids in the columns replaced by what they were merged into. The mapping is small against the facts, and joined by key."""
    for c in columns:
        m = mapping.select(F.col("dup").alias("_dup"), F.col("keep").alias("_keep"))
        df = df.join(m, df[c] == m["_dup"], "left").withColumn(c, F.coalesce("_keep", c)).drop("_dup", "_keep")
    return df


def merge_facts(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """Facts on the kept entities; those between an entity and its duplicate go, self-loops that were there stay."""
    moved = repoint(facts.withColumn("_src", F.col("src")).withColumn("_dst", F.col("dst")), mapping, "src", "dst")
    return moved.where((F.col("src") != F.col("dst")) | (F.col("_src") == F.col("_dst"))).drop("_src", "_dst")


def merge_bridges(rows: DataFrame, mapping: DataFrame, entity: str = "entity") -> DataFrame:
    """Bridge rows on the kept entities, each pair once."""
    return repoint(rows, mapping, entity).dropDuplicates()


def merge_entities(entities: DataFrame, mapping: DataFrame, labels: DataFrame | None = None, limit: int = 3000) -> DataFrame:
    """Entities without the merged ones; summaries of those are appended in order and cut to ``limit`` characters.

    A kept entity takes the longest prefix that can matter from its duplicates: they are cut before they
    are gathered.
    """
    dup = entities.join(mapping, entities["uuid"] == mapping["dup"]).where("coalesce(summary, '') <> ''")
    # each takes up four characters at least, so later rows than that are dropped where they are read
    line = Window.partitionBy("keep").orderBy("ord", "uuid")
    dup = dup.withColumn("_row", F.row_number().over(line)).where(F.col("_row") <= limit // 4 + 1).drop("_row")
    order = line.rowsBetween(Window.unboundedPreceding, -1)
    before = dup.withColumn("_before", F.coalesce(F.sum(F.length("summary") + 3).over(order), F.lit(0))).where(F.col("_before") < limit)
    parts = before.groupBy("keep").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "uuid", "summary"))), lambda x: x["summary"]), " | ").alias("_more"))
    kept = entities.join(mapping.select(F.col("dup").alias("uuid")), "uuid", "left_anti").join(parts.withColumnRenamed("keep", "uuid"), "uuid", "left")
    text = F.when(F.col("_more").isNotNull(), F.left(F.concat(F.coalesce("summary", F.lit("")), F.lit(" | "), F.col("_more")), F.lit(limit))).otherwise(F.col("summary"))
    out = kept.withColumn("summary", text).drop("_more")
    if labels is not None:
        more = labels.groupBy(F.col("keep").alias("uuid")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("labels")))).alias("_labels"))
        out = out.join(more, "uuid", "left").withColumn("labels", F.array_distinct(F.concat("labels", F.coalesce("_labels", F.array().cast("array<string>"))))).drop("_labels")
    return out.select(*entities.columns)


def merge_audit(before: dict[str, DataFrame], after: dict[str, DataFrame], refs: DataFrame) -> DataFrame:
    """One row: rows of each table before and after, and references to facts that are gone."""
    out = dangling(refs, after["facts"]).agg(F.count("*").alias("dangling"))
    for name in before:
        out = out.crossJoin(before[name].agg(F.count("*").alias(f"{name}_before"))).crossJoin(after[name].agg(F.count("*").alias(f"{name}_after")))
    return out


def split_by_provenance(facts: DataFrame, mentions: DataFrame, episodes: DataFrame, node: str, new_node: str, pattern: str, prefix: int = 4000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Move what comes from matching episodes only to another node: (facts, mentions, mixed facts).

    ``facts`` have episodes as an array; an episode matches by its name and the first ``prefix`` characters
    of its content, case aside. Facts with other episodes as well stay, and are returned as mixed.
    """
    own = mentions.where(F.col("entity") == node)
    hit = F.concat(F.coalesce("name", F.lit("")), F.lit(" "), F.coalesce(F.left("content", F.lit(prefix)), F.lit(""))).rlike(f"(?iu){pattern}")
    chosen = episodes.join(own.select(F.col("episode").alias("uuid")), "uuid", "left_semi").where(hit).select(F.col("uuid").alias("episode"))
    at = facts.where((F.col("src") == node) | (F.col("dst") == node))
    sides = at.select("uuid", F.explode("episodes").alias("episode")).join(chosen.withColumn("_in", F.lit(True)), "episode", "left")
    verdict = sides.groupBy("uuid").agg(F.bool_and(F.col("_in").isNotNull()).alias("_all"), F.bool_or(F.col("_in").isNotNull()).alias("_any"))
    marked = facts.join(verdict, "uuid", "left")
    move = F.coalesce("_all", F.lit(False))
    out = marked
    for c in ("src", "dst"):
        out = out.withColumn(c, F.when(move & (F.col(c) == node), F.lit(new_node)).otherwise(F.col(c)))
    moved = mentions.join(chosen.withColumn("_in", F.lit(True)), "episode", "left")
    moved = moved.withColumn("entity", F.when(F.col("_in").isNotNull() & (F.col("entity") == node), F.lit(new_node)).otherwise(F.col("entity")))
    return out.select(*facts.columns), moved.select(*mentions.columns).dropDuplicates(), marked.where("_any and not _all").select(*facts.columns)


def new_entity(spark, name: str, labels: list[str], summary: str = "", group: str = "main", embed=None) -> DataFrame:
    """A row for an entity that a split creates. Its id is a hash of group and name, so a second run makes the same one; ``embed``: a column function for the name's vector."""
    one = spark.range(1).select(F.lit(name).alias("name"), F.lit(group).alias("group_id"), F.array(*[F.lit(x) for x in labels]).cast("array<string>").alias("labels"), F.lit(summary).alias("summary"))
    one = one.select(F.left(F.sha1(F.concat_ws("|", "group_id", tx.norm(F.col("name")))), F.lit(32)).alias("uuid"), "*")
    return one if embed is None else one.withColumn("name_embedding", embed(F.col("name")))


def add_triplet(entities: DataFrame, facts: DataFrame, src: str, name: str, dst: str, fact: str, at: Column, group: str = "main") -> tuple[DataFrame, DataFrame]:
    """(entities, facts) with a fact between two entities by name; those that aren't there are created, a fact that is there is not repeated."""
    spark = entities.sparkSession
    wanted = new_entity(spark, src, ["Entity"], group=group).unionByName(new_entity(spark, dst, ["Entity"], group=group))
    named = entities.where(F.col("group_id") == group).select(tx.norm(F.col("name")).alias("norm"), F.col("uuid").alias("found"))
    named = named.where(F.col("norm").isin(*{_norm(src), _norm(dst)})).groupBy("norm").agg(F.min("found").alias("found"))
    ends = wanted.withColumn("norm", tx.norm(F.col("name"))).join(named, "norm", "left")
    created = ends.where("found is null").drop("norm", "found").dropDuplicates(["uuid"])
    ids = ends.select("norm", F.coalesce("found", "uuid").alias("id")).dropDuplicates(["norm"])
    s, t = (ids.where(F.col("norm") == _norm(x)).select(F.col("id").alias(c)) for x, c in ((src, "src"), (dst, "dst")))
    row = s.crossJoin(t).withColumns({"name": F.lit(name), "fact": F.lit(fact), "valid_at": at, "created_at": at, "group_id": F.lit(group)})  # one row each
    row = row.withColumn("uuid", F.left(F.sha1(F.concat_ws("|", "group_id", "src", "name", "dst", "fact")), F.lit(32))).join(facts.select("uuid"), "uuid", "left_anti")
    return entities.unionByName(created, allowMissingColumns=True), facts.unionByName(row, allowMissingColumns=True)


def _norm(name: str) -> str:
    return " ".join(name.strip().strip(tx.QUOTES).lower().split())


def dedupe_candidates(entities: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """(a, b, merge): entities of equal normalised name and other label sets, each with the group's first; not merged without a verdict."""
    one = entities.select("uuid", "ord", tx.norm(F.col("name")).alias("norm"))
    first = one.groupBy("norm").agg(F.min_by("uuid", "ord").alias("a"), F.count("*").alias("n")).where("n > 1")
    pairs = one.join(first, "norm").where("uuid <> a").select("a", F.col("uuid").alias("b"))
    if verdicts is None:
        return pairs.withColumn("merge", F.lit(False))
    return pairs.join(verdicts.select("a", "b", "merge"), ["a", "b"], "left").withColumn("merge", F.coalesce("merge", F.lit(False)))

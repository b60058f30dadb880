"""Dated facts: supersession, reads as of a time, repair of invalidations, run metrics.

A fact holds in [valid_at, invalid_at); created_at and expired_at say when the store learned it and
when it was given up. A null invalid_at is a fact that still holds.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import in_blocks

DAY = 86_400
EXCLUSIVE, CUMULATIVE, TEMPORAL = "EXCLUSIVE", "CUMULATIVE", "TEMPORAL"


def window_seconds(start: str = "valid_at", end: str = "invalid_at") -> Column:
    """Length of the validity window; null if a date is missing, below zero if the dates are the wrong way round."""
    return F.timestamp_diff("SECOND", F.col(start), F.col(end))


def _next_change(rows: DataFrame, line, before=None) -> DataFrame:
    """``rows`` with _change, the time at which a row's value begins (null for a repeated one), and _next, the first such time of a later row."""
    previous = F.lag("dst").over(line) if before is None else F.coalesce(F.lag("dst").over(line), before)
    changed = rows.withColumn("_previous", previous).withColumn("_change", F.when(F.col("_previous").isNull() | (F.col("_previous") != F.col("dst")), F.col("valid_at")))
    return changed.withColumn("_next", F.first("_change", ignorenulls=True).over(line.rowsBetween(1, Window.unboundedFollowing)))


def _next_change_in_blocks(facts: DataFrame) -> DataFrame:
    """The same where a subject's rows are in blocks: the last value of the block before, and the first change in a later block, are carried over."""
    rows = in_blocks(facts, "src", "name", "valid_at", "created_at", "uuid")
    place = F.struct("valid_at", "created_at", "uuid")
    over = Window.partitionBy("src", "name").orderBy("_block")
    same = F.col("src").eqNullSafe(F.col("_s")) & F.col("name").eqNullSafe(F.col("_n")) & (F.col("_block") == F.col("_b"))
    keys = [F.col("src").alias("_s"), F.col("name").alias("_n"), F.col("_block").alias("_b")]
    ends = rows.groupBy("src", "name", "_block").agg(F.max_by("dst", place).alias("_last"))
    rows = rows.join(ends.select(*keys, F.lag("_last").over(over).alias("_before")), same, "left").drop("_s", "_n", "_b")
    line = Window.partitionBy("src", "name", "_block").orderBy("valid_at", "created_at", "uuid")
    changed = _next_change(rows, line, F.col("_before"))
    firsts = changed.groupBy("src", "name", "_block").agg(F.min_by("_change", F.when(F.col("_change").isNotNull(), place)).alias("_first"))
    later = firsts.select(*keys, F.first("_first", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_later"))
    return changed.join(later, same, "left").withColumn("_next", F.coalesce("_next", "_later"))


#: A subject's facts of one relation that one task may hold; beyond that they are dealt out in blocks.
HOT_ROWS = 1_000_000


def supersede(facts: DataFrame, kinds: DataFrame | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Close an exclusive fact when its subject gets another value of the same relation.

    ``kinds``: (name, kind) of relations; without it all are exclusive. Facts that repeat the value, and
    facts of other kinds, stay open. An earlier close is kept. Where a subject has more than ``hot_rows``
    facts of a relation, facts are dealt out in blocks, and what a block needs of the others is a row each;
    the result is the same.
    """
    columns = facts.columns
    if kinds is not None:
        facts = facts.join(kinds.select("name", F.col("kind").alias("_kind")).dropDuplicates(["name"]), "name", "left")
        exclusive = F.coalesce(F.col("_kind") == EXCLUSIVE, F.lit(False))
    else:
        exclusive = F.lit(True)
    marked = facts.withColumn("_exclusive", exclusive)
    most = facts.groupBy("src", "name").count().agg(F.max("count")).first()[0]
    line = Window.partitionBy("src", "name").orderBy("valid_at", "created_at", "uuid")
    closed = _next_change_in_blocks(marked) if most and most > hot_rows else _next_change(marked, line)
    closed = closed.withColumn("_next", F.when(F.col("_exclusive"), F.col("_next")))
    superseded = F.col("_next").isNotNull() & (F.col("invalid_at").isNull() | (F.col("_next") < F.col("invalid_at")))
    out = closed.withColumn("superseded", superseded).withColumn("invalid_at", F.when(superseded, F.col("_next")).otherwise(F.col("invalid_at")))
    return out.select(*columns, "superseded")


def as_of(facts: DataFrame, when: Column) -> DataFrame:
    """Facts that held at a time."""
    return facts.where((F.col("valid_at") <= when) & (F.col("invalid_at").isNull() | (F.col("invalid_at") > when)))


def now_view(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("invalid_at").isNull())


def _ends(facts: DataFrame, *columns: Column) -> DataFrame:
    """A row per different endpoint of each fact."""
    return facts.select(*columns, F.explode(F.array_distinct(F.array("src", "dst"))).alias("end"))


def invalidators(facts: DataFrame, exclude_self: bool = True, in_order: bool = True) -> DataFrame:
    """(uuid, by): for facts with an end, the first fact that begins at that end and shares an endpoint.

    The shared endpoint is part of the equality key, not a filter on all facts of the day. First by
    (created_at, uuid). ``exclude_self``/``in_order``: another fact, and one not created earlier.
    """
    old = _ends(facts.where("invalid_at is not null"), F.col("uuid"), F.col("invalid_at").alias("at"), F.col("created_at").alias("old_created"))
    new = _ends(facts.where("valid_at is not null"), F.col("uuid").alias("by"), F.col("valid_at").alias("at"), F.col("created_at").alias("by_created"))
    met = old.join(new, ["at", "end"])
    if exclude_self:
        met = met.where("uuid <> by")
    if in_order:
        met = met.where("by_created >= old_created")
    return met.groupBy("uuid").agg(F.min_by("by", F.struct("by_created", "by")).alias("by"))


def repair_classify(facts: DataFrame, judge_days: float = 7) -> DataFrame:
    """(uuid, class, by) of every fact with an end: no_dates, history, rule_1, judge or leave."""
    ended = facts.where("invalid_at is not null")
    found = ended.join(invalidators(facts), "uuid", "left")
    w = window_seconds()
    kind = (
        F.when(F.col("valid_at").isNull(), "no_dates")
        .when(F.col("by").isNull(), "history")
        .when(w < DAY, "rule_1")
        .when(w <= judge_days * DAY, "judge")
        .otherwise("leave")
    )
    return found.select("uuid", kind.alias("class"), "by")


def repair_same_day(facts: DataFrame, since: Column | None = None, expired_since: Column | None = None) -> DataFrame:
    """Facts with a window below one day (wrong-way windows included), whoever ended them."""
    out = facts.where("invalid_at is not null").where(window_seconds() < DAY)
    if since is not None:
        out = out.where(F.col("created_at") >= since)
    if expired_since is not None:
        out = out.where(F.col("expired_at") >= expired_since)
    return out


def repair_plan(classes: DataFrame, verdicts: DataFrame | None = None) -> DataFrame:
    """(uuid, by) to restore: all of rule_1, and judged pairs that do not contradict (no verdict: they do)."""
    rule = classes.where(F.col("class") == "rule_1").select("uuid", "by")
    if verdicts is None:
        return rule
    cleared = verdicts.where(~F.col("contradiction")).select("uuid")
    return rule.unionByName(classes.where(F.col("class") == "judge").join(cleared, "uuid", "left_semi").select("uuid", "by"))


def undo_log(facts: DataFrame, restore: DataFrame) -> DataFrame:
    """What a repair will overwrite."""
    return facts.join(restore.select("uuid", "by"), "uuid").select("uuid", "invalid_at", "expired_at", "by")


def repair_apply(facts: DataFrame, restore: DataFrame) -> DataFrame:
    """Facts with the ends of restored ones removed; columns as before."""
    marked = facts.join(restore.select("uuid").distinct().withColumn("_restore", F.lit(True)), "uuid", "left")
    for c in ("invalid_at", "expired_at"):
        marked = marked.withColumn(c, F.when(F.col("_restore").isNull(), F.col(c)))
    return marked.select(*facts.columns)


def run_metrics(facts: DataFrame, since: Column) -> DataFrame:
    """One row: new facts, facts given up in the run, fast ones with and without an invalidator, share in percent."""
    new = F.col("created_at") >= since
    gone = F.col("expired_at") >= since
    # looser than the repair: the fact itself may count, and creation order does not matter
    met = facts.where(gone & (window_seconds() < DAY)).select("uuid", "src", "dst", "invalid_at")
    ends = _ends(met, F.col("uuid"), F.col("invalid_at").alias("at"))
    begins = _ends(facts.where("valid_at is not null"), F.col("valid_at").alias("at")).distinct()
    fast = ends.join(begins, ["at", "end"], "left_semi").select("uuid").distinct().withColumn("_fast", F.lit(1))
    marked = facts.join(fast, "uuid", "left")
    quick = gone & (window_seconds() < DAY)
    row = marked.agg(
        F.count_if(new).alias("new_facts"),
        F.count_if(gone).alias("invalidated_in_run"),
        F.count_if(quick & F.col("_fast").isNotNull()).alias("fast_invalid"),
        F.count_if(quick & F.col("_fast").isNull()).alias("fast_invalid_extracted"),
    )
    share = (100 * F.col("fast_invalid") / F.col("new_facts")).cast("decimal(20,6)")
    return row.withColumn("fast_invalid_pct", F.when(F.col("new_facts") > 0, F.bround(share, 1).cast("double")).otherwise(F.lit(0.0)))


def alerts(metrics: DataFrame, fast_max: float = 5, generic_max: int = 3) -> DataFrame:
    """A row per alert that fires: name and value."""
    fired = F.array(
        F.when((F.col("new_facts") > 0) & (F.col("fast_invalid_pct") > fast_max), F.struct(F.lit("fast_invalid").alias("alert"), F.col("fast_invalid_pct").cast("double").alias("value"))),
        F.when(F.col("generic_nodes") > generic_max, F.struct(F.lit("generic_nodes").alias("alert"), F.col("generic_nodes").cast("double").alias("value"))),
    )
    return metrics.select(F.inline(F.array_compact(fired)))


def costs(usage: DataFrame, prices: DataFrame, since: Column | None = None) -> DataFrame:
    """Usage rows with the price of the lower-cased model, else of the model as written, else 0; usd as an exact decimal, whose twelfth place is the last that a price a million tokens can reach. A model listed twice has its lowest price."""
    if since is not None:
        usage = usage.where(F.col("ts") >= since)
    # a division would leave six places of a row's cost; the price of one token has room for all of them, and so has its product with a long
    each = lambda c: (F.col(c).cast("decimal(18,6)") * F.lit(Decimal("0.000001"))).cast("decimal(18,12)")
    p = prices.select("model", each("usd_in").alias("usd_in"), each("usd_out").alias("usd_out"))
    p = p.groupBy("model").agg(F.min("usd_in").alias("usd_in"), F.min("usd_out").alias("usd_out"))
    low = p.select(F.col("model").alias("m1"), F.col("usd_in").alias("in1"), F.col("usd_out").alias("out1"))
    exact = p.select(F.col("model").alias("m2"), F.col("usd_in").alias("in2"), F.col("usd_out").alias("out2"))
    priced = usage.join(low, F.lower("model") == F.col("m1"), "left").join(exact, F.col("model") == F.col("m2"), "left")
    zero = F.lit(0).cast("decimal(18,12)")
    cost = lambda n, *price: (F.col(n).cast("decimal(19,0)") * F.coalesce(*price, zero)).cast("decimal(30,12)")
    usd = cost("in", "in1", "in2") + cost("out", "out1", "out2")
    return priced.select(*usage.columns, usd.cast("decimal(31,12)").alias("usd"))


def cost_by(usage_costs: DataFrame, key: str) -> DataFrame:
    return usage_costs.groupBy(key).agg(F.sum("in").alias("tokens_in"), F.sum("out").alias("tokens_out"), F.bround(F.sum("usd"), 3).cast("double").alias("usd"))


def run_summary(facts: DataFrame, entities: DataFrame, usage_costs: DataFrame, since: Column, generic: Column, types: int = 8, fast_types: int = 5, top: int = 10) -> DataFrame:
    """One row with a run's metrics: those of ``run_metrics``, new nodes and generic ones, relation types of new and of fast facts, the most connected nodes, and the cost.

    Lists are bounded reports of ``types``, ``fast_types`` and ``top`` entries. ``entities``: uuid, name, created_at; ``generic``: a condition on them.
    """
    from .patterns import hubs, most_common

    listed = lambda df, key, n: df.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(key).alias("k")))), lambda x: F.concat(x["k"], F.lit(":"), (-x["o"]).cast("string"))), ",").alias(n))
    new = facts.where(F.col("created_at") >= since)
    fast = facts.where((F.col("expired_at") >= since) & (window_seconds() < DAY))
    nodes = entities.where(F.col("created_at") >= since).agg(F.count("*").alias("new_nodes"), F.count_if(generic).alias("generic_nodes"))
    cost = usage_costs.agg(F.bround(F.sum("usd"), 3).cast("double").alias("cost_usd"))
    degrees = hubs(facts, entities, top).withColumnRenamed("degree", "n")
    out = run_metrics(facts, since)
    for one in (nodes, listed(most_common(new, "name", types), "name", "new_fact_types"), listed(most_common(fast, "name", fast_types), "name", "fast_types"), listed(degrees, "uuid", "top_degree"), cost):
        out = out.crossJoin(one)  # a row each
    return out

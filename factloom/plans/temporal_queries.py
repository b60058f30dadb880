"""Queries over dated facts and usage, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..operators import temporal as t
from ..streaming import incremental as inc
from . import graph as g
from .graph import table, with_sql

SINCE = "1996-01-01"
WHEN = "1995-06-17"


def _timeline(spark, d):
    """Suppliers of a part over time, as an exclusive relation of the part."""
    f = g.facts(spark, d)
    return f.select("uuid", F.col("dst").alias("src"), F.lit("SUPPLIED_BY").alias("name"), F.col("src").alias("dst"), F.col("invalid_at").alias("valid_at"), F.lit(None).cast("timestamp_ntz").alias("invalid_at"), "created_at")


def supersede_exclusive(spark, d):
    kinds = spark.range(1).select(F.lit("SUPPLIED_BY").alias("name"), F.lit(t.EXCLUSIVE).alias("kind"))
    return t.supersede(_timeline(spark, d), kinds).select("uuid", "src", "dst", "valid_at", "invalid_at", "superseded")


def as_of_facts(spark, d):
    held = t.as_of(g.facts(spark, d), F.lit(WHEN).cast("timestamp_ntz"))
    return held.groupBy("src").agg(F.count("*").alias("n"))


def now_view(spark, d):
    return t.now_view(t.supersede(_timeline(spark, d))).select("uuid", "src", "dst", "valid_at")


def invalid_share(spark, d):
    f = t.supersede(_timeline(spark, d))
    return f.agg(F.count("*").alias("facts"), F.count("invalid_at").alias("invalid"), (100 * F.count("invalid_at") / F.count("*")).cast("decimal(20,4)").cast("double").alias("pct"))


def repair_classify(spark, d):
    return t.repair_classify(g.facts(spark, d))


def repair_class_counts(spark, d):
    return t.repair_classify(g.facts(spark, d)).groupBy("class").agg(F.count("*").alias("n"))


def repair_same_day(spark, d):
    at = F.lit(SINCE).cast("timestamp_ntz")
    return t.repair_same_day(g.facts(spark, d), at, at).select("uuid", "valid_at", "invalid_at")


def repair_apply(spark, d):
    f = g.facts(spark, d)
    classes = cut(t.repair_classify(f))  # used three times
    verdicts = classes.where(F.col("class") == "judge").select("uuid", (F.length("uuid") % 2 == 0).alias("contradiction"))
    return t.repair_apply(f, t.repair_plan(classes, verdicts)).select("uuid", "valid_at", "invalid_at", "expired_at")


def undo_log(spark, d):
    f = g.facts(spark, d)
    return t.undo_log(f, t.repair_plan(t.repair_classify(f)))


def fast_invalid_metrics(spark, d):
    return t.run_metrics(g.facts(spark, d), F.lit(SINCE).cast("timestamp_ntz"))


def quality_alerts(spark, d):
    m = t.run_metrics(g.facts(spark, d), F.lit(SINCE).cast("timestamp_ntz"))
    names = table(spark, d, "part").agg(F.count_if(F.col("p_size") > 45).alias("generic_nodes"))
    return t.alerts(m.crossJoin(names))


def _usage(spark, d):
    e = table(spark, d, "events")
    model = F.when(F.col("event_id") % 7 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    return e.select("event_id", "ts", F.col("user_id").cast("string").alias("tag"), model.alias("model"), F.floor("value").cast("long").alias("in"), (F.col("event_id") % 100).alias("out"))


def _prices(spark, d):
    rows = table(spark, d, "events").select("event_type").distinct().where("event_type <> 'click'")
    price = rows.select(F.col("event_type").alias("model"), (F.length("event_type") * 0.1).alias("usd_in"), (F.length("event_type") * 0.4).alias("usd_out"))
    return price.unionByName(price.where("model = 'view'").select(F.lit("CLICK").alias("model"), F.lit(9.0).alias("usd_in"), F.lit(1.0).alias("usd_out")))


def cost_by_model(spark, d):
    return t.cost_by(t.costs(_usage(spark, d), _prices(spark, d)), "model")


def cost_by_tag(spark, d):
    return t.cost_by(t.costs(_usage(spark, d), _prices(spark, d)), "tag")


def price_lookup_fallback(spark, d):
    c = t.costs(_usage(spark, d), _prices(spark, d))
    return c.groupBy("model").agg(F.count_if(F.col("usd") == 0).alias("free"), F.count("*").alias("calls"))


def last10_moving_avg(spark, d):
    e = table(spark, d, "events").withColumn("v", F.floor("value"))
    out = inc.moving_average(e, "v", "user_id", ["ts", "event_id"], 10)
    return out.select("event_id", "user_id", F.round("mean", 6).alias("mean"))


def stall_gaps(spark, d):
    return inc.gaps(table(spark, d, "events"), 86_400).select("event_id", "user_id", "gap")


def retention_keep_n(spark, d):
    out = inc.keep_newest(table(spark, d, "orders"), 5, "o_custkey", [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return out.select("o_orderkey", "o_custkey", "keep")


def session_windows(spark, d):
    return inc.sessions(table(spark, d, "events"), "2 hours")


def daily_run_metrics(spark, d):
    return inc.daily(table(spark, d, "events"), "ts", None, "event_type").select("day", "event_type", "events", F.round(F.col("total").cast("double"), 2).alias("total"))


def new_items_anti(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("name"), "o_orderstatus")
    loaded = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("name"))
    skipped = orders.where("o_orderstatus = 'P'").select("name")
    return inc.new_items(orders, loaded, skipped)


def incremental_two_runs(spark, d):
    """Names that a second run finds after a first run has loaded the older half."""
    e = table(spark, d, "events").select(F.col("event_id").alias("name"), "ts")
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    first = e.where(F.col("ts") < middle)
    return inc.new_items(e, first).groupBy(F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("day")).agg(F.count("*").alias("n"))


def changed_digests(spark, d):
    c = table(spark, d, "conversations").groupBy(F.col("conv_id").alias("sid")).agg(F.sha1(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "|")).alias("hash"))
    old = c.where("sid % 3 <> 0")
    return inc.changed_items(c, old)


QUERIES = {f.__name__: f for f in (
    supersede_exclusive, as_of_facts, now_view, invalid_share, repair_classify, repair_class_counts, repair_same_day, repair_apply, undo_log, fast_invalid_metrics, quality_alerts,
    cost_by_model, cost_by_tag, price_lookup_fallback, last10_moving_avg, stall_gaps, retention_keep_n, session_windows, daily_run_metrics, new_items_anti, incremental_two_runs, changed_digests,
)}

_TIMELINE = """timeline AS (SELECT uuid, dst AS src, src AS dst, invalid_at AS valid_at, created_at FROM facts),
  changes AS (SELECT *, CASE WHEN lag(dst) OVER w IS NULL OR lag(dst) OVER w <> dst THEN valid_at END AS c FROM timeline WINDOW w AS (PARTITION BY src ORDER BY valid_at, created_at, uuid)),
  closed AS (SELECT uuid, src, dst, valid_at, first(c IGNORE NULLS) OVER (PARTITION BY src ORDER BY valid_at, created_at, uuid ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS invalid_at FROM changes)"""
_CLASSES = """ended AS (SELECT *, epoch_us(invalid_at) - epoch_us(valid_at) AS us FROM facts),
  ends AS (SELECT uuid, valid_at, created_at, unnest(list_distinct([src, dst])) AS e FROM facts),
  met AS (SELECT f.uuid, arg_min(c.uuid, {'a': c.created_at, 'b': c.uuid}) AS "by" FROM (SELECT uuid, invalid_at, created_at, unnest(list_distinct([src, dst])) AS e FROM facts) f
    JOIN ends c ON c.valid_at = f.invalid_at AND c.e = f.e AND c.uuid <> f.uuid AND c.created_at >= f.created_at GROUP BY f.uuid),
  classes AS (SELECT uuid, CASE WHEN "by" IS NULL THEN 'history' WHEN us < 86400000000 THEN 'rule_1' WHEN us <= 7 * 86400000000 THEN 'judge' ELSE 'leave' END AS class, "by" FROM ended LEFT JOIN met USING (uuid))"""
_METRICS = f"""begins AS (SELECT DISTINCT valid_at AS t, unnest([src, dst]) AS e FROM facts),
  quick AS (SELECT *, epoch_us(invalid_at) - epoch_us(valid_at) < 86400000000 AND expired_at >= TIMESTAMP '{SINCE}' AS q FROM facts),
  met AS (SELECT DISTINCT uuid FROM (SELECT uuid, invalid_at AS t, unnest([src, dst]) AS e FROM quick WHERE q) JOIN begins USING (t, e)),
  metrics AS (SELECT count(*) FILTER (WHERE created_at >= TIMESTAMP '{SINCE}') AS new_facts, count(*) FILTER (WHERE expired_at >= TIMESTAMP '{SINCE}') AS invalidated_in_run,
    count(*) FILTER (WHERE q AND uuid IN (SELECT uuid FROM met)) AS fast_invalid, count(*) FILTER (WHERE q AND uuid NOT IN (SELECT uuid FROM met)) AS fast_invalid_extracted FROM quick),
  scored AS (SELECT *, CASE WHEN new_facts > 0 THEN CAST(round_even(CAST(100 * fast_invalid / new_facts AS DECIMAL(20, 6)), 1) AS DOUBLE) ELSE 0.0 END AS fast_invalid_pct FROM metrics)"""
_USAGE = """usage AS (SELECT event_id, ts, CAST(user_id AS VARCHAR) AS tag, CASE WHEN event_id % 7 = 0 THEN upper(event_type) ELSE event_type END AS model,
    CAST(floor(value) AS BIGINT) AS i, event_id % 100 AS o FROM events),
  prices AS (SELECT DISTINCT event_type AS model, CAST(length(event_type) * 0.1 AS DECIMAL(18, 6)) AS pi, CAST(length(event_type) * 0.4 AS DECIMAL(18, 6)) AS po FROM events WHERE event_type <> 'click'
    UNION ALL SELECT DISTINCT 'CLICK', CAST(9 AS DECIMAL(18, 6)), CAST(1 AS DECIMAL(18, 6)) FROM events WHERE event_type = 'view'),
  costs AS (SELECT u.*, (i * coalesce(p1.pi, p2.pi, 0) + o * coalesce(p1.po, p2.po, 0)) AS micro FROM usage u LEFT JOIN prices p1 ON lower(u.model) = p1.model LEFT JOIN prices p2 ON u.model = p2.model)"""
_COST = "SELECT {k}, CAST(sum(i) AS BIGINT) AS tokens_in, CAST(sum(o) AS BIGINT) AS tokens_out, CAST(round_even(CAST(sum(micro) AS DECIMAL(38, 6)) / 1000000, 3) AS DOUBLE) AS usd FROM costs GROUP BY 1"


def _with(more: str, body: str) -> str:
    return with_sql("", "facts").rstrip() + ",\n" + more + "\n" + body


ORACLES = {
    "supersede_exclusive": _with(_TIMELINE, "SELECT uuid, src, dst, valid_at, invalid_at, invalid_at IS NOT NULL AS superseded FROM closed"),
    "as_of_facts": with_sql(f"SELECT src, count(*) AS n FROM facts WHERE valid_at <= TIMESTAMP '{WHEN}' AND (invalid_at IS NULL OR invalid_at > TIMESTAMP '{WHEN}') GROUP BY 1", "facts"),
    "now_view": _with(_TIMELINE, "SELECT uuid, src, dst, valid_at FROM closed WHERE invalid_at IS NULL"),
    "invalid_share": _with(_TIMELINE, "SELECT count(*) AS facts, count(invalid_at) AS invalid, CAST(CAST(100 * count(invalid_at) / count(*) AS DECIMAL(20, 4)) AS DOUBLE) AS pct FROM closed"),
    "repair_classify": _with(_CLASSES, 'SELECT uuid, class, "by" FROM classes'),
    "repair_class_counts": _with(_CLASSES, "SELECT class, count(*) AS n FROM classes GROUP BY 1"),
    "repair_same_day": with_sql(
        f"SELECT uuid, valid_at, invalid_at FROM facts WHERE epoch_us(invalid_at) - epoch_us(valid_at) < 86400000000 AND created_at >= TIMESTAMP '{SINCE}' AND expired_at >= TIMESTAMP '{SINCE}'", "facts"),
    "repair_apply": _with(_CLASSES + ",\n  restore AS (SELECT uuid FROM classes WHERE class = 'rule_1' OR (class = 'judge' AND length(uuid) % 2 <> 0))",
        """SELECT uuid, valid_at, CASE WHEN uuid IN (SELECT uuid FROM restore) THEN NULL ELSE invalid_at END AS invalid_at,
        CASE WHEN uuid IN (SELECT uuid FROM restore) THEN NULL ELSE expired_at END AS expired_at FROM facts"""),
    "undo_log": _with(_CLASSES, "SELECT uuid, invalid_at, expired_at, \"by\" FROM facts JOIN classes USING (uuid) WHERE class = 'rule_1'"),
    "fast_invalid_metrics": _with(_METRICS, "SELECT * FROM scored"),
    "quality_alerts": _with(_METRICS, """SELECT 'fast_invalid' AS alert, fast_invalid_pct AS value FROM scored WHERE new_facts > 0 AND fast_invalid_pct > 5
        UNION ALL SELECT 'generic_nodes', CAST(n AS DOUBLE) FROM (SELECT count(*) AS n FROM part WHERE p_size > 45) WHERE n > 3"""),
    "cost_by_model": f"WITH {_USAGE} " + _COST.format(k="model"),
    "cost_by_tag": f"WITH {_USAGE} " + _COST.format(k="tag"),
    "price_lookup_fallback": f"WITH {_USAGE} SELECT model, count(*) FILTER (WHERE micro = 0) AS free, count(*) AS calls FROM costs GROUP BY 1",
    "last10_moving_avg": "SELECT event_id, user_id, round(avg(floor(value)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS mean FROM events",
    "stall_gaps": """SELECT event_id, user_id, gap FROM (SELECT event_id, user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) // 1000000 AS gap FROM events) WHERE gap > 86400""",
    "retention_keep_n": "SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 5 AS keep FROM orders",
    "session_windows": """WITH marked AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 2 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS events FROM numbered GROUP BY user_id, s""",
    "daily_run_metrics": "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS events, round(CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE), 2) AS total FROM events GROUP BY 1, 2",
    "new_items_anti": "SELECT o_orderkey AS name, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "incremental_two_runs": "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS n FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-15') GROUP BY 1",
    "changed_digests": "SELECT conv_id AS sid, sha1(string_agg(text, '|' ORDER BY turn)) AS hash FROM conversations WHERE conv_id % 3 = 0 GROUP BY 1",
}

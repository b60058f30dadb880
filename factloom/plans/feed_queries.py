"""Queries that write a feed or a sink and read it back, and runs of incremental loads, with their SQL.

Feeds of notes and transcripts are literals; the others are made from the driver's tables.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.lineage import scratch_path
from ..sources import feeds, sinks
from ..streaming import incremental as inc
from .graph import table
from .text_queries import packed_sql, paragraphs_sql

NOTES = {
    "alpha.md": "---\nstatus: confirmed\nverified_at: 2024-05-01\nscope: lab\ndescription: About alpha\n---\nfirst line\n\nsecond line",
    "beta.md": "no front matter\n\n  indented",
    "gamma.md": "---\nhistorical: true\nwritten_at: 2020-01-01\n---\nold text",
    "INDEX.md": "an index",
    "skip.md": "left out",
}
TIMES = {"alpha.md": 1714521600, "beta.md": 1600000000, "gamma.md": 1577836800}
NOTE_LIMIT = 15
TRANSCRIPTS = {
    "abcdefghij.jsonl": "\n".join((
        '{"type":"user","timestamp":"2024-01-01T00:00:00Z","message":{"content":"hello <sys>x</sys> there"}}',
        '{"type":"assistant","timestamp":"2024-01-01T00:01:00Z","message":{"content":[{"type":"text","text":"a long enough answer"},{"type":"tool","text":"no"}]}}',
        "not json",
        '{"type":"assistant","message":{"content":"short"}}',
        '{"type":"user","isMeta":true,"message":{"content":"meta"}}',
        '{"aiTitle":"One"}',
        '{"aiTitle":"Two"}',
    )),
    "other.jsonl": "\n".join(('{"type":"user","timestamp":"2024-02-01T00:00:00Z","message":{"content":"[service] started"}}', '{"type":"user","timestamp":"2024-02-01T00:00:05Z","message":{"content":"a question"}}', '{"aiTitle":" "}')),
}
NOW = 1735689600
AT = int(datetime(2024, 2, 3, 4, 5, 6, tzinfo=timezone.utc).timestamp())


def _notes(spark):
    folder = scratch_path(spark, "notes")
    feeds.write_feed(spark, folder, NOTES)
    manifest = spark.createDataFrame(list(TIMES.items()), "file string, mtime_epoch long")
    return feeds.with_manifest(feeds.note_files(spark, folder, exclude=["skip.md"]), manifest)


def note_scan(spark, d):
    return _notes(spark).select("file", F.length("text").alias("chars"), F.unix_timestamp("modified_at").alias("at"))


def note_episode_records(spark, d):
    out = feeds.note_episodes(_notes(spark), "main", NOTE_LIMIT)
    return out.select("name", "content", F.unix_timestamp(tx.parse_time(F.col("reference_time"))).alias("at"), "source_description")


def note_copies(spark, d):
    """Clean copies under the notes' names, with their times; what an earlier run has left goes."""
    folder = scratch_path(spark, "copies")
    feeds.write_feed(spark, folder, {"stale.md": "from before"})
    n = sinks.write_note_files(_notes(spark).withColumn("text", F.upper("text")), folder)
    back = feeds.note_files(spark, folder)
    return back.select("file", F.md5("text").alias("md5"), F.unix_timestamp("modified_at").alias("at"), F.lit(n).alias("written"))


def _transcripts(spark):
    folder = scratch_path(spark, "transcripts")
    feeds.write_feed(spark, folder, TRANSCRIPTS)
    return feeds.transcript_lines(spark, folder)


def transcript_turns(spark, d):
    return feeds.turns(_transcripts(spark), ["sys"], ("[service]",)).select("session", "line_no", "ts", "role", "text")


def transcript_titles(spark, d):
    return feeds.titles(_transcripts(spark))


def transcript_episodes(spark, d):
    lines = _transcripts(spark)
    said = feeds.turns(lines, ["sys"], ("[service]",)).join(feeds.titles(lines), "session", "left")
    return feeds.session_episodes(said, "main").select("name", "content", "reference_time")


def inbox_records(spark, d):
    path = scratch_path(spark, "inbox")
    docs = table(spark, d, "documents")
    docs.select(
        F.col("doc_id").alias("id"),
        F.lit("2024-01-01T10:00:00").alias("ts"),
        F.lit("m").alias("kind"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("  ")).otherwise(F.left("text", F.lit(60))).alias("text"),
        F.concat(F.lit("caption, from "), "source").alias("caption"),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("/a/b/"), "source", F.lit(".pdf"))).alias("file"),
    ).write.json(path)
    feeds.write_feed(spark, path, {"bad.json": "not json\n{\"id\": -1, \"text\": \"short\"}\n"})
    return feeds.inbox_episodes(feeds.inbox(spark, path), "main").select("name", "content")


def episode_records(spark, d):
    path = scratch_path(spark, "episodes")
    docs = table(spark, d, "documents")
    time = F.element_at(F.array(F.lit("2024-02-03T04:05:06Z"), F.lit(""), F.lit("soon")), (F.col("doc_id") % 3 + 1).cast("int"))
    rows = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("name"), F.col("lang").alias("group"), F.left("text", F.lit(20)).alias("content"), time.alias("reference_time"), F.lit("x").alias("source_description"))
    sinks.write_episodes(rows, path)
    return feeds.episodes(spark, path, "en", F.timestamp_seconds(F.lit(NOW))).select("name", F.unix_timestamp("at").alias("at"))


def usage_records(spark, d):
    path = scratch_path(spark, "usage")
    e = table(spark, d, "events").select(F.col("event_id").cast("double").alias("ts"), F.lit("t").alias("tag"), F.col("event_type").alias("model"), F.col("user_id").alias("in"), F.lit(1).cast("long").alias("out"))
    for odd in (0, 1):
        sinks.append_usage(e.where(F.col("in") % 2 == odd), path)
    feeds.write_feed(spark, path, {"bad.json": '{"ts": 1e9, "model": "click", "in": 7, "out": 0}\n{"ts": oops\n'})
    return feeds.usage(spark, path, 500.0).groupBy("model").agg(F.count("*").alias("calls"), F.sum("in").alias("tokens_in"), F.sum("out").alias("tokens_out"))


def prefix_pick(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("session"), "turn")
    return feeds.by_prefix(c, ["1", "23"])


def idle_sessions(spark, d):
    last = table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    return inc.closed_only(last, F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"), 12.5)


def _names(spark, d):
    return table(spark, d, "orders").select(F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("name"), "o_orderstatus")


def state_slice(spark, d):
    names = _names(spark, d)
    return inc.new_items(names, names.where("o_orderstatus = 'F'"), offset=5, limit=20)


def state_commit(spark, d):
    """Names that are new after two commits that overlap, and after the state's files were put together."""
    path = scratch_path(spark, "state")
    names = _names(spark, d)
    sinks.append_state(names.where("o_orderstatus = 'F'"), path)
    sinks.append_state(names.where("o_orderstatus in ('F', 'P')"), path)
    inc.compact_state(spark, path)
    return inc.new_items(names, inc.loaded(spark, path)).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


LOG = "concat(if(event_id % 10 = 0, 'ERROR in ', if(event_id % 3 = 0, 'noise from ', 'batch ')), event_id % 9 + 1, '/9 took ', event_id % 100, '.5 s')"


def _log(spark, d):
    path = scratch_path(spark, "log")
    table(spark, d, "events").select(F.expr(LOG).alias("value")).write.text(path)
    return spark.read.text(path)


def log_progress(spark, d):
    return feeds.progress(_log(spark, d)).groupBy("done", "total").agg(F.count("*").alias("n"), F.sum("seconds").alias("seconds"))


def log_visible(spark, d):
    return feeds.visible(_log(spark, d), "^noise|^batch 1/").groupBy(F.split("value", " ")[0].alias("kind")).agg(F.count("*").alias("n"))


def run_error_count(spark, d):
    lines = table(spark, d, "events").select(F.col("event_id").alias("seq"), F.expr(LOG).alias("line"))
    return inc.run_errors(lines, 100)


def rebuilt_digests(spark, d):
    """The output is always that of all stored rows: what only an earlier run had is gone."""
    path = scratch_path(spark, "digests")
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"))
    sinks.rebuild(c.withColumn("turns", F.lit(-1).cast("long")).unionByName(spark.range(1).select(F.lit(-5).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turns"))), path)
    sinks.rebuild(c, path)
    return spark.read.parquet(path)


def replaced_groups(spark, d):
    path = scratch_path(spark, "groups")
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("group_id"))
    sinks.replace_group(rows, path)
    sinks.replace_group(rows.where("group_id in ('BUILDING', 'MACHINERY') and c_custkey % 2 = 0"), path)
    return spark.read.parquet(path).groupBy("group_id").agg(F.count("*").alias("n"))


def clean_note_rows(spark, d):
    path = scratch_path(spark, "clean")
    docs = table(spark, d, "documents").select(F.concat(F.lit("n"), F.col("doc_id").cast("string"), F.lit(".md")).alias("file"), F.timestamp_seconds("doc_id").alias("modified_at"), "text", "doc_id")
    sinks.write_notes(docs, path)
    sinks.write_notes(docs.where("doc_id % 2 = 0").withColumn("text", F.concat(F.lit("# "), "text")), path)
    return spark.read.parquet(path).select("file", F.unix_timestamp("modified_at").alias("at"), F.md5("text").alias("md5"))


def undo_by_run(spark, d):
    path = scratch_path(spark, "undo")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_undo(o.where("o_orderstatus = 'F'"), path, "run-1")
    sinks.write_undo(o.where("o_orderkey % 2 = 0"), path, "run-2")
    return spark.read.parquet(path).groupBy("run").agg(F.count("*").alias("n"))


def snapshot_retention(spark, d):
    root = scratch_path(spark, "snapshots")
    n = table(spark, d, "nation")
    versions = ["2024-01-01", "2024-01-03", "2024-01-02"]
    for v in versions:
        sinks.snapshot(n, root, v)
    stale = sinks.stale_snapshots(versions, 2)
    kept = [v for v in versions if v not in stale]
    out = None
    for v in kept:
        one = spark.read.parquet(f"{root}/{v}").agg(F.count("*").alias("rows")).select(F.lit(v).alias("version"), "rows", F.lit(",".join(stale)).alias("stale"))
        out = one if out is None else out.unionByName(one)
    return out


def regrouped(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("group_id"))
    both = c.unionByName(sinks.regroup(c.where("group_id = 'BUILDING'"), "copy"))
    return both.groupBy("group_id").agg(F.count("*").alias("n"))


def run_attention(spark, d):
    e = table(spark, d, "events")
    errors = inc.run_errors(e.select(F.col("event_id").alias("seq"), F.expr(LOG).alias("line")), 50)
    secrets = table(spark, d, "documents").agg(F.count_if(F.col("text").contains("@")).alias("hits"))
    return sinks.alert_flags(errors, secrets, e.where("event_type = 'nothing'").select("event_id"))


def cluster_dump(spark, d):
    path = scratch_path(spark, "clusters")
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("cluster"), F.col("c_custkey").cast("string").alias("node"), F.col("c_name").alias("name"))
    sinks.dump_clusters(c, path, 3)
    return spark.read.json(path).select("community", "n_members", "names")


def _target(path):
    """A loader that writes a run's rows to a folder of the run's id, over what is there."""
    return lambda rows, run: rows.write.mode("overwrite").parquet(f"{path}/run={run}")


def nightly_runs(spark, d):
    """Rows that three runs load: of half the orders, of all of them, and of nothing new; and what the target has then."""
    root = scratch_path(spark, "nightly")
    names = _names(spark, d)
    n = [inc.load_batch(part, _target(f"{root}/target"), f"{root}/state") for part in (names.where("o_orderstatus = 'F'"), names, names)]
    held = spark.read.parquet(f"{root}/target").agg(F.count("*").alias("held"), F.count_distinct("name").alias("different"))
    return spark.createDataFrame([(i + 1, x) for i, x in enumerate(n)], "run int, loaded long").crossJoin(held)


def load_redone(spark, d):
    """A run that stops between load and commit is done again under the same id: nothing is there twice."""
    root = scratch_path(spark, "redone")
    names, write = _names(spark, d), _target(f"{root}/target")

    def stops(rows, run):
        write(rows, run)
        raise InterruptedError("after the load")

    try:
        inc.load_batch(names, stops, f"{root}/state")
        first = "committed"
    except InterruptedError:
        first = "stopped"
    inc.load_batch(names, write, f"{root}/state")
    return spark.read.parquet(f"{root}/target").agg(F.count("*").alias("held"), F.count_distinct("name").alias("different")).select(F.lit(first).alias("first_run"), "held", "different")


def load_batches(spark, d):
    """Batches of about 30 names, eight at a time, one of which fails in the first run; the second run takes it up."""
    root = scratch_path(spark, "batches")
    names = table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("name"))
    write = _target(f"{root}/target")

    def fails(rows, run):
        if rows.where("name = '7'").count():
            raise ValueError("this one fails")
        write(rows, run)

    first = inc.load_in_batches(names, fails, f"{root}/state", 30, workers=8)
    again = inc.load_in_batches(names, write, f"{root}/state", 30, workers=8)
    failed = [b for b in first if b[2]]
    row = (sum(n for _, n, e in first if not e) + sum(n for _, n, _ in failed), len(failed), failed[0][2], sum(n for _, n, _ in again) == sum(n for _, n, _ in failed))
    held = spark.read.parquet(f"{root}/target").agg(F.count("*").alias("held"))
    return spark.createDataFrame([row], "seen long, failed int, error string, rest_loaded boolean").crossJoin(held)


def second_writer(spark, d):
    """While one holds a state, another gets an error; afterwards it is free."""
    path = scratch_path(spark, "held")
    said = []
    with inc.single_writer(spark, path):
        try:
            with inc.single_writer(spark, path):
                said.append("two writers")
        except RuntimeError:
            said.append("refused")
    with inc.single_writer(spark, path):
        said.append("free")
    return spark.createDataFrame([(i, s) for i, s in enumerate(said)], "step int, outcome string")


def grown_notes(spark, d):
    """Chunk names that a grown text adds: only what its last chunks have changed is new."""
    docs = table(spark, d, "documents").select("doc_id", "text")

    def names(df):
        rows = df.select("doc_id", F.posexplode(tx.chunks(F.col("text"), 500, r"\n")).alias("i", "chunk"))
        return rows.select("doc_id", tx.chunk_name(F.col("doc_id").cast("string"), F.col("i") + 1, tx.content_hash(F.col("chunk"))).alias("name"))

    grown = docs.withColumn("text", F.concat("text", F.lit("\none more paragraph")))
    return inc.new_items(names(grown), names(docs)).groupBy("doc_id").agg(F.count("*").alias("n"))


def blank_chunks(spark, d):
    """Texts cut at literal blank lines, where blank paragraphs take part."""
    docs = table(spark, d, "documents").select("doc_id", F.replace("text", F.lit(". "), F.lit(".\n\n \n\n")).alias("text"))
    rows = docs.select("doc_id", F.posexplode(tx.chunks(F.col("text"), 300, "\n\n", keep_blank=True)).alias("i", "chunk"))
    return rows.select("doc_id", "i", F.length("chunk").alias("chars"), F.md5("chunk").alias("md5"))


def model_calls(spark, d):
    """The log of model calls, with failed ones and a broken line: calls, failures and seconds by model."""
    path = scratch_path(spark, "calls")
    e = table(spark, d, "events")
    status = F.when(F.col("event_id") % 10 == 0, 500).otherwise(200)
    e.select(
        F.col("event_id").cast("double").alias("ts"), F.lit("t").alias("tag"), F.lit("/v1").alias("path"), status.alias("status"), F.col("event_type").alias("model"), F.col("user_id").alias("pt"), F.lit(1).cast("long").alias("ct"),
        F.lit(0).cast("long").alias("rt"), F.lit(0.5).alias("cost"), (F.col("event_id") % 1000).alias("ms"), F.when(F.col("event_id") % 10 == 0, F.lit("timeout")).alias("err"),
    ).write.json(path)
    feeds.write_feed(spark, path, {"bad.json": "{\"ts\": 1, \"status\": oops\n"})
    calls = feeds.model_calls(spark, path, 100.0)
    return calls.groupBy("model").agg(F.count("*").alias("calls"), F.count("err").alias("failed"), F.sum("ms").alias("ms"), F.sum("cost").alias("cost"))


def retried(spark, d):
    """A load that fails twice and is done in a smaller batch at last."""
    asked = []

    def run(size):
        asked.append(size)
        if len(asked) < 3:
            raise ValueError("not yet")

    attempt = inc.retry(run)
    return spark.createDataFrame([(attempt, ",".join(map(str, asked)))], "attempt int, sizes string")


def build_steps(spark, d):
    config = feeds.Config({"graph": {"name": "main"}, "sources": {"n": {"instr": "own"}, "archives": [{"label": "old", "instr": "archived"}]}, "steps": [{"kind": "notes", "key": "n"}, {"kind": "notes", "key": "old"}, {"kind": "chat"}, {"kind": "chat", "key": "n", "instr": "step"}]})
    rows = [("step", *s) for s in config.steps({"chat": "by kind"})]
    rows += [("value", "graph.name", str(config.get("graph.name")), ""), ("default", "graph.port", str(config.get("graph.port", 6379)), "")]
    rows += [("problem", p, "", "") for p in feeds.Config({"sources": {"a": {}}}).problems()]
    return spark.createDataFrame(rows, "what string, kind string, key string, instruction string")


QUERIES = {f.__name__: f for f in (
    note_scan, note_episode_records, note_copies, transcript_turns, transcript_titles, transcript_episodes, inbox_records, episode_records, usage_records, prefix_pick, idle_sessions, state_slice, state_commit,
    log_progress, log_visible, run_error_count, rebuilt_digests, replaced_groups, clean_note_rows, undo_by_run, snapshot_retention, regrouped, run_attention, cluster_dump, nightly_runs, load_redone, load_batches,
    second_writer, grown_notes, blank_chunks, model_calls, retried, build_steps,
)}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _listed(rows, *columns: str) -> str:
    one = lambda v: _text(v) if isinstance(v, str) else "NULL" if v is None else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) v({', '.join(columns)})"


_KEPT = [(f, NOTES[f], TIMES[f]) for f in ("alpha.md", "beta.md", "gamma.md")]
_SAID = "user: hello  there\n\nassistant: a long enough answer"
_HEADER = "[note: status CONFIRMED (current); checked 2024-05-01; scope lab] "
_CHUNKS = [
    ("alpha.md", 1, "first line", "|confirmed|2024-05-01", _HEADER + "About alpha\n\nfirst line"),
    ("alpha.md", 2, "second line", "|confirmed|2024-05-01", _HEADER + "\n\nsecond line"),
    ("beta.md", 1, "no front matter", "||", "no front matter"),
    ("beta.md", 2, "  indented", "||", "  indented"),
    ("gamma.md", 1, "old text", "||", "[ARCHIVE, written 2020-01-01] \n\nold text"),
]
_LOG_SQL = "(CASE WHEN event_id % 10 = 0 THEN 'ERROR in ' WHEN event_id % 3 = 0 THEN 'noise from ' ELSE 'batch ' END) || (event_id % 9 + 1) || '/9 took ' || (event_id % 100) || '.5 s'"
_NAMES_SQL = "names AS (SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS name, o_orderstatus FROM orders)"


_FULL_NAMES = lambda t: f"SELECT doc_id, doc_id || '#' || (i + 1) || '@' || left(sha1(chunk), 8) AS name FROM {t}"

ORACLES = {
    "note_scan": 'SELECT file, CAST(length(t) AS INTEGER) AS chars, CAST("at" AS BIGINT) AS "at" FROM (' + _listed(_KEPT, "file", "t", '"at"') + ")",
    "note_episode_records": """SELECT file || '#' || i || '@' || left(sha1(chunk || tail), 8) AS name, content, CAST("at" AS BIGINT) AS "at", 'note ' || file AS source_description FROM ("""
    + _listed([(*c, TIMES[c[0]]) for c in _CHUNKS], "file", "i", "chunk", "tail", "content", '"at"') + ")",
    "note_copies": 'SELECT file, md5(upper(t)) AS md5, CAST("at" AS BIGINT) AS "at", 3 AS written FROM (' + _listed(_KEPT, "file", "t", '"at"') + ")",
    "transcript_turns": _listed([("abcdefghij", 0, "2024-01-01T00:00:00Z", "user", "hello  there"), ("abcdefghij", 1, "2024-01-01T00:01:00Z", "assistant", "a long enough answer"), ("other", 1, "2024-02-01T00:00:05Z", "user", "a question")], "session", "line_no", "ts", "role", "text"),
    "transcript_titles": "SELECT 'abcdefghij' AS session, 'Two' AS title",
    "transcript_episodes": f"""SELECT 'abcdefgh#1@' || left(sha1({_text(_SAID)}), 8) AS name, '[session Two, 2024-01-01, part 1] ' || {_text(_SAID)} AS content, '2024-01-01T00:00:00Z' AS reference_time
        UNION ALL SELECT 'other#1@' || left(sha1('user: a question'), 8), '[session , 2024-02-01, part 1] user: a question', '2024-02-01T00:00:05Z'""",
    "inbox_records": """WITH said AS (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 OR trim(t) = '' THEN 'caption, from ' || source ELSE t END AS said
          FROM (SELECT doc_id, source, regexp_replace(coalesce(left(text, 60), ''), '^\\s+|\\s+$', '', 'g') AS t FROM documents))
        SELECT 'inbox_' || doc_id || '@' || left(sha1(said), 8) AS name, '[inbox 2024-01-01T10:00' || CASE WHEN doc_id % 2 = 0 THEN ', file ' || source || '.pdf' ELSE '' END || '] ' || said AS content
        FROM said WHERE length(said) >= 20""",
    "episode_records": f"""SELECT 'd' || doc_id AS name, CAST(CASE WHEN doc_id % 3 = 0 THEN {AT} ELSE {NOW} END AS BIGINT) AS "at" FROM documents WHERE lang = 'en'""",
    "usage_records": """SELECT model, count(*) AS calls, CAST(sum(i) AS BIGINT) AS tokens_in, CAST(sum(o) AS BIGINT) AS tokens_out FROM (SELECT event_type AS model, user_id AS i, 1 AS o FROM events WHERE event_id >= 500
        UNION ALL SELECT 'click', 7, 0) GROUP BY 1""",
    "prefix_pick": "SELECT CAST(conv_id AS VARCHAR) AS session, turn FROM conversations WHERE starts_with(CAST(conv_id AS VARCHAR), '1') OR starts_with(CAST(conv_id AS VARCHAR), '23')",
    "idle_sessions": "SELECT user_id, max(ts) AS last_ts FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 750 MINUTE",
    "state_slice": f"WITH {_NAMES_SQL} SELECT * FROM names WHERE o_orderstatus <> 'F' ORDER BY name LIMIT 20 OFFSET 5",
    "state_commit": "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'P') GROUP BY 1",
    "log_progress": "SELECT CAST(event_id % 9 + 1 AS INTEGER) AS done, 9 AS total, count(*) AS n, CAST(sum(event_id % 100 + 0.5) AS DOUBLE) AS seconds FROM events WHERE event_id % 10 <> 0 AND event_id % 3 <> 0 GROUP BY 1",
    "log_visible": f"SELECT string_split(l, ' ')[1] AS kind, count(*) AS n FROM (SELECT {_LOG_SQL} AS l FROM events) WHERE l LIKE 'ERROR%' OR NOT regexp_matches(l, '^noise|^batch 1/') GROUP BY 1",
    "run_error_count": "SELECT count(*) AS errors FROM events WHERE event_id > 100 AND event_id % 10 = 0",
    "rebuilt_digests": "SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1",
    "replaced_groups": "SELECT c_mktsegment AS group_id, count(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') OR c_custkey % 2 = 0 GROUP BY 1",
    "clean_note_rows": """SELECT 'n' || doc_id || '.md' AS file, doc_id AS "at", md5('# ' || text) AS md5 FROM documents WHERE doc_id % 2 = 0""",
    "undo_by_run": "SELECT 'run-1' AS run, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'run-2', count(*) FROM orders WHERE o_orderkey % 2 = 0",
    "snapshot_retention": "SELECT v AS version, (SELECT count(*) FROM nation) AS rows, '2024-01-01' AS stale FROM (VALUES ('2024-01-03'), ('2024-01-02')) t(v)",
    "regrouped": "SELECT c_mktsegment AS group_id, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT 'copy', count(*) FROM customer WHERE c_mktsegment = 'BUILDING'",
    "run_attention": """SELECT *, errors > 0 OR secrets > 0 OR alerts > 0 AS attention FROM (SELECT (SELECT count(*) FROM events WHERE event_id > 50 AND event_id % 10 = 0) AS errors,
        (SELECT count(*) FROM documents WHERE contains(text, '@')) AS secrets, CAST(0 AS BIGINT) AS alerts)""",
    "cluster_dump": """SELECT c_mktsegment AS community, count(*) AS n_members, array_to_string(list(c_name ORDER BY c_name, CAST(c_custkey AS VARCHAR))[1:3], '|') AS names FROM customer GROUP BY 1""",
    "nightly_runs": """SELECT run, loaded, held, held AS different FROM (SELECT 1 AS run, count(*) AS loaded FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 2, count(*) FROM orders WHERE o_orderstatus <> 'F'
        UNION ALL SELECT 3, 0), (SELECT count(*) AS held FROM orders)""",
    "load_redone": "SELECT 'stopped' AS first_run, count(*) AS held, count(DISTINCT o_orderkey) AS different FROM orders",
    "load_batches": "SELECT count(*) AS seen, 1 AS failed, 'ValueError: this one fails' AS error, true AS rest_loaded, count(*) AS held FROM supplier",
    "second_writer": "SELECT * FROM (VALUES (0, 'refused'), (1, 'free')) v(step, outcome)",
    "grown_notes": f"""WITH RECURSIVE before AS (SELECT doc_id, {paragraphs_sql('text')} AS ps FROM documents), after AS (SELECT doc_id, {paragraphs_sql("text || chr(10) || 'one more paragraph'")} AS ps FROM documents),
{packed_sql('before', 500, 'old')}, {packed_sql('after', 500, 'fresh')}
SELECT doc_id, count(*) AS n FROM ({_FULL_NAMES('fresh')}) WHERE name NOT IN (SELECT name FROM ({_FULL_NAMES('old')})) GROUP BY 1""",
    "blank_chunks": f"""WITH RECURSIVE paragraphs AS (SELECT doc_id, string_split(replace(text, '. ', '.' || chr(10) || chr(10) || ' ' || chr(10) || chr(10)), chr(10) || chr(10)) AS ps FROM documents),
{packed_sql('paragraphs', 300, 'packed')} SELECT doc_id, CAST(i AS INTEGER) AS i, CAST(length(chunk) AS INTEGER) AS chars, md5(chunk) AS md5 FROM packed""",
    "model_calls": """SELECT event_type AS model, count(*) AS calls, count(*) FILTER (WHERE event_id % 10 = 0) AS failed, CAST(sum(event_id % 1000) AS BIGINT) AS ms, CAST(count(*) * 0.5 AS DOUBLE) AS cost
        FROM events WHERE event_id >= 100 GROUP BY 1""",
    "retried": "SELECT 3 AS attempt, '12,12,6' AS sizes",
    "build_steps": _listed([("step", "notes", "n", "own"), ("step", "notes", "old", "archived"), ("step", "chat", "", "by kind"), ("step", "chat", "n", "step"), ("value", "graph.name", "main", ""), ("default", "graph.port", "6379", ""), ("problem", "missing: graph", "", "")], "what", "kind", "key", "instruction"),
}

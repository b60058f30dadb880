"""Feeds: notes, transcripts, inbox messages, episodes, usage logs, build steps."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

# Limits of transcripts and inbox messages, and files that are indexes rather than notes.
MAX_TURN, MIN_ASSISTANT, MIN_INBOX = 40_000, 15, 20
INDEX_FILES = ("MEMORY.md", "INDEX.md", "README.md")
EPISODE = "name string, group string, content string, reference_time string, source_description string"


def note_files(spark: SparkSession, folder: str, exclude: list[str] = (), files: list[str] = (), skip: tuple[str, ...] = INDEX_FILES) -> DataFrame:
    """(file, modified_at, text) of all *.md files but indexes and excluded ones, or of the files named."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(folder)
    rows = raw.select(tx.base_name(F.col("path")).alias("file"), F.col("modificationTime").alias("modified_at"), F.decode("content", "utf-8").alias("text"))
    if files:
        return rows.where(F.col("file").isin(list(files)))
    hidden = [*skip, *exclude]
    return rows.where(~F.col("file").isin(hidden)) if hidden else rows


def with_manifest(notes: DataFrame, manifest: DataFrame) -> DataFrame:
    """Times of the manifest (file, mtime_epoch) before those of the files."""
    m = manifest.select("file", F.timestamp_seconds("mtime_epoch").alias("_at"))
    return notes.join(m, "file", "left").withColumn("modified_at", F.coalesce("_at", "modified_at")).drop("_at")


def note_episodes(notes: DataFrame, group: str, limit: int = 2500, source: str = "note") -> DataFrame:
    """Notes as episodes: chunks with status headers, named by file, ordinal and content hash."""
    parsed = notes.withColumn("fm", tx.front_matter(F.col("text"))).withColumn("body", tx.body(F.col("text")))
    rows = parsed.select("file", "modified_at", "fm", F.posexplode(tx.chunks(F.col("body"), limit)).alias("i", "chunk"))
    get = lambda k: F.coalesce(F.try_element_at("fm", F.lit(k)), F.lit(""))
    digest = tx.content_hash(F.col("chunk"), get("status"), get("verified_at"))
    return rows.select(
        tx.chunk_name(F.col("file"), F.col("i") + 1, digest).alias("name"),
        F.lit(group).alias("group"),
        tx.with_header(tx.status_header(F.col("fm")), get("description"), F.col("chunk"), F.col("i") == 0).alias("content"),
        F.date_format("modified_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("reference_time"),
        F.concat(F.lit(f"{source} "), F.col("file")).alias("source_description"),
    )


def transcript_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(session, line_no, line) of JSONL transcripts."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl").load(folder)
    named = rows.select(F.regexp_replace(tx.base_name(F.col("path")), r"\.jsonl$", "").alias("session"), F.decode("content", "utf-8").alias("text"))
    return named.select("session", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where("trim(line) <> ''")


def turns(lines: DataFrame, tags: list[str] = (), service: tuple[str, ...] = ()) -> DataFrame:
    """(session, line_no, ts, role, text): spoken turns. Lines that are not JSON are skipped; content is a string or a list of blocks."""
    v = lines.withColumn("v", F.try_parse_json("line")).where("v is not null")
    kind = F.try_variant_get("v", "$.type", "string")
    flag = lambda n: F.coalesce(F.try_variant_get("v", f"$.{n}", "boolean"), F.lit(False))
    blocks = F.try_variant_get("v", "$.message.content", "array<variant>")
    texts = F.transform(F.filter(blocks, lambda b: F.try_variant_get(b, "$.type", "string") == "text"), lambda b: F.try_variant_get(b, "$.text", "string"))
    text = F.when(blocks.isNotNull(), F.array_join(F.filter(texts, lambda t: t.isNotNull()), "\n")).otherwise(F.try_variant_get("v", "$.message.content", "string"))
    rows = v.where(kind.isin("user", "assistant") & ~flag("isMeta") & ~flag("isSidechain"))
    rows = rows.select("session", "line_no", F.try_variant_get("v", "$.timestamp", "string").alias("ts"), kind.alias("role"), text.alias("text"))
    if tags:
        rows = rows.withColumn("text", tx.strip_tags(F.col("text"), list(tags)))
    return spoken(rows.withColumn("text", tx.strip(F.col("text"))), service)


def spoken(rows: DataFrame, service: tuple[str, ...] = (), max_turn: int = MAX_TURN, min_assistant: int = MIN_ASSISTANT) -> DataFrame:
    """Turns worth keeping: not empty, not over-long, no service messages, no very short answers."""
    n = F.length("text")
    ok = (n > 0) & (n <= max_turn) & ~((F.col("role") == "assistant") & (n < min_assistant))
    for s in service:
        ok &= ~((F.col("role") == "user") & F.col("text").startswith(s))
    return rows.where(ok)


def titles(lines: DataFrame) -> DataFrame:
    """(session, title): the last title that is not empty."""
    v = lines.withColumn("title", F.try_variant_get(F.try_parse_json("line"), "$.aiTitle", "string")).where("trim(title) <> ''")
    return v.groupBy("session").agg(F.max_by("title", "line_no").alias("title"))


def write_feed(spark: SparkSession, folder: str, files: dict[str, str]) -> None:
    """Small files with given names and texts, through the folder's file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, text in files.items():
        out = fs.create(path(f"{folder}/{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()


def by_prefix(df: DataFrame, prefixes: list[str], key: str = "session") -> DataFrame:
    """Sessions whose id begins with one of the prefixes."""
    listed = F.array(*[F.lit(p) for p in prefixes])
    return df.where(F.exists(listed, lambda p: F.startswith(F.col(key), p)))


def session_episodes(turn_rows: DataFrame, group: str, limit: int = 4000, header: str = "[session {title}, {date}, part {part}] ") -> DataFrame:
    """Sessions as episodes: packed turns, dated by their first turn, named by session, ordinal and hash."""
    one = turn_rows.groupBy("session").agg(F.array_sort(F.collect_list(F.struct("line_no", "ts", "role", "text"))).alias("t"), F.first("title").alias("title"))
    rows = one.select("session", "title", F.posexplode(tx.chunk_turns(F.col("t"), limit)).alias("i", "c"))
    lead = F.lit(header)
    for name, value in (("title", F.coalesce("title", F.lit(""))), ("date", F.coalesce(F.left("c.ts", F.lit(10)), F.lit("?"))), ("part", (F.col("i") + 1).cast("string"))):
        lead = F.replace(lead, F.lit("{" + name + "}"), value)
    return rows.select(
        tx.chunk_name(F.left("session", F.lit(8)), F.col("i") + 1, tx.content_hash(F.col("c.text"))).alias("name"),
        F.lit(group).alias("group"),
        F.concat(lead, F.col("c.text")).alias("content"),
        F.col("c.ts").alias("reference_time"),
        F.concat(F.lit("session "), F.col("session")).alias("source_description"),
    )


def session_report(turn_rows: DataFrame, chunk_rows: DataFrame) -> DataFrame:
    """Per session: turns, chunks, characters, first and last date in the order of turns."""
    t = turn_rows.groupBy("session").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"), F.min_by(F.left("ts", F.lit(10)), "line_no").alias("first"), F.max_by(F.left("ts", F.lit(10)), "line_no").alias("last"))
    return t.join(chunk_rows.groupBy("session").agg(F.count("*").alias("chunks")), "session", "left")


def inbox(spark: SparkSession, path: str, min_chars: int = MIN_INBOX) -> DataFrame:
    """Inbox messages with enough text (or caption); lines that are not JSON are skipped."""
    schema = "id long, ts string, kind string, text string, caption string, file string"
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    said = F.coalesce(F.nullif(tx.strip(F.col("text")), F.lit("")), F.nullif(tx.strip(F.col("caption")), F.lit("")))
    return rows.withColumn("said", said).where(F.length("said") >= min_chars)


def inbox_episodes(rows: DataFrame, group: str, redacted: Column | None = None) -> DataFrame:
    said = F.col("said") if redacted is None else redacted
    file = F.when(F.coalesce("file", F.lit("")) != "", F.concat(F.lit(", file "), tx.base_name(F.col("file")))).otherwise(F.lit(""))
    return rows.select(
        F.concat(F.lit("inbox_"), F.col("id").cast("string"), F.lit("@"), tx.content_hash(said)).alias("name"),
        F.lit(group).alias("group"),
        F.concat(F.lit("[inbox "), F.left("ts", F.lit(16)), file, F.lit("] "), said).alias("content"),
        F.col("ts").alias("reference_time"),
        F.lit("inbox").alias("source_description"),
    )


def episodes(spark: SparkSession, path: str, group: str | None, now: Column | None = None) -> DataFrame:
    """Episode records of a group (None: any); a missing or unreadable time is now."""
    rows = spark.read.schema(EPISODE).option("mode", "DROPMALFORMED").json(path)
    rows = rows if group is None else rows.where(F.col("group") == group)
    return rows.withColumn("at", F.coalesce(tx.parse_time(F.col("reference_time")), now if now is not None else F.current_timestamp()))


def usage(spark: SparkSession, path: str, since: float | None = None) -> DataFrame:
    """Usage records from a time (epoch seconds) on; bad lines are skipped."""
    rows = spark.read.schema("ts double, tag string, model string, in long, out long").option("mode", "DROPMALFORMED").json(path)
    return rows if since is None else rows.where(F.col("ts") >= since)


def model_calls(spark: SparkSession, path: str, since: float | None = None) -> DataFrame:
    """The log of model calls: tokens in, out and for reasoning, cost, milliseconds, and an error if one failed; bad lines are skipped."""
    schema = "ts double, tag string, path string, status int, model string, pt long, ct long, rt long, cost double, ms long, err string"
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows if since is None else rows.where(F.col("ts") >= since)


def progress(log: DataFrame, line: str = "value") -> DataFrame:
    """(done, total, seconds) of progress lines such as ``batch 3/12 ... 81 s``."""
    pattern = r"batch (\d+)/(\d+).*?([\d.]+) ?s\b"
    rows = log.where(F.col(line).rlike(pattern))
    return rows.select(*[F.regexp_extract(line, pattern, i).cast(t).alias(n) for i, n, t in ((1, "done", "int"), (2, "total", "int"), (3, "seconds", "double"))])


def visible(log: DataFrame, drop: str, line: str = "value") -> DataFrame:
    """Log lines without those that match ``drop``; errors always stay."""
    return log.where(F.col(line).rlike("(?i)error|traceback") | ~F.col(line).rlike(drop))


@dataclass
class Config:
    """Settings with dotted access: ``get("sources.notes.exclude", [])``."""

    values: dict = field(default_factory=dict)

    def get(self, path: str, default=None):
        at = self.values
        for part in path.split("."):
            if not isinstance(at, dict) or part not in at:
                return default
            at = at[part]
        return default if at is None else at

    def source(self, key: str) -> dict | None:
        """A source by its name, else by the label it has in the lists of notes and sessions."""
        named = self.get("sources", {})
        if isinstance(named.get(key), dict):
            return named[key]
        listed = [s for name in ("archives", "sessions") for s in (named.get(name) or []) if isinstance(s, dict)]
        return next((s for s in listed if s.get("label") == key), None)

    def steps(self, defaults: dict[str, str]) -> list[tuple[str, str, str]]:
        """(kind, key, instruction) of the build's steps: the step's own, else the source's, else the kind's."""
        out = []
        for step in self.get("steps", []):
            kind, key = step["kind"], step.get("key", "")
            out.append((kind, key, step.get("instr") or (self.source(key) or {}).get("instr") or defaults.get(kind, "")))
        return out

    def problems(self, required: tuple[str, ...] = ("graph", "sources")) -> list[str]:
        return [f"missing: {p}" for p in required if self.get(p) in (None, "", {}, [])]

"""Chat formatting by quotation linking.

Lines that begin with ``>`` marks are quotations, as deep as they have marks; the line that
introduces a quotation ("X wrote:") belongs to it. A message's own lines, and each quoted line, are
normalised (marks off, A-Z lowered, white space runs as one space) and hashed. Per conversation and
hash, a quoted line of any level is linked to the last earlier message that has the line as its own; a
message replies to the one that most of its lines at the outermost level that has a link are linked to
(the latest one on a tie), or, without a link, to the message before it. A reply to an older message opens a branch.
Conversations are laid out branch by branch: a branch follows the message that it replies to.

No group is gathered: lines meet by (conversation, hash), of which each message has one row a level. The
last own line before a quoted one, and the running branch, are found in blocks first and then over the
blocks. A block is a range partition, whatever the turns' numbers are, so neither a common line nor a long
conversation makes a long window: one key has at most a partition's rows in a block, and a row a partition over them.

Rows: one per message: conv_id, turn, role, own text without quotations, reply_to (turn, null for the
first), n_quoted lines, depth (deepest quotation level), branch (the turn that opened it), and place
(sort key within the conversation: the turn replied to by the branch, the branch, the turn).
Defined cases: a null text is an empty message; messages of only quotations have an empty own text;
null conv_ids make up one conversation; a null turn comes last; repeated (conv_id, turn) rows keep
their rows and count as one message for links; an empty table gives no rows; other columns are never
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import forget, materialize, prepare, table

SPACE = r"[ \t\n\x0B\f\r]+"
MARK = r"^[ \t]*((?:>[ \t]?)+)"
INTRO = r"^(?:[^\n]{0,200}[ \t])?(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t]*:[ \t]*\z"
BREAK = r"\r?\n"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST = 2**62


def level(line: Column) -> Column:
    """Depth of quotation of a line."""
    return F.length(F.regexp_replace(F.regexp_extract(line, MARK, 1), r"[^>]", ""))


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.regexp_replace(line, MARK, ""), UPPER, LOWER), SPACE, " "))


def in_blocks(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` in the order of the keys, with the number of the range partition as column block."""
    return materialize(df.repartitionByRange(*keys).withColumn("block", F.spark_partition_id()), "chat-blocks")


def parse(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages with their lines: array of (no, level, line, hash), introducing lines taken as quoted."""
    src = messages.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    lines = F.transform(F.split("text", BREAK), lambda x, i: F.struct(i.alias("no"), level(x).alias("level"), x.alias("line")))
    src = src.withColumn("lines", lines)
    following = F.transform(
        "lines",
        lambda x: F.struct(
            x["no"].alias("no"),
            F.when((x["level"] == 0) & x["line"].rlike(INTRO), F.coalesce(F.get("lines", x["no"] + 1)["level"], F.lit(0))).otherwise(x["level"]).alias("level"),
            ((x["level"] == 0) & x["line"].rlike(INTRO)).alias("intro"),
            x["line"].alias("line"),
            F.xxhash64(normal(x["line"])).alias("hash"),
        ),
    )
    return src.withColumn("lines", following).drop("text").withColumn("order", F.coalesce(F.col("turn").cast("long"), F.lit(LAST)))


def link(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, order, quoted): the turn that each quoting message replies to; and the scratch table that this reads."""
    rows = messages.select("conv_id", "order", F.explode("lines").alias("l")).where((F.length(F.trim(normal(F.col("l.line")))) > 0) & ~F.col("l.intro"))
    rows = rows.select("conv_id", "order", F.col("l.hash").alias("hash"), F.col("l.level").alias("level"))
    quotes = rows.where("level > 0").groupBy("conv_id", "order", "hash", "level").agg(F.count("*").alias("votes"))
    wanted = quotes.select(F.col("conv_id").alias("q_conv"), F.col("hash").alias("q_hash")).distinct()
    own = rows.where("level = 0").join(wanted, rows["conv_id"].eqNullSafe(F.col("q_conv")) & (F.col("hash") == F.col("q_hash")), "left_semi").select("conv_id", "order", "hash").distinct()
    # quoted and own lines of a hash: the last own line before each quoted one, within blocks and then across them
    both = quotes.unionByName(own.withColumn("level", F.lit(0)).withColumn("votes", F.lit(0).cast("long")))
    placed = in_blocks(both, "conv_id", "hash", "order")
    both = placed.withColumn("own", F.when(F.col("votes") == 0, F.col("order")))
    inside = Window.partitionBy("conv_id", "hash", "block").orderBy("order").rangeBetween(Window.unboundedPreceding, -1)
    near = both.withColumn("near", F.max("own").over(inside)).where("votes > 0").drop("own")
    earlier = Window.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = both.groupBy("conv_id", "hash", "block").agg(F.max("own").alias("last")).withColumn("far", F.max("last").over(earlier)).where("far is not null")
    ends = ends.select(F.col("conv_id").alias("e_conv"), F.col("hash").alias("e_hash"), F.col("block").alias("e_block"), "far")
    same = near["conv_id"].eqNullSafe(ends["e_conv"]) & (F.col("hash") == F.col("e_hash")) & (F.col("block") == F.col("e_block"))
    found = near.join(ends, same, "left").withColumn("source", F.coalesce("near", "far")).where("source is not null")
    votes = found.groupBy("conv_id", "order", "level", "source").agg(F.sum("votes").alias("votes"))
    return votes.groupBy("conv_id", "order").agg(F.max_by("source", F.struct(-F.col("level"), "votes", "source")).alias("quoted")), placed


def conversations(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message, laid out by replies; sort by conv_id and place to read conversations."""
    parsed = materialize(parse(messages, conv, turn, role, text), "chat")
    links, lines = link(parsed)
    found = links.select(F.col("conv_id").alias("l_conv"), F.col("order").alias("l_order"), "quoted")
    turns = parsed.select("conv_id", "order").distinct()
    linked = turns.join(found, turns["conv_id"].eqNullSafe(F.col("l_conv")) & (F.col("order") == F.col("l_order")), "left").select("conv_id", "order", "quoted")
    linked = in_blocks(linked, "conv_id", "order")
    forget(lines)
    inside = Window.partitionBy("conv_id", "block").orderBy("order")
    # the message before, within the block and then across blocks
    step = linked.withColumn("previous", F.lag("order").over(inside))
    ends = step.groupBy("conv_id", "block").agg(F.max("order").alias("last"))
    over = Window.partitionBy("conv_id").orderBy("block")
    ends = ends.select(F.col("conv_id").alias("e_conv"), F.col("block").alias("e_block"), F.lag("last").over(over).alias("before"))
    step = step.join(ends, step["conv_id"].eqNullSafe(F.col("e_conv")) & (F.col("block") == F.col("e_block")), "left")
    step = step.withColumn("previous", F.coalesce("previous", "before")).select("conv_id", "order", "block", "quoted", "previous")
    # a branch opens where a message replies to another than the one before it, and at the first message
    opens = F.col("previous").isNull() | (F.col("quoted").isNotNull() & (F.col("quoted") != F.col("previous")))
    branch = F.when(opens, F.struct(F.col("order").alias("branch"), F.coalesce("quoted", F.lit(-1).cast("long")).alias("from")))
    marked = step.withColumn("opened", branch)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    marked = materialize(marked.withColumn("running", F.last("opened", ignorenulls=True).over(so_far)), "chat-branches")
    tails = marked.groupBy("conv_id", "block").agg(F.max("opened").alias("tail"))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    tails = tails.select(F.col("conv_id").alias("t_conv"), F.col("block").alias("t_block"), F.last("tail", ignorenulls=True).over(earlier).alias("carried"))
    placed = marked.join(tails, marked["conv_id"].eqNullSafe(F.col("t_conv")) & (F.col("block") == F.col("t_block")), "left")
    placed = placed.select(
        F.col("conv_id").alias("p_conv"), F.col("order").alias("p_order"), F.coalesce("quoted", "previous").alias("reply_to"), F.coalesce("running", "carried").alias("b")
    )
    placed = materialize(placed, "chat-placed")
    forget(linked, marked)
    out = parsed.join(placed, parsed["conv_id"].eqNullSafe(F.col("p_conv")) & (F.col("order") == F.col("p_order")), "left")
    own = F.filter("lines", lambda x: x["level"] == 0)
    quoted = F.filter("lines", lambda x: x["level"] > 0)
    clean = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["line"]), "\n"), rf"^{SPACE}|{SPACE}\z", "")
    return out.select(
        "conv_id",
        "turn",
        "role",
        clean.alias("text"),
        F.when(F.col("reply_to") < LAST, F.col("reply_to")).alias("reply_to"),
        F.size(quoted).cast("long").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform("lines", lambda x: x["level"])), F.lit(0)).cast("long").alias("depth"),
        F.col("b.branch").alias("branch"),
        F.struct(F.col("b.from").alias("from"), F.col("b.branch").alias("branch"), F.col("order").alias("turn")).alias("place"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = conversations(table(prepare(spark), sf_dir, "conversations"))
    return out.select("conv_id", "turn", "role", F.length("text").cast("long").alias("own_chars"), F.md5("text").alias("own_md5"), "reply_to", "n_quoted", "depth", "branch", F.col("place.from").alias("branch_from"))


_NORMAL = f"trim(regexp_replace(translate(regexp_replace(line, '{MARK}', ''), '{UPPER}', '{LOWER}'), '{SPACE}', ' ', 'g'))"
#: The same in DuckDB SQL, with normalised lines in place of hashes.
ORACLE_SQL = f"""
WITH messages AS (
  SELECT row_number() OVER () AS id, conv_id, turn, role, coalesce(turn, {LAST}) AS ord, string_split_regex(coalesce(text, ''), '{BREAK}') AS parts FROM conversations
), split AS (
  SELECT id, conv_id, ord, unnest(parts) AS line, generate_subscripts(parts, 1) AS no FROM messages
), leveled AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '{MARK}', 1), '[^>]', '', 'g')) AS own_level FROM split
), marked AS (
  SELECT *, own_level = 0 AND regexp_matches(line, '{INTRO}') AS intro, coalesce(lead(own_level) OVER (PARTITION BY id ORDER BY no), 0) AS next_level FROM leveled
), lines AS (
  SELECT id, conv_id, ord, no, line, intro, CASE WHEN intro THEN next_level ELSE own_level END AS level, {_NORMAL} AS norm FROM marked
), used AS (
  SELECT * FROM lines WHERE norm <> '' AND NOT intro
), quotes AS (
  SELECT conv_id, ord, norm, level, count(*) AS votes FROM used WHERE level > 0 GROUP BY ALL
), own AS (
  SELECT DISTINCT conv_id, ord, norm FROM used WHERE level = 0
), linked AS (
  SELECT q.conv_id, q.ord, q.norm, q.level, q.votes, max(o.ord) AS source
  FROM quotes q JOIN own o ON q.conv_id IS NOT DISTINCT FROM o.conv_id AND q.norm = o.norm AND o.ord < q.ord GROUP BY ALL
), ranked AS (
  SELECT conv_id, ord, source, row_number() OVER (PARTITION BY conv_id, ord ORDER BY level, sum(votes) DESC, source DESC) AS place FROM linked GROUP BY conv_id, ord, level, source
), turns AS (
  SELECT conv_id, ord, lag(ord) OVER (PARTITION BY conv_id ORDER BY ord) AS previous FROM (SELECT DISTINCT conv_id, ord FROM messages)
), steps AS (
  SELECT t.conv_id, t.ord, t.previous, r.source AS quoted, t.previous IS NULL OR (r.source IS NOT NULL AND r.source <> t.previous) AS opens
  FROM turns t LEFT JOIN ranked r ON t.conv_id IS NOT DISTINCT FROM r.conv_id AND t.ord = r.ord AND r.place = 1
), placed AS (
  SELECT conv_id, ord, coalesce(quoted, previous) AS reply_to,
    last_value(CASE WHEN opens THEN ord END IGNORE NULLS) OVER w AS branch, last_value(CASE WHEN opens THEN coalesce(quoted, -1) END IGNORE NULLS) OVER w AS branch_from
  FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), texts AS (
  SELECT id, count(*) FILTER (WHERE level > 0) AS n_quoted, max(level) AS depth,
    regexp_replace(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE level = 0), ''), '^{SPACE}|{SPACE}\\z', '', 'g') AS own
  FROM lines GROUP BY id
)
SELECT m.conv_id, m.turn, m.role, CAST(length(x.own) AS BIGINT) AS own_chars, md5(x.own) AS own_md5, CAST(CASE WHEN p.reply_to < {LAST} THEN p.reply_to END AS BIGINT) AS reply_to,
  CAST(x.n_quoted AS BIGINT) AS n_quoted, CAST(x.depth AS BIGINT) AS depth, CAST(p.branch AS BIGINT) AS branch, CAST(p.branch_from AS BIGINT) AS branch_from
FROM messages m JOIN texts x USING (id) JOIN placed p ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.ord = p.ord
"""

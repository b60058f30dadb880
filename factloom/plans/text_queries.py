"""Queries over text, redaction and feeds, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import plugins
from ..functions import redact as r
from ..functions import text as tx
from ..sources import feeds
from .graph import table

TAGS = ["script", "style", "nav"]
LIMIT = 2500
TURN_LIMIT = 1200


def norm_names(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.concat(F.lit(" «"), F.upper("p_name"), F.lit("\t "), F.col("p_brand"), F.lit("» ")).alias("name"))
    return part.select("p_partkey", tx.norm(F.col("name")).alias("norm"))


def page_tag_strip(spark, d):
    pages = table(spark, d, "pages")
    return pages.select("page_id", F.md5(tx.strip_tags(F.col("html"), TAGS)).alias("md5"))


def _chunked(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(tx.chunks(F.col("text"), LIMIT, r"\n")).alias("i", "chunk"))


def chunk_packing(spark, d):
    return _chunked(spark, d).select("doc_id", "i", F.length("chunk").alias("chars"), F.md5("chunk").alias("md5"))


def content_hash_names(spark, d):
    docs = table(spark, d, "documents")
    digest = tx.content_hash(F.col("text"), F.col("lang"), F.col("source"))
    return docs.select("doc_id", tx.chunk_name(F.concat(F.col("source"), F.lit(".md")), F.col("doc_id"), digest).alias("name"))


def turn_chunking(spark, d):
    c = table(spark, d, "conversations")
    one = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("turn").cast("string").alias("ts"), "role", "text"))).alias("t"))
    rows = one.select("conv_id", F.posexplode(tx.chunk_turns(F.col("t"), TURN_LIMIT)).alias("i", "c"))
    return rows.select("conv_id", "i", F.col("c.ts").alias("first_turn"), F.length("c.text").alias("chars"), F.md5("c.text").alias("md5"))


def front_header(spark, d):
    """Status headers of notes whose front matter is made from document columns."""
    docs = table(spark, d, "documents")
    status = F.element_at(F.array(*[F.lit(x) for x in ("confirmed", "proposed", "paused", "obsolete", "other", "mixed", "")]), (F.col("doc_id") % 7 + 1).cast("int"))
    old = F.when(F.col("doc_id") % 11 == 0, F.lit("historical: true\nwritten_at: '2020'\n")).otherwise(F.lit(""))
    note = F.concat(F.lit("---\nstatus: "), status, F.lit("\nscope: "), F.col("lang"), F.lit("\n"), old, F.lit("---\nbody "), F.col("source"))
    rows = docs.select("doc_id", note.alias("note"))
    return rows.select("doc_id", tx.status_header(tx.front_matter(F.col("note"))).alias("header"), tx.body(F.col("note")).alias("body"))


def turn_filter(spark, d):
    c = table(spark, d, "conversations").where(F.col("role").isin("user", "assistant")).withColumn("text", tx.strip(F.col("text")))
    return feeds.spoken(c, service=("The ", "A "), max_turn=1000, min_assistant=100).select("conv_id", "turn", "role")


def role_rollup(spark, d):
    return table(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("turns"), F.sum(F.length("text")).cast("long").alias("chars"))


def session_rollup(spark, d):
    c = table(spark, d, "conversations")
    return c.groupBy("conv_id").agg(F.count("*").alias("turns"), F.sum(F.length("text")).cast("long").alias("chars"), F.min_by("role", "turn").alias("first_role"), F.max_by("role", "turn").alias("last_role"))


def _redacted(spark, d):
    return r.redact_table(table(spark, d, "documents").select("doc_id", "source", "text"), "text", r.chain())


def redact_text(spark, d):
    return _redacted(spark, d).select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("md5"))


def redact_rule_counts(spark, d):
    return r.hit_totals(_redacted(spark, d))


def redact_source_counts(spark, d):
    return r.hit_totals(_redacted(spark, d), "source")


def redact_entropy(spark, d):
    """Texts in which the third layer found something, and what they are then."""
    out = _redacted(spark, d).select("doc_id", F.coalesce(F.try_element_at("_hits", F.lit(r.ENTROPY)), F.lit(0).cast("long")).alias("hits"), F.md5("text").alias("md5"))
    return out.where("hits > 0")


SECRETS = ("ghp_abcdefghij0123456789", "Qx7Lm2Zp9Rt4Vw8Ks3Nd6Hb1", "vk1.a.ABCDEFGHIJ0123456789abcd", "DB_PASSWORD=hunter22", "known value 17", "-----BEGIN KEY-----\nabc\n-----END KEY-----")


def planted_secrets(spark, d):
    """A secret put at the end of every text: which rule takes it, and whether it is gone."""
    docs = table(spark, d, "documents").select("doc_id")
    secret = F.element_at(F.array(*[F.lit(x) for x in SECRETS]), (F.col("doc_id") % len(SECRETS) + 1).cast("int"))
    rows = docs.withColumn("secret", secret).withColumn("text", F.concat(F.lit("it is "), "secret", F.lit(" and no more")))
    out = r.redact_table(rows, "text", r.chain(known=["known value 17"]))
    return out.select("doc_id", "secret", F.array_join(F.map_keys("_hits"), ",").alias("found"), (~F.contains("text", "secret")).alias("gone"))


def secret_audit(spark, d):
    """All text fields of the graph, redacted: hits by kind, field and rule."""
    fields = {"document.text": (table(spark, d, "documents"), "doc_id", "text"), "page.url": (table(spark, d, "pages"), "page_id", "url"), "part.name": (table(spark, d, "part"), "p_partkey", "p_name")}
    return r.hit_totals(r.redact_table(r.audit(fields), "text", r.chain()), "kind", "field")


def scrubbed_names(spark, d):
    """Cleaned names written back, with a new embedding only where the name has changed."""
    part = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.array(F.lit(0.0).cast("float")).alias("e"))
    return plugins.scrub(part, "name", F.replace("name", F.lit("red"), F.lit("green")), "e").select("p_partkey", "name", F.size("e").alias("size"))


def leak_check_zero(spark, d):
    rules = r.chain()
    return _redacted(spark, d).select("doc_id", F.explode(r.leaks(F.col("text"), rules)).alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def entropy_tokens(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.explode(r.entropy_tokens(F.col("text"))).alias("token"))


def audit_fields_union(spark, d):
    fields = {
        "part.name": (table(spark, d, "part"), "p_partkey", "p_name"),
        "customer.name": (table(spark, d, "customer"), "c_custkey", "c_name"),
        "document.text": (table(spark, d, "documents"), "doc_id", "text"),
        "page.url": (table(spark, d, "pages"), "page_id", "url"),
    }
    rows = r.audit(fields).where(F.col("text").rlike(r"[0-9]{16}|@"))
    return rows.groupBy("kind", "field").agg(F.count("*").alias("n"))


def generic_names(spark, d):
    part = table(spark, d, "part")
    return part.where(tx.generic_name(F.split("p_name", " ")[0], r"^[a-z][a-z\s-]{2,5}$", ["red", "green"])).select("p_partkey", "p_name")


def community_name_clean(spark, d):
    docs = table(spark, d, "documents")
    lead = F.element_at(F.array(*[F.lit(x) for x in ("This summary details the ", "the document covers ", "THE TEXT is about ", "Notes on ", "this passage explains")]), (F.col("doc_id") % 5 + 1).cast("int"))
    return docs.select("doc_id", tx.clean_title(F.concat(lead, F.lower("source"))).alias("title"))


def json_salvage(spark, d):
    e = table(spark, d, "events")
    said = F.concat(F.lit("answer: ["), F.col("props"), F.lit("] done"))
    return e.select("event_id", tx.json_array(said, "array<struct<k:bigint>>")[0]["k"].alias("k"))


def iso_times(spark, d):
    o = table(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 5 == 0, F.lit("soon")).otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    at = tx.parse_time(text)
    return o.select("o_orderkey", F.unix_timestamp(at).alias("epoch"))


def props_from_json(spark, d):
    e = table(spark, d, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return e.groupBy("event_type").agg(F.sum(k).alias("k"), F.count(k).alias("n"))


QUERIES = {f.__name__: f for f in (
    norm_names, page_tag_strip, chunk_packing, content_hash_names, turn_chunking, front_header, turn_filter, role_rollup, session_rollup, redact_text, redact_rule_counts, redact_source_counts,
    redact_entropy, planted_secrets, secret_audit, scrubbed_names, leak_check_zero, entropy_tokens, audit_fields_union, generic_names, community_name_clean, json_salvage, iso_times, props_from_json,
)}


def paragraphs_sql(text: str) -> str:
    return f"list_filter(string_split(coalesce({text}, ''), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13)) <> '')"


def packed_sql(ps: str, limit: int, name: str) -> str:
    """CTEs: the greedy packing of paragraph lists (a table with doc_id, ps) into ``{name}`` (doc_id, i, chunk)."""
    return f"""{name}_fold AS (
  SELECT doc_id, ps, 1 AS pos, '' AS cur, CAST([] AS VARCHAR[]) AS out FROM {ps}
  UNION ALL
  SELECT doc_id, ps, pos + 1,
    CASE WHEN length(cur) + length(ps[pos]) + 2 <= {limit} THEN CASE WHEN cur = '' THEN ps[pos] ELSE cur || chr(10) || chr(10) || ps[pos] END
      ELSE ps[pos][(greatest((length(ps[pos]) - 1) // {limit}, 0)) * {limit} + 1 :] END,
    CASE WHEN length(cur) + length(ps[pos]) + 2 <= {limit} THEN out
      ELSE list_concat(CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END,
        list_transform(range(0, greatest((length(ps[pos]) - 1) // {limit}, 0)), lambda k: ps[pos][k * {limit} + 1 : (k + 1) * {limit}])) END
  FROM {name}_fold WHERE pos <= len(ps)
), {name}_done AS (
  SELECT doc_id, CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END AS out FROM {name}_fold WHERE pos = len(ps) + 1
), {name} AS (
  SELECT doc_id, unnest(range(0, len(out))) AS i, unnest(out) AS chunk FROM {name}_done
)"""


def _sql_pattern(p: str) -> str:
    return p.replace("'", "''")


def _entropy_sql(p: str) -> str:
    """Bits a character of a piece."""
    share = f"len(list_filter(string_split({p}, ''), lambda x: x = c)) / length({p})"
    return f"-list_sum(list_transform(list_distinct(string_split({p}, '')), lambda c: {share} * log2({share})))"


def redact_sql(source: str, keys: str) -> str:
    """CTEs: the chain of replacements as nested queries (each step has the text so far and the hits of its rule), and ``redacted``: keys, text, h0, h1 ..."""
    steps = [f"s0 AS (SELECT {keys}, text FROM {source})"]
    for n, rule in enumerate(RULES):
        p = _sql_pattern(rule.pattern)
        steps.append(
            f"s{n + 1} AS (SELECT * REPLACE (regexp_replace(text, '{p}', '[REDACTED:{rule.name}]', 'g') AS text), CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS h{n} FROM s{n})"
        )
    c, n = r.TOKEN_CHARACTERS, len(RULES)
    secret = f"length(p) >= {r.TOKEN_LENGTH} AND regexp_full_match(p, '[{c}]+') AND {_entropy_sql('p')} >= {r.TOKEN_BITS}"
    steps.append(f"""pieces AS (SELECT *, CASE WHEN regexp_matches(text, '[{c}]{{{r.TOKEN_LENGTH},}}') THEN regexp_extract_all(text, '[{c}]+|[^{c}]+') END AS ps FROM s{n})""")
    steps.append(f"""redacted AS (SELECT * EXCLUDE (ps) REPLACE (CASE WHEN ps IS NULL THEN text ELSE array_to_string(list_transform(ps, lambda p: CASE WHEN {secret} THEN '[REDACTED:{r.ENTROPY}]' ELSE p END), '') END AS text),
      CASE WHEN ps IS NULL THEN 0 ELSE len(list_filter(ps, lambda p: {secret})) END AS h{n} FROM pieces)""")
    return ",\n".join(steps)


def hits_sql(keys: str) -> str:
    """Hits by keys and rule of ``redacted``."""
    names = [x.name for x in RULES] + [r.ENTROPY]
    rows = " UNION ALL ".join(f"SELECT {keys}, '{name}' AS rule, h{n} AS h FROM redacted" for n, name in enumerate(names))
    return f"SELECT {keys}, rule, CAST(sum(h) AS BIGINT) AS hits FROM ({rows}) GROUP BY ALL HAVING sum(h) > 0"


RULES = r.chain()
_STEPS = redact_sql("documents", "doc_id, source")

ORACLES = {
    "norm_names": "SELECT p_partkey, lower(regexp_replace(p_name || ' ' || p_brand, '\\s+', ' ', 'g')) AS norm FROM part",
    "page_tag_strip": "SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script>.*?</script>', '', 'g'), '(?s)<style>.*?</style>', '', 'g'), '(?s)<nav>.*?</nav>', '', 'g')) AS md5 FROM pages",
    "chunk_packing": f"""WITH RECURSIVE paragraphs AS (SELECT doc_id, {paragraphs_sql('text')} AS ps FROM documents), {packed_sql('paragraphs', LIMIT, 'packed')}
SELECT doc_id, CAST(i AS INTEGER) AS i, CAST(length(chunk) AS INTEGER) AS chars, md5(chunk) AS md5 FROM packed""",
    "turn_chunking": f"""WITH RECURSIVE turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k, CAST(turn AS VARCHAR) AS ts, role, text FROM conversations
), paragraphs AS (
  SELECT conv_id, k, list_filter(regexp_split_to_array(text, '\\n\\s*\\n'), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '') AS ps
  FROM turns WHERE length(role || ': ' || text) > {TURN_LIMIT}
), cutting AS (
  SELECT conv_id, k, ps, 1 AS pos, '' AS cur, CAST([] AS VARCHAR[]) AS out FROM paragraphs
  UNION ALL
  SELECT conv_id, k, ps, pos + 1,
    CASE WHEN length(cur) + length(ps[pos]) + 2 <= {TURN_LIMIT - 30} THEN CASE WHEN cur = '' THEN ps[pos] ELSE cur || chr(10) || chr(10) || ps[pos] END
      ELSE ps[pos][(greatest((length(ps[pos]) - 1) // {TURN_LIMIT - 30}, 0)) * {TURN_LIMIT - 30} + 1 :] END,
    CASE WHEN length(cur) + length(ps[pos]) + 2 <= {TURN_LIMIT - 30} THEN out
      ELSE list_concat(CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END,
        list_transform(range(0, greatest((length(ps[pos]) - 1) // {TURN_LIMIT - 30}, 0)), lambda n: ps[pos][n * {TURN_LIMIT - 30} + 1 : (n + 1) * {TURN_LIMIT - 30}])) END
  FROM cutting WHERE pos <= len(ps)
), cut AS (
  SELECT conv_id, k, unnest(range(0, len(out))) AS j, unnest(out) AS p
  FROM (SELECT conv_id, k, CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END AS out FROM cutting WHERE pos = len(ps) + 1)
), pieces AS (
  SELECT conv_id, k, 0 AS j, ts, role || ': ' || text AS p FROM turns WHERE length(role || ': ' || text) <= {TURN_LIMIT}
  UNION ALL SELECT conv_id, k, j, ts, role || CASE WHEN j = 0 THEN ': ' ELSE ' (continued): ' END || p FROM cut JOIN turns USING (conv_id, k)
), listed AS (
  SELECT conv_id, list(ts ORDER BY k, j) AS tss, list(p ORDER BY k, j) AS ps FROM pieces GROUP BY 1
), packing AS (
  SELECT conv_id, tss, ps, 1 AS pos, '' AS cur, 0 AS size, CAST(NULL AS VARCHAR) AS ts, CAST([] AS VARCHAR[]) AS firsts, CAST([] AS VARCHAR[]) AS out FROM listed
  UNION ALL
  SELECT conv_id, tss, ps, pos + 1,
    CASE WHEN cur = '' OR size + length(ps[pos]) > {TURN_LIMIT} THEN ps[pos] ELSE cur || chr(10) || chr(10) || ps[pos] END,
    CAST(CASE WHEN cur = '' OR size + length(ps[pos]) > {TURN_LIMIT} THEN 0 ELSE size END + length(ps[pos]) + 2 AS INTEGER),
    CASE WHEN cur = '' OR size + length(ps[pos]) > {TURN_LIMIT} THEN tss[pos] ELSE ts END,
    CASE WHEN cur <> '' AND size + length(ps[pos]) > {TURN_LIMIT} THEN list_append(firsts, ts) ELSE firsts END,
    CASE WHEN cur <> '' AND size + length(ps[pos]) > {TURN_LIMIT} THEN list_append(out, cur) ELSE out END
  FROM packing WHERE pos <= len(ps)
), finished AS (
  SELECT conv_id, CASE WHEN cur = '' THEN firsts ELSE list_append(firsts, ts) END AS firsts, CASE WHEN cur = '' THEN out ELSE list_append(out, cur) END AS out FROM packing WHERE pos = len(ps) + 1
), placed AS (
  SELECT conv_id, unnest(range(0, len(out))) AS i, unnest(firsts) AS first_turn, unnest(out) AS chunk FROM finished
)
SELECT conv_id, CAST(i AS INTEGER) AS i, first_turn, CAST(length(chunk) AS INTEGER) AS chars, md5(chunk) AS md5 FROM placed""",
    "content_hash_names": "SELECT doc_id, source || '.md#' || doc_id || '@' || left(sha1(text || '|' || lang || '|' || source), 8) AS name FROM documents",
    "front_header": """WITH n AS (SELECT doc_id, lang, source, (['confirmed', 'proposed', 'paused', 'obsolete', 'other', 'mixed', ''])[doc_id % 7 + 1] AS s FROM documents)
SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '[ARCHIVE, written 2020] ' WHEN s = 'mixed' THEN '[status: mixed] ' WHEN s <> '' THEN '[note: status ' ||
  CASE s WHEN 'confirmed' THEN 'CONFIRMED (current)' WHEN 'proposed' THEN 'PLAN, not in place' WHEN 'paused' THEN 'ON HOLD' WHEN 'obsolete' THEN 'OUTDATED, no longer valid' ELSE s END
  || '; checked ?; scope ' || lang || '] ' ELSE '' END AS header, 'body ' || source AS body FROM n""",
    "turn_filter": """SELECT conv_id, turn, role FROM (SELECT conv_id, turn, role, trim(text, ' ' || chr(10) || chr(9) || chr(13)) AS t FROM conversations WHERE role IN ('user', 'assistant'))
WHERE length(t) BETWEEN 1 AND 1000 AND NOT (role = 'assistant' AND length(t) < 100) AND NOT (role = 'user' AND (starts_with(t, 'The ') OR starts_with(t, 'A ')))""",
    "role_rollup": "SELECT role, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars FROM conversations GROUP BY 1",
    "session_rollup": "SELECT conv_id, count(*) AS turns, CAST(sum(length(text)) AS BIGINT) AS chars, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role FROM conversations GROUP BY 1",
    "redact_text": f"WITH {_STEPS} SELECT doc_id, CAST(length(text) AS INTEGER) AS chars, md5(text) AS md5 FROM redacted",
    "redact_rule_counts": f"WITH {_STEPS} SELECT rule, CAST(sum(hits) AS BIGINT) AS hits FROM ({hits_sql('source')}) GROUP BY 1",
    "redact_source_counts": f"WITH {_STEPS} {hits_sql('source')}",
    "redact_entropy": f"WITH {_STEPS} SELECT doc_id, CAST(h{len(RULES)} AS BIGINT) AS hits, md5(text) AS md5 FROM redacted WHERE h{len(RULES)} > 0",
    "leak_check_zero": f"WITH {_STEPS} SELECT rule, count(*) AS n FROM ("
    + " UNION ALL ".join(f"SELECT '{x.name}' AS rule FROM redacted WHERE regexp_matches(regexp_replace(text, '{r.MARK}', ' ', 'g'), '{_sql_pattern(x.pattern)}')" for x in RULES)
    + ") GROUP BY 1",
    "planted_secrets": """SELECT doc_id, (['ghp_abcdefghij0123456789', 'Qx7Lm2Zp9Rt4Vw8Ks3Nd6Hb1', 'vk1.a.ABCDEFGHIJ0123456789abcd', 'DB_PASSWORD=hunter22', 'known value 17', '-----BEGIN KEY-----' || chr(10) || 'abc' || chr(10) || '-----END KEY-----'])[doc_id % 6 + 1] AS secret,
      (['api_key', 'entropy', 'vk_token', 'env_secret', 'known', 'pem'])[doc_id % 6 + 1] AS found, true AS gone FROM documents""",
    "secret_audit": f"""WITH fields AS (SELECT 'document' AS kind, 'text' AS field, CAST(doc_id AS VARCHAR) AS uuid, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'page', 'url', CAST(page_id AS VARCHAR), url FROM pages WHERE url IS NOT NULL
      UNION ALL SELECT 'part', 'name', CAST(p_partkey AS VARCHAR), p_name FROM part WHERE p_name IS NOT NULL),
    {redact_sql('fields', 'kind, field, uuid')} {hits_sql('kind, field')}""",
    "scrubbed_names": "SELECT p_partkey, replace(p_name, 'red', 'green') AS name, CASE WHEN contains(p_name, 'red') THEN 256 ELSE 1 END AS size FROM part",
    "entropy_tokens": """WITH t AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9+/=_-]{24,}')) AS token FROM documents),
c AS (SELECT doc_id, token, unnest(string_split(token, '')) AS c FROM t), n AS (SELECT doc_id, token, c, count(*) AS k FROM c GROUP BY ALL)
SELECT doc_id, token FROM n GROUP BY ALL HAVING -sum(k / length(token) * log2(k / length(token))) >= 3.5""",
    "audit_fields_union": """SELECT kind, field, count(*) AS n FROM (SELECT 'part' AS kind, 'name' AS field, p_name AS t FROM part UNION ALL SELECT 'customer', 'name', c_name FROM customer
UNION ALL SELECT 'document', 'text', text FROM documents UNION ALL SELECT 'page', 'url', url FROM pages) WHERE regexp_matches(t, '[0-9]{16}|@') GROUP BY 1, 2""",
    "generic_names": "SELECT p_partkey, p_name FROM part WHERE regexp_matches(string_split(p_name, ' ')[1], '^[a-z][a-z\\s-]{2,5}$') AND string_split(p_name, ' ')[1] NOT IN ('red', 'green')",
    "community_name_clean": """SELECT doc_id, CASE doc_id % 5 WHEN 3 THEN 'Notes on ' || lower(source) WHEN 4 THEN 'This passage explains' || lower(source)
  ELSE upper(left(lower(source), 1)) || lower(source)[2:] END AS title FROM documents""",
    "json_salvage": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "iso_times": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE epoch_ms(date_trunc('second', o_orderdate)) // 1000 END AS epoch FROM orders",
    "props_from_json": "SELECT event_type, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(json_extract(props, '$.k')) AS n FROM events GROUP BY 1",
}

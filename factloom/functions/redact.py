"""Redaction: an ordered table of rules, applied as a chain of replacements with hit counts.

Three layers: known values (longest first), patterns, and, after all rules, long tokens of high entropy. A hit becomes
[REDACTED:<rule>]; a later rule never sees what an earlier one has taken. All of it is column
expressions, so it stays in the engine's own code.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = r"\[REDACTED:\w+\]"


@dataclass(frozen=True)
class Rule:
    """A pattern, and strings of which every match has one: where none is there, the pattern isn't tried."""

    name: str
    pattern: str
    needs: tuple[str, ...] = ()

    def may(self, text: Column) -> Column:
        found = [F.contains(text, F.lit(n)) for n in self.needs]
        return reduce(lambda a, b: a | b, found) if found else F.lit(True)


#: Patterns without look-around or back-references, so that any engine can run them.
RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]+-----[\s\S]*?-----END [A-Z ]+-----", ("-----BEGIN",)),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", ("eyJ",)),
    Rule("api_key", r"\b(?:sk|pk|ghp|xox[abp]|AKIA|AIza)[-_A-Za-z0-9]{16,}", ("sk", "pk", "ghp", "xox", "AKIA", "AIza")),
    Rule("bot_token", r"\b[0-9]{8,10}:[A-Za-z0-9_-]{35}", (":",)),
    Rule("url_login", r"\b[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s/@]+@", ("://",)),
    Rule("bearer", r"\bBearer [A-Za-z0-9._~+/-]{16,}=*", ("Bearer ",)),
    Rule("webhook", r"\bhttps://(?:hooks\.|[a-z.]*webhook)[^\s\"'<>]{8,}", ("https://",)),
    Rule("vk_token", r"\bvk[0-9]\.[a-z]\.[A-Za-z0-9_-]{20,}", ("vk",)),
    Rule("env_secret", r"\b[A-Z][A-Z0-9_]*(?:SECRET|TOKEN|PASSWORD|PASSWD|API_KEY|PRIVATE_KEY)[A-Z0-9_]*=[^\s\"']{6,}", ("=",)),
    Rule("key_value", r"(?i)\b(?:password|passwd|secret|token|api_?key)\b ?[=:] ?[\"']?[^\s\"']{6,}[\"']?", ("=", ":")),
    Rule("hex32", r"\b[0-9a-f]{32,64}\b"),
    Rule("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", ("@",)),
    Rule("card", r"\b[0-9]{16}\b"),
    Rule("phone", r"\+[0-9]{1,3} ?\(?[0-9]{3}\)? ?[0-9]{3}-?[0-9]{2}-?[0-9]{2}\b", ("+",)),
)


def known_rule(values: list[str], name: str = "known") -> Rule | None:
    """A rule for known values: whole ones, the longest first."""
    listed = sorted({v for v in values if v}, key=lambda v: (-len(v), v))
    return Rule(name, "|".join(re.escape(v) for v in listed)) if listed else None


def chain(rules=RULES, known: list[str] = (), exclude: tuple[str, ...] = ()) -> list[Rule]:
    """Rules in order: known values first, excluded names left out."""
    first = known_rule(list(known))
    return [r for r in [*([first] if first else []), *rules] if r.name not in exclude]


def redact(text: Column, rules: list[Rule]) -> tuple[Column, dict[str, Column]]:
    """The redacted text, and the hits of each rule."""
    hits = {}
    for r in rules:
        hits[r.name] = F.regexp_count(text, F.lit(r.pattern)).cast("long")
        text = F.regexp_replace(text, r.pattern, f"[REDACTED:{r.name}]")
    return text, hits


def redact_table(df: DataFrame, column: str, rules: list[Rule], entropy_layer: bool = True) -> DataFrame:
    """``df`` with the column redacted and _hits, a map from rule to count; after the rules, tokens of high entropy go.

    One fold over the rules: a chain of projections would be merged by the optimizer into expressions
    that grow with the number of rules. Most texts have no hit, which one search per rule finds out.
    """
    table = F.array(*[F.struct(F.lit(r.name).alias("name"), F.lit(r.pattern).alias("pattern"), F.array(*[F.lit(n) for n in r.needs]).cast("array<string>").alias("needs")) for r in rules])
    start = F.struct(F.col(column).alias("text"), F.array().cast("array<struct<key:string,value:bigint>>").alias("hits"))

    def step(acc: Column, r: Column) -> Column:
        may = (F.size(r["needs"]) == 0) | F.exists(r["needs"], lambda n: F.contains(acc["text"], n))
        hit = F.struct(r["name"].alias("key"), F.regexp_count(acc["text"], r["pattern"]).cast("long").alias("value"))
        taken = F.struct(
            F.regexp_replace(acc["text"], r["pattern"], F.concat(F.lit("[REDACTED:"), r["name"], F.lit("]"))).alias("text"), F.concat(acc["hits"], F.array(hit)).alias("hits")
        )
        return F.when(may & F.rlike(acc["text"], r["pattern"]), taken).otherwise(acc)

    out = df.withColumn("_r", F.aggregate(table, start, step))
    if entropy_layer:
        out = out.withColumn("_e", F.when(F.col("_r.text").rlike(_TOKEN), _by_entropy(F.col("_r.text"))))
        more = F.array(F.struct(F.lit(ENTROPY).alias("key"), F.col("_e.hits").alias("value")))
        taken = F.struct(F.col("_e.text").alias("text"), F.concat("_r.hits", more).alias("hits"))
        out = out.withColumn("_r", F.when(F.col("_e.hits") > 0, taken).otherwise(F.col("_r"))).drop("_e")
    return out.withColumn(column, F.col("_r.text")).withColumn("_hits", F.map_from_entries("_r.hits")).drop("_r")


def leaks(text: Column, rules: list[Rule], entropy_layer: bool = True) -> Column:
    """Names of the rules that still find something outside the marks, in the rules' order, and ``entropy`` after them."""
    bare = F.regexp_replace(text, MARK, " ")
    found = [F.when(r.may(bare) & bare.rlike(r.pattern), F.lit(r.name)) for r in rules]
    if entropy_layer:
        found.append(F.when(F.size(entropy_tokens(bare)) > 0, F.lit(ENTROPY)))
    return F.array_compact(F.array(*found))


#: The third layer: tokens without white space or dots, of so many characters and bits a character at least.
ENTROPY = "entropy"
TOKEN_LENGTH, TOKEN_BITS = 24, 3.5
TOKEN_CHARACTERS = "A-Za-z0-9+/=_-"
_TOKEN = f"[{TOKEN_CHARACTERS}]{{{TOKEN_LENGTH},}}"


def entropy(token: Column) -> Column:
    """Shannon entropy of a token's characters, in bits."""
    n = F.length(token)
    chars = F.split(token, "")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
    return F.aggregate(F.array_distinct(F.filter(chars, lambda x: x != "")), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))


def entropy_tokens(text: Column, min_length: int = TOKEN_LENGTH, min_bits: float = TOKEN_BITS) -> Column:
    """Distinct tokens without white space or dots of high entropy."""
    tokens = F.array_distinct(F.regexp_extract_all(text, F.lit(rf"[{TOKEN_CHARACTERS}]{{{min_length},}}"), F.lit(0)))
    return F.filter(tokens, lambda t: entropy(t) >= min_bits)


def _by_entropy(text: Column) -> Column:
    """The text with tokens of high entropy marked, and how many. Tokens are whole runs of their characters, so no other word is touched."""
    pieces = F.regexp_extract_all(text, F.lit(rf"[{TOKEN_CHARACTERS}]+|[^{TOKEN_CHARACTERS}]+"), F.lit(0))
    secret = lambda p: p.rlike(f"^{_TOKEN}$") & (entropy(p) >= TOKEN_BITS)
    marked = F.transform(pieces, lambda p: F.when(secret(p), F.lit(f"[REDACTED:{ENTROPY}]")).otherwise(p))
    hits = F.size(F.filter(pieces, secret)).cast("long")
    return F.struct(F.array_join(marked, "").alias("text"), hits.alias("hits"))


def hit_totals(df: DataFrame, *keys: str) -> DataFrame:
    """Hits by rule (and by further keys) of a redacted table."""
    return df.select(*keys, F.explode("_hits").alias("rule", "hits")).groupBy(*keys, "rule").agg(F.sum("hits").alias("hits"))


def audit(fields: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(kind, field, uuid, text) of all text fields of a graph; ``fields``: name -> (table, id column, text column)."""
    out = None
    for name, (df, key, column) in fields.items():
        kind, field = name.split(".")
        one = df.where(F.col(column).isNotNull()).select(F.lit(kind).alias("kind"), F.lit(field).alias("field"), F.col(key).cast("string").alias("uuid"), F.col(column).alias("text"))
        out = one if out is None else out.unionByName(one)
    return out

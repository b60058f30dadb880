"""Text functions as column expressions: names, chunks, hashes, headers, front matter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trimmed from names.
QUOTES = "«»\"'` "


def strip(s: Column) -> Column:
    """Trim all Unicode white space."""
    return F.regexp_replace(s, r"(?U)^\s+|\s+$", "")


def norm(s: Column) -> Column:
    """Name for comparison: trimmed of white space and quotes, runs of white space as one space, lower case."""
    bare = F.trim(strip(F.coalesce(s, F.lit(""))), F.lit(QUOTES))
    return F.regexp_replace(F.lower(bare), r"(?U)\s+", " ")


def strip_tags(s: Column, tags: list[str]) -> Column:
    """Remove <tag>...</tag> blocks of the given tags, across lines."""
    return F.regexp_replace(s, r"(?s)<(" + "|".join(tags) + r")>.*?</\1>", "")


def _slices(p: Column, limit: int) -> Column:
    """Full slices of ``limit`` characters that come before the rest of an over-long piece."""
    n = F.ceil(F.length(p) / limit).cast("int") - 1
    return F.when(F.length(p) > limit, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.substring(p, i * limit + 1, F.lit(limit)))).otherwise(F.array().cast("array<string>"))


def _rest(p: Column, limit: int) -> Column:
    n = F.greatest(F.ceil(F.length(p) / limit).cast("int") - 1, F.lit(0))
    return F.substring(p, n * limit + 1, F.lit(limit))


def pack(pieces: Column, limit: int, joiner: str = "\n\n") -> Column:
    """Greedy packing of pieces into chunks of at most ``limit`` characters; over-long pieces are sliced hard."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(acc: Column, p: Column) -> Column:
        fits = F.length(acc["cur"]) + F.length(p) + 2 <= limit
        joined = F.when(acc["cur"] == "", p).otherwise(F.concat(acc["cur"], F.lit(joiner), p))
        flushed = F.concat(acc["out"], F.when(acc["cur"] == "", F.array().cast("array<string>")).otherwise(F.array(acc["cur"])), _slices(p, limit))
        return F.struct(F.when(fits, acc["out"]).otherwise(flushed).alias("out"), F.when(fits, joined).otherwise(_rest(p, limit)).alias("cur"))

    return F.aggregate(pieces, start, step, lambda a: F.concat(a["out"], F.when(a["cur"] == "", F.array().cast("array<string>")).otherwise(F.array(a["cur"]))))


def chunks(text: Column, limit: int = 2500, separator: str = r"(?U)\n\s*\n", joiner: str = "\n\n", keep_blank: bool = False) -> Column:
    """Paragraphs, as they stand, packed into chunks. ``keep_blank``: blank paragraphs take part."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), separator)
    if not keep_blank:
        paragraphs = F.filter(paragraphs, lambda p: strip(p) != "")
    return pack(paragraphs, limit, joiner)


def chunk_turns(turns: Column, limit: int, continued: str = " (continued): ") -> Column:
    """Turns (ts, role, text) in order, packed into (ts of the first piece, text); long turns are cut first."""
    empty = F.array().cast("array<struct<ts:string,text:string>>")

    def pieces(t: Column) -> Column:
        whole = F.concat(t["role"], F.lit(": "), t["text"])
        cut = F.transform(chunks(t["text"], limit - 30), lambda p, i: F.concat(t["role"], F.when(i == 0, F.lit(": ")).otherwise(F.lit(continued)), p))
        return F.transform(F.when(F.length(whole) > limit, cut).otherwise(F.array(whole)), lambda p: F.struct(t["ts"].cast("string").alias("ts"), p.alias("text")))

    start = F.struct(empty.alias("out"), F.lit("").alias("cur"), F.lit(0).alias("size"), F.lit(None).cast("string").alias("ts"))

    def step(acc: Column, p: Column) -> Column:
        flush = (acc["cur"] != "") & (acc["size"] + F.length(p["text"]) > limit)
        fresh = flush | (acc["cur"] == "")
        return F.struct(
            F.when(flush, F.concat(acc["out"], F.array(F.struct(acc["ts"].alias("ts"), acc["cur"].alias("text"))))).otherwise(acc["out"]).alias("out"),
            F.when(fresh, p["text"]).otherwise(F.concat(acc["cur"], F.lit("\n\n"), p["text"])).alias("cur"),
            (F.when(fresh, F.lit(0)).otherwise(acc["size"]) + F.length(p["text"]) + 2).alias("size"),
            F.when(fresh, p["ts"]).otherwise(acc["ts"]).alias("ts"),
        )

    return F.aggregate(
        F.flatten(F.transform(turns, pieces)), start, step, lambda a: F.concat(a["out"], F.when(a["cur"] == "", empty).otherwise(F.array(F.struct(a["ts"].alias("ts"), a["cur"].alias("text")))))
    )


def content_hash(*parts: Column) -> Column:
    """First 8 hex digits of the SHA-1 of parts joined by a pipe."""
    return F.left(F.sha1(F.concat_ws("|", *parts)), F.lit(8))


def chunk_name(base: Column, ordinal: Column, digest: Column) -> Column:
    return F.concat(base, F.lit("#"), ordinal.cast("string"), F.lit("@"), digest)


FRONT = r"(?s)\A---\n(.*?)\n---\n(.*)\z"


def front_matter(text: Column) -> Column:
    """Flat ``key: value`` lines between --- marks at the beginning, quotes off, as a map (empty if absent)."""
    lines = F.filter(F.split(F.regexp_extract(text, FRONT, 1), "\n"), lambda x: x.rlike(r"^\w+:"))
    value = lambda x: F.trim(strip(F.regexp_replace(x, r"^\w+:", "")), F.lit("\"'"))
    pairs = F.transform(lines, lambda x, i: F.struct(F.regexp_extract(x, r"^(\w+):", 1).alias("key"), i.alias("i"), value(x).alias("value")))
    last = F.filter(pairs, lambda p: ~F.exists(pairs, lambda q: (q["key"] == p["key"]) & (q["i"] > p["i"])))
    return F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"])))


def body(text: Column) -> Column:
    return F.when(text.rlike(FRONT), F.regexp_extract(text, FRONT, 2)).otherwise(text)


# Statuses of notes (with what a header says of them), and older ones.
STATUS = {"confirmed": "CONFIRMED (current)", "proposed": "PLAN, not in place", "paused": "ON HOLD", "obsolete": "OUTDATED, no longer valid"}
LEGACY = ("current", "flipped", "mixed", "closed")


def status_header(fm: Column) -> Column:
    """Header that a note's front matter calls for, or ''."""
    get = lambda k, default="?": F.coalesce(F.try_element_at(fm, F.lit(k)), F.lit(default))
    status = F.try_element_at(fm, F.lit("status"))
    named = status
    for k, v in STATUS.items():
        named = F.when(status == k, F.lit(v)).otherwise(named)
    return (
        F.when(get("historical") == "true", F.concat(F.lit("[ARCHIVE, written "), get("written_at"), F.lit("] ")))
        .when(status.isin(*LEGACY), F.concat(F.lit("[status: "), status, F.lit("] ")))
        .when(F.coalesce(status, F.lit("")) != "", F.concat(F.lit("[note: status "), named, F.lit("; checked "), get("verified_at"), F.lit("; scope "), get("scope"), F.lit("] ")))
        .otherwise(F.lit(""))
    )


def with_header(header: Column, description: Column, chunk: Column, first: Column) -> Column:
    """Header on every chunk, description on the first."""
    desc = F.coalesce(description, F.lit(""))
    lead = F.when(first & (desc != ""), F.concat(header, desc, F.lit("\n\n"))).when(header != "", F.concat(header, F.lit("\n\n"))).otherwise(F.lit(""))
    return F.concat(lead, chunk)


# Fixed value: the phrase that summaries begin with.
TITLE_LEAD = r"^\s*(this|the)\s+(summary|text|document|passage|content)\s+(details|outlines|describes|covers|discusses|summarizes|provides|presents|explains|focuses on|is about|documents|highlights|addresses|concerns)\s+(the\s+)?"


def capital(s: Column) -> Column:
    """First letter upper case, the rest as it is."""
    return F.concat(F.upper(F.left(s, F.lit(1))), F.substring(s, 2, 1 << 20))


def clean_title(name: Column) -> Column:
    """A community's name without the phrase that summaries begin with; names of only that phrase stay."""
    cut = strip(F.regexp_replace(F.coalesce(name, F.lit("")), f"(?i){TITLE_LEAD}", ""))
    return F.when(cut != "", capital(cut)).otherwise(F.coalesce(name, F.lit("")))


def parse_time(s: Column) -> Column:
    """ISO time with Z or an offset; null if it can't be read."""
    return F.try_to_timestamp(F.nullif(strip(s), F.lit("")))


def json_array(s: Column, schema: str) -> Column:
    """From the first [ to the last ] of a text, parsed; null if it isn't JSON."""
    return F.from_json(F.regexp_extract(s, r"(?s)\[.*\]", 0), schema)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def generic_name(name: Column, pattern: str, allowed: list[str]) -> Column:
    """A generic word rather than a name: matches the pattern, is not allow-listed, and has two words at most."""
    s = strip(F.coalesce(name, F.lit("")))
    known = F.lower(s).isin(*allowed) if allowed else F.lit(False)
    return s.rlike(pattern) & ~known & (F.size(F.split(s, r"(?U)\s+")) <= 2)


# Fixed value: hosts with a port, or as a network of one address.
IP_PORT = r"^(\d{1,3}(?:\.\d{1,3}){3})(?::\d+|/32)$"


def host_of(name: Column) -> Column:
    """The address of a.b.c.d:port or a.b.c.d/32, else null."""
    return F.nullif(F.regexp_extract(name, IP_PORT, 1), F.lit(""))

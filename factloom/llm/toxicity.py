"""Toxicity by a weighted finite-state pattern grammar over clauses.

A text's words become symbols: insult (with the weight of its lexicon entry), threat, target,
negation, reported speech, clause end, or other. Five small transducers read the symbols: one marks
what follows a negation, one what is reported, one whether the clause speaks to or about somebody,
and one each accepts insults and threats. Their composition is a single automaton, which is run over
the clauses that hold an insult or a threat; it outputs one pattern per match (insult or threat,
targeted or not, negated or not, reported or not). A text's score is the logistic function of the
sum over its matched patterns of pattern weight times lexicon weight, bent by a logarithm so that
long texts do not score by length alone.

The insult lexicon and the weights are learned from labelled rows: word beginnings of 4 letters or
more, and whole words of fewer letters, that stand in toxic documents far more often than in others.
What is learned from is a bounded sample, the first ``max_documents`` different labelled rows in hash
order; their word beginnings are counted on the executors. An entry stands in the share ``MIN_SHARE`` of
the sample's toxic documents at least, so the lexicon has at most the mean number of different beginnings
of a toxic document divided by that share; there is no other limit.

Defined cases: null and empty texts have no pattern and get the base score; null labels and null
doc_ids are not learned from; rows without a doc_id are not held out; a repeated row is scored like
the first and counts once in the sample; an id that is labelled twice is toxic if either label says so;
without a labelled toxic row every score is next to 0; empty tables give no rows; other columns are never read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import column, forget, hash_strings, map_arrow, materialize, mix64, prepare, slices, table, words_of

MAX_DOCUMENTS = 8000
#: A lexicon entry stands in so many toxic documents of the sample, and in this share of them.
MIN_TOXIC = 6
MIN_SHARE = 0.015
MIN_PRECISION = 0.8
#: Lengths of word beginnings; a shorter word is an entry as a whole.
PREFIXES = (4, 5, 6, 7, 8)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
THREATS = ("kill", "hurt", "destroy", "burn", "shoot", "stab", "beat", "töten", "umbringen", "schlagen", "tuer", "frapper", "détruire", "matar", "golpear", "destruir")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "him", "her", "du", "dich", "ihr", "euch", "sie", "tu", "toi", "vous", "ils", "tú", "vosotros", "ustedes", "ellos")
NEGATIONS = ("not", "no", "never", "isn't", "aren't", "nicht", "kein", "keine", "nie", "pas", "jamais", "ne", "nunca", "jamás", "ni")
REPORTS = ("said", "says", "called", "reported", "quoted", "wrote", "sagte", "nannte", "schrieb", "dit", "appelé", "écrit", "dijo", "llamó", "escribió")
#: A negation reaches so many words ahead.
NEGATION_REACH = 3


@dataclass
class Transducer:
    """States 0..n-1 from 0 on; arcs[state][symbol] = (next state, flag that holds at this symbol)."""

    arcs: list[list[tuple[int, int]]]

    @property
    def states(self) -> int:
        return len(self.arcs)


def _symbols(rule) -> list[tuple[int, int]]:
    return [rule(s) for s in range(7)]


def negation_transducer(reach: int = NEGATION_REACH) -> Transducer:
    """Its flag is up within ``reach`` words after a negation, and not beyond the clause."""

    def arc(state: int):
        def rule(s: int) -> tuple[int, int]:
            if s == END:
                return 0, 0
            return (reach, int(state > 0)) if s == NEGATION else (max(0, state - 1), int(state > 0))

        return rule

    return Transducer([_symbols(arc(k)) for k in range(reach + 1)])


def latch_transducer(opens: int) -> Transducer:
    """Its flag is up from a symbol on to the end of the clause."""
    return Transducer([[(0, 0) if s == END else (int(state or s == opens), int(state or s == opens)) for s in range(7)] for state in (0, 1)])


def acceptor(symbol: int) -> Transducer:
    """Its flag is up at the symbol itself."""
    return Transducer([_symbols(lambda s: (0, int(s == symbol)))])


@dataclass
class Grammar:
    """The composition: moves[state, symbol] and the flags, one bit per transducer, in outputs[state, symbol]."""

    moves: np.ndarray
    outputs: np.ndarray


def compose(parts: list[Transducer]) -> Grammar:
    """Product of deterministic transducers that read the same symbols, over the states that can be reached."""
    start = (0,) * len(parts)
    number, todo, moves, outputs = {start: 0}, [start], [], []
    for state in todo:
        move, out = [], []
        for s in range(7):
            arcs = [p.arcs[q][s] for p, q in zip(parts, state, strict=True)]
            nxt = tuple(a[0] for a in arcs)
            if nxt not in number:
                number[nxt] = len(number)
                todo.append(nxt)
            move.append(number[nxt])
            out.append(sum(a[1] << k for k, a in enumerate(arcs)))
        moves.append(move)
        outputs.append(out)
    return Grammar(np.array(moves), np.array(outputs))


#: Patterns: (threat, targeted, negated, reported).
PATTERNS = list(product((0, 1), repeat=4))


def grammar() -> Grammar:
    return compose([acceptor(INSULT), acceptor(THREAT), latch_transducer(TARGET), negation_transducer(), latch_transducer(REPORT)])


def pattern_of(flags: int) -> int | None:
    insult, threat, targeted, negated, reported = (flags >> k & 1 for k in range(5))
    return PATTERNS.index((threat, targeted, negated, reported)) if insult or threat else None


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(PATTERNS)))
    bias: float = -20.0

    def score(self, strength: np.ndarray) -> np.ndarray:
        z = np.log1p(strength) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def bare(words: pa.Array) -> pa.Array:
    """Words in lower case without the punctuation around them."""
    return pc.utf8_trim(pc.utf8_lower(words), characters=".,;:!?\"'()[]{}«»“”„‘’¡¿*#$%&|<>-_")


def matches(text: pa.Array, lexicon: dict[str, float], rules: Grammar) -> np.ndarray:
    """Summed strength of each pattern in each text."""
    out = np.zeros((len(text), len(PATTERNS)))
    flat, offsets = words_of(text)
    if not len(flat):
        return out
    coded = flat.dictionary_encode()
    at = np.asarray(coded.indices)
    word = bare(coded.dictionary)
    symbol = np.zeros(len(word), np.int8)
    for kind, listed in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
        symbol[pc.is_in(word, pa.array(listed)).to_numpy(zero_copy_only=False)] = kind
    weight = np.ones(len(word))
    if lexicon:
        entries = pa.array(list(lexicon), pa.string())
        values = np.array(list(lexicon.values()))
        best, letters = np.zeros(len(word)), pc.utf8_length(word).to_numpy(zero_copy_only=False)
        for n in (*PREFIXES, 0):
            slot = pc.index_in(pc.utf8_slice_codeunits(word, 0, n) if n else word, entries)
            hit = pc.is_valid(slot).to_numpy(zero_copy_only=False) & (letters >= n if n else letters < PREFIXES[0])
            found = pc.fill_null(slot, 0).to_numpy(zero_copy_only=False)
            best = np.where(hit, np.maximum(best, values[found]), best)
        symbol[best > 0] = INSULT
        weight[best > 0] = best[best > 0]
    ends = pc.match_substring_regex(coded.dictionary, "[.,;:!?]$").to_numpy(zero_copy_only=False)
    hot = np.flatnonzero((symbol[at] == INSULT) | (symbol[at] == THREAT))
    if not len(hot):
        return out
    stops = np.flatnonzero(ends[at])
    doc = np.searchsorted(offsets, hot, side="right") - 1
    before = np.searchsorted(stops, hot)
    begin = np.maximum(np.where(before > 0, stops[np.maximum(before - 1, 0)] + 1, 0), offsets[doc])
    end = np.minimum(np.where(before < len(stops), stops[np.minimum(before, len(stops) - 1)] + 1, len(at)), offsets[doc + 1])
    clause, once = np.unique(begin, return_index=True)
    moves, flags = rules.moves.tolist(), rules.outputs.tolist()
    named = [pattern_of(f) for f in range(32)]
    for b, e, d in zip(clause.tolist(), end[once].tolist(), doc[once].tolist(), strict=True):
        state = 0
        words = at[b:e]
        for s, w in zip(symbol[words].tolist(), weight[words].tolist(), strict=True):
            p = named[flags[state][s]]
            if p is not None:
                out[d, p] += w
            state = moves[state][s]
    return out


def beginnings(words: list[str]) -> set[str]:
    """All beginnings of 4 to 8 letters of words of letters, and shorter words."""
    return {w[:n] for w in words if w.isalpha() for n in PREFIXES if len(w) >= n or n == PREFIXES[0]}


def sketches(text: pa.Array) -> np.ndarray:
    """Four min-hashes over the 4-word shingles of each text; texts of fewer words give their own hash."""
    flat, offsets = words_of(text, lower=True)
    out = mix64(hash_strings(pc.fill_null(text, "")))[:, None] + np.arange(4, dtype=np.uint64)
    if len(flat) < 4:
        return out
    coded = flat.dictionary_encode()
    word = mix64(hash_strings(coded.dictionary))[np.asarray(coded.indices)]
    n = len(word) - 3
    shingle = mix64(mix64(mix64(word[:n] + np.uint64(1)) ^ word[1 : n + 1]) + word[2 : n + 2]) ^ word[3:]
    full = np.flatnonzero(np.diff(offsets) >= 4)
    inside = np.flatnonzero(np.arange(n) + 4 <= np.repeat(offsets[1:], np.diff(offsets))[:n])
    shingle = shingle[inside]
    starts = np.searchsorted(inside, offsets[:-1][full])
    for k in range(4):
        if len(full):
            out[full, k] = np.minimum.reduceat(mix64(shingle + np.uint64(k * 7919 + 13)), starts)
    return out


def learn_lexicon(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Beginnings with the weight of their evidence; a longer one is left out where a shorter one covers it."""
    found = {}
    for w, pos, neg in counts:
        rate_pos, rate_neg = pos / max(toxic, 1), neg / max(clean, 1)
        precision = rate_pos / (rate_pos + rate_neg)
        # odds of toxic against clean once both are equally frequent, pulled down where evidence is thin
        if precision >= MIN_PRECISION:
            lift = math.log((pos + 0.5) / (toxic + 1)) - math.log((neg + 0.5) / (clean + 1))
            if lift >= 2:
                found[w] = (lift, pos)
    out: dict[str, float] = {}
    for w in sorted(found, key=lambda w: (len(w), w)):
        lift, pos = found[w]
        shorter = [w[:n] for n in PREFIXES if n < len(w) and w[:n] in out]
        if not any(out[s] >= lift - 0.5 for s in shorter):
            out[w] = lift
    return {w: out[w] / 4 for w in sorted(out)}


def train_weights(strength: np.ndarray, toxic: np.ndarray, steps: int = 400, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam, classes balanced halfway."""
    x, y = np.log1p(strength), toxic.astype(float)
    rarity = math.sqrt(max(1.0, (len(y) - y.sum()) / max(1.0, y.sum())))
    c = np.where(y > 0, rarity, 1.0)
    theta = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ theta[:-1] + theta[-1], -30, 30)))
        e = c * (p - y) / c.sum()
        g = np.append(x.T @ e + decay * theta[:-1], e.sum())
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        theta -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_documents: int = MAX_DOCUMENTS) -> Model:
    """Learn from the first ``max_documents`` different labelled rows in the order of their id's hash."""
    named = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("toxic"))
    named = named.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null").withColumn("digest", F.xxhash64("text"))
    # rows are chosen without their texts; those that are chosen are then joined back, each once however often it is repeated
    rows = src.select("doc_id", "digest").distinct().join(named, F.col("doc_id") == F.col("label_id"))
    chosen = rows.select("label_id", F.col("digest").alias("label_digest"), "toxic").orderBy(F.xxhash64("label_id"), "label_id", "label_digest").limit(max_documents)
    small = F.broadcast(chosen)  # at most max_documents rows of three numbers
    sample = src.join(small, (F.col("doc_id") == F.col("label_id")) & (F.col("digest") == F.col("label_digest"))).dropDuplicates(["doc_id", "digest"])
    sample = materialize(sample.select("label_id", "digest", "toxic", "text"), "toxic-sample")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([column(b, "label_id"), column(b, "digest"), pa.array(sketches(column(b, "text")).view(np.int64).tolist(), pa.list_(pa.int64()))], ["label_id", "digest", "sketch"])

    # copies would count the same evidence many times: of rows that share a sketch value, one is counted
    kind = sample.schema["label_id"].dataType.simpleString()
    seen, single = set(), []
    sketched = map_arrow(sample.select("label_id", "digest", "text"), sketch, f"label_id {kind}, digest long, sketch array<long>").collect()  # max_documents rows
    for r in sorted(sketched, key=lambda r: (str(r.label_id), r.digest)):
        if not seen.intersection(r.sketch):
            single.append((r.label_id, r.digest))
        seen.update(r.sketch)
    if not single:
        return Model()
    kept = docs.sparkSession.createDataFrame(single, f"kept_id {kind}, kept_digest long")
    same = (F.col("label_id") == F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    evidence = sample.join(F.broadcast(kept), same, "left_semi").select("toxic", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": list(seen), "pos": [v[0] for v in seen.values()], "neg": [v[1] for v in seen.values()]}, schema=kind)

        kind = pa.schema([("word", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])
        seen: dict[str, list[int]] = {}
        total = Counter()
        for b in slices(batches, "text"):
            flat, offsets = words_of(column(b, "text"))
            coded = flat.dictionary_encode()
            word, at = bare(coded.dictionary).to_pylist(), np.asarray(coded.indices)
            for k, toxic in enumerate(column(b, "toxic").to_pylist()):
                total[toxic] += 1
                for w in beginnings([word[j] for j in np.unique(at[offsets[k] : offsets[k + 1]]).tolist()]):
                    seen.setdefault(w, [0, 0])[0 if toxic else 1] += 1
            if len(seen) > 500_000:
                yield out()
                seen = {}
        seen[""] = [total[1], total[0]]
        yield out()

    counts = map_arrow(evidence, count, "word string, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counts = materialize(counts.where(f"pos >= {MIN_TOXIC} or word = ''"), "toxic-counts")
    totals = counts.where("word = ''").first()
    toxic, clean = (totals.pos, totals.neg) if totals else (0, 0)
    if not toxic:
        forget(sample, counts)
        return Model()
    precise = (F.col("pos") / toxic) >= MIN_PRECISION * (F.col("pos") / toxic + F.col("neg") / max(clean, 1))
    strong = counts.where(precise & (F.col("pos") >= max(MIN_TOXIC, MIN_SHARE * toxic)) & (F.col("word") != "")).orderBy(F.desc("pos"), "word")
    lexicon = learn_lexicon([tuple(r) for r in strong.collect()], toxic, clean)
    rules = grammar()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            s = matches(column(b, "text"), lexicon, rules)
            yield pa.RecordBatch.from_arrays([column(b, "toxic"), pa.array(s.tolist(), pa.list_(pa.float64()))], ["toxic", "strength"])

    rows = map_arrow(sample.select("toxic", "text"), measure, "toxic int, strength array<double>").collect()  # max_documents rows of 16 numbers
    rows.sort()
    forget(sample, counts)
    weights, bias = train_weights(np.array([r.strength for r in rows]), np.array([r.toxic for r in rows]))
    return Model(lexicon, weights, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, n_matches), one row per document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its lexicon is bounded by MIN_SHARE
    rules = grammar()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text"):
            s = matches(column(b, "text"), m.lexicon, rules)
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(m.score(s)), pa.array(s.sum(axis=1))], ["doc_id", "score", "strength"])

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(src, run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, score double, strength double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = fit(docs, labels.where(~held_out))
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "strength")

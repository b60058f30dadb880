import zlib

import numpy as np
import test_decontaminate as brute_leaks
import test_line_dedup as brute_lines
import test_packing as brute_packing
import test_quality as brute_quality
import test_simhash as brute_near

import corpus_pipeline
from factloom.llm import line_dedup, packing, quality


def test_stages_take_effect(spark, tmp_path, make, rng):
    passage = " ".join(f"p{k}." if k % 7 == 6 else f"p{k}" for k in range(70))
    leak = " ".join(f"b{k}" for k in range(40))
    clean = [make(220) for _ in range(6)]
    near = make(28).replace(".", "")
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(10, make(120) + "\n" + passage + "\n"), (11, make(120) + "\n" + passage + "\n" + make(60)), (12, "spam ham " * 100), (13, "too short"), (14, make(100) + " " + leak + " " + make(30))]
    rows += [(20, clean[0]), (21, None), (22, near + " " + make(60).replace(".", "").replace("\n", " "))]
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    d = str(tmp_path / "tables")
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{d}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path / f"stage{k}")
        stage(spark, docs, d).write.parquet(out)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert spark.read.parquet(out).columns == docs.columns, name
        docs = spark.read.parquet(out)
        seen[name] = docs.collect()
    ids = {name: {r.doc_id for r in rows} for name, rows in seen.items()}
    assert not {12, 13, 21} & ids["quality rules"] and set(range(6)) <= ids["quality rules"]
    text = {r.doc_id: r.text for r in seen["line dedup"]}
    assert passage in text[10] and "p30" not in text[11] and 20 not in text
    assert 14 not in ids["decontamination"] and {*range(6), 10, 11, 22} <= ids["decontamination"]
    left = {r.doc_id: r.text for r in seen["decontamination"]}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_file())
    for doc, body in left.items():
        tokens = [*t.encode(body, add_special_tokens=False).ids, 2]
        own = sorted((r for r in seen["packing"] if r.doc_id == doc), key=lambda r: r.start)
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()] and sum(r.length for r in own) == len(tokens)
        assert all(r.ids_crc32 == zlib.crc32(np.array(tokens[r.start : r.start + r.length], "<u4").tobytes()) for r in own)
    assert corpus_pipeline.run(spark, d).count() == len(seen["packing"])


def brute_pipeline(rows, items):
    """The rows that the four filtering stages leave, each by its own definition."""
    kept = []
    for i, t in rows:
        m = brute_quality.brute(t, quality.MIN_REPEAT)
        n = m["n_words"]
        if n >= 50 and 100 * m["n_repeat_words"] <= 50 * n and m["n_covered"] <= quality.MAX_COVERED * n and m["longest_repeat"] <= quality.MAX_LONGEST:
            kept.append((i, t))
    ranges = brute_lines.brute_windows(kept, line_dedup.RUN_WORDS)
    kept = [(i, brute_lines.cut_words(t, ranges[i]) if ranges[i] else t) for i, t in kept]
    kept = [(i, t) for i, t in kept if t]
    roots = brute_near.brute_components([brute_near.brute_fingerprint(t) for _, t in kept])
    first = {}
    for (i, _), root in zip(kept, roots, strict=True):
        first[root] = min(first.get(root, i), i)
    kept = [(i, t) for (i, t), root in zip(kept, roots, strict=True) if first[root] == i]
    norm = lambda t: " ".join("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).split()).encode()
    return [(i, t) for i, t in kept if not any(brute_leaks.distance_within(norm(x), norm(t)) <= int(0.05 * len(norm(x))) for x in items)]


def test_whole_result_against_brute_force(spark, tmp_path, make, rng):
    items = [make(12), make(15)]
    passage = " ".join(f"p{k}" for k in range(60))
    base = [make(rng.randint(60, 130)) for _ in range(16)]
    texts = list(base)
    texts += [base[2], base[3] + " tail", passage + " " + make(60), make(70) + " " + passage + " " + make(10), make(20), "spam ham " * 60, ""]
    texts += [make(50) + " " + items[0].upper() + " " + make(20), make(60) + items[1][:-2] + "zz " + make(9), " ".join([make(9)] * 12) + make(60)]
    rows = list(enumerate(texts))
    d = tmp_path / "tables"
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows] + [(99, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(d / "benchmark.parquet"))
    want = dict(brute_pipeline(rows, items))
    assert 0 < len(want) < len(rows) - 5
    brute_packing.check_rows(corpus_pipeline.run(spark, str(d)).collect(), {i: brute_packing.reference_ids(t) for i, t in want.items()}, packing.CAPACITY)


def test_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    docs = spark.createDataFrame([], schema + ", `a.b` string, _runs int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[-2:] == ["a.b", "_runs"] and docs.count() == 0

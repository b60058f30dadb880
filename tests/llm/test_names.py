"""Extra columns whose names clash with those that operators use inside, and columns with odd names."""

import pytest
from pyspark.sql import functions as F

from factloom.llm import decontaminate, language, licenses, line_dedup, packing, quality, simhash, toxicity

NAMES = ["_id", "_hash", "_ranges", "_cut", "_runs", "_spans", "_text_hash", "_text", "a.b", "c0", "c1", "key", "key2", "hash", "cut", "runs", "f_doc_id", "stay_id", "keep_text", "from", "to", "kept", "words", "old", "new", "A b`c"]


def with_names(docs):
    for k, n in enumerate(NAMES):
        docs = docs.withColumns({n: F.concat(F.lit(f"{k}-"), F.col("doc_id").cast("string"))})
    return docs


def stages(spark):
    bench = spark.createDataFrame([(1, "a passage of the benchmark that is long enough to be found")], "item_id long, text string")
    return {
        "quality": quality.filter_documents,
        "line dedup": line_dedup.stage,
        "near-duplicates": simhash.keep_one,
        "decontamination": lambda docs: decontaminate.stage(docs, bench),
        "line dedup, runs": lambda docs: line_dedup.dedup_runs(docs, runs_as="deleted").drop("deleted"),
        "leaks": lambda docs: decontaminate.find_leaks(docs, bench, spans_as="found").drop("found"),
    }


@pytest.mark.parametrize("name", ["quality", "line dedup", "near-duplicates", "decontamination", "line dedup, runs", "leaks"])
def test_columns_are_kept_whatever_their_names(spark, documents, make, name):
    rows = [(1, make(80)), (2, make(90)), (3, make(120)), (4, make(70))]
    docs = with_names(documents(rows))
    got = stages(spark)[name](docs)
    assert got.columns == docs.columns
    for r in got.collect():
        values = tuple(r)
        assert values[1] == dict(rows)[values[0]]
        assert list(values[5:]) == [f"{k}-{values[0]}" for k in range(len(NAMES))]
    assert got.count() == 4


def readers():
    return {
        "packing": packing.pack,
        "fingerprints": lambda docs: simhash.near_duplicates(docs).drop("text_hash"),
        "rules": quality.rules,
        "licenses": licenses.scan,
        "language": lambda docs: language.identify(docs, None),
        "toxicity": lambda docs: toxicity.score(docs, toxicity.Model({"gnu": 1.0})),
    }


@pytest.mark.parametrize("name", ["packing", "fingerprints", "rules", "licenses", "language", "toxicity"])
def test_columns_that_are_not_read_change_nothing(spark, documents, make, name):
    docs = documents([(1, make(80) + " gnu general public license"), (2, make(90)), (2, "cc by"), (3, None)]).coalesce(1)
    plain, more = readers()[name](docs), readers()[name](with_names(docs))
    assert plain.columns == more.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, more.collect()))

"""What the queries leave in the shared folder: the small table that their result reads, and nothing else."""

import os

import pytest

from factloom.llm import registry
from factloom.llm._shared import SETTINGS, shared_dir

DATA = os.environ.get("FACTLOOM_TESTDATA", "/root/testdata/sf0.001")
#: Scratch tables that a query's result still reads; they go when the application ends.
LEFT = {"op1_warc_round_trip": 1, "op3_chat_quotation_linking": 2, "op4_simhash_near_dedup": 1, "op7_license_scan": 1, "op9_line_dedup": 1}


def scratch(spark):
    root = f"{shared_dir(spark).removeprefix('file://')}/factloom-{spark.sparkContext.applicationId}"
    return set(os.listdir(root)) if os.path.isdir(root) else set()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_scratch_tables_go_and_settings_stay(spark, name):
    before = scratch(spark)
    known = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone", "spark.checkpoint.dir")}
    assert registry.QUERIES[name](spark, DATA).count() > 0
    left = {x for x in scratch(spark) - before if not x.startswith(".")}
    assert len(left) <= LEFT.get(name, 0), left
    assert {k: spark.conf.get(k, None) for k in known} == known
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from factloom.llm import warc
from factloom.llm._shared import prepare


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, path string, payload string")


def rows_for(make):
    texts = ["", None, "<p>é ü 漢</p>", make(50), make(50), "x\r\n\r\ny"]
    rows = [(i, f"http://h/{i}?q=a b&é", t, "p", "q") for i, t in enumerate(texts)]
    rows += [(10, "http://a", texts[3], "p", "q"), (9, None, texts[3], "p", "q"), (11, "u", make(3000), "p", "q"), (12, "u\nWARC-Type: evil", texts[2], "p", "q")]
    return rows


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, tmp_path, make, least):
    rows = rows_for(make)
    path = str(tmp_path / "w")
    assert warc.write_archives(pages(spark, rows).repartition(3), path, min_revisit_bytes=least) == len(rows)
    full = {i: (t or "").encode() for i, _, t, _, _ in rows}
    first = {}
    for i in sorted(full):
        if len(full[i]) >= least:
            first.setdefault(full[i], i)
    got = {r.record_id: r for r in warc.read_back(spark, path).collect()}
    assert len(got) == len(rows)
    for i, data in full.items():
        r = got[warc.urn(i)]
        revisit = len(data) >= least and first[data] != i
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (warc.urn(first[data]) if revisit else None)
        assert r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_filters_and_options(spark, tmp_path, make):
    path = str(tmp_path / "w")
    warc.write_archives(pages(spark, rows_for(make)), path)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    assert warc.read_archives(spark, path, "record_type = 'revisit'").count() == 4
    prepare(spark)
    some = warc.read_archives(spark, path, (F.col("record_type") == "revisit") & F.col("target_uri").startswith("http://a"))
    assert [r.record_id for r in some.collect()] == [warc.urn(10)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan, "record type and headers are filtered by the source"
    bare = warc.read_archives(spark, path, payload="false").collect()
    assert all(r.payload is None for r in bare) and sum(r.payload_bytes or 0 for r in bare) == sum(r.payload_bytes or 0 for r in warc.read_archives(spark, path).collect()) > 0
    assert warc.read_archives(spark, path, partitionBytes="1").rdd.getNumPartitions() >= 1


def test_one_result_in_many_queries(spark, tmp_path, make):
    path = str(tmp_path / "w")
    n = warc.write_archives(pages(spark, rows_for(make)), path)
    every = warc.read_archives(spark, path)
    revisits, responses = every.where("record_type = 'revisit'"), every.where("record_type = 'response'")
    assert revisits.count() + responses.count() == n
    assert every.count() == revisits.unionAll(responses).count() == n
    joined = revisits.alias("a").join(responses.alias("b"), F.col("a.refers_to") == F.col("b.record_id"))
    assert joined.count() == revisits.count() > 0
    narrowed = warc.read_archives(spark, path, "record_type = 'revisit'")
    assert narrowed.where("target_uri = 'http://a'").count() == 1
    assert narrowed.count() == revisits.count()


def test_plain_archives_and_other_records(spark, tmp_path):
    record = warc.record("response", "<urn:page:1>", "http://x", b"abc", warc.digest(b"abc"))
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:i>\r\nX-Long: a\r\n b\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(info + record + record.replace(b"page:1", b"page:2"))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(info + record.replace(b"page:1", b"page:3")))
    (tmp_path / "c.txt").write_bytes(b"no archive")
    got = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {"<urn:page:1>": b"abc", "<urn:page:2>": b"abc", "<urn:page:3>": b"abc", "<urn:i>": b"hello"}
    offsets = [r.offset for r in warc.read_archives(spark, str(tmp_path / "a.warc")).collect()]
    raw = (tmp_path / "a.warc").read_bytes()
    assert all(raw[o : o + 8] == b"WARC/1.1" for o in offsets)


def test_null_ids_ties_and_empty(spark, tmp_path):
    rows = [(None, "u", "same", "p", "q"), (5, "u", "same", "p", "q"), (5, "u", "same", "p", "q"), (None, "u", "lone", "p", "q"), (None, "u", "lone", "p", "q")]
    warc.write_archives(pages(spark, rows), str(tmp_path / "a"))
    got = sorted((r.record_id, r.record_type, r.refers_to or "") for r in warc.read_back(spark, str(tmp_path / "a")).collect())
    assert [x[1] for x in got].count("revisit") == 1
    assert warc.write_archives(pages(spark, []), str(tmp_path / "b")) == 0
    assert warc.read_back(spark, str(tmp_path / "b")).count() == 0


def test_plain_format_keeps_its_rows_under_many_filters(spark, tmp_path, make):
    path = str(tmp_path / "w")
    n = warc.write_archives(pages(spark, rows_for(make)), path)
    warc.read_archives(spark, path)  # registers the source
    every = spark.read.format("warc").load(path)
    revisits = every.where("record_type = 'revisit'").count()
    assert revisits > 0 and every.where("record_type = 'response'").count() == n - revisits
    assert every.count() == n


def test_altered_payload_shows_its_own_digest(spark, tmp_path):
    path = tmp_path / "a"
    rows = [(1, "u", "first text", "p", "q"), (2, "u", "first text", "p", "q"), (3, "u", "other", "p", "q")]
    warc.write_archives(pages(spark, rows).coalesce(1), str(path))
    (file,) = path.glob("*.warc.gz")
    (path / "b.warc").write_bytes(gzip.decompress(file.read_bytes()).replace(b"first text", b"First text"))
    file.unlink()
    got = {r.record_id: r for r in warc.read_back(spark, str(path)).collect()}
    assert got[warc.urn(1)].payload_digest == warc.digest(b"First text")
    assert got[warc.urn(2)].record_type == "revisit" and got[warc.urn(2)].payload_digest is None and got[warc.urn(2)].payload_bytes is None
    assert got[warc.urn(3)].payload_digest == warc.digest(b"other")


@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz"])
def test_damaged_archives_fail_the_read(spark, tmp_path, name):
    record = warc.record("response", "<urn:page:1>", "http://x", b"abc" * 50, warc.digest(b"abc" * 50))
    pack = gzip.compress if name.endswith("gz") else bytes
    whole = pack(record) + pack(record)
    for data, says in ((whole[:-60], "ends inside"), (pack(record) + pack(record.replace(b"Content-Length: ", b"Content-Length: x")), "Content-Length")):
        (tmp_path / name).write_bytes(data)
        with pytest.raises(Exception, match=says):
            warc.read_archives(spark, str(tmp_path)).collect()
    (tmp_path / name).write_bytes(whole)
    assert warc.read_archives(spark, str(tmp_path)).count() == 2


def test_query_on_odd_rows_and_an_empty_table(spark, tmp_path, make):
    long = "x y " * 300_000
    rows = [(1, "u", long, "p", "q"), (7, None, None, "p", "q"), (None, "u", "", "p", "q"), (3, "v", "", "p", "q"), (8, "v", "n", "p", "q")]
    for sub, part in (("a", rows), ("b", [])):
        pages(spark, part).write.parquet(str(tmp_path / sub / "pages.parquet"))
    got = {r.page_id: r for r in warc.query(spark, str(tmp_path / "a")).collect()}
    assert got[1].payload_bytes == len(long) and got[1].payload_digest == warc.digest(long.encode())
    assert (got[3].record_type, got[7].record_type, got[7].refers_to, got[7].payload_bytes) == ("response", "revisit", 3, 0)
    assert got[None].record_type == "revisit" and len(got) == 5
    assert warc.query(spark, str(tmp_path / "b")).collect() == []

import base64
import gzip
import hashlib
from pathlib import Path

from pyspark.sql import functions as F

from dunlin.llm.warc import SCHEMA, WarcReader, page_of, read_warc, records_of, write_warc
from pyspark.sql.datasource import EqualTo, In, StringStartsWith

PAGES = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://b/4", ""), (5, "http://b/5", "WARC/1.1\r\n\r\nHTTP/1.1 200\r\n\r\n"),
         (None, "u\r\nv", "<p>é</p>"), (0, "http://c/0", "x" * 100_000), (9, "http://c/9", "tie"), (9, "http://c/9", "tie"), (10, "http://c/10", "tie"), (None, "z", "alone"), (None, "z", "alone")]
SHIP = 1000


def pages(spark):
    return spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, payload string, first int")


def test_round_trip(spark, tmp_path):
    for name, compression, ship in (("plain", "none", SHIP), ("packed", "gzip", 0)):
        path = f"{tmp_path}/{name}"
        write_warc(records_of(pages(spark).repartition(3), ship), path, compression)
        rows = read_warc(spark, path).withColumn("page_id", page_of("record_id").cast("long")).withColumn("first", page_of("refers_to").cast("long")).collect()
        assert len(rows) == len(PAGES)
        want = sorted((p[0] if p[0] is not None else -1, len((p[2] or "").encode()), base64.b32encode(hashlib.sha1((p[2] or "").encode()).digest()).decode()) for p in PAGES)
        assert sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest.removeprefix("sha1:")) for r in rows) == want
        kinds = sorted((r.page_id if r.page_id is not None else -1, r.warc_type, r.first) for r in rows)
        assert kinds == sorted([(-1, "revisit", 1), (-1, "response", None), (-1, "response", None), (0, "response", None), (1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "revisit", 3),
                                (5, "response", None), (9, "response", None), (9, "response", None), (10, "revisit", 9)], key=lambda x: x[:2])
        for r in rows:
            if r.warc_type == "response":
                assert base64.b32encode(hashlib.sha1(r.payload).digest()).decode() == r.payload_digest.removeprefix("sha1:")
            else:
                assert r.payload is None


def test_smaller_payloads_are_all_responses(spark, tmp_path):
    write_warc(records_of(pages(spark), SHIP, min_revisit_bytes=4), f"{tmp_path}/w")
    rows = read_warc(spark, f"{tmp_path}/w").collect()
    assert {r.payload_bytes for r in rows if r.warc_type == "revisit"} == {9}


def test_predicates_reach_the_reader(spark, tmp_path):
    path = f"{tmp_path}/w"
    write_warc(records_of(pages(spark), SHIP), path)
    held = read_warc(spark, path, "warc_type string, record_id string, content_length long").where("warc_type = 'revisit' AND content_length > 10")
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "Filter " not in plan and "PythonFilter" not in plan, plan
    assert held.count() == 4
    reader = WarcReader(path, ["warc_type", "target_uri"], {})
    assert list(reader.pushFilters([EqualTo(("warc_type",), "response"), In(("target_uri",), ("http://a/1",)), EqualTo(("payload",), b"")])) == [EqualTo(("payload",), b"")]
    assert [r for part in reader.partitions() for b in reader.read(part) for r in b.to_pylist()] == [{"warc_type": "response", "target_uri": "http://a/1"}]
    reader = WarcReader(path, ["record_id"], {})
    list(reader.pushFilters([StringStartsWith(("target_uri",), "http://b/")]))
    assert sum(b.num_rows for part in reader.partitions() for b in reader.read(part)) == 2


def test_blocks_are_not_read_unless_asked_for(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/w"
    write_warc(records_of(pages(spark), SHIP), path)
    skipped = []
    monkeypatch.setattr(WarcReader, "skip", staticmethod(lambda stream, n, packed: (skipped.append(n), stream.seek(n, 1))))
    reader = WarcReader(path, ["warc_type"], {})
    total = sum(b.num_rows for part in reader.partitions() for b in reader.read(part))
    assert total == len(PAGES) == len(skipped) and sum(skipped) > 100_000


def test_files_outside_the_manifest_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/w"
    write_warc(records_of(pages(spark), SHIP), path)
    Path(path, "lost-attempt.warc").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n")
    assert read_warc(spark, path).count() == len(PAGES)
    assert set(read_warc(spark, path).columns) == {c.split()[0] for c in SCHEMA.split(", ")}


def test_foreign_files_and_empty_tables(spark, tmp_path):
    folder = tmp_path / "foreign"
    folder.mkdir()
    record = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (folder / "a.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    assert read_warc(spark, str(folder), "warc_type string").where(F.col("warc_type") == "warcinfo").count() == 2
    write_warc(records_of(pages(spark).limit(0), SHIP), f"{tmp_path}/none")
    assert read_warc(spark, f"{tmp_path}/none").count() == 0


def test_later_writes_add_to_earlier_ones_or_replace_them(spark, tmp_path):
    path = f"{tmp_path}/w"
    records = records_of(pages(spark), SHIP)
    write_warc(records.where("record_id = '<urn:x-page:0>'"), path)
    write_warc(records.where("record_id = '<urn:x-page:4>'"), path, "gzip")
    write_warc(records.where("record_id = '<urn:x-page:none>'"), path)
    assert sorted(r.record_id for r in read_warc(spark, path).collect()) == ["<urn:x-page:0>", "<urn:x-page:4>"]
    write_warc(records.where("record_id = '<urn:x-page:5>'"), path, mode="overwrite")
    assert [r.record_id for r in read_warc(spark, path).collect()] == ["<urn:x-page:5>"]
    assert len(list(Path(path).glob("*.warc*"))) == 1

import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from dunlin.operators import catalog as C
from dunlin.operators import udfs as U
from dunlin.session import broadcast_if_bounded, discard, materialize, measured_bytes
from dunlin.sources import readers as R
from dunlin.sources import records as B
from dunlin.streaming import jobs as J
from dunlin.sources.writers import write_table
from dunlin.streaming.polled import COMPACT, PolledLinesReader, read_polled_lines
from dunlin.streaming.rows import FolderRows, write_rows
from tests.conftest import values

BLOCKS = """# header line

Id:   1
ASIN: 0827229534
  title: Say "Id: 5" \\ and\ttab
  group: Book
  salesrank: 396585
  similar: 2  0804215715  156101074X
  categories: 2
   |Books[283155]|Subjects[1000]
   |Books[283155]\\Preaching[12370]
  reviews: total: 2  downloaded: 2  avg rating: 4.5
    2000-7-28  cutomer: A2JW67OY8U6HHK  rating: 5  votes:  10  helpful:   9
    2003-12-14  cutomer: A2VE83MZF98ITY  rating: 4  votes:   6  helpful:   5

Id:   2
ASIN: 0738700797
  discontinued product

Id:   3
ASIN: 0486287785
  title: Plain
  group: Music
  salesrank: -1
  similar: 0
  categories: 0
  reviews: total: 0  downloaded: 0  avg rating: 0
"""


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_product_blocks(spark, tmp_path, newline):
    (tmp_path / "p.txt").write_bytes(BLOCKS.replace("\n", newline).encode())
    products = B.parse_blocks(B.read_blocks(spark, str(tmp_path), newline * 2))
    rows = {r["Id"]: r.asDict(recursive=True) for r in products.collect()}
    assert sorted(rows) == [1, 2, 3]
    assert rows[1]["title"] == 'Say "Id: 5" \\ and\ttab' and rows[1]["salerank"] == 396585
    assert [s["similar"] for s in rows[1]["similarLines"]] == ["0804215715", "156101074X"]
    assert [c["category"] for c in rows[1]["categoryLines"]][1] == "|Books[283155]\\Preaching[12370]"
    assert rows[1]["ReviewMetaData"] == {"total": 2, "downloaded": 2, "avg_rating": 4.5}
    assert [r["review"]["votes"] for r in rows[1]["reviewLines"]] == [10, 6]
    assert rows[2]["ASIN"] == "0738700797" and rows[2]["title"] is None and rows[2]["reviewLines"] is None
    assert rows[3]["similarLines"] == [] and rows[3]["salerank"] == -1
    text = [r["value"] for r in B.to_json_lines(products.where("Id = 1")).collect()][0]
    assert '"title":"Say  Id: 5    and tab"' in text and "/Preaching" in text


def test_bad_records(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"a": 1, "b": 2.5}\n{"a": oops\n{"a": "text", "b": 1}\n')
    loose = R.read_json(spark, str(tmp_path), "a INT, b DOUBLE", corrupt_column="_bad").cache()
    assert loose.count() == 3 and loose.where("_bad IS NOT NULL").count() == 2
    assert R.read_json(spark, str(tmp_path), "a INT, b DOUBLE", "DROPMALFORMED").collect()[0]["a"] == 1
    with pytest.raises(Exception):
        R.read_json(spark, str(tmp_path), "a INT, b DOUBLE", "FAILFAST").collect()
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "y.json").write_text('[\n {"a": 1},\n {"a": 2}\n]')
    assert values(R.read_json(spark, str(tmp_path / "m"), "a INT", multi_line=True)) == [(1,), (2,)]


def test_typed_fields_and_wide(spark, tmp_path):
    (tmp_path / "t.txt").write_text("id;v\n1; 2.5\nbad;x\n3\n")
    rows = R.typed_fields(R.read_lines(spark, str(tmp_path)), {"id": "int", "v": "double"}, ";", "id;v")
    assert values(rows) == sorted([(1, 2.5), (None, None), (3, None)], key=repr)
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "w.txt").write_text("1,0.5,2\n2,1,x\n")
    wide = R.name_features(R.read_wide(spark, str(tmp_path / "w")), ["p", "q"])
    assert values(wide) == sorted([(1.0, 0.5, 2.0), (2.0, 1.0, None)], key=repr)


def test_materialize_and_discard(spark):
    df = materialize(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    path = df.inputFiles()[0].replace("file:", "").replace("//", "/")
    discard(df)
    from pathlib import Path
    assert not Path(path).exists()
    assert materialize(spark.range(0)).count() == 0


def test_broadcast_needs_a_proven_bound(spark):
    # Few rows, but wide ones: the bound is in bytes.
    wide = spark.range(3).withColumn("fill", F.repeat(F.lit("x"), 1_000_000))
    assert measured_bytes(wide) > 3_000_000 and measured_bytes(spark.range(0)) == 0
    small = spark.range(100).join(broadcast_if_bounded(spark.range(5), 1000), "id")
    large = spark.range(100).join(broadcast_if_bounded(wide, 1_000_000), "id")
    assert "strategy=broadcast" in small._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in large._jdf.queryExecution().analyzed().toString()


def test_schema_json(spark):
    schema = spark.range(1).select("id", F.struct(F.array(F.lit(1)).alias("a")).alias("s")).schema
    assert C.schema_from_json(C.schema_to_json(schema)) == schema


def polled(reader, start):
    end = reader.latestOffset()
    return end, [v for p in reader.partitions(start, end) for batch in reader.read(p) for v in batch.column(1).to_pylist()]


def test_polled_ranges_cover_every_line_once(tmp_path):
    lines = [f"line {i} " + "x" * (i % 17) for i in range(200)] + ["é" * 30, "", "last"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(lines), encoding="utf-8")
    (folder / "_SUCCESS").write_text("")
    for size in (1, 7, 64, 10_000):
        reader = PolledLinesReader(str(folder), str(tmp_path / f"log-{size}"), size)
        end, got = polled(reader, reader.initialOffset())
        assert got == lines
        assert reader.partitions(end, end) == [] and reader.latestOffset() == end


def test_polled_files_are_taken_once(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    reader = PolledLinesReader(str(folder), str(tmp_path / "log"), 100)
    assert reader.latestOffset() == reader.initialOffset()
    (folder / "b.txt").write_text("b\r\nc\n\n")
    first, got = polled(reader, reader.initialOffset())
    assert got == ["b", "c", ""]
    # A file that was moved in later keeps an older time stamp.
    (folder / "a.txt").write_text("late")
    os.utime(folder / "a.txt", (1, 1))
    second, got = polled(reader, first)
    assert got == ["late"]
    # An emptied folder never sets the offset back, and a file is not read again.
    for name in ("a.txt", "b.txt"):
        (folder / name).unlink()
    assert reader.latestOffset() == second
    (folder / "a.txt").write_text("late")
    assert PolledLinesReader(str(folder), str(tmp_path / "log"), 100).latestOffset() == second
    with pytest.raises(FileNotFoundError):
        PolledLinesReader(str(tmp_path / "none"), str(tmp_path / "log"), 100).latestOffset()


def test_polled_stream_resumes(spark, tmp_path):
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()

    def run():
        stream = read_polled_lines(spark, str(folder), f"{out}/log")
        J.start_file_sink(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()

    (folder / "b.txt").write_text("one\ntwo\n")
    run()
    (folder / "a.txt").write_text("three\n")
    run()
    run()
    assert values(spark.read.parquet(f"{out}/data"), "value") == [("one",), ("three",), ("two",)]


def test_complete_drain_keeps_the_last_result(spark, tmp_path):
    src = str(tmp_path / "in")
    for i in range(5):
        spark.range(i + 1).coalesce(1).write.mode("append").parquet(src)
    stream = J.read_files(spark, src, "id long", files_per_trigger=1)
    assert J.drain_complete(stream.groupBy().count(), "keep").first()[0] == 15
    empty = tmp_path / "none"
    empty.mkdir()
    assert J.drain_complete(J.read_files(spark, str(empty), "id long").groupBy("id").count(), "none").count() == 0


def test_totals_outlast_the_reports_spark_keeps(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(6):
        spark.range(10).coalesce(1).write.mode("append").parquet(src)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with J.totals(spark) as held:
            query = J.start_file_sink(J.read_files(spark, src, "id long", files_per_trigger=1), f"{out}/data", f"{out}/checkpoint")
            query.awaitTermination()
            seen = J.progress_row(query, held)
        assert len(query.recentProgress) <= 2 and (seen["input_rows"], seen["batches"]) == (60, 6)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_rebalanced_write_opens_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).withColumn("k", F.col("id") % 5)
    write_table(df, f"{tmp_path}/a", partition_by=["k"])
    write_table(df, f"{tmp_path}/b", partition_by=["k"], rebalance=True)
    files = [len(spark.read.parquet(f"{tmp_path}/{x}").inputFiles()) for x in "ab"]
    assert files[0] == 40 and files[1] <= 10
    assert spark.read.parquet(f"{tmp_path}/b").count() == 4000


def test_late_rows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "ts timestamp, k string"

    def send(rows):
        frame = spark.createDataFrame(rows, "ts string, k string").withColumn("ts", F.to_timestamp("ts"))
        frame.coalesce(1).write.mode("append").parquet(src)
        counts = J.sliding_counts(J.read_files(spark, src, schema), "ts", ["k"], "10 minutes", "10 minutes", "10 minutes")
        J.start_file_sink(counts, f"{out}/data", f"{out}/checkpoint").awaitTermination()

    send([("2024-01-01 00:01:00", "a"), ("2024-01-01 00:30:00", "a")])
    send([("2024-01-01 00:02:00", "a"), ("2024-01-01 00:29:00", "a"), ("2024-01-01 01:00:00", "a")])
    got = [(r["win_start"].minute, r["n"]) for r in spark.read.parquet(f"{out}/data").orderBy("win_start").collect()]
    assert got == [(0, 1), (20, 1), (30, 1)]


def test_envelopes(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    sent = J.encode_envelope(df, F.col("id"))
    assert dict(sent.dtypes) == {"key": "binary", "value": "binary"}
    back = J.decode_envelope(sent, "id INT, name STRING, absent DOUBLE")
    assert values(back) == sorted([("1", 1, "a", None), ("2", 2, None, None)], key=repr)
    assert J.decode_envelope(sent, "id INT").columns == ["key", "id"]


def test_grouped_apply_takes_one_way_for_every_group(spark, monkeypatch):
    from dunlin.operators import udfs
    df = spark.createDataFrame([("hot", 1.0)] * 1000 + [("hot", 7.0), ("cold", 2.0), (None, 3.0)], "k string, v double").repartition(3)
    sizes = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def count(frame):
        return frame.groupby("k", dropna=False)["v"].agg(["max", "count"]).reset_index()

    def merge(frame):
        return frame.groupby("k", dropna=False).agg({"max": "max", "count": "sum"}).reset_index()

    want = sorted([("hot", 7.0, 1001), ("cold", 2.0, 1), (None, 3.0, 1)], key=repr)
    for batch, large in (("10000", 10_000), ("7", 100)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        monkeypatch.setattr(udfs, "LARGE_GROUP", large)
        try:
            assert values(U.grouped_apply(df, ["k"], count, "k string, max double, count long", merge)) == want
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", sizes)
    assert values(U.whole_groups(df, ["k"], count, "k string, max double, count long")) == want



def test_a_poll_reads_one_compacted_file_and_what_came_after(tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    reader = PolledLinesReader(str(folder), str(tmp_path / "log"), 100)
    for i in range(2 * COMPACT + 3):
        (folder / f"{i:03d}.txt").write_text(f"line {i}")
        end = reader.latestOffset()
    assert end == {"entries": 2 * COMPACT + 3}
    reads = []
    read = PolledLinesReader._read
    monkeypatch.setattr(PolledLinesReader, "_read", lambda self, path: reads.append(path) or read(self, path))
    # A new reader, as after a restart: the last compacted file and three entries.
    fresh = PolledLinesReader(str(folder), str(tmp_path / "log"), 100)
    assert fresh.latestOffset() == end
    assert len(reads) == 4 and reads[0].endswith(".compact")
    reads.clear()
    (folder / "new.txt").write_text("new")
    assert fresh.latestOffset() == {"entries": 2 * COMPACT + 4} and reads == []
    assert polled(fresh, end)[1] == ["new"]
    # What the first reader has not seen itself it finds in the log.
    assert reader.latestOffset() == {"entries": 2 * COMPACT + 4}
    assert len(reader.partitions({"entries": 0}, end)) == 2 * COMPACT + 3


def test_compacted_log_survives_a_lost_compaction(tmp_path):
    folder, log = tmp_path / "in", tmp_path / "log"
    folder.mkdir()
    for i in range(COMPACT):
        (folder / f"{i}.txt").write_text("x")
        PolledLinesReader(str(folder), str(log), 100).latestOffset()
    for path in log.glob("*.compact"):
        path.unlink()
    assert PolledLinesReader(str(folder), str(log), 100).latestOffset() == {"entries": COMPACT}


def test_foreach_writer_skips_committed_partitions(tmp_path):
    writer = FolderRows(str(tmp_path / "out"))
    assert writer.open(3, 7)
    writer.process(Row(a=1, b="é"))
    writer.close(None)
    assert not FolderRows(str(tmp_path / "out")).open(3, 7)
    # A try that fails leaves nothing; the next one may write.
    broken = FolderRows(str(tmp_path / "out"))
    assert broken.open(4, 7)
    broken.process(Row(a=2, b=None))
    broken.close(ValueError("lost"))
    again = FolderRows(str(tmp_path / "out"))
    assert again.open(4, 7)
    again.process(Row(a=2, b=None))
    again.close(None)
    files = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_file())
    assert files == ["000000000007-000003.json", "000000000007-000004.json"]
    assert (tmp_path / "out" / files[0]).read_text(encoding="utf-8") == '{"a": 1, "b": "\\u00e9"}\n' and not list((tmp_path / "out" / "_tries").iterdir())


def test_replayed_epochs_write_nothing_twice(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for i in range(3):
        spark.range(100 * i, 100 * i + 100, 1, 2).write.mode("append").parquet(source)
    stream = lambda: J.read_files(spark, source, spark.range(1).schema, files_per_trigger=2)
    write_rows(stream(), out, checkpoint).awaitTermination()
    want = values(spark.read.schema("id long").json(out))
    assert sorted(v for (v,) in want) == list(range(300))
    before = sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "out").iterdir() if p.is_file())
    last = max((p for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    write_rows(stream(), out, checkpoint).awaitTermination()
    assert sorted((p.name, p.stat().st_mtime_ns) for p in (tmp_path / "out").iterdir() if p.is_file()) == before


def test_unreported_end_is_an_error(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    query = J.start_file_sink(J.read_files(spark, str(tmp_path / "in"), spark.range(1).schema), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    with pytest.raises(TimeoutError):
        J.progress_row(query, J.Totals(), timeout=0.1)


def test_a_task_makes_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(R, "ROWS_PER_TASK", 100, raising=False)
    made = R.generated_rows(spark, 2050, seed=1)
    assert made.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 100
    assert made.count() == made.select("id").distinct().count() == 2050
    assert R.generated_rows(spark, 0, seed=1).count() == 0

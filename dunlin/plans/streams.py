"""Plans for Structured Streaming; every result is compared with a batch query."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from dunlin.plans.registry import Tables, plan
from dunlin.session import delete_path, scratch_path
from dunlin.streaming import jobs as J
from dunlin.streaming.polled import read_polled_lines
from dunlin.streaming.rows import write_rows


def rows(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


def events(t: Tables, **options):
    """The events table as a stream with event time."""
    return J.with_event_time(J.read_files(t.spark, pattern(t), t.events.schema, **options), "ts")


def pattern(t: Tables) -> str:
    """The events table as a glob, which fits a single file and a folder alike."""
    return t.path("events")[:-1] + "[t]"


def naive(df, *columns):
    """Instants back to zone-less stamps."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


WINDOWS = """
    SELECT s AS win_start, s + INTERVAL 10 MINUTE AS win_end, {key} AS {name}, count(*) AS n FROM {source}, LATERAL
      (SELECT unnest([time_bucket(INTERVAL 5 MINUTE, ts), time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE]) AS s) GROUP BY 1, 2, 3"""
BY_TYPE = WINDOWS.format(key="event_type", name="event_type", source="events")
CLOSED = f"SELECT * FROM ({BY_TYPE}) WHERE win_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


@plan("T01_file_stream_rate_cap", "SELECT count(*) AS n, round(sum(value), 2) AS total, true AS capped FROM events")
def _(t: Tables):
    staged, out = scratch_path(t.spark, "t01-in"), scratch_path(t.spark, "t01")
    files = max(6, t.events.rdd.getNumPartitions())
    t.events.repartition(files).write.parquet(staged)
    stream = J.read_files(t.spark, staged, t.events.schema, files_per_trigger=files // 3)
    with J.totals(t.spark) as held:
        query = J.start_file_sink(stream.select("value"), f"{out}/data", f"{out}/checkpoint")
        query.awaitTermination()
        capped = J.progress_row(query, held)["batches"] >= 3
    return t.spark.read.parquet(f"{out}/data").agg(rows(), F.round(F.sum("value"), 2).alias("total"), F.lit(capped).alias("capped"))


@plan("T01_newest_first", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    stream = J.read_files(t.spark, pattern(t), t.events.schema, files_per_trigger=1, newest_first=True)
    return J.drain(stream.select("event_type"), "t01n").groupBy("event_type").agg(rows())


@plan("T02_running_count_complete", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    return J.drain_complete(events(t).groupBy("event_type").agg(rows()), "t02")


@plan("T03_sliding_window_count", BY_TYPE)
def _(t: Tables):
    return naive(J.drain_complete(J.sliding_counts(events(t), "ts", ["event_type"]), "t03"), "win_start", "win_end")


@plan("T04_watermark_complete", BY_TYPE)
def _(t: Tables):
    counts = J.sliding_counts(events(t), "ts", ["event_type"], watermark="10 minutes")
    return naive(J.drain_complete(counts, "t04"), "win_start", "win_end")


@plan("T05_watermark_append", CLOSED)
def _(t: Tables):
    counts = J.sliding_counts(events(t), "ts", ["event_type"], watermark="10 minutes")
    return naive(J.drain(counts, "t05"), "win_start", "win_end")


@plan("T05_watermark_update", BY_TYPE)
def _(t: Tables):
    counts = J.sliding_counts(events(t), "ts", ["event_type"], watermark="10 minutes")
    return naive(J.drain_update(counts, ["win_start", "win_end", "event_type"], "t05u"), "win_start", "win_end")


@plan("T05_late_rows_dropped", CLOSED)
def _(t: Tables):
    # Everything is sent again after the windows closed; the copies are late.
    staged, out = scratch_path(t.spark, "t05-in"), scratch_path(t.spark, "t05l")

    def run():
        stream = J.with_event_time(J.read_files(t.spark, staged, t.events.schema), "ts")
        counts = J.sliding_counts(stream, "ts", ["event_type"], watermark="10 minutes")
        J.start_file_sink(counts, f"{out}/data", f"{out}/checkpoint").awaitTermination()

    t.events.write.parquet(staged)
    run()
    t.events.write.mode("append").parquet(staged)
    run()
    return naive(t.spark.read.parquet(f"{out}/data"), "win_start", "win_end")


@plan("T06_stream_static_join", """
    SELECT event_id, user_id, c_mktsegment FROM events JOIN customer ON user_id = c_custkey""")
def _(t: Tables):
    joined = J.join_static(events(t), t.customer.select("c_custkey", "c_mktsegment"), "user_id", "c_custkey")
    return J.drain(joined.select("event_id", "user_id", "c_mktsegment"), "t06")


@plan("J19_stream_static_outer_join", """
    SELECT event_id, s_name FROM events LEFT JOIN supplier ON user_id = s_suppkey""")
def _(t: Tables):
    joined = J.join_static(events(t), t.supplier.select("s_suppkey", "s_name"), "user_id", "s_suppkey", "left")
    return J.drain(joined.select("event_id", "s_name"), "j19")


@plan("T07_joined_window_count", WINDOWS.format(
    key="c_mktsegment", name="c_mktsegment", source="(SELECT * FROM events JOIN customer ON user_id = c_custkey)"))
def _(t: Tables):
    joined = J.join_static(events(t), t.customer.select("c_custkey", "c_mktsegment"), "user_id", "c_custkey")
    return naive(J.drain_complete(J.sliding_counts(joined, "ts", ["c_mktsegment"]), "t07"), "win_start", "win_end")


@plan("T08_stateless_etl", """
    SELECT event_id, CAST(ts AS DATE) AS date, upper(event_type) AS kind, CAST(props ->> 'k' AS INTEGER) AS k FROM events""")
def _(t: Tables):
    shaped = events(t).select("event_id", F.to_date("ts").alias("date"), F.upper("event_type").alias("kind"),
                              F.from_json("props", "k INT").getField("k").alias("k"))
    return J.drain(shaped, "t08")


@plan("T09_memory_sink", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 0")
def _(t: Tables):
    # The in-memory table holds one row per event type.
    name = f"dunlin_mem_{uuid.uuid4().hex[:8]}"
    return J.drain_to_memory(events(t).groupBy("event_type").agg(rows()), name).where("n > 0")


def _by_date(t: Tables, fmt: str):
    dated = J.with_event_time(events(t), "ts").select("event_id", "value", F.to_date("ts").alias("date"))
    return J.drain(dated, f"t10-{fmt}", fmt, ["date"]).groupBy("date").agg(rows(), F.round(F.sum("value"), 2).alias("total"))


_T10 = "SELECT CAST(ts AS DATE) AS date, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1"


@plan("T10_partitioned_parquet_sink", _T10)
def _(t: Tables):
    return _by_date(t, "parquet")


@plan("T10_partitioned_json_sink", _T10)
def _(t: Tables):
    return _by_date(t, "json")


@plan("T11_foreach_batch_sink", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    out = scratch_path(t.spark, "t11")
    stream = events(t).select("user_id", "event_id")
    J.write_batches(stream, f"{out}/checkpoint", J.batch_folder_writer(f"{out}/data")).awaitTermination()
    return t.spark.read.parquet(f"{out}/data").groupBy("user_id").agg(rows())


@plan("T11_foreach_rows_sink", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def _(t: Tables):
    """Each row goes through open, process and close; the last epoch is then replayed and writes nothing again."""
    out = scratch_path(t.spark, "t11-rows")
    stream = events(t).select("user_id", "value")
    write_rows(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    delete_path(t.spark, f"{out}/checkpoint/commits")
    write_rows(events(t).select("user_id", "value"), f"{out}/data", f"{out}/checkpoint").awaitTermination()
    written = t.spark.read.schema("user_id long, value double").json(f"{out}/data")
    return written.groupBy("user_id").agg(rows(), F.round(F.sum("value"), 2).alias("total"))


@plan("T13_bounded_replay_trigger", "SELECT count(*) AS n, true AS stopped FROM events")
def _(t: Tables):
    out = scratch_path(t.spark, "t13")
    query = J.start_file_sink(events(t).select("event_id"), f"{out}/data", f"{out}/checkpoint")
    query.awaitTermination()
    return t.spark.read.parquet(f"{out}/data").agg(rows(), F.lit(not query.isActive).alias("stopped"))


@plan("T13_interval_trigger", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables):
    out = scratch_path(t.spark, "t13i")
    query = J.start_file_sink(events(t).select("event_type"), f"{out}/data", f"{out}/checkpoint", interval="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return t.spark.read.parquet(f"{out}/data").groupBy("event_type").agg(rows())


def _topic(t: Tables, label: str) -> str:
    """Events as key/value rows in a folder that stands for a topic."""
    out = scratch_path(t.spark, label)
    rows_ = events(t).select("ts", F.to_date("ts").alias("date"), "event_id", "event_type", "value")
    J.start_file_sink(J.encode_envelope(rows_, F.col("ts")), f"{out}/topic", f"{out}/checkpoint").awaitTermination()
    return f"{out}/topic"


@plan("T14_envelope_encode", """
    SELECT event_id, event_type, round(value, 2) AS value, true AS keyed FROM events""")
def _(t: Tables):
    topic = t.spark.read.parquet(_topic(t, "t14"))
    value = F.col("value").cast("string")
    return topic.select(
        F.get_json_object(value, "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object(value, "$.event_type").alias("event_type"),
        F.round(F.get_json_object(value, "$.value").cast("double"), 2).alias("value"),
        F.startswith(F.col("key").cast("string"), F.get_json_object(value, "$.date")).alias("keyed"))


@plan("T15_envelope_decode", """
    SELECT event_id, event_type, CAST(ts AS DATE)::VARCHAR AS date, CAST(NULL AS VARCHAR) AS remote_user FROM events""")
def _(t: Tables):
    stream = J.read_files(t.spark, _topic(t, "t15"), "key BINARY, value BINARY")
    wide = J.decode_envelope(stream, "event_id BIGINT, event_type STRING, date STRING, remote_user STRING")
    return J.drain(wide.drop("key"), "t15out")


@plan("T16_query_progress", """
    SELECT count(*) AS input_rows, false AS active, false AS failed, true AS has_ids, true AS all_written, 0::BIGINT AS still_active FROM events""")
def _(t: Tables):
    out, name = scratch_path(t.spark, "t16"), f"t16_{uuid.uuid4().hex[:8]}"
    with J.totals(t.spark) as held:
        query = J.start_file_sink(events(t).select("event_id"), f"{out}/data", f"{out}/checkpoint", name=name)
        query.awaitTermination()
        seen = J.progress_row(query, held)
    active = sum(1 for q in t.spark.streams.active if q.name == name)
    return t.spark.read.parquet(f"{out}/data").agg(
        F.lit(seen["input_rows"]).cast("long").alias("input_rows"), F.lit(seen["active"]).alias("active"),
        F.lit(seen["failed"]).alias("failed"), F.lit(seen["has_ids"]).alias("has_ids"),
        (F.count(F.lit(1)) == seen["input_rows"]).alias("all_written"), F.lit(active).cast("long").alias("still_active"))


@plan("T16_stop_and_failure", """
    SELECT count(*) AS n, true AS was_active, false AS active, false AS stop_failed, true AS failure_seen FROM events""")
def _(t: Tables):
    out = scratch_path(t.spark, "t16s")
    with J.totals(t.spark) as held:
        live = J.start_file_sink(events(t).select("event_id"), f"{out}/data", f"{out}/checkpoint", interval="1 second")
        live.processAllAvailable()
        was_active = live.isActive
        live.stop()
        stopped = J.progress_row(live, held)

        def refuse(batch, batch_id):
            raise ValueError("refused on purpose")

        broken = J.write_batches(events(t).select("event_id"), f"{out}/checkpoint-2", refuse)
        try:
            broken.awaitTermination()
        except StreamingQueryException:
            pass
        failure = J.progress_row(broken, held)["error"]
    return t.spark.read.parquet(f"{out}/data").agg(
        rows(), F.lit(was_active).alias("was_active"), F.lit(stopped["active"]).alias("active"), F.lit(stopped["failed"]).alias("stop_failed"),
        F.lit("refused on purpose" in (failure or "")).alias("failure_seen"))


def _line_folder(t: Tables, label: str) -> str:
    path = scratch_path(t.spark, label)
    t.spread("documents").select(F.explode(F.split("text", "\n")).alias("value")).write.text(path)
    return path


_LINES = "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"


@plan("T17_polled_source", f"SELECT count(*) AS n, CAST(sum(length(line)) AS BIGINT) AS chars FROM {_LINES}")
def _(t: Tables):
    lines = read_polled_lines(t.spark, _line_folder(t, "t17-in"), scratch_path(t.spark, "t17-log"))
    return J.drain(lines, "t17").agg(rows(), F.sum(F.length("value")).alias("chars"))


@plan("T18_streaming_word_count", f"""
    SELECT word, count(*) AS n FROM (SELECT unnest(string_split(line, ' ')) AS word FROM {_LINES}) GROUP BY 1""")
def _(t: Tables):
    lines = read_polled_lines(t.spark, _line_folder(t, "t18-in"), scratch_path(t.spark, "t18-log"))
    words = lines.select(F.explode(F.split("value", " ")).alias("word")).groupBy("word").agg(rows())
    return J.drain_complete(words, "t18")


@plan("T19_restart_exactly_once", "SELECT event_type, count(*) AS n, count(*) AS ids FROM events GROUP BY 1")
def _(t: Tables):
    staged, out = scratch_path(t.spark, "t19-in"), scratch_path(t.spark, "t19")

    def run():
        stream = J.read_files(t.spark, staged, t.events.schema).select("event_id", "event_type")
        J.start_file_sink(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()

    half = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    t.events.where(half).write.parquet(staged)
    run()
    t.events.where(~half).write.mode("append").parquet(staged)
    run()
    run()
    return t.spark.read.parquet(f"{out}/data").groupBy("event_type").agg(rows(), F.countDistinct("event_id").alias("ids"))


@plan("T20_text_file_per_batch", "SELECT count(*) AS n, true AS per_batch, round(sum(value), 2) AS total FROM events")
def _(t: Tables):
    staged, out = scratch_path(t.spark, "t20-in"), scratch_path(t.spark, "t20")
    files = max(4, t.events.rdd.getNumPartitions())
    t.events.repartition(files).write.parquet(staged)
    stream = J.read_files(t.spark, staged, t.events.schema, files_per_trigger=files // 2)
    text = stream.select(F.concat_ws(",", "event_id", "value").alias("value"))
    J.write_batches(text, f"{out}/checkpoint", J.batch_folder_writer(f"{out}/lines", "text")).awaitTermination()
    back = t.spark.read.text(f"{out}/lines")
    number = F.substring_index("value", ",", -1).cast("double")
    return back.agg(rows(), (F.countDistinct("batch") >= 2).alias("per_batch"), F.round(F.sum(number), 2).alias("total"))

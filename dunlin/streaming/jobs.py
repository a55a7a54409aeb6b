"""Stream readers, windowed counts, joins, envelopes and sinks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from dunlin.session import broadcast_if_bounded, delete_path, scratch_path

# -------------------------------------------------------------------- sources


def read_files(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    newest_first: bool = False,
    **options: str,
) -> DataFrame:
    """File stream with a declared schema and an optional rate cap."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if newest_first:
        reader = reader.option("latestFirst", True)
    return reader.load(path)


def with_event_time(df: DataFrame, column: str) -> DataFrame:
    """Zone-less stamps as instants, which watermarks need."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


# ------------------------------------------------------------ transformations


def sliding_counts(
    df: DataFrame,
    ts: str,
    keys: Sequence[str] = (),
    length: str = "10 minutes",
    slide: str = "5 minutes",
    watermark: str | None = None,
) -> DataFrame:
    """Rows per sliding window and key; works on a stream and on a table.

    With a watermark the state of closed windows is dropped (append or update
    output); without one every window is kept for ever.
    """
    timed = df.withWatermark(ts, watermark) if watermark else df
    counts = timed.groupBy(F.window(ts, length, slide), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("win_start"), F.col("window.end").alias("win_end"), *keys, "n")


def join_static(stream: DataFrame, table: DataFrame, stream_key: str, table_key: str, how: str = "inner") -> DataFrame:
    """Stream joined with a static table, shipped whole only if proven small."""
    return stream.join(broadcast_if_bounded(table), stream[stream_key] == table[table_key], how).drop(table[table_key])


def encode_envelope(df: DataFrame, key: Column) -> DataFrame:
    """Binary ``(key, value)`` rows whose value is the whole row as JSON."""
    return df.select(key.cast("string").cast("binary").alias("key"),
                     F.to_json(F.struct("*")).cast("binary").alias("value"))


def decode_envelope(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Value JSON back to columns; fields that the payload lacks become null."""
    body = F.from_json(F.col("value").cast("string"), schema if isinstance(schema, str) else schema.simpleString())
    return df.select(F.col("key").cast("string").alias("key"), body.alias("data")).select("key", "data.*")


# ---------------------------------------------------------------------- sinks


def start_file_sink(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Exactly-once file output.

    With ``interval`` the query runs for ever at that pace; without it, it
    takes what is there, in capped batches, and stops.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def write_batches(
    df: DataFrame,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    mode: str = "append",
    interval: str | None = None,
) -> StreamingQuery:
    """Hand each micro-batch to ``write(batch, id)``.

    A batch may be replayed after a failure, so ``write`` must replace what an
    earlier try of the same id left behind.
    """
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(**trigger).start())


def batch_folder_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A writer that keeps each batch in its own folder and replaces it on replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch={batch_id}")

    return write


def drain(df: DataFrame, label: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    """Run a stream to the end of its input and return the output table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    query = start_file_sink(df, f"{path}/data", f"{path}/checkpoint", fmt, partition_by)
    query.awaitTermination()
    return spark.read.format(fmt).schema(df.schema).load(f"{path}/data")


def drain_complete(df: DataFrame, label: str) -> DataFrame:
    """Run an aggregating stream in complete mode and return its last result.

    Each batch replaces the one before it, which is deleted once it is no longer
    needed for a replay.  Without input the result is empty.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    store, done = batch_folder_writer(f"{path}/data"), []

    def write(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        done.append(batch_id)
        delete_path(spark, f"{path}/data/batch={batch_id - 2}")

    query = write_batches(df, f"{path}/checkpoint", write, "complete")
    query.awaitTermination()
    if not done:
        return spark.createDataFrame([], df.schema)
    return spark.read.schema(df.schema).parquet(f"{path}/data/batch={done[-1]}")


def drain_update(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Run an aggregating stream in update mode and return the last row per key."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    write_batches(df, f"{path}/checkpoint", batch_folder_writer(f"{path}/data"), "update").awaitTermination()
    updates = spark.read.parquet(f"{path}/data")
    rest = [c for c in df.columns if c not in keys]
    return (updates.groupBy(*keys).agg(*[F.max_by(c, "batch").alias(c) for c in rest]).select(*df.columns))


def drain_to_memory(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Run a stream into a named in-memory table; for small results only."""
    spark = df.sparkSession
    query = (df.writeStream.format("memory").queryName(name).outputMode(mode)
             .option("checkpointLocation", scratch_path(spark, name)).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.sql(f"SELECT * FROM {name}")


class Totals(StreamingQueryListener):
    """Adds up what each run of a query reports; Spark itself keeps only the last reports."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = defaultdict(int)
        self.batches: dict[str, int] = defaultdict(int)
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] += event.progress.numInputRows
        self.batches[run] += event.progress.numInputRows > 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()


@contextmanager
def totals(spark: SparkSession) -> Iterator[Totals]:
    """Count the reports of all queries started inside the block."""
    held = Totals()
    spark.streams.addListener(held)
    try:
        yield held
    finally:
        spark.streams.removeListener(held)


def progress_row(query: StreamingQuery, held: Totals, timeout: float = 60) -> dict:
    """What a query that has ended reports about itself, from its first batch to its last."""
    # Reports arrive on their own thread; the end is the last of them.
    if not held.ended[str(query.runId)].wait(timeout):
        raise TimeoutError(f"the end of {query.name or query.id} was not reported in {timeout} s, so its totals may lack batches")
    failure = query.exception()
    return {
        "name": query.name, "active": query.isActive, "failed": failure is not None, "error": str(failure) if failure else None,
        "has_ids": bool(query.id) and bool(query.runId), "message": query.status["message"],
        "input_rows": held.rows[str(query.runId)], "batches": held.batches[str(query.runId)],
    }

"""Helpers shared by the training-text operators."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.session import materialize, ship_code

#: Ids up to which a list of documents may be shipped whole to every executor (about 40 MB).
SHIPPED_IDS = 2_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id and the text, under names that no operator's own columns clash with."""
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """Apply ``function`` to Arrow batches inside the tasks that read ``df``."""
    ship_code(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch, column: str, characters: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``characters`` of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > characters:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs before the next large one starts."""
    # The second round finds what the first one only marked.
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def without_ids(docs: DataFrame, ids: DataFrame, doc_id: str = "doc_id", among: Column | None = None) -> DataFrame:
    """Rows of ``docs`` whose id is not in ``ids`` (one column, ``dropped_id``); rows for which ``among`` does not hold stay in any case.

    The list is written first and broadcast only when its counted size is
    within :data:`SHIPPED_IDS`; beyond that the join shuffles.
    """
    ids = materialize(ids.select("dropped_id").distinct(), "dropped")
    if ids.count() <= SHIPPED_IDS:
        ids = F.broadcast(ids)
    gone = F.col(f"`{doc_id}`") == F.col("dropped_id")
    return docs.join(ids, gone if among is None else gone & among, "left_anti")


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and leave every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str], rows: int) -> Iterator[pa.Table]:
    """Gather the batches of a partition that is sorted by ``keys`` into tables of whole groups.

    Each table has about ``rows`` rows, more only where one group has more. Keys must not be null.
    """
    ready: list[pa.RecordBatch] = []
    open_group: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        of_last = pc.equal(batch.column(keys[0]), batch.column(keys[0])[-1])
        for key in keys[1:]:
            of_last = pc.and_(of_last, pc.equal(batch.column(key), batch.column(key)[-1]))
        cut = batch.num_rows - pc.sum(of_last).as_py()
        if cut or (open_group and any(open_group[-1].column(k)[-1] != batch.column(k)[0] for k in keys)):
            ready += open_group + ([batch.slice(0, cut)] if cut else [])
            open_group = []
        open_group.append(batch.slice(cut))
        if sum(b.num_rows for b in ready) >= rows:
            yield pa.Table.from_batches(ready)
            ready = []
    if ready or open_group:
        yield pa.Table.from_batches(ready + open_group)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered pair; it is not linear, so periodic texts have no special values."""
    with np.errstate(over="ignore"):
        h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B19E3779F9))
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sliding(values: np.ndarray, width: int, pick: np.ufunc, beyond: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over ``values[i: i + width]`` for every i; ``beyond`` stands for places after the end."""
    n = len(values)
    padded = np.full(-(-(n + width - 1) // width) * width, beyond, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    onward = pick.accumulate(blocks, axis=1).ravel()
    back = pick.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], onward[width - 1: width - 1 + n])

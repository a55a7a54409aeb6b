"""Session settings, shared scratch storage and size-checked broadcasts.

Everything that has to be written between stages goes to the folder named by
``spark.checkpoint.dir``, which every executor can reach.  A temporary folder
is only made where that setting is absent, as in local tests.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"

#: Measured bytes up to which a lookup may be shipped whole to every executor.
BROADCAST_BYTES = 64 << 20


def build_session(app: str = "dunlin", master: str | None = None, **settings: str) -> SparkSession:
    """Return a session with adaptive execution and UTC time.

    ``shuffle.partitions`` is left to the caller: adaptive execution merges
    small partitions, so a cluster should set it from its own size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that all executors can read and write.

    Without the setting a local session gets a temporary folder; on a cluster
    that is an error, since executors would not see each other's files.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        root = spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="dunlin-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return root.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_root(spark)}/dunlin/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application.

    Functions that run inside tasks import it, and executors need not have it
    installed.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='dunlin-code-')}/dunlin", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def delete_path(spark: SparkSession, folder: str) -> None:
    """Delete a file or folder on whatever file system it is; an absent one is no error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(conf).delete(path, True)


def path_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of a file or of all files of a folder on whatever file system it is."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(conf).getContentSummary(path).getLength()


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder.

    Frames that still read from there must not be used afterwards.
    """
    for name in _BUCKETED.values():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    _BUCKETED.clear()
    delete_path(spark, scratch_root(spark))


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage of a loop, survives the loss of executors and gives
    the optimizer real sizes for the next join.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Catalog names of the bucketed tables by the last part of their paths.
_BUCKETED: dict[str, str] = {}


def store_ordered(df: DataFrame, keys: Sequence[str], path: str, name: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as the table ``name``, cut into buckets by ``keys`` and sorted by them, and read it back.

    Joins and aggregations by ``keys`` then neither shuffle nor sort this side, however often it is read.
    Rows are dealt out by the buckets' own hash first, so each bucket is one sorted file; Spark relies
    on the order of such files only if its setting for bucketed scans says so, which is set here.
    ``buckets`` defaults to the number of shuffle partitions, so that the other side of a join has as many.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(count, *keys).write.format("parquet").option("path", path)
    writer.bucketBy(count, *keys).sortBy(*keys).saveAsTable(name)
    return spark.table(name)


def materialize_by(df: DataFrame, keys: Sequence[str], label: str = "arcs") -> DataFrame:
    """:func:`materialize` for a table that a loop joins by ``keys`` in every round: stored once in the order of the join."""
    path = scratch_path(df.sparkSession, label)
    leaf = path.rsplit("/", 1)[-1]
    _BUCKETED[leaf] = f"dunlin_{leaf.replace('-', '_')}"
    return store_ordered(df, keys, path, _BUCKETED[leaf])


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by :func:`materialize` or :func:`materialize_by`."""
    spark = df.sparkSession
    marker = scratch_root(spark).split("://")[-1].removeprefix("file:").lstrip("/")
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if f"{marker}/" in folder:
            if name := _BUCKETED.pop(folder.rsplit("/", 1)[-1], None):
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_path(spark, folder)


def measured_bytes(df: DataFrame) -> int:
    """About what the rows of ``df`` hold in memory: their JSON text plus 16 bytes per field."""
    row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return int(df.agg(F.sum(row + F.lit(16 * len(df.columns)))).first()[0] or 0)


def broadcast_if_bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its measured bytes are within the bound.

    Drop unused columns first.  Beyond the bound the frame is returned as it is
    and the join shuffles.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df

"""A polled line source: files of a shared folder, read in parallel on the executors."""

from __future__ import annotations

import io
import json
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SOURCE_NAME = "dunlin_lines"
#: Bytes that a task decodes at once.
BLOCK_BYTES = 4 << 20
#: Entries of the log after which the names of all files are written as one.
COMPACT = 10


class ByteRange(InputPartition):
    """A stretch of one file; lines belong to the stretch they start in."""

    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class PolledLinesReader(DataSourceStreamReader):
    """Offsets count the entries of a log of files seen, kept beside the stream's checkpoint.

    Every poll that finds files not yet in the log writes one more entry with
    their names and sizes, so a file is taken once whatever its time stamp, and
    a restart finds the same entries.  Every :data:`COMPACT` entries the names of
    all files so far are also written as one compacted file: a reader that starts
    reads that and the entries after it, and from then on only entries it has not
    read.  Files have to be moved into the folder complete, keep their name and stay
    unchanged.  An emptied folder gives nothing new; a missing one is an error.
    """

    def __init__(self, folder: str, log: str, range_bytes: int):
        self.folder, self.log, self.range_bytes = folder, log, range_bytes
        #: Names of the files in the first ``known`` entries.
        self.seen: set[str] = set()
        self.known = 0

    def _place(self, path: str):
        if "://" in path or path.startswith("file:/"):
            return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        return pafs.LocalFileSystem(), path

    def _entries(self, ending: str = ".json") -> list[str]:
        fs, root = self._place(self.log)
        found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        return sorted(f.path for f in found if f.base_name.endswith(ending))

    def _write(self, name: str, held: list) -> None:
        """Written aside and moved, so that a torn file is never read."""
        fs, root = self._place(self.log)
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{name}.tmp") as out:
            out.write(json.dumps(held).encode())
        fs.move(f"{root}/{name}.tmp", f"{root}/{name}")

    def _catch_up(self, entries: list[str]) -> None:
        """Learn the names in all entries, from the last compacted file where that is ahead."""
        compacted = self._entries(".compact") if self.known == 0 else []
        if compacted:
            self.seen = set(self._read(compacted[-1]))
            self.known = int(compacted[-1].rsplit("/", 1)[-1].split(".")[0])
        for entry in entries[self.known:]:
            self.seen.update(path for path, _ in self._read(entry))
        self.known = max(self.known, len(entries))

    def _read(self, path: str) -> list:
        fs, _ = self._place(self.log)
        with fs.open_input_stream(path) as held:
            return json.loads(held.read())

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        fs, root = self._place(self.folder)
        found = fs.get_file_info(pafs.FileSelector(root))
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and not f.base_name.startswith(("_", ".")))
        entries = self._entries()
        self._catch_up(entries)
        fresh = [f for f in files if f[0] not in self.seen]
        if fresh:
            self._write(f"{len(entries):012d}.json", fresh)
            self.seen.update(path for path, _ in fresh)
            self.known = len(entries) + 1
            if self.known % COMPACT == 0:
                self._write(f"{self.known:012d}.compact", sorted(self.seen))
        return {"entries": len(entries) + bool(fresh)}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        taken = self._entries()[start["entries"]:end["entries"]]
        return [ByteRange(path, at, min(at + self.range_bytes, size))
                for entry in taken for path, size in self._read(entry) for at in range(0, size, self.range_bytes)]

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        fs, _ = self._place(self.folder)
        name = partition.path.rsplit("/", 1)[-1]
        with io.BufferedReader(fs.open_input_file(partition.path), 1 << 20) as handle:
            if partition.start > 0:
                handle.seek(partition.start - 1)
                handle.readline()
            while handle.tell() < partition.end:
                # Whole blocks up to the end of the stretch, each ended at a line's end.
                block = handle.read(min(BLOCK_BYTES, partition.end - handle.tell()))
                block += handle.readline() if not block.endswith(b"\n") else b""
                if not block:
                    break
                lines = block.decode("utf-8", "replace").replace("\r\n", "\n").removesuffix("\n").split("\n")
                yield pa.RecordBatch.from_arrays([pa.array([name]).take(pa.array([0] * len(lines))), pa.array(lines)], ["file", "value"])


class PolledLines(DataSource):
    """Options: ``path``, ``log`` (folder of the files seen) and ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        return "file string, value string"

    def streamReader(self, schema) -> PolledLinesReader:
        return PolledLinesReader(self.options["path"], self.options["log"],
                                 int(self.options.get("rangebytes", self.options.get("rangeBytes", 64 << 20))))


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system on which Spark itself would look for it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(place).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def read_polled_lines(spark: SparkSession, path: str, log: str, **options):
    """Stream of ``(file, value)`` lines from a polled folder.

    ``log`` belongs to one stream, like its checkpoint, and both are kept or
    dropped together.
    """
    # The process that plans the source cannot see shipped files, so the classes
    # of this module travel by value.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PolledLines)
    return (spark.readStream.format(SOURCE_NAME).option("path", _qualified(spark, path)).option("log", _qualified(spark, log))
            .options(**options).load())

"""Foreach sink: a writer that sees one row at a time between ``open`` and ``close``."""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery

from dunlin.session import ship_code
from dunlin.streaming.polled import _qualified


class FolderRows:
    """Writes each row as a JSON line, one file per partition and epoch.

    Spark calls ``open``, then ``process`` for each row, then ``close``. Rows go to a file of the try's own, which
    ``close`` moves to its final name; that name is the commit. A replayed epoch finds the names of
    its committed partitions in ``open`` and skips them, so nothing is written twice; a try that failed
    leaves nothing behind. This rests on a replay having the same rows in the same partition, as
    sources that keep offsets give while the number of partitions stays the same.
    """

    def __init__(self, folder: str):
        self.folder = folder
        self.out = None

    def _place(self):
        if "://" in self.folder:
            return pafs.FileSystem.from_uri(self.folder.replace("s3a://", "s3://", 1))
        return pafs.LocalFileSystem(), self.folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.fs, root = self._place()
        self.fs.create_dir(f"{root}/_tries", recursive=True)
        self.final = f"{root}/{epoch_id:012d}-{partition_id:06d}.json"
        if self.fs.get_file_info(self.final).type != pafs.FileType.NotFound:
            return False
        self.aside = f"{root}/_tries/{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.aside)
        return True

    def process(self, row: Row) -> None:
        self.out.write((json.dumps(row.asDict(recursive=True), default=str) + "\n").encode())

    def close(self, error: Exception | None) -> None:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        if error is None:
            self.fs.move(self.aside, self.final)
        else:
            self.fs.delete_file(self.aside)


def write_rows(df: DataFrame, folder: str, checkpoint: str, mode: str = "append", interval: str | None = None, writer: type = FolderRows) -> StreamingQuery:
    """Hand each row of a stream to a ``writer`` made for ``folder``, an object with ``open``, ``process`` and ``close``.

    Meant for sinks that take single rows; whole batches go faster through :func:`dunlin.streaming.jobs.write_batches`.
    """
    ship_code(df.sparkSession)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreach(writer(_qualified(df.sparkSession, folder))).trigger(**trigger).start())

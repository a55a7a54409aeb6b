"""WARC archives as a Python data source.

The writer puts one file per task (cut at ``max_bytes``) into a folder under a
name of its own; every write adds a manifest that lists the files of its
successful attempts, so repeated or lost attempts leave nothing that is read and
later writes add to earlier ones.  The reader plans its partitions from the files
of all manifests and takes over predicates on the record type and the
other header fields.  It parses a record's headers first and reads its block
only if the predicates hold and the payload is among the requested columns; in
plain files the block is skipped by seeking.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan,
    LessThanOrEqual, StringStartsWith, WriterCommitMessage)

#: Names of manifests; each write has one of its own.
MANIFEST = re.compile(r"_manifest-[0-9a-f]+\.json")
#: Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header fields by column.
FIELDS = {"warc_type": "WARC-Type", "record_id": "WARC-Record-ID", "warc_date": "WARC-Date", "target_uri": "WARC-Target-URI",
          "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
SCHEMA = ("warc_type string, record_id string, warc_date string, target_uri string, refers_to string, payload_digest string, "
          "content_length long, payload_bytes long, payload binary")
WRITTEN = "record_id string, warc_date string, target_uri string, refers_to string, payload_bytes long, payload binary, sha1 string"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", path))


@dataclass
class _Written(WriterCommitMessage):
    files: list


@dataclass
class _Files(InputPartition):
    files: list

    def __init__(self, files: list):
        super().__init__(0)
        self.files = files


def _manifests(store: fs.FileSystem, root: str) -> dict[str, list]:
    """Files (name, bytes) by the path of the manifest that lists them."""
    found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
    held = {}
    for path in sorted(x.path for x in found if MANIFEST.fullmatch(x.base_name)):
        with store.open_input_stream(path) as source:
            held[path] = json.loads(source.read())
    return held


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, options: dict, overwrite: bool = False):
        self.path = path
        self.overwrite = overwrite
        self.gzip = options.get("compression", "none") == "gzip"
        self.max_bytes = int(options.get("max_bytes", 1 << 30))

    def record(self, row: dict) -> bytes:
        """One record: a response with its payload, or a revisit that holds the response's headers alone."""
        revisit = row["refers_to"] is not None
        payload = b"" if revisit else row["payload"] or b""
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['payload_bytes']}\r\n\r\n").encode() + payload
        digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
        fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["warc_date"]),
                  ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Refers-To", row["refers_to"]),
                  ("WARC-Profile", REVISIT_PROFILE if revisit else None), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
        head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
        data = f"{VERSION}\r\n{head}\r\n".encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
        return gzip.compress(data, 6, mtime=0) if self.gzip else data

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, root = _place(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                for start in range(0, batch.num_rows, 256):
                    for row in batch.slice(start, 256).to_pylist():
                        if out is None or size >= self.max_bytes:
                            if out is not None:
                                out.close()
                                files[-1][1] = size
                            files.append([f"{uuid.uuid4().hex}.warc" + ".gz" * self.gzip, 0])
                            out, size = store.open_output_stream(f"{root}/{files[-1][0]}", compression=None), 0
                        data = self.record(row)
                        out.write(data)
                        size += len(data)
        finally:
            if out is not None:
                out.close()
                files[-1][1] = size
        return _Written(files)

    def commit(self, messages: list) -> None:
        store, root = _place(self.path)
        store.create_dir(root, recursive=True)
        before = _manifests(store, root) if self.overwrite else {}
        with store.open_output_stream(f"{root}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())
        # What an overwrite replaces goes only once its own files are listed; a manifest goes before its files.
        for path in before:
            store.delete_file(path)
        for name, _ in (f for files in before.values() for f in files):
            store.delete_file(f"{root}/{name}")

    def abort(self, messages: list) -> None:
        store, root = _place(self.path)
        for name, _ in (f for m in messages if m for f in m.files):
            store.delete_file(f"{root}/{name}")


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list, options: dict):
        self.path, self.columns = path, columns
        self.split_bytes = int(options.get("split_bytes", 128 << 20))
        self.tests: list = []

    def pushFilters(self, filters: list) -> Iterator[Filter]:
        """Take over what headers alone can answer; Spark evaluates the rest."""
        known = {*FIELDS, "content_length"}
        kinds = (EqualTo, In, IsNotNull, StringStartsWith, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for f in filters:
            if isinstance(f, kinds) and len(f.attribute) == 1 and f.attribute[0] in known:
                self.tests.append((type(f).__name__, f.attribute[0], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list:
        """Files, small ones together, up to ``split_bytes``; a folder without a manifest is listed."""
        store, root = _place(self.path)
        if listed := _manifests(store, root):
            files = sorted(f for held in listed.values() for f in held)
        else:
            found = store.get_file_info(fs.FileSelector(root))
            files = sorted([x.base_name, x.size] for x in found if re.search(r"\.warc(\.gz)?$", x.base_name))
        groups, held = [[]], 0
        for name, size in files:
            if groups[-1] and held + size > self.split_bytes:
                groups.append([])
                held = 0
            groups[-1].append(f"{root}/{name}")
            held += size
        return [_Files(g) for g in groups]

    def holds(self, row: dict) -> bool:
        for kind, name, value in self.tests:
            x = row[name]
            if x is None:
                return False
            if not {"EqualTo": lambda: x == value, "In": lambda: x in value, "IsNotNull": lambda: True, "StringStartsWith": lambda: x.startswith(value),
                    "GreaterThan": lambda: x > value, "GreaterThanOrEqual": lambda: x >= value, "LessThan": lambda: x < value, "LessThanOrEqual": lambda: x <= value}[kind]():
                return False
        return True

    def records(self, store: fs.FileSystem, file: str) -> Iterator[dict]:
        packed = file.endswith(".gz")
        with store.open_input_file(file) as raw:
            stream = gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw, 1 << 16)
            while True:
                line = stream.readline()
                if not line:
                    return
                if not line.strip():
                    continue
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"{file}: not a record: {line[:40]!r}")
                fields = {}
                for line in iter(stream.readline, b"\r\n"):
                    if not line:
                        raise ValueError(f"{file} ends inside a header")
                    name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
                    fields[name.strip().lower()] = value.strip()
                length = int(fields["content-length"])
                row = {c: fields.get(h.lower()) for c, h in FIELDS.items()} | {"content_length": length}
                if not self.holds(row):
                    self.skip(stream, length, packed)
                    continue
                if "payload" in self.columns or "payload_bytes" in self.columns:
                    # The HTTP headers come first; the payload itself is read only if it is asked for.
                    got = 0
                    for line in iter(stream.readline, b"\r\n"):
                        got += len(line)
                        if got >= length:
                            break
                        name, _, value = line.partition(b":")
                        if name.strip().lower() == b"content-length":
                            row["payload_bytes"] = int(value)
                    else:
                        got += 2
                    if "payload" in self.columns and row["warc_type"] != "revisit":
                        row["payload"] = stream.read(length - got)
                    else:
                        self.skip(stream, length - got, packed)
                else:
                    self.skip(stream, length, packed)
                yield row

    @staticmethod
    def skip(stream, length: int, packed: bool) -> None:
        if packed:
            while length > 0:
                length -= len(stream.read(min(length, 1 << 20))) or length
        elif length:
            stream.seek(length, io.SEEK_CUR)

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        store, _ = _place(self.path)
        kinds = {"content_length": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(c, kinds.get(c, pa.string())) for c in self.columns])
        rows, held = [], 0
        for file in partition.files:
            for row in self.records(store, file):
                rows.append({c: row.get(c) for c in self.columns})
                held += 200 + len(row.get("payload") or b"")
                if held > 8_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)


class WarcSource(DataSource):
    """``spark.read.format("warc").schema(...)`` with any of the columns of ``SCHEMA``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options["path"], schema.names, dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options["path"], dict(self.options), overwrite)


def register_warc(spark: SparkSession) -> None:
    """Make the format known to the session; its code travels by value."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def records_of(pages: DataFrame, shipped: int, min_revisit_bytes: int = 0, warc_date: str = "2024-01-01T00:00:00Z",
               page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """The columns of ``WRITTEN`` for every row of ``pages``.

    Of rows with equal payloads of ``min_revisit_bytes`` or more, the one with the
    smallest id is the response and the others revisit it.  Rows equal in id and
    payload stand for one page and are treated alike.  Rows without an id are
    never referred to.  Null html is an empty payload; a null url has no header.
    """
    from dunlin.session import materialize

    name = F.col(f"`{page_id}`")
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    plain = pages.select(name.alias("page_id"), F.regexp_replace(F.col(f"`{url}`"), r"[\r\n]", "%0A").alias("target_uri"), payload.alias("payload"))
    plain = plain.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    # Only ids and digests are shuffled; payloads stay where they were read.
    keys = plain.where(F.col("payload_bytes") >= min_revisit_bytes).select("page_id", "sha1")
    first = keys.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("sha1", "first")
    again = materialize(keys.join(first, "sha1").where("NOT (page_id <=> first)").select(
        F.col("page_id").alias("r_id"), F.col("sha1").alias("r_sha1"), "first").distinct(), "revisits")
    if again.count() <= shipped:
        again = F.broadcast(again)
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), F.url_encode(c.cast("string")), F.lit(">"))
    held = plain.join(again, plain.page_id.eqNullSafe(again.r_id) & (plain.sha1 == again.r_sha1), "left")
    return held.select(F.coalesce(urn(F.col("page_id")), F.lit("<urn:x-page>")).alias("record_id"), F.lit(warc_date).alias("warc_date"), "target_uri",
                       urn(F.col("first")).alias("refers_to"), "payload_bytes", F.when(F.col("first").isNull(), F.col("payload")).alias("payload"), "sha1")


def write_warc(records: DataFrame, path: str, compression: str = "none", mode: str = "append") -> None:
    """Write records to the folder ``path``; ``mode`` is ``append`` or ``overwrite``, which replaces earlier writes."""
    register_warc(records.sparkSession)
    records.write.format("warc").option("compression", compression).mode(mode).save(path)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA) -> DataFrame:
    register_warc(spark)
    return spark.read.format("warc").schema(columns).load(path)


def page_of(urn: str):
    """The page id inside a record id, as text; null if it holds none."""
    held = F.regexp_extract(urn, "^<urn:x-page:(.*)>$", 1)
    return F.when(held != "", F.url_decode(held))

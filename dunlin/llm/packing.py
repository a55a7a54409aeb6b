"""Packing by power-of-two decomposition.

A document of n tokens is cut, largest first, into the pieces of n's binary
form, none longer than ``max_length``.  Every piece is a sequence of its own:
equal lengths make up a bucket, no sequence crosses documents and none needs
padding.  Nothing is shuffled; a bucket is a column and, once written, a folder.

Token ids are those of the byte-level BPE given by its ``tokenizers`` file.  The
file's rules split a text before every single space that follows a non-space,
so the ids of a text are the ids of its space-separated units; each task keeps
a bounded table of units it has met. The file is shipped with the job, so executors need no copy.  Texts with longer white space or with a
special token's string are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dunlin.llm.common import in_arrow, pieces, text_of

MAX_LENGTH = 2048
END_ID = 1
#: Units that a task keeps at most, and the longest that it keeps.
KEPT_UNITS, KEPT_CHARS = 400_000, 48
#: White space before a space that more white space or the end follows: the space is no boundary.
UNSAFE = re.compile(r"\s (?:\s|\Z)")
#: Fixed value: the splitting pattern of this kind of vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies spell printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Units(dict):
    """The ids, as little-endian bytes, of a space and a unit of text."""

    def __init__(self, path: str):
        super().__init__()
        held = json.load(open(path, encoding="utf-8"))
        special = {t["content"]: t["id"] for t in held.get("added_tokens", [])}
        letters = _byte_of_letter()
        ranks = {bytes(map(letters.__getitem__, token)): i for token, i in held["model"]["vocab"].items() if token not in special}
        self.native = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.path, self.special = path, tuple(special)

    @cached_property
    def whole(self) -> Tokenizer:
        """The tokenizer itself, loaded only where a text holds a special token."""
        return Tokenizer.from_file(self.path)

    def __missing__(self, unit: str) -> bytes:
        ids = self.plain(" " + unit)
        if len(self) < KEPT_UNITS and len(unit) <= KEPT_CHARS:
            self[unit] = ids
        return ids

    def plain(self, text: str) -> bytes:
        return np.array(self.native.encode_ordinary(text), "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of ``text`` without special tokens added."""
        if any(token in text for token in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        if UNSAFE.search(text):
            return np.frombuffer(self.plain(text), "<u4")
        first, *rest = text.split(" ")
        return np.frombuffer(self.plain(first) + b"".join(map(self.__getitem__, rest)), "<u4")


@lru_cache(maxsize=1)
def units(path: str) -> Units:
    """The table of the tokenizer file at the driver's ``path``, from the copy that Spark ships with the job where there is one."""
    shipped = SparkFiles.get(os.path.basename(path))
    return Units(shipped if os.path.exists(shipped) else path)


def binary_lengths(n: int, most: int = MAX_LENGTH) -> list[int]:
    """Powers of two, none over ``most`` (a power of two), that add up to ``n``, largest first."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(most.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, tokenizer: str, max_length: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, ids``.

    A document's ids are those of its text and then ``end_id``; a null or empty
    text has that id alone.  ``bucket`` is the exponent of ``length``; each piece
    is sequence ``sequence_id`` at offset 0.  Repeated rows are packed each for
    itself.  Other columns are ignored.  An empty table gives no rows.  Memory is
    that of one piece of texts (about 2 MB, or one long document).
    """
    if max_length & (max_length - 1) or max_length < 1:
        raise ValueError("max_length has to be a power of two")
    docs.sparkSession.sparkContext.addFile(tokenizer)
    source = text_of(docs, doc_id, text)
    schema = f"doc_id {dict(source.dtypes)['doc_id']}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = units(tokenizer)
        for piece in pieces(batch, "text"):
            rows, starts, lengths, sums, totals, held = [], [], [], [], [], []
            for row, value in enumerate(piece.column("text").to_pylist()):
                ids = np.append(table.encode(value or ""), np.uint32(end_id)).astype("<u4")
                sizes = binary_lengths(len(ids), max_length)
                at = np.cumsum([0, *sizes])
                data = memoryview(ids.tobytes())
                rows += [row] * len(sizes)
                starts += at[:-1].tolist()
                lengths += sizes
                totals += [len(ids)] * len(sizes)
                sums += [zlib.crc32(data[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), sizes)]
                if with_ids:
                    held.append(ids)
            columns = [piece.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                flat = np.concatenate(held).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(np.r_[0, np.cumsum(lengths)].astype(np.int32), flat))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    cuts = in_arrow(source, cut, schema)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", F.monotonically_increasing_id().alias("sequence_id"),
             F.lit(0).cast("long").alias("offset"), F.log2("length").cast("int").alias("bucket")]
    return cuts.select(*names, *["ids"] * with_ids)


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length, so that a reader can batch equal lengths."""
    packed.write.partitionBy("bucket").parquet(path)

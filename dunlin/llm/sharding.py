"""Shards of bounded size by extendible hashing, in built-in functions.

The directory is indexed by the leading bits of a document's hash.  A bucket
whose bytes exceed the limit is split on its next bit, and only such buckets
are, until every shard fits.  Because a bucket's bytes only shrink as bits are
added, a document's shard is the bucket of the fewest bits that fits.

Bytes are first summed per leading ``STEP`` bits, so a round works on at most
2**STEP rows per bucket that it splits; buckets that are still too large then
go to the next round with further bits.  The 60 bits of the key's digest are
followed by 60 bits of a digest of the row's number, so that one key, or
repeated rows of one key, can be split too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import text_of
from dunlin.session import materialize

#: Bits that one round looks at.
STEP = 10
BITS = 60
LIMIT = 1 << 20


def _bits(text: Column) -> Column:
    """The first 60 bits of an MD5 digest as text of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 2), BITS, "0")


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """``shard`` (bits), ``shard_bytes`` and ``shard_docs`` of every bucket that fits or cannot be split.

    ``sizes`` has ``bits`` and ``bytes``.
    """
    longest = 2 * BITS
    found, depth, split = None, 0, None
    while True:
        upto = min(depth + STEP, longest)
        live = sizes if split is None else sizes.join(split, F.substring("bits", 1, depth) == F.col("parent"), "left_semi")
        fine = live.groupBy(F.substring("bits", 1, upto).alias("shard")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("docs"))
        # A round adds up its finest sums for every shorter prefix.
        levels = F.sequence(F.lit(depth if depth == 0 else depth + 1), F.lit(upto))
        each = fine.select(F.explode(levels).alias("depth"), "shard", "bytes", "docs")
        sums = each.groupBy("depth", F.expr("substring(shard, 1, depth)").alias("shard")).agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
        sums = materialize(sums, "directory")
        fits = (F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1) | (F.col("depth") == longest)
        # The bucket of the fewest bits: it fits and the one above it does not.
        above = sums.where(~fits).select((F.col("depth") + 1).alias("depth"), F.col("shard").alias("parent"))
        parent = F.expr("substring(shard, 1, depth - 1)")
        top = F.col("depth") == (0 if depth == 0 else depth + 1)
        kept = sums.where(fits).withColumn("parent", parent)
        leaves = kept.where(top).drop("parent").unionByName(
            kept.where(~top).join(above, ["depth", "parent"], "left_semi").drop("parent"))
        found = leaves if found is None else found.unionByName(leaves)
        split = sums.where(~fits & (F.col("depth") == upto)).select(F.col("shard").alias("parent"))
        if upto == longest or split.isEmpty():
            return materialize(found.select("shard", F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_docs"), "shards")
        depth = upto


def assign_shards(docs: DataFrame, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, bytes, shard, depth, shard_bytes, shard_docs`` of every row.

    ``bytes`` are those of the text in UTF-8 (null: 0).  ``shard`` is the
    bucket's bits, empty for an undivided table.  No shard is larger than
    ``limit`` unless it is a single document that is.  A null id is hashed like
    an empty one.  Rows with one id share a shard until their bytes exceed the
    limit; they are then split by their numbers.  Other columns are ignored and
    an empty table gives no rows.
    """
    plain = text_of(docs, doc_id, text).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"))
    # Written once: row numbers must not change between the rounds.
    return _placed(materialize(plain, "sizes"), limit).select("doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_docs")


def _placed(sizes: DataFrame, limit: int) -> DataFrame:
    """``sizes`` (``doc_id, bytes, row``), each row with its shard."""
    sizes = sizes.withColumn("bits", F.concat(_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), _bits(F.col("row").cast("string"))))
    shards = directory(sizes, limit)
    # A directory of n shards is searched by its depths, few of which are in use.
    depths = [r[0] for r in shards.select("depth").distinct().collect()]  # at most 121
    keyed = sizes.withColumn("shard", F.explode(F.array(*[F.substring("bits", 1, d) for d in sorted(depths)]) if depths else F.array(F.lit(""))))
    return keyed.join(shards, "shard")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``docs``, all columns, with one folder per shard; every row is written once, also without an id or with a repeated one."""
    row = "shard_row"
    while row in docs.columns:
        row += "_"
    # Rows carry their own number, so that it and not the id brings them together with their shards.
    held = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    sizes = held.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.octet_length(F.col(f"`{text}`").cast("string")), F.lit(0)).cast("long").alias("bytes"),
                        F.col(row).alias("row"))
    shards = _placed(sizes, limit).select(F.col("row").alias(row), F.concat(F.lit("b"), "shard").alias("shard_bits"))
    held.join(shards, row).drop(row).repartition("shard_bits").write.partitionBy("shard_bits").parquet(path)

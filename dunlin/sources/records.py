"""Multi-line product records: text blocks to nested rows and to JSON lines.

A block holds ``Id:``, ``ASIN:``, ``title:``, ``group:``, ``salesrank:``,
``similar:``, ``categories:`` with one line per category, and ``reviews:`` with
one line per review.  One block is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Field labels of the record format (``cutomer`` is its spelling).
DISCONTINUED = "discontinued product"
REVIEW_LINE = (r"(?m)^\s*(\d{4}-\d{1,2}-\d{1,2})\s+cutomer:\s*(\S+)\s+rating:\s*(\d+)"
               r"\s+votes:\s*(\d+)\s+helpful:\s*(\d+)")
REVIEW_HEAD = r"(?m)^\s*reviews:\s*total:\s*(\d+)\s+downloaded:\s*(\d+)\s+avg rating:\s*([0-9.]+)"


def read_blocks(spark: SparkSession, path: str, separator: str = "\n\n") -> DataFrame:
    """Blocks separated by an empty line; use ``\\r\\n\\r\\n`` for such files."""
    return spark.read.text(path, lineSep=separator).where(F.rlike("value", F.lit(r"(?m)^\s*Id:")))


def _field(label: str, pattern: str) -> Column:
    return F.regexp_extract("value", rf"(?m)^\s*{label}:[ \t]*{pattern}", 1)


def parse_blocks(blocks: DataFrame) -> DataFrame:
    """Nested product rows; a discontinued product keeps only Id and ASIN."""
    similar = F.split(F.trim(F.regexp_extract("value", r"(?m)^\s*similar:\s*\d+[ \t]*(.*)$", 1)), r"\s+")
    category = F.regexp_extract_all("value", F.lit(r"(?m)^\s*(\|.*?)\s*$"), F.lit(1))
    lines = F.regexp_extract_all("value", F.lit(REVIEW_LINE), F.lit(0))

    def review(line: Column) -> Column:
        part = [F.regexp_extract(line, REVIEW_LINE, i) for i in range(1, 6)]
        return F.struct(F.struct(
            part[0].alias("date"), part[1].alias("customerId"), part[2].cast("int").alias("rating"),
            part[3].cast("int").alias("votes"), part[4].cast("int").alias("helpful")).alias("review"))

    head = [F.regexp_extract("value", REVIEW_HEAD, i) for i in (1, 2, 3)]
    columns = {
        "title": F.trim(_field("title", r"(.*)")),
        "group": F.trim(_field("group", r"(.*)")),
        "salerank": _field("salesrank", r"(-?\d+)").try_cast("int"),
        "similars": _field("similar", r"(\d+)").try_cast("int"),
        "similarLines": F.transform(F.filter(similar, lambda s: s != ""), lambda s: F.struct(s.alias("similar"))),
        "categories": _field("categories", r"(\d+)").try_cast("int"),
        "categoryLines": F.transform(category, lambda c: F.struct(c.alias("category"))),
        "ReviewMetaData": F.struct(head[0].try_cast("int").alias("total"), head[1].try_cast("int").alias("downloaded"),
                                   head[2].try_cast("double").alias("avg_rating")),
        "reviewLines": F.transform(lines, review),
    }
    kept = ~F.contains("value", F.lit(DISCONTINUED))
    return blocks.select(
        _field("Id", r"(\d+)").try_cast("long").alias("Id"), F.trim(_field("ASIN", r"(\S+)")).alias("ASIN"),
        *[F.when(kept, c).alias(name) for name, c in columns.items()])


def to_json_lines(products: DataFrame) -> DataFrame:
    """One JSON text per product in column ``value``, nulls left out.

    Quotes, backslashes and tabs in titles become blanks, and backslashes in
    category paths become slashes.
    """
    clean = products.withColumns({
        "title": F.translate("title", '"\\\t', "   "),
        "categoryLines": F.transform(
            "categoryLines", lambda c: F.struct(F.translate(c["category"], "\\", "/").alias("category")))})
    return clean.select(F.to_json(F.struct("*")).alias("value"))

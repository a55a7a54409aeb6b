"""Benchmark decontamination with built-in functions only.

A document is normalised and cut into consecutive blocks of five words.  Any
ten words in a row hold one such block whole, so looking up every block in a
broadcast hash set of all five-word grams of the benchmark misses no window and
probes a fifth of the places.  A block that hits carries its neighbours; the
windows that begin up to four words before it are spelled out and joined with
the benchmark's windows, which verifies them.  An item of m < 10 words is one
window of m words, found in the same way with blocks of (m + 1) / 2 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import ascii_lower, text_of, without_ids
from dunlin.session import materialize

WINDOW = 10
#: Fixed value: what separates words once A-Z are lower-cased.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes that the set of gram hashes, and the table of windows, may each take to be shipped whole to every executor.
SHIPPED_BYTES = 64 << 20
#: Bytes of one gram in a broadcast set: its hash, its place in the hash table and its row.
GRAM_BYTES = 40


def normal(text: Column) -> Column:
    """Words separated and closed off by one space each: ``'a b '``; empty without words."""
    spaced = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), BREAK, " ")
    trimmed = F.trim(spaced)
    return F.when(trimmed == "", "").otherwise(F.concat(trimmed, F.lit(" ")))


def count_words(normal_text: Column) -> Column:
    return (F.length(normal_text) - F.length(F.translate(normal_text, " ", ""))).cast("long")


def _windows(benchmark: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """Distinct windows: ``size``, ``window`` (words, each closed off by a space), ``items`` (ids as strings)."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("item"), normal(F.col(f"`{text}`")).alias("t")).where("t <> ''")
    words = items.select("item", F.split(F.rtrim("t"), " ").alias("w")).withColumn("size", F.least(F.size("w"), F.lit(width)))
    starts = words.select("item", "w", "size", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("s"))
    spelled = starts.select("item", "size", F.concat(F.array_join(F.slice("w", F.col("s"), F.col("size")), " "), F.lit(" ")).alias("window"))
    return spelled.groupBy("size", "window").agg(F.collect_set("item").alias("items"))


def find_windows(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, doc_id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document with what it shares with the benchmark.

    Columns: ``doc_id, n_words, spans`` (sorted array of struct ``start, size``
    of every occurrence of a window, counted in words from 0) and ``items``
    (sorted ids as strings).  Documents are scanned once; only blocks that hit
    and one short row per document are shuffled.  Rows with the same id are
    taken as one document with the words of each: their spans are merged and
    ``n_words`` is the largest.  Null texts and texts without words have no
    words; without benchmark words nothing hits.  Other columns are ignored.
    """
    windows = materialize(_windows(benchmark, item_id, item_text, width), "windows")
    sizes = [r[0] for r in windows.select("size").distinct().collect()]  # at most `width` values
    bytes_held = windows.agg(F.sum(F.octet_length("window") + F.size("items") * 24 + 64)).first()[0] or 0
    # Each side by its own size: the windows only meet what the hashes have found.
    windows = F.broadcast(windows) if bytes_held <= SHIPPED_BYTES else windows

    by_block: dict[int, list[int]] = {}
    for size in sorted(sizes):
        by_block.setdefault((size + 1) // 2, []).append(size)
    # Grams of each block length at all offsets of the windows.
    words = F.split(F.rtrim("window"), " ")
    grams = None
    for block, held in by_block.items():
        part = (windows.where(F.col("size").isin(held))
                .select(F.explode(F.transform(F.sequence(F.lit(1), F.col("size") - block + 1),
                                              lambda s: F.concat(F.array_join(F.slice(words, s, block), " "), F.lit(" ")))).alias("g")))
        grams = part if grams is None else grams.union(part)

    scan = text_of(docs, doc_id, text).select("doc_id", normal(F.col("text")).alias("t"))
    empty = "struct(-1 AS i, 0 AS k, '' AS g, '' AS prev, '' AS next)"
    lists = [F.expr(f"array({empty})")]
    for block in by_block:
        cut = F.regexp_extract_all(F.col("t"), F.lit(f"(?:[^ ]+ ){{1,{block}}}"), F.lit(0))
        scan = scan.withColumn(f"b{block}", cut)
        lists.append(F.expr(f"transform(b{block}, (g, i) -> struct(i AS i, {block} AS k, g AS g, "
                            f"coalesce(get(b{block}, i - 1), '') AS prev, coalesce(get(b{block}, i + 1), '') AS next))"))
    blocks = scan.select("doc_id", count_words(F.col("t")).alias("n_words"), F.explode(F.concat(*lists)).alias("b")).select(
        "doc_id", F.when(F.col("b.i") < 0, F.col("n_words")).alias("n_words"), "b.*")
    if grams is None:
        hits = blocks.where("i < 0")
    else:
        grams = materialize(grams.select(F.xxhash64("g").alias("h")).distinct(), "grams")
        grams = F.broadcast(grams) if grams.count() * GRAM_BYTES <= SHIPPED_BYTES else grams
        probed = blocks.withColumn("h", F.xxhash64("g")).join(grams.withColumn("known", F.lit(True)), "h", "left")
        hits = probed.where("i < 0 OR known")
    # The window of m words that begins r words before the block, for each m and r < k.
    opened = F.expr("split(rtrim(concat(prev, g, next)), ' ')")
    before = F.expr("CASE WHEN prev = '' THEN 0 ELSE k END")
    choices = [F.struct(F.lit(size).alias("size"), F.lit(block).alias("k"), F.lit(r).alias("r"))
               for block, held in by_block.items() for size in held for r in range(block)]
    none = F.struct(F.lit(0).alias("size"), F.lit(0).alias("k"), F.lit(0).alias("r"))
    tried = (hits.withColumn("w", opened).withColumn("before", before)
             .select("doc_id", "n_words", "i", "k", "w", "before",
                     F.explode(F.filter(F.array(none, *choices), lambda c: c.k == F.col("k"))).alias("c"))
             .withColumn("from", F.col("before") - F.col("c.r"))
             .where("i < 0 OR (from >= 0 AND from + c.size <= size(w))")
             .select("doc_id", "n_words", (F.col("i") * F.col("k") - F.col("c.r")).cast("long").alias("start"), F.col("c.size").alias("size"),
                     F.when(F.col("i") >= 0, F.concat(F.array_join(F.expr("slice(w, from + 1, c.size)"), " "), F.lit(" "))).alias("window")))
    found = tried.join(windows.select("window", "items"), "window", "left").where("n_words IS NOT NULL OR items IS NOT NULL")
    span = F.when(F.col("items").isNotNull(), F.struct("start", F.col("size").cast("long").alias("size")))
    return found.groupBy("doc_id").agg(
        F.coalesce(F.max("n_words"), F.lit(0)).alias("n_words"),
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def covered(spans: str = "spans") -> Column:
    """Words inside at least one span of a sorted array."""
    return F.expr(f"aggregate({spans}, struct(0L AS n, 0L AS upto), (a, s) -> struct(a.n + greatest(0L, s.start + s.size - greatest(s.start, a.upto)) AS n, "
                  f"greatest(a.upto, s.start + s.size) AS upto), a -> a.n)")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that share no window with the benchmark.

    Rows without an id are judged by their text, each for itself.
    """
    key = F.col(f"`{doc_id}`")
    known, nameless = docs.where(key.isNotNull()), docs.where(key.isNull())
    hit = find_windows(known, benchmark, width, doc_id, text).where("size(spans) > 0")
    kept = without_ids(known, hit.select(F.col("doc_id").alias("dropped_id")), doc_id)
    if nameless.isEmpty():
        return kept
    hit = find_windows(_distinct_texts(nameless, text), benchmark, width).where("size(spans) > 0")
    hit = materialize(hit.select(F.col("doc_id").alias("dropped_digest")), "dropped")
    return kept.unionByName(nameless.join(hit, _digest(text) == F.col("dropped_digest"), "left_anti"))


def cut_spans(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every word inside a window, and what follows it up to the next word, taken out of the text.

    Rows without a hit keep their text as it is.  Rows that share an id share
    their spans, so ids should be unique here.  Rows without an id are judged by
    their text, each for itself.
    """
    key = F.col(f"`{doc_id}`")
    known, nameless = docs.where(key.isNotNull()), docs.where(key.isNull())
    hit = find_windows(known, benchmark, width, doc_id, text).where("size(spans) > 0")
    cut = _without_words(known, hit, key, text)
    if nameless.isEmpty():
        return cut
    digest = _digest(text)
    hit = find_windows(_distinct_texts(nameless, text), benchmark, width).where("size(spans) > 0")
    return cut.unionByName(_without_words(nameless, hit, digest, text))


def _digest(text: str) -> Column:
    """Stands for a text where there is no id."""
    return F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256)


def _distinct_texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(_digest(text).alias("doc_id"), F.col(f"`{text}`").alias("text")).dropDuplicates(["doc_id"])


def _without_words(docs: DataFrame, hits: DataFrame, key: Column, text: str) -> DataFrame:
    """``docs`` without the words in the ``spans`` of the row of ``hits`` whose ``doc_id`` is ``key``."""
    # Struct names inside one column, so that no column of the documents clashes with them.
    found = hits.select(F.col("doc_id").alias("hit_id"), F.col("spans").alias("hit_spans"))
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key")).join(found, F.col("key") == F.col("hit_id"), "left")
    # A leading stretch without words, then each word with what follows it.
    word, rest = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    whole = F.col("row")[text]
    parts = F.regexp_extract_all(whole, F.lit(word + rest), F.lit(0))
    left = F.filter(parts, lambda p, i: ~F.exists("hit_spans", lambda s: (s.start <= i) & (i < s.start + s.size)))
    cleaned = F.when(F.col("hit_id").isNull(), whole).otherwise(F.concat(F.regexp_extract(whole, "^" + rest, 0), F.array_join(left, "")))
    return held.select(*[(cleaned if c == text else F.col("row")[c]).alias(c) for c in docs.columns])

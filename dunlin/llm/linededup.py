"""Similar lines across documents: an exact set-similarity join in built-in functions.

A line is the set of its words.  Every word has one rank: how often its hash
bucket occurs in all documents, rarest first, then its hash.  Two sets of n and
m words with a Jaccard similarity of t or more share a word among the first
n - ceil(t n) + 1 and m - ceil(t m) + 1 of that order (prefix filter); of the set that
is not larger, among the first n - ceil(2t / (1 + t) n) + 1 (its front); the places
of the first shared word, the sizes and a 128-bit parity map of each set bound
their overlap from above (positional, length and bitmap filter).  What passes
is verified on the 64-bit hashes of all words of both lines.

Equal lines are folded first, by their hash, so copies never meet each other.
Variants of one line are settled next: sets that agree in two hashes next to
fixed points of the hash range are compared with the first such set alone, one comparison
each; in crowded groups where it passes with any, all meet a few more.  Only sets
that are still open ask all earlier sets in the prefix join, so a large group of
near copies does not list its pairs.

A line goes if any earlier line (by document id and place) is similar to it,
whether or not that line stays.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import SHIPPED_IDS, release, text_of
from dunlin.session import broadcast_if_bounded, discard, materialize

SIMILARITY = 0.8
#: Every line that has a word is compared; a caller may leave shorter lines alone.
MIN_WORDS = 1
#: Buckets of the table of word frequencies are 2 to this power; its size does not depend on the data.
#: Rare words share their buckets with others, which leaves them in front of frequent ones; Spark counts so many keys in its fast map.
RANK_BITS = 16
#: White space inside a line, beside the space.
BLANKS = "\t\x0b\x0c\r"
_HASH_BITS = 64 - RANK_BITS
#: Sets that a set of a crowded signature is compared with before it asks all earlier sets.
HEADS = 8


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with its place and two hashes that stand for its text."""
    at = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return at.withColumn("k1", F.xxhash64("line")).withColumn("k2", F.hash("line"))


def _words(line: Column) -> Column:
    # Splitting at one plain character needs no pattern; few lines hold other white space or runs of it.
    # Searches for plain text cost a tenth of a pattern.
    rare = (line == "") | line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    for blank in BLANKS:
        rare |= line.contains(blank)
    return F.when(rare, F.array_remove(F.split(line, rf"[ {BLANKS}]+"), "")).otherwise(F.split(line, " "))


def _frequencies(docs: DataFrame) -> DataFrame:
    """One row, ``rank``: for every bucket what turns a hash into its place in the order by one exclusive or.

    The bucket is the highest bits of the hash. They give way to 512 log2 of one more than the bucket's words in all documents.
    Words are cut at spaces alone here: any table gives a valid order.
    """
    words = docs.select(F.explode(F.split("text", " ")).alias("w"))
    counts = words.groupBy(F.shiftrightunsigned(F.xxhash64("w"), _HASH_BITS).alias("id")).count()
    full = docs.sparkSession.range(1 << RANK_BITS).join(counts, "id", "left").select("id", F.shiftleft(
        (F.log2(F.coalesce("count", F.lit(0)) + 1) * 512).cast("long").bitwiseXOR(F.col("id")), _HASH_BITS).alias("r"))
    return full.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "r"))), lambda s: s.r).alias("rank"))


def _sets(docs: DataFrame, t: Fraction, min_words: int) -> DataFrame:
    """Distinct lines of ``min_words`` words or more, at their first place.

    Unless ``min_words`` is 1, sets of a single word are left out too.  ``n`` words, ``prefix`` (ranked, rarest first), ``map`` and ``map2`` (parity of
    the words over 128 bits: those of hashes below zero, and the others), ``sigs`` (hashes of four pairs of marks: the two lowest and
    the two highest word hashes and the two next to zero on either side; null where both are absent) and ``copies`` (equal lines).
    """
    rank = materialize(_frequencies(docs), "ranks")
    lines = _lines(docs)
    if min_words > 1:
        # Told by one pattern: a filter on the split words would split them twice. Lines without a word go below.
        lines = lines.where(F.col("line").rlike(r"^[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]" % (min_words - 1)))
    words = lines.withColumn("words", _words(F.col("line")))
    hashes = words.select("doc_id", "pos", "k1", "k2", F.expr("sort_array(array_distinct(transform(words, w -> xxhash64(w))))").alias("own"))
    # The generators keep the optimizer from computing the hashes again wherever they are used.
    hashed = hashes.select("doc_id", "pos", "k1", "k2", F.explode(F.array("own")).alias("h"))
    # Rank in the high bits, hash in the low ones: one sort of longs orders by both.
    # The table is bound to a name, which keeps it in place: as a column it would be copied into rows, as a bare subquery looked up anew for every word.
    # No element can be null that way, so Spark sorts plain longs.
    looked = f"transform(h, x -> coalesce(get(r, int(shiftrightunsigned(x, {_HASH_BITS}))), 0L) ^ x)"
    # ``z`` words have a hash below zero.
    ordered = hashed.withColumn("rank", rank.scalar()).select(
        "doc_id", "pos", "k1", "k2", "h", F.expr("int(array_position(sort_array(concat(h, array(0L))), 0L)) - 1").alias("z"),
        F.expr(f"sort_array(transform(array(rank), r -> {looked})[0])").alias("ranked"))
    marks = [F.expr(f"get(h, {at})") for at in ("0", "1", "size(h) - 2", "size(h) - 1", "z - 2", "z - 1", "z", "z + 1")]
    sigs = F.array(*[F.when(marks[2 * k].isNotNull() | marks[2 * k + 1].isNotNull(), F.xxhash64(F.lit(k), marks[2 * k], marks[2 * k + 1])) for k in range(4)])
    parity = "aggregate({}, 0L, (a, x) -> a ^ shiftleft(1L, int(x & 63)))"
    row = F.struct(
        "doc_id", "pos", F.expr("size(h)").alias("n"),
        F.expr(parity.format("slice(h, 1, z)")).alias("map"), F.expr(parity.format("slice(h, z + 1, size(h) - z)")).alias("map2"),
        sigs.alias("sigs"),
        F.expr(f"slice(ranked, 1, size(h) - int((size(h) * {t.numerator}L + {t.denominator - 1}L) div {t.denominator}) + 1)").alias("prefix"))
    # Only what stays of a line is sorted and shuffled.
    rows = ordered.select("k1", "k2", F.explode(F.array(row)).alias("s"))
    return rows.groupBy("k1", "k2").agg(F.min("s").alias("s"), F.count("*").alias("copies")).select("k1", "k2", "copies", "s.*").where(F.col("n") >= min(2, min_words))


def _near(x: str, y: str, t: Fraction) -> str:
    """Length and bitmap filter for the sizes and parity maps of two sets."""
    need = f"((({x}.n + {y}.n) * {t.numerator}L + {t.denominator + t.numerator - 1}L) div {t.denominator + t.numerator})"
    return (f"least({x}.n, {y}.n) * {t.denominator}L >= greatest({x}.n, {y}.n) * {t.numerator}L "
            f"AND bit_count({x}.map ^ {y}.map) + bit_count({x}.map2 ^ {y}.map2) <= {x}.n + {y}.n - 2 * {need}")


_SET = ("doc_id", "pos", "n", "map", "map2")


def _signed(sets: DataFrame) -> DataFrame:
    """Every set once under each of its signatures."""
    return sets.select(F.explode("sigs").alias("sig"), *_SET).where("sig IS NOT NULL")


def _firsts(sets: DataFrame) -> DataFrame:
    """``sig``, a set ``y`` of the smallest document and the number ``c`` of sets of every signature that several sets share."""
    # Column by column, which Spark keeps in a hash table; equal comparisons in equal order take all of them from one set.
    held = [F.min("doc_id").alias("doc_id"), *[F.min_by(k, "doc_id").alias(k) for k in _SET[1:]]]
    return _signed(sets).groupBy("sig").agg(*held, F.count("*").alias("c")).where("c > 1").select("sig", F.struct(*_SET).alias("y"), "c")


def _met(signed: DataFrame, heads: DataFrame, t: Fraction) -> DataFrame:
    """Pairs of a set and an earlier one from ``heads`` (``sig, y`` and others) that pass the length and the bitmap filter."""
    # The same join at every size; both sides come straight from a shuffle, so that a hot signature can be split.
    met = signed.join(heads.hint("shuffle_merge"), "sig").withColumn("x", F.struct(*_SET))
    return met.where("y.doc_id < x.doc_id OR y.doc_id = x.doc_id AND y.pos < x.pos").where(_near("x", "y", t)).select(
        *[c for c in heads.columns if c != "y"], F.col("x.doc_id").alias("xd"), F.col("x.pos").alias("xp"), F.col("y.doc_id").alias("yd"), F.col("y.pos").alias("yp"))


def _leaders(sets: DataFrame, firsts: DataFrame, t: Fraction) -> DataFrame:
    """Pairs of a set and the first one that shares two of its marks, with ``sig`` and ``c``, written once."""
    return materialize(_met(_signed(sets), firsts, t), "leaders")


def _later_leaders(sets: DataFrame, leaders: DataFrame, t: Fraction) -> DataFrame:
    """Pairs of a set and the first sets of ``HEADS`` parts of each crowded signature whose first set met one like it, written once.

    In a group whose members are only about as similar as asked for, the first one
    is often not similar enough, but one of several is. Sets that share nothing but two
    frequent words are left out: not one of them passes with the first.
    """
    warm = materialize(leaders.where(F.col("c") > HEADS).select("sig").distinct(), "warm")
    crowded = materialize(_signed(sets).join(broadcast_if_bounded(warm), "sig", "left_semi"), "crowded")
    part = F.pmod(F.xxhash64("doc_id", "pos"), F.lit(HEADS))
    heads = materialize(crowded.groupBy("sig", part.alias("part")).agg(F.min(F.struct(*_SET)).alias("y")).select("sig", "y"), "heads")
    pairs = materialize(_met(crowded, heads, t).drop("sig").distinct(), "leaders")
    for done in (warm, crowded, heads):
        discard(done)
    return pairs


def _prefix_pairs(sets: DataFrame, settled: DataFrame, t: Fraction) -> DataFrame:
    """Pairs of an open set and an earlier set that pass all filters at a shared word.

    The set that is not larger has that word in its front. Fronts meet fronts and rests, rests
    never meet each other; each is shuffled once.
    """
    flagged = sets.join(broadcast_if_bounded(settled.withColumn("done", F.lit(True))), ["doc_id", "pos"], "left")
    placed = flagged.select("doc_id", "pos", "n", "map", "map2", F.coalesce("done", F.lit(False)).alias("done"), F.posexplode("prefix").alias("i", "word"))
    # One long holds place and size, another one the place in the order and whether the set is open.
    packed = ["word", "doc_id", "map", "map2", F.expr("shiftleft(bigint(pos), 32) | bigint(n)").alias("at"), F.expr("i * 2 + int(NOT done)").alias("m")]
    whole = t.denominator + t.numerator
    in_front = F.expr(f"i <= n - (n * {2 * t.numerator}L + {whole - 1}L) div {whole}")
    fronts, rests = placed.where(in_front).select(*packed), placed.where(~in_front).select(*packed)
    n = lambda s: f"({s}.at & {(1 << 32) - 1}L)"
    pos = lambda s: f"int(shiftright({s}.at, 32))"
    left = lambda s: f"({n(s)} - shiftright({s}.m, 1))"
    before = lambda s, o: f"({s}.doc_id < {o}.doc_id OR {s}.doc_id = {o}.doc_id AND {pos(s)} < {pos(o)})"
    need = f"((({n('x')} + {n('y')}) * {t.numerator}L + {whole - 1}L) div {whole})"
    # Cheap tests first. The later set has to be open; of two sets of one size, y is the earlier one.
    near = " AND ".join([
        "x.word = y.word", f"{n('y')} <= {n('x')}", f"{n('y')} * {t.denominator}L >= {n('x')} * {t.numerator}L",
        f"bit_count(x.map ^ y.map) + bit_count(x.map2 ^ y.map2) <= {n('x')} + {n('y')} - 2 * {need}",
        f"least({left('x')}, {left('y')}) >= {need}",
        f"({before('y', 'x')} AND (x.m & 1) = 1 OR {before('x', 'y')} AND {n('y')} < {n('x')} AND (y.m & 1) = 1)"])
    later, sooner = "if(" + before("y", "x") + ", x.{0}, y.{0})", "if(" + before("y", "x") + ", y.{0}, x.{0})"
    met = [larger.alias("x").join(fronts.alias("y"), F.expr(near)).selectExpr(
        later.format("doc_id") + " AS xd", f"int(shiftright({later.format('at')}, 32)) AS xp",
        sooner.format("doc_id") + " AS yd", f"int(shiftright({sooner.format('at')}, 32)) AS yp") for larger in (fronts, rests)]
    return met[0].union(met[1]).distinct()


def _verified(docs: DataFrame, pairs: DataFrame, t: Fraction) -> DataFrame:
    """Places (``doc_id``, ``pos``) of the later lines whose words really are that similar to the earlier ones', written once; ``pairs`` is deleted."""
    ids = listed = materialize(pairs.selectExpr("inline(array(struct(xd AS ad, xp AS ap), struct(yd AS ad, yp AS ap)))").groupBy("ad").agg(F.collect_set("ap").alias("aps")), "asked")
    if (ids.agg(F.sum(F.size("aps") + 1)).first()[0] or 0) <= SHIPPED_IDS:
        ids = F.broadcast(ids)
    # Only documents that hold an asked line are cut into lines, and only the asked lines into words.
    # The lines are bound once: as a column they would be cut again for every place.
    lines = F.transform(F.array(F.split("text", "\n")), lambda held: F.transform("aps", lambda p: F.struct(p.alias("ap"), F.get(held, p).alias("line"))))
    held = docs.join(ids, F.col("doc_id") == F.col("ad")).select("ad", F.explode(F.get(lines, F.lit(0))).alias("l")).where("l.line IS NOT NULL")
    asked = held.select("ad", "l.ap", _words(F.col("l.line")).alias("words"))
    words = asked.select("ad", "ap", F.expr("array_distinct(transform(words, w -> xxhash64(w)))").alias("w"))
    words = materialize(words, "asked-words")
    x = words.toDF("xd", "xp", "xw")
    y = words.toDF("yd", "yp", "yw")
    both = pairs.join(x, ["xd", "xp"]).join(y, ["yd", "yp"]).withColumn("common", F.size(F.array_intersect("xw", "yw")))
    similar = F.col("common") * t.denominator >= (F.size("xw") + F.size("yw") - F.col("common")) * t.numerator
    found = materialize(both.where(similar).select(F.col("xd").alias("doc_id"), F.col("xp").alias("pos")).distinct(), "settled")
    for done in (listed, words, pairs):
        discard(done)
    release(docs.sparkSession)
    return found


def _settled(docs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """Places of the sets that are similar to one of their leaders."""
    firsts = materialize(_firsts(sets), "firsts")
    release(docs.sparkSession)
    leaders = _leaders(sets, firsts, t)
    discard(firsts)
    again = _later_leaders(sets, leaders, t)
    pairs = materialize(leaders.drop("sig", "c").union(again).distinct(), "pairs")
    for done in (leaders, again):
        discard(done)
    return _verified(docs, pairs, t)


def removed_lines(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``pos`` and hash ``k1`` of every line that goes.

    Lines are cut at newlines and counted from 0; words are what stands between
    white space, letter case included.  Lines of fewer than ``min_words`` words
    are never compared and stay; unless ``min_words`` is 1, so do lines with a
    single distinct word.  Null and empty texts have no lines to compare.
    Rows without an id are left alone.  Rows that share an id are one document:
    equal lines at the same place of both are one line.
    """
    t = Fraction(str(similarity))
    spark = docs.sparkSession
    plain = text_of(docs, doc_id, text).where("doc_id IS NOT NULL AND text IS NOT NULL")
    sets = materialize(_sets(plain, t, min_words), "sets")
    release(spark)
    settled = _settled(plain, sets, t)
    later = materialize(_prefix_pairs(sets, settled, t), "pairs")
    release(spark)
    gone = settled.union(_verified(plain, later, t)).withColumn("similar", F.lit(True))
    # A line that neither has copies nor is similar stays, so it need not be looked for.
    first = sets.select("k1", "k2", "copies", "doc_id", "pos").join(gone, ["doc_id", "pos"], "left").where("copies > 1 OR similar").select(
        "k1", "k2", F.col("doc_id").alias("first_id"), F.col("pos").alias("first_pos"), "similar")
    met = _lines(plain).select("k1", "k2", "doc_id", "pos").join(first, ["k1", "k2"])
    return met.where("similar OR (doc_id, pos) <> (first_id, first_pos)").select("doc_id", "pos", "k1")


def line_report(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``n_lines``, ``n_removed`` and ``removed`` (places, comma-joined).

    Null texts have no lines.  Rows that share an id are reported together.
    """
    gone = removed_lines(docs, similarity, min_words, doc_id, text).select("doc_id", F.lit(None).cast("int").alias("n"), "pos")
    # Newlines are counted by what is left without them; a null text has no lines.
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    counts = text_of(docs, doc_id, text).select("doc_id", F.coalesce(n_lines, F.lit(0)).alias("n"), F.lit(None).cast("int").alias("pos"))
    return counts.union(gone).groupBy("doc_id").agg(
        F.max("n").cast("long").alias("n_lines"), F.array_sort(F.collect_set("pos")).alias("at")).select(
        "doc_id", "n_lines", F.size("at").cast("long").alias("n_removed"), F.array_join("at", ",").alias("removed"))


def drop_similar_lines(docs: DataFrame, similarity: float = SIMILARITY, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text",
                       n_chars: str = "n_chars") -> DataFrame:
    """``docs``, all columns, without the lines that go; ``n_chars`` is counted anew where it exists.

    A document that loses lines and has no word left is dropped; one that had
    none to begin with stays.
    """
    gone = materialize(removed_lines(docs, similarity, min_words, doc_id, text).groupBy("doc_id").agg(
        F.collect_set(F.struct("pos", "k1")).alias("gone_lines")).withColumnRenamed("doc_id", "gone_id"), "gone")
    held = docs.join(gone, F.col(f"`{doc_id}`") == F.col("gone_id"), "left")
    left = F.array_join(F.filter(F.split(F.col(f"`{text}`"), "\n"), lambda line, i: ~F.exists(
        "gone_lines", lambda g: (g.pos == i) & (g.k1 == F.xxhash64(line)))), "\n")
    # Only documents that lose a line are rebuilt.
    changed = F.col("gone_id").isNotNull()
    held = held.withColumn(text, F.when(changed, left).otherwise(F.col(f"`{text}`"))).where(~changed | F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"))
    if n_chars in docs.columns:
        held = held.withColumn(n_chars, F.when(changed, F.length(F.col(f"`{text}`")).cast(docs.schema[n_chars].dataType)).otherwise(F.col(f"`{n_chars}`")))
    return held.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Spelling variants: words that differ by one letter, found with bit-sliced position indexes.

Words are dealt so that near words meet: in the class of t letters are the words
of t and of t + 1 letters, and a pair of the class has one edit, before or behind
the middle of t. Words that agree outside one half (equal beginnings of the same
length, equal ends) form a group; a group of more than :data:`GROUP` words is cut
again by the halves of its open region, down to a region of one letter, where
the alphabet bounds it. A pair's edit is taken at its first differing letter, so
exactly one group holds it and no link is lost or counted twice.

In a group every (position, letter) has a bitset over the group's words (a Python
integer). A word of t letters is held against all of them at once: ``zero`` are
the words equal so far; a word leaves it at its first other letter, into ``changed``
(same length, the rest must agree in place) or into ``longer`` (one letter more,
the rest must agree one place further). Bits are in the order of the words' counts,
so the lowest bit set is the commonest near word. Groups hand on one row per
word with a near one, not the pairs.

Links are followed by pointer doubling over written tables; a form is at least
``ratio`` times as common as its word, so chains are short.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import pieces, text_of, whole_groups
from dunlin.session import broadcast_if_bounded, discard, materialize, ship_code

LETTERS = "A-Za-zÀ-ÿ"
#: Words up to which a group is searched; larger groups are cut further.
GROUP = 4096
#: Distinct words that a task counts before it hands its counts on.
HELD = 300_000
#: Rows of small groups that share one step.
ROWS = 8192


def without_letter(run: str, doc: bytes | None, noise: int) -> str:
    """``run`` without one letter if ``noise`` divides the checksum of document and run; as it is if the id is null."""
    if doc is None:
        return run
    h = zlib.crc32(run.encode(), zlib.crc32(doc + b":"))
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, min_letters: int = 6, min_count: int = 5, noise: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word`` and ``n`` of all runs of letters with A-Z in lower case, at least ``min_letters`` long and ``min_count`` times in all documents.

    With ``noise`` a letter is taken out of some runs first (:func:`without_letter`), for measuring on known errors.
    A null text has no words; counts are combined in the task before they are shuffled.
    """
    source = text_of(docs, doc_id, text).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    ship_code(docs.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]{{{min_letters},}}").findall
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=schema)

        for batch in batches:
            for piece in pieces(batch, "text"):
                for doc, value in zip(piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()):
                    # bytes.lower changes A-Z alone.
                    found = runs((value or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                    if noise is None:
                        total.update(found)
                        continue
                    doc = None if doc is None else doc.encode()
                    for run, n in Counter(found).items():
                        word = without_letter(run, doc, noise)
                        if len(word) >= min_letters:
                            total[word] += n
                if len(total) > HELD:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _regions(words: DataFrame) -> DataFrame:
    """Each word in both halves of both classes it belongs to."""
    size = F.length("word")
    classes = words.withColumn("t", F.explode(F.array(size, size - 1))).where("t >= 0")
    half = F.floor(F.col("t") / 2).cast("int")
    halves = F.array(F.struct(F.lit(0).alias("low"), half.alias("high")), F.struct(half.alias("low"), F.col("t").alias("high")))
    regions = classes.withColumn("r", F.explode(F.array_distinct(halves))).select("word", "n", "t", "r.low", "r.high")
    return regions.where("high > low OR t = 0")


def _keyed(regions: DataFrame) -> DataFrame:
    """The letters outside the open region; the region's places and the class make them unambiguous."""
    return regions.withColumn("key", F.concat(F.expr("left(word, low)"), F.expr("right(word, t - high)")))


PLACE = ["t", "low", "high", "key"]


def neighbour_groups(words: DataFrame, limit: int = GROUP) -> DataFrame:
    """Rows of (``word``, ``n``) with the group they belong to; groups above ``limit`` are cut while their region has two letters or more."""
    rows = _keyed(_regions(words))
    done = None
    while True:
        hot = materialize(rows.where("high - low > 1").groupBy(*PLACE).count().where(F.col("count") > limit).select(*PLACE), "large-groups")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        hot = broadcast_if_bounded(hot)
        rest = rows.join(hot, PLACE, "left_anti").select(rows.columns)
        done = rest if done is None else done.unionByName(rest)
        middle = F.expr("low + (high - low) div 2").cast("int")
        parts = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
        cut = rows.join(hot, PLACE, "left_semi").withColumn("r", F.explode(parts)).select("word", "n", "t", "r.low", "r.high")
        rows = materialize(_keyed(cut), "cut-groups")


def lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def near_in_group(words: list[str], t: int, low: int, high: int) -> dict[int, list[int]]:
    """For words in order of preference: number of near words and place of the first, by place of the word.

    Only pairs whose first differing letter is in the region count (at the end of the word too if the region ends there).
    """
    index: list[dict[str, int]] = [{} for _ in range(low, high + 1)]
    short = long = 0
    for place, word in enumerate(words):
        bit = 1 << place
        size = len(word)
        if size == t:
            short |= bit
        else:
            long |= bit
        for letters, letter in zip(index, word[low: min(high + 1, size)]):
            letters[letter] = letters.get(letter, 0) | bit
    found: dict[int, list[int]] = {}
    if not short:
        return found
    everyone = short | long
    for place, word in enumerate(words):
        if len(word) != t:
            continue
        zero, changed, longer = everyone, 0, 0
        for at in range(low, high):
            letter = word[at]
            here = index[at - low].get(letter, 0)
            leaving = zero & ~here
            changed = changed & here | leaving & short
            longer = (longer | leaving & long) & index[at - low + 1].get(letter, 0)
            zero &= here
        if high == t:
            longer |= zero & long
        near = changed | longer
        if near:
            own = found.setdefault(place, [0, len(words)])
            own[0] += near.bit_count()
            own[1] = min(own[1], lowest(near))
        while longer:
            other = lowest(longer)
            longer &= longer - 1
            own = found.setdefault(other, [0, len(words)])
            own[0] += 1
            own[1] = min(own[1], place)
    return found


def near_words(words: DataFrame, limit: int = GROUP) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (n and word of the commonest near word, ties by code points) of every word with a near word.

    ``words`` has each ``word`` once, with its count ``n``.
    """
    groups = neighbour_groups(words, limit)
    ship_code(words.sparkSession)
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("n", pa.int64()), ("near", pa.string())])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, PLACE, ROWS):
            rows = zip(*(table.column(c).to_pylist() for c in [*PLACE, "n", "word"]))
            out: list[tuple] = []

            def close(place: tuple | None, held: list[tuple[int, str]]) -> None:
                if len(held) > 1:
                    held.sort(key=lambda r: (-r[0], r[1]))
                    for at, (n_near, best) in near_in_group([w for _, w in held], *place[:3]).items():
                        out.append((held[at][1], n_near, *held[best]))

            place, held = None, []
            for *key, n, word in rows:
                if key != place:
                    close(place, held)
                    place, held = key, []
                held.append((n, word))
            close(place, held)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    found = groups.repartition(*PLACE).sortWithinPartitions(*PLACE).mapInArrow(search, "word string, n_near long, n long, near string")
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("near").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.struct((-F.col("best.m")).alias("n"), F.col("best.word").alias("word")).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root`` of links ``word`` to ``form`` without cycles, one per word: each round doubles the steps taken."""
    reached = materialize(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(reached.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(reached)
        reached = stepped.select("word", "root")
        if not stepped.where("moved").limit(1).count():
            return reached


def variant_groups(words: DataFrame, ratio: int = 5, limit: int = GROUP) -> DataFrame:
    """Every word with its count, number of near words, form, the form's count, and root.

    Two words are near if they differ by one inserted, deleted or replaced code point. The form is the
    commonest near word (ties: the smallest in code-point order) if it is at least ``ratio`` times as
    common; the root is reached by following forms to the last. ``ratio`` must be above 1, or forms could form cycles.
    ``words`` must have each word once; columns beside ``word`` and ``n`` are ignored, an empty table gives an empty one.
    """
    if ratio <= 1:
        raise ValueError("a form must be more common than its word")
    words = materialize(words.select("word", "n"), "words")
    near = materialize(near_words(words, limit), "near")
    judged = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("best.n") >= ratio * F.col("n"), F.col("best")).alias("form")), "forms")
    links = judged.where("form IS NOT NULL").select("word", F.col("form.word").alias("form"))
    return judged.join(roots(links), "word", "left").select(
        "word", F.col("form.word").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("form.n").alias("form_n"))

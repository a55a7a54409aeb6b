"""Removal of passages that occur twice, with prefix-partitioned suffix trees.

A window is ``window`` consecutive words of one document; words of windows that
start at two places or more are removed.

* Suffixes are sorted into groups by prefixes that start at anchors: the anchor of
  a window is its gram of :data:`GRAM` words with the least hash, which depends on
  the window's words alone, so equal windows are in the same group. Consecutive
  windows with the same anchor hash form a stretch; its words are shipped once.
* An anchor hash that occurs once in all documents cannot lie in a repeated window:
  only stretches of repeated anchors are shipped.
* A group with up to :data:`GROUP` anchors fits into memory. Its suffixes are
  sorted by prefix doubling down to ``window`` words: a rank that several suffixes
  share is an internal node of that depth, and all windows below it are repeated.
  The union of their words is that of all maximal repeats of ``window`` words or more.
* Larger groups take longer prefixes. Equal stretches are first counted as one,
  combined before the shuffle: a stretch with a copy is repeated as a whole. Windows
  of the different ones go on under prefixes of all their ``window`` words (128 bits
  of hash). Such a prefix is itself the deep node, so counting its suffixes is enough
  however many there are.

Words are compared as bytes in the trees; the long prefixes by 128-bit hashes.
Documents are numbered in a written table, so ids may be null or repeat. A null
text has no words; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import in_arrow, mixed, pieces, release, sliding, text_of, whole_groups
from dunlin.session import discard, materialize, ship_code

#: Words of an anchor; must be shorter than the window.
GRAM = 12
#: Anchors up to which a group's suffixes are sorted together.
GROUP = 2000
#: Windows of one stretch; longer ones are cut.
STRETCH = 256
#: Stretches of small groups that are sorted together.
ROWS = 4096
#: Distinct words whose hashes a task holds.
HELD = 200_000
LAST = np.iinfo(np.uint64).max


class _Hashes(dict):
    """Hash of each word; emptied when it has grown large."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HELD:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def gram_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all grams of ``length`` words."""
    level, power = words, 1
    while 2 * power <= length:
        level = mixed(level[:-power], level[power:])
        power *= 2
    rest = length - power
    return mixed(level[: len(level) - rest], level[rest:]) if rest else level


def stretches(words: np.ndarray, sizes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors and stretches of documents joined in ``words``.

    Returns the places and hashes of all anchors, and the first windows and anchor hashes of all stretches;
    a stretch ends before the next one of its document begins.
    """
    width = window - GRAM + 1
    gram = gram_hashes(words, GRAM) if len(words) >= window else np.empty(0, np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    valid = np.arange(len(words)) + window <= ends
    if not valid.any():
        none = np.empty(0, np.int64)
        return none, gram[:0], none, gram[:0]
    least = sliding(gram, width, np.minimum, LAST)
    least = np.where(valid[: len(least)], least, 0)
    # An anchor is the least gram of any window that holds it; windows across documents do not count.
    most = sliding(np.concatenate([np.zeros(width - 1, np.uint64), least]), width, np.maximum, 0)[: len(gram)]
    anchor = np.flatnonzero((gram == most) & (gram != 0))
    starts = np.flatnonzero(valid)
    value = least[starts]
    new = np.r_[True, (value[1:] != value[:-1]) | (np.diff(starts) > 1) | (ends[starts[1:]] != ends[starts[:-1]])]
    head = np.flatnonzero(new)
    lengths = np.diff(np.r_[head, len(starts)])
    parts = -(-lengths // STRETCH)
    first = np.repeat(head, parts) + STRETCH * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return anchor, gram[anchor], starts[first], value[first]


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(values))


def with_anchors(docs: DataFrame, window: int) -> DataFrame:
    """``row``, ``doc_id``, ``text``, hashes of all ``anchors``, and ``firsts`` and ``prefixes`` of the stretches of each document, written once."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")

    def mark(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(1)
        for piece in pieces(batch, "text"):
            words = [words_of(t) for t in piece.column("text").to_pylist()]
            sizes = np.array(list(map(len, words)), np.int64)
            begin = np.cumsum(sizes) - sizes
            places, anchors, firsts, prefixes = stretches(hashes.of([w for t in words for w in t]), sizes, window)
            # Documents without words begin where the next one does: the last of equal beginnings holds the words.
            in_doc = lambda at: np.searchsorted(begin, at, "right") - 1
            per_doc = lambda at: np.bincount(in_doc(at), minlength=len(sizes))
            yield pa.RecordBatch.from_arrays([
                *(piece.column(c) for c in ("row", "doc_id", "text")), lists(anchors.view(np.int64), per_doc(places)),
                lists((firsts - begin[in_doc(firsts)]).astype(np.int32), per_doc(firsts)), lists(prefixes.view(np.int64), per_doc(firsts))],
                ["row", "doc_id", "text", "anchors", "firsts", "prefixes"])

    kind = dict(docs.dtypes)["doc_id"]
    return materialize(in_arrow(numbered, mark, f"row long, doc_id {kind}, text string, anchors array<long>, firsts array<int>, prefixes array<long>"), "anchors")


def shipped_stretches(marked: DataFrame, window: int, limit: int) -> DataFrame:
    """The stretches of repeated anchors with their ``words``; ``large`` tells those of groups above ``limit``.

    All lists here grow with the corpus, so none is broadcast.
    """
    counts = marked.select(F.explode("anchors").alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1").select(
        "prefix", (F.col("n") > limit).alias("large"))
    places = marked.select("row", F.posexplode("prefixes").alias("k", "prefix")).join(counts, "prefix")
    wanted = materialize(places.groupBy("row").agg(F.collect_list(F.struct("k", "large")).alias("wanted")), "wanted")
    release(marked.sparkSession)
    source = marked.select("row", "text", "firsts", "prefixes").join(wanted, "row")
    schema = pa.schema([("prefix", pa.int64()), ("large", pa.bool_()), ("row", pa.int64()), ("first", pa.int32()), ("words", pa.binary())])

    def ship(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batch, "text"):
            out: list[tuple] = []
            for row, text, firsts, prefixes, wanted in zip(*(piece.column(c).to_pylist() for c in ("row", "text", "firsts", "prefixes", "wanted"))):
                words = words_of(text)
                firsts.append(len(words) - window + 1)
                for w in wanted:
                    k = w["k"]
                    out.append((prefixes[k], w["large"], row, firsts[k], b" ".join(words[firsts[k]: firsts[k + 1] + window - 1])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    shipped = materialize(in_arrow(source, ship, "prefix long, large boolean, row long, first int, words binary"), "stretches")
    discard(wanted)
    release(marked.sparkSession)
    return shipped


def windows_of(stretches: DataFrame, window: int) -> DataFrame:
    """One row per window of each stretch: its prefix of ``window`` words as two longs (``k``, ``more``), beside ``row``, ``first`` and ``copies``."""
    schema = pa.schema([("k", pa.int64()), ("more", pa.int64()), ("row", pa.int64()), ("first", pa.int32()), ("copies", pa.int64())])

    def hashed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(2), _Hashes(3)
        for piece in pieces(batch, "words"):
            words = [t.split() for t in piece.column("words").to_pylist()]
            if not words:
                continue
            sizes = np.array([len(w) - window + 1 for w in words])
            offset = np.concatenate([np.arange(n) for n in sizes.tolist()])
            long = [np.concatenate([gram_hashes(h.of(w), window) for w in words]).view(np.int64) for h in hashes]
            row, first, copies = (np.repeat(np.array(piece.column(c)), sizes) for c in ("row", "first", "copies"))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((*long, row, first + offset, copies), schema)], schema=schema)

    return in_arrow(stretches.select("words", "row", "first", "copies"), hashed, "k long, more long, row long, first int, copies long")


def suffix_ranks(words: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix that has ``depth`` words by those words; equal ranks are one node."""
    if len(words) < depth:
        return words[:0]
    rank, power, parts = words, 1, []
    while True:
        if depth & power:
            parts.append((power, rank))
        power *= 2
        if power > depth:
            break
        rank = pair_ranks(rank[: len(rank) - power // 2], rank[power // 2:])
    done, (power, out) = 0, parts.pop()
    while parts:
        done += power
        power, rank = parts.pop()
        n = len(words) - done - power + 1
        out = pair_ranks(out[:n], rank[done: done + n])
    return out


def pair_ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not len(a):
        return a
    return np.unique(a.astype(np.int64) * np.int64(b.max() + 1) + b, return_inverse=True)[1]


def repeated_windows(segments: list[bytes], window: int) -> list[np.ndarray]:
    """For each segment of words the places of windows whose words also start at another place of any segment."""
    number: dict[bytes, int] = {}
    words = [[number.setdefault(w, len(number)) for w in s.split()] for s in segments]
    begin = np.cumsum([0, *map(len, words)])
    flat = np.fromiter((w for t in words for w in t), np.int64, int(begin[-1]))
    rank = suffix_ranks(flat, window)
    inside = np.zeros(len(rank), bool)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        inside[a: max(a, b - window + 1)] = True
    leaves = np.bincount(rank[inside], minlength=int(rank.max(initial=0)) + 1)
    deep = inside & (leaves[rank] > 1)
    return [np.flatnonzero(deep[a: max(a, b - window + 1)]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


def repeated(stretches: DataFrame, window: int) -> DataFrame:
    """``row`` and all its repeated ``windows``, as ranges of their ``first`` words, written once; ``stretches`` and all made on the way is deleted."""
    schema = pa.schema([("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["prefix"], ROWS):
            rows, firsts = np.array(table.column("row")), np.array(table.column("first"))
            out: list[tuple[int, int, int]] = []
            for row, first, places in zip(rows.tolist(), firsts.tolist(), repeated_windows(table.column("words").to_pylist(), window)):
                if len(places):
                    cut = np.flatnonzero(np.diff(places) > 1)
                    for a, b in zip(places[np.r_[0, cut + 1]].tolist(), places[np.r_[cut, len(places) - 1]].tolist()):
                        out.append((row, first + a, first + b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    small = stretches.where("NOT large").select("prefix", "row", "first", "words")
    in_trees = small.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(search, "row long, first int, last int")
    copy = [F.xxhash64("words").alias("a"), F.xxhash64(F.lit("more"), "words").alias("b")]
    large = stretches.where("large").select(*copy, "row", "first", "words")
    distinct = materialize(large.groupBy("a", "b").agg(
        F.first("words").alias("words"), F.count("*").alias("copies"), F.min("row").alias("row"), F.min("first").alias("first")), "distinct")
    # Written on its own, so that adaptive execution can split a stretch with very many copies.
    copied = materialize(large.select("a", "b", "row", "first", (F.size(F.split(F.col("words").cast("string"), " ")) - window).alias("more")).join(
        distinct.where("copies > 1").select("a", "b"), ["a", "b"], "left_semi").select("row", "first", (F.col("first") + F.col("more")).cast("int").alias("last")), "copied")
    # What has no copy has one place, which its row here names.
    windows = materialize(windows_of(distinct, window), "long-prefixes")
    twice = materialize(windows.groupBy("k", "more").agg(F.sum("copies").alias("n")).where("n > 1").select("k", "more"), "twice")
    # On its own too: very many different stretches may share one window.
    single = materialize(windows.where("copies = 1").join(twice, ["k", "more"], "left_semi").select("row", "first", F.col("first").alias("last")), "single")
    for done in (distinct, windows, twice):
        discard(done)
    release(stretches.sparkSession)
    ranges = in_trees.unionByName(copied).unionByName(single)
    found = materialize(ranges.groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("windows")), "windows")
    for done in (copied, single, stretches):
        discard(done)
    release(stretches.sparkSession)
    return found


def spans_of(windows: list[dict] | None, window: int) -> list[tuple[int, int]]:
    """Starts and ends in words of what the windows cover, in order and apart from each other."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted((w["first"], w["last"]) for w in windows or ()):
        if spans and first <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(spans[-1][1], last + window)
        else:
            spans.append((first, last + window))
    return spans


def drop_repeated_passages(docs: DataFrame, window: int = 35, limit: int = GROUP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, the removed ``spans`` (start and length in words) and the ``kept`` text of every row.

    Words (anything between spaces, tabs and line ends) in windows of ``window`` words that start at two places of all
    documents or more go, the first place included; the others are joined by one space. Windows are judged on the texts as given.
    """
    if window <= GRAM:
        raise ValueError(f"a window must be longer than an anchor of {GRAM} words")
    marked = with_anchors(text_of(docs, doc_id, text), window)
    found = repeated(shipped_stretches(marked, window, limit), window)
    source = marked.select("row", "doc_id", "text").join(found, "row", "left")

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batch, "text"):
            sizes, removed, kept = [], [], []
            for text, windows in zip(piece.column("text").to_pylist(), piece.column("windows").to_pylist()):
                words = words_of(text)
                spans = spans_of(windows, window)
                sizes.append(len(words))
                removed.append([{"start": a, "length": b - a} for a, b in spans])
                edges = [0, *(x for span in spans for x in span), len(words)]
                kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]))
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "spans", "kept"])

    kind = dict(marked.dtypes)["doc_id"]
    return in_arrow(source, cut, f"doc_id {kind}, n_words long, spans array<struct<start:long,length:long>>, kept string")

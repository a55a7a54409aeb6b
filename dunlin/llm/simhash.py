"""Near duplicates by 64-bit fingerprints, searched with BK-trees.

Two fingerprints within ``radius`` bits agree in at least one of ``radius + 1``
blocks of bits, so each distinct fingerprint goes to one shard per block.  A
shard that holds many fingerprints is cut into parts by hash and its members
are dealt to every pair of parts, so no task holds a hot shard whole.  In each
part a BK-tree (children keyed by the Hamming distance to their parent) is
built and walked for all queries at once, following only edges within the
radius.  A part hands on one link per fingerprint that spans what it found, not
all pairs; the links of all parts together have the same components.

A few differing bits find hardly any pair below a Jaccard similarity of 0.95, and
a radius wide enough for 0.8 leaves no blocks to shard by.  Dropping near copies
(:func:`keep_one_of_each`) therefore takes its candidates from bands of minimal
shingle hashes and links what exact Jaccard similarity of the shingles confirms.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import SHIPPED_IDS, in_arrow, pieces, text_of, without_ids
from dunlin.session import discard, materialize, ship_code

SEED = 42
#: Fingerprints that one tree holds.
TREE = 2048
#: Pairs of query and node that are compared in one step.
STEP = 1 << 20
#: Fingerprints of small shards that share one call.
GROUP = 4096
SIMILARITY = 0.8
#: Bands of so many minimal hashes each: two sets of similarity s share a band with a chance of 1 - (1 - s ** HASHES) ** BANDS.
BANDS, HASHES = 24, 5
#: Members of a band's bucket up to which all of its pairs are compared, and members that those of a larger one meet before the exact search.
PAIRED, MET = 8, 8


def shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of all shingles; fewer words than one holds are a shingle of their own."""
    whole = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(whole, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(whole[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())]
    return np.array(hashes, np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Majority of the bits of the hashes of all shingles; zero without words."""
    if not words:
        return 0
    array = shingle_hashes(words, shingle)
    bits = np.zeros(64, np.int64)
    for at in range(0, len(array), 1 << 16):
        part = np.ascontiguousarray(array[at: at + (1 << 16)]).view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(array), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fingerprint`` (a signed long of the same bits) of every row."""
    source = text_of(docs, doc_id, text)

    def mark(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batch, "text"):
            values = [fingerprint(words_of(t), shingle) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(np.array(values, np.uint64).view(np.int64))], ["doc_id", "fingerprint"])

    return in_arrow(source, mark, f"doc_id {dict(source.dtypes)['doc_id']}, fingerprint long")


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances; signed longs are counted by their bits, not by their absolute values."""
    return np.bitwise_count((a ^ b).view(np.uint64)).astype(np.int64)


class BKForest:
    """BK-trees over distinct 64-bit values, one per shard, built and searched level by level."""

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        by = np.lexsort((values, shard))
        self.values, shard = values[by], shard[by]
        count = len(values)
        head = np.r_[True, shard[1:] != shard[:-1]] if count else np.empty(0, bool)
        #: The first value of each shard is its root.
        self.shards, self.roots = shard[head], np.nonzero(head)[0]
        self.largest = int(np.diff(np.r_[self.roots, count]).max()) if count else 0
        edge, parent = np.zeros(count, np.int64), np.full(count, -1, np.int64)
        left, under = np.nonzero(~head)[0], self.roots[np.cumsum(head) - 1][~head]
        # Of all values that come down to a node, the first at each distance
        # becomes its child and the others go on below that child.
        while len(left):
            distance = differing(self.values[left], self.values[under])
            by = np.lexsort((left, distance, under))
            left, under, distance = left[by], under[by], distance[by]
            first = np.r_[True, (under[1:] != under[:-1]) | (distance[1:] != distance[:-1])]
            child = left[first]
            edge[child], parent[child] = distance[first], under[first]
            left, under = left[~first], child[np.cumsum(first) - 1][~first]
        child = np.nonzero(parent >= 0)[0]
        self.children = child[np.argsort(parent[child], kind="stable")]
        self.edge = edge[self.children]
        self.offsets = np.r_[0, np.cumsum(np.bincount(parent[child], minlength=count))].astype(np.int64)

    def within(self, queries: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries' places and values of their shards within ``radius``, in steps of bounded size."""
        if not len(self.values):
            return
        tree = np.minimum(np.searchsorted(self.shards, shard), len(self.shards) - 1)
        known = np.nonzero(self.shards[tree] == shard)[0]
        width = max(1, STEP // self.largest)
        for at in range(0, len(known), width):
            query = known[at: at + width]
            node = self.roots[tree[query]]
            while len(node):
                distance = differing(queries[query], self.values[node])
                hit = distance <= radius
                yield query[hit], self.values[node[hit]]
                number = self.offsets[node + 1] - self.offsets[node]
                spread = np.repeat(np.arange(len(node)), number)
                edge = self.offsets[node][spread] + np.arange(len(spread)) - np.repeat(np.cumsum(number) - number, number)
                near = np.abs(self.edge[edge] - distance[spread]) <= radius
                query, node = query[spread[near]], self.children[edge[near]]


def spanning_links(values: np.ndarray, shard: np.ndarray, part: np.ndarray, low: int, high: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what the parts ``low`` and ``high`` of some shards have within ``radius``.

    Each value is linked to the smallest of its local component, so the number
    of links is that of the values at most.
    """
    own = part == low
    asks = part == high
    forest = BKForest(values[own], shard[own])
    nodes = np.unique(values)
    root = np.arange(len(nodes))

    def find(x: np.ndarray) -> np.ndarray:
        while True:
            up = root[x]
            above = root[up]
            if np.array_equal(up, above):
                return up
            root[x] = above

    places = np.searchsorted(nodes, values[asks])
    for query, value in forest.within(values[asks], shard[asks], radius):
        a, b = places[query], np.searchsorted(nodes, value)
        while True:
            a, b = find(a), find(b)
            differ = a != b
            if not differ.any():
                break
            a, b = a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
    top = find(np.arange(len(nodes)))
    moved = np.nonzero(top != np.arange(len(nodes)))[0]
    return nodes[moved], nodes[top[moved]]


def near_links(prints: DataFrame, radius: int = 4, tree: int = TREE, group: int = GROUP) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints that span the components of the radius graph."""
    ship_code(prints.sparkSession)
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    shard = F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fingerprint", lo).bitwiseAND((1 << (hi - lo)) - 1).alias("bits"))
                      for k, (lo, hi) in enumerate(zip(edges, edges[1:]))])
    dealt = prints.select("fingerprint", F.explode(shard).alias("s")).select("fingerprint", "s.block", "s.bits")
    # Only shards of two or more matter; their size says into how many parts they are cut.
    sizes = dealt.groupBy("block", "bits").count().where("count > 1")
    sized = dealt.join(sizes, ["block", "bits"]).withColumn("parts", F.ceil(F.col("count") / tree).cast("int"))
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int")
    pairs = sized.withColumn("part", part).select(
        "block", "bits", "fingerprint", "part",
        F.explode(F.expr("transform(sequence(0, parts - 1), o -> struct(least(part, o) AS low, greatest(part, o) AS high))")).alias("p"))
    # Small shards share a Python call: about ``group`` fingerprints each.
    calls = max(1, prints.count() // group)

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = spanning_links(frame["fingerprint"].to_numpy(), frame["bits"].to_numpy(), frame["part"].to_numpy(),
                              int(frame["low"].iloc[0]), int(frame["high"].iloc[0]), radius)
        return pd.DataFrame({"a": a, "b": b})

    return (pairs.select("block", "bits", "fingerprint", "part", "p.low", "p.high", F.pmod(F.xxhash64("bits"), F.lit(calls)).alias("call"))
            .groupBy("block", "call", "low", "high").applyInPandas(search, "a long, b long").distinct())


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """Each node's smallest reachable node (``node``, ``root``), by alternating star contraction.

    Nodes are ordered by value.  Each round is written to the shared folder, so
    lineage stays short and lost executors cost one round.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), label)
    while True:
        # Large star: every larger neighbour is tied to the smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: every node and its smaller neighbours are tied to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        after = materialize(small, label)
        changed = not after.exceptAll(edges).isEmpty() or not edges.exceptAll(after).isEmpty()
        discard(edges)
        edges = after
        if not changed:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, tree: int = TREE,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits, the document itself included.  Texts without a
    word and null texts have fingerprint zero and are linked like any other.
    Rows without an id keep their fingerprint and take the smallest id of their
    component, or null if it has none.  Repeated rows are in one component.
    Other columns of ``docs`` are ignored.  An empty table gives no rows.
    """
    prints = materialize(fingerprints(docs, shingle, doc_id, text), "prints")
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(near_links(distinct.select("fingerprint"), radius, tree))
    labelled = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = labelled.join(lowest, "root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Distinct hashes of the shingles of ``text``, sorted."""
    return np.unique(shingle_hashes(words_of(text), shingle))


def set_digest(hashes: np.ndarray) -> int:
    """A signed long that stands for the whole set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def band_keys(hashes: np.ndarray, bands: int = BANDS, rows: int = HASHES) -> np.ndarray:
    """One long per band of minimal hashes under odd multipliers, which permute the 64-bit values."""
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    # A low bit of a product depends on lower bits alone, so high bits are brought down first.
    mixed = hashes ^ (hashes >> np.uint64(32))
    for at in range(0, len(mixed), 1 << 12):
        least = np.minimum(least, (factors[:, None] * mixed[None, at: at + (1 << 12)]).min(axis=1))
    rows_of = least.reshape(bands, rows)
    return np.array([xxhash.xxh3_64_intdigest(r.tobytes(), k) for k, r in enumerate(rows_of)], np.uint64).view(np.int64)


def _sets_of(source: DataFrame, shingle: int, bands: bool) -> DataFrame:
    """``doc_id``, ``node`` (digest of the shingle set) and ``keys`` (of its bands) or ``hashes`` (all) of every row."""
    name = "keys" if bands else "hashes"

    def mark(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batch, "text"):
            sets = [shingle_set(t, shingle) for t in piece.column("text").to_pylist()]
            lists = [band_keys(x) if bands else x.view(np.int64) for x in sets]
            offsets = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([set_digest(x) for x in sets], pa.int64()), pa.ListArray.from_arrays(offsets, np.concatenate(lists))],
                ["doc_id", "node", name])

    return in_arrow(source, mark, f"doc_id {dict(source.dtypes)['doc_id']}, node long, {name} array<long>")


def _asked_sets(source: DataFrame, asked: DataFrame, least_ids: DataFrame, shingle: int) -> DataFrame:
    """``node`` and all ``hashes`` of the nodes in ``asked`` and of other texts under their ids."""
    ids = materialize(asked.distinct().join(least_ids, "node").select(F.col("least_id").alias("asked_id")).distinct(), "asked")
    if ids.count() <= SHIPPED_IDS:
        ids = F.broadcast(ids)
    texts = source.join(ids, F.col("doc_id") == F.col("asked_id"), "left_semi")
    return materialize(_sets_of(texts, shingle, bands=False).select("node", "hashes"), "asked-sets")


def _similar(source: DataFrame, pairs: DataFrame, least_ids: DataFrame, t: Fraction, shingle: int) -> DataFrame:
    """The pairs (``a``, ``b``) of nodes whose shingle sets really are that similar."""
    sets = _asked_sets(source, pairs.select(F.explode(F.array("a", "b")).alias("node")), least_ids, shingle)
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").withColumn("common", F.size(F.array_intersect("x", "y")))
    return both.where(F.col("common") * t.denominator >= (F.size("x") + F.size("y") - F.col("common")) * t.numerator).select("a", "b").distinct()


def _open_pairs(source: DataFrame, large: DataFrame, links: DataFrame, least_ids: DataFrame, t: Fraction, shingle: int) -> DataFrame | None:
    """Pairs (``a``, ``b``) of nodes in ``large(key, node)`` that can be similar and that ``links`` leave in different components.

    Where all members of a bucket are in one component nothing is open. In another bucket
    those outside its largest component ask all members, with a prefix filter: two similar
    sets share one of their rarest hashes, so what a bucket has in common makes no pairs. None if nothing is open.
    """
    roots = components(links)
    placed = materialize(large.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "placed")
    blocks = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    mixed = blocks.groupBy("key").agg(F.count("*").alias("roots"), F.max(F.struct("n", "root"))["root"].alias("main")).where("roots > 1")
    members = materialize(placed.join(mixed, "key").groupBy("node", "root").agg(F.bool_or(F.col("root") != F.col("main")).alias("asks")), "members")
    if members.isEmpty():
        return None
    sets = _asked_sets(source, members.select("node"), least_ids, shingle).dropDuplicates(["node"]).join(members, "node")
    hashes = materialize(sets.select("node", "root", "asks", F.size("hashes").alias("size"), F.explode("hashes").alias("hash")), "hashes")
    ranked = hashes.join(hashes.groupBy("hash").agg(F.count("*").alias("n")), "hash").groupBy("node", "root", "asks", "size").agg(
        F.sort_array(F.collect_list(F.struct("n", "hash"))).alias("ranked"))
    # Similar sets have at least t of either's hashes in common.
    length = F.expr(f"size - cast((size * {t.numerator} + {t.denominator - 1}) div {t.denominator} AS int) + 1")
    prefix = materialize(ranked.select("node", "root", "asks", "size", F.explode(F.slice("ranked", F.lit(1), length)["hash"]).alias("hash")), "prefixes")
    x, y = prefix.where("asks").alias("x"), prefix.alias("y")
    near_size = ((F.col("x.size") * t.denominator >= F.col("y.size") * t.numerator) & (F.col("y.size") * t.denominator >= F.col("x.size") * t.numerator))
    met = x.join(y, (F.col("x.hash") == F.col("y.hash")) & (F.col("x.root") != F.col("y.root")) & near_size)
    return met.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def similar_links(source: DataFrame, nodes: DataFrame, similarity: float = SIMILARITY, shingle: int = 5) -> DataFrame:
    """Links (``a``, ``b``) between nodes of ``similarity`` or more; each was verified on all shingles of both.

    A small bucket lists its pairs.  Members of a larger one meet its first
    member, and those that differ from it the first ones in other orders, so a
    large group does not list its pairs.  What these links leave in different
    components is compared by :func:`_open_pairs`, so similar nodes that share a
    bucket always end in one component.  ``nodes`` has ``node, least_id, keys``.
    """
    t = Fraction(str(similarity))
    least_ids = nodes.select("node", "least_id")
    entries = nodes.select("node", F.explode("keys").alias("key"))
    heads = F.array(F.min("node"), *[F.min(F.struct(F.xxhash64("node", F.lit(k)).alias("by"), "node"))["node"] for k in range(1, MET)])
    buckets = entries.groupBy("key").agg(F.count("*").alias("c"), heads.alias("heads")).where("c > 1")
    held = materialize(entries.join(buckets, "key"), "held")
    small = held.where(F.col("c") <= PAIRED).select("key", F.col("node").alias("a"))
    listed = small.join(small.withColumnRenamed("a", "b"), "key").where("a > b").select("a", "b")
    large = held.where(F.col("c") > PAIRED).select("key", F.col("node").alias("a"), "heads")
    pairs = materialize(listed.union(large.select("a", F.col("heads")[0].alias("b")).where("a <> b")).distinct(), "met")
    found = materialize(_similar(source, pairs, least_ids, t, shingle), "similar")
    if large.isEmpty():
        return found
    others = (large.withColumn("b", F.col("heads")[0]).where("a <> b").join(found, ["a", "b"], "left_anti")
              .select("a", F.explode(F.slice("heads", 2, MET - 1)).alias("b")).where("a <> b").distinct())
    others = materialize(others.join(pairs, ["a", "b"], "left_anti"), "met-others")
    if not others.isEmpty():
        found = found.union(materialize(_similar(source, others, least_ids, t, shingle), "similar"))
    left = _open_pairs(source, large.select("key", F.col("a").alias("node")), found, least_ids, t, shingle)
    if left is None:
        return found
    both_ways = pairs.union(others).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    left = materialize(left.join(both_ways, ["a", "b"], "left_anti"), "met-open")
    return found if left.isEmpty() else found.union(materialize(_similar(source, left, least_ids, t, shingle), "similar"))


def _similar_nodes(source: DataFrame, similarity: float, shingle: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id, node`` of every row of ``source``, and ``node, least_id, root`` of every shingle set; near copies share a root."""
    marked = materialize(_sets_of(source, shingle, bands=True), "marked")
    nodes = materialize(marked.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("keys").alias("keys")), "nodes")
    roots = components(similar_links(source, nodes, similarity, shingle))
    return marked.select("doc_id", "node"), nodes.select("node", "least_id").join(roots, "node", "left").select(
        "node", "least_id", F.coalesce("root", "node").alias("root"))


def similar_classes(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``component_id`` of every row: the smallest id reachable over links of ``similarity`` or more.

    Similarity is that of Jaccard on the sets of shingles.  Equal sets are one
    node, so copies never meet each other.
    """
    marked, labelled = _similar_nodes(text_of(docs, doc_id, text), similarity, shingle)
    lowest = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return marked.join(labelled.join(lowest, "root").select("node", "component_id"), "node").select("doc_id", "component_id")


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each group of near copies: the one with the smallest id.

    Texts without a word hold nothing to compare and all stay; so do rows
    without an id.  Rows that share an id are judged each by its own text: of
    those in one group a single one stays, those in different groups all can.
    """
    key = F.col(f"`{doc_id}`")
    worded = F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]") & key.isNotNull()
    source = text_of(docs.where(worded), doc_id, text)
    marked, labelled = _similar_nodes(source, similarity, shingle)
    # The row that stays: the smallest id, and among texts that share it the smallest set.
    stays = labelled.groupBy("root").agg(F.min(F.struct(F.col("least_id").alias("doc_id"), "node")).alias("stays"))
    judged = marked.join(labelled.join(stays, "root").select("node", "stays"), "node").select(
        "doc_id", "node", (F.struct("doc_id", "node") == F.col("stays")).alias("stay"))
    judged = materialize(judged, "judged")
    ids = materialize(judged.groupBy("doc_id").agg(F.bool_or("stay").alias("stay"), F.count("*").alias("rows")).where("NOT stay OR rows > 1"), "ids")
    shared = ids.where("stay AND rows > 1").select(F.col("doc_id").alias("dropped_id"))
    kept = without_ids(docs, ids.select(F.col("doc_id").alias("dropped_id")), doc_id, worded)
    if shared.isEmpty():
        return kept
    # Rows of these ids are told apart by their texts.
    digest = F.sha2(F.col(f"`{text}`").cast("string"), 256)
    rows = docs.where(worded).join(shared, key == F.col("dropped_id"), "left_semi").select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("doc_id"), digest.alias("digest")).dropDuplicates(["doc_id", "digest"])
    texts = rows.select(F.col("digest").alias("doc_id"), F.col("row")[text].cast("string").alias("text")).dropDuplicates(["doc_id"])
    sets = _sets_of(texts, shingle, bands=False).select(F.col("doc_id").alias("digest"), "node")
    again = rows.join(sets, "digest").join(judged.where("stay").select("doc_id", "node").distinct(), ["doc_id", "node"]).dropDuplicates(["doc_id", "node"])
    return kept.unionByName(again.select(*[F.col("row")[c].alias(c) for c in docs.columns]))

"""Toxicity grades by cumulative-link (ordinal logistic) regression.

P(grade > k) = sigmoid(w.x - cut_k): one weight vector is shared by all ordered
cut points.  The features are hashed lower-case words and their beginnings of
four to seven letters (inflected forms share these), 1 + log(count) each.  Only
slots whose share of documents differs clearly between toxic and other labelled
rows get a weight, so chance words of few rows carry none.

The labels table has no grades; they are ordered from its two columns: 0 = not
toxic and of good quality, 1 = not toxic but of bad quality, 2 = toxic.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import in_arrow, pieces, text_of
from dunlin.session import materialize, ship_code

#: Labelled rows that a model is fitted on at most: the documented bound of the sample.
FIT_ROWS = 20_000
FEATURE_BITS = 20
#: Standard errors by which a slot's share has to differ, and slots kept at most.
CLEAR, SLOTS = 5.0, 1024
GRADES = 3
#: Rows that the fit widens at once.
BLOCK = 1024
WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the beginnings of longer words that are features.
HEADS = (4, 5, 6, 7)
#: Words whose slots a task keeps (about 300 bytes each).
KEPT_WORDS = 100_000


class Slots(dict):
    """The places of a word's slots among those wanted; a bounded table of words met."""

    def __init__(self, wanted: np.ndarray | None, bits: int):
        super().__init__()
        self.bits = bits
        self.places = None if wanted is None else {int(s): i for i, s in enumerate(wanted)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        # A beginning is told from a word of the same letters by its hyphen.
        parts = [word, *(word[:n] + "-" for n in HEADS if len(word) > n)]
        slots = {zlib.crc32(p.encode("utf-8", "surrogatepass")) & ((1 << self.bits) - 1) for p in parts}
        places = tuple(sorted(slots)) if self.places is None else tuple(self.places[s] for s in sorted(slots) if s in self.places)
        if len(self) < KEPT_WORDS:
            self[word] = places
        return places

    def counts(self, text: str | None) -> Counter:
        return Counter(chain.from_iterable(map(self.__getitem__, WORD.findall((text or "").lower()))))


def amount(n: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(n)


def grade_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0, 1 or 2; null where ``toxic`` is null."""
    return F.when(F.col(toxic) == 1, GRADES - 1).when(F.col(toxic) == 0, F.when(F.col(quality) == 0, 1).otherwise(0))


@dataclass
class OrdinalModel:
    """Slots with a weight, their weights and the ordered cut points."""

    slots: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray
    bits: int = FEATURE_BITS

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score (rows) and cut (columns)."""
        return 1.0 / (1.0 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -60, 60)))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int = GRADES, penalty: float = 0.1, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered cut points by Fisher scoring on the log likelihood less ``penalty / 2 * |weights|^2``.

    A step is halved until the likelihood grows; cut points out of order have none.
    ``x`` is widened block by block, so that single precision can be given.
    """
    n, m = x.shape
    blocks = [slice(a, a + BLOCK) for a in range(0, n, BLOCK)]

    def score(weights: np.ndarray) -> np.ndarray:
        return np.concatenate([x[b].astype(np.float64) @ weights for b in blocks]) if blocks else np.empty(0)

    def gathered(values: np.ndarray) -> np.ndarray:
        """x transposed times ``values``."""
        return sum((x[b].T.astype(np.float64) @ values[b] for b in blocks), np.zeros((m, *values.shape[1:])))

    def weighted(values: np.ndarray) -> np.ndarray:
        """x transposed times x with its rows scaled."""
        total = np.zeros((m, m))
        for b in blocks:
            wide = x[b].astype(np.float64)
            total += wide.T @ (wide * values[b][:, None])
        return total

    row, inner = np.arange(n), range(1, grades)
    share = np.clip([(grade > k).mean() for k in range(grades - 1)], 1e-4, 1 - 1e-4)
    cuts = -np.log(share / (1 - share)) + 1e-3 * np.arange(grades - 1)
    state = np.r_[np.zeros(m), cuts]

    def chances(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= k) with both ends, and the chance of each grade."""
        above = 1.0 / (1.0 + np.exp(-np.clip(score(at[:m])[:, None] - at[m:][None, :], -40, 40)))
        above = np.c_[np.ones(n), above, np.zeros(n)]
        return above, above[:, :-1] - above[:, 1:]

    def value(at: np.ndarray) -> float:
        if (np.diff(at[m:]) <= 0).any():
            return -np.inf
        return np.log(np.maximum(chances(at)[1][row, grade], 1e-15)).sum() - penalty / 2 * at[:m] @ at[:m]

    best = value(state)
    for _ in range(rounds):
        above, p = chances(state)
        p = np.maximum(p, 1e-12)
        slope = above * (1 - above)
        turn = slope[:, :-1] - slope[:, 1:]
        step = np.zeros((n, grades - 1, grades))
        for k in inner:
            step[:, k - 1, k], step[:, k - 1, k - 1] = -slope[:, k], slope[:, k]
        gradient = np.r_[gathered((turn / p)[row, grade]) - penalty * state[:m], (step / p[:, None, :])[row, :, grade].sum(axis=0)]
        across = np.einsum("ij,ikj->ik", turn / p, step)
        info = np.zeros((m + grades - 1,) * 2)
        info[:m, :m] = weighted((turn * turn / p).sum(axis=1)) + penalty * np.eye(m)
        info[:m, m:] = gathered(across)
        info[m:, :m] = info[:m, m:].T
        info[m:, m:] = np.einsum("ikj,ilj->kl", step / p[:, None, :], step) + 1e-6 * np.eye(grades - 1)
        move = np.linalg.solve(info, gradient)
        while (now := value(state + move)) < best and np.abs(move).max() > 1e-7:
            move /= 2
        if now - best < 1e-4:
            break
        state, best = state + move, now
    return state[:m], state[m:]


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, bits: int = FEATURE_BITS,
                 doc_id: str = "doc_id", text: str = "text") -> OrdinalModel:
    """Fit on at most ``rows`` labelled documents, chosen by the hash of their ids.

    A document with several labels takes the highest grade; labels without a
    grade or a document, and null ids, are left out before the choice.  Of
    documents that share an id the one with the smallest hash of its text counts.  With labelled toxic rows
    alone, or none, the model has no weights and rejects nothing.
    """
    graded = (labels.select(F.col("doc_id").alias("label_id"), grade_of().alias("grade"))
              .where("grade IS NOT NULL AND label_id IS NOT NULL").groupBy("label_id").agg(F.max("grade").alias("grade")))
    source = text_of(docs, doc_id, text)
    held = graded.join(source.select("doc_id"), F.col("doc_id") == F.col("label_id"), "left_semi")
    sample = materialize(held.orderBy(F.xxhash64("label_id"), "label_id").limit(rows), "sample")
    labelled = source.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id")).select("label_id", "grade", "text")
    repeated = materialize(labelled.groupBy("label_id").count().where("count > 1").select("label_id"), "repeated")
    if not repeated.isEmpty():
        again = labelled.join(F.broadcast(repeated), "label_id", "left_semi").groupBy("label_id", "grade").agg(
            F.min(F.struct(F.xxhash64("text").alias("by"), "text"))["text"].alias("text"))
        labelled = materialize(labelled.join(F.broadcast(repeated), "label_id", "left_anti").union(again), "labelled")

    chosen = _clear_slots(labelled, bits)
    kind = dict(labelled.dtypes)["label_id"]

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = Slots(chosen, bits)
        for piece in pieces(batch, "text"):
            found = [table.counts(t) for t in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("label_id"), piece.column("grade").cast(pa.int32()),
                 pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                ["label_id", "grade", "places", "counts"])

    # At most ``rows`` short lists: only places of the chosen slots.
    held = in_arrow(labelled, count, f"label_id {kind}, grade int, places array<int>, counts array<int>").toArrow().sort_by("label_id").combine_chunks()
    grade = held.column("grade").to_numpy().astype(np.int64)
    toxic = grade == GRADES - 1
    if not toxic.any() or toxic.all():
        return OrdinalModel(np.empty(0, np.int64), np.empty(0), np.array([49.0, 50.0]), bits)
    x = np.zeros((len(grade), len(chosen)), np.float32)
    for row, (places, counts) in enumerate(zip(held.column("places").to_pylist(), held.column("counts").to_pylist())):
        x[row, places] = amount(np.array(counts, float))
    weights, cuts = fit_ordinal(x, grade)
    return OrdinalModel(chosen, weights, cuts, bits)


def _clear_slots(labelled: DataFrame, bits: int) -> np.ndarray:
    """Slots whose share of documents differs by ``CLEAR`` standard errors, at most ``SLOTS`` of them; counted in Spark."""

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Slots(None, bits)
        # One counter per slot and side (8 MB); the last slot counts the documents themselves.
        sums = np.zeros((2, (1 << bits) + 1), np.int32)
        for batch in batches:
            for piece in pieces(batch, "text"):
                for text, grade in zip(piece.column("text").to_pylist(), piece.column("grade").to_pylist()):
                    own = table.counts(text)
                    side = sums[int(grade == GRADES - 1)]
                    side[np.fromiter(own, np.int64, len(own))] += 1
                    side[-1] += 1
        slots = np.flatnonzero(sums.any(axis=0))
        numbers = np.where(slots == 1 << bits, -1, slots)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (numbers, sums[1, slots], sums[0, slots])], ["slot", "toxic", "other"])

    ship_code(labelled.sparkSession)
    tallied = labelled.mapInArrow(tally, "slot long, toxic long, other long").groupBy("slot").agg(F.sum("toxic").alias("t"), F.sum("other").alias("o"))
    tallied = materialize(tallied, "slots")
    total = tallied.where("slot = -1").first()
    if total is None or not total["t"] or not total["o"]:
        return np.empty(0, np.int64)
    a, b = float(total["t"]), float(total["o"])
    share = (F.col("t") + F.col("o")) / (a + b)
    clear = F.abs(F.col("t") / a - F.col("o") / b) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / a + 1 / b))
    best = tallied.where("slot >= 0 AND t + o >= 5").withColumn("z", clear).where(F.col("z") >= CLEAR).orderBy(F.desc("z"), "slot").limit(SLOTS)
    return np.sort(np.array([r["slot"] for r in best.select("slot").collect()], np.int64))


SCORES = "toxic_chance double, expected_severity double, severity int"


def score_toxicity(docs: DataFrame, model: OrdinalModel, limit: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, toxic_chance, expected_severity, severity, toxic, kept`` of every row.

    ``toxic_chance`` is that of the highest grade, ``expected_severity`` the mean grade,
    ``severity`` the likeliest grade; a document is toxic, and not kept, from a
    chance of ``limit`` on.  Null and empty texts have no features and take the
    base chance.  Repeated rows are scored alike, other columns ignored, and an
    empty table gives no rows.  Whole texts are read; nothing is shuffled.
    """
    source = text_of(docs, doc_id, text)

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = Slots(model.slots, model.bits)
        for piece in pieces(batch, "text", 8_000_000):
            found = [table.counts(t) for t in piece.column("text").to_pylist()]
            points = np.array([sum(model.weights[s] * amount(n) for s, n in f.items()) for f in found], float)
            above = model.above(points)
            chances = np.c_[np.ones(len(points)), above] - np.c_[above, np.zeros(len(points))]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(above[:, -1]), pa.array(above.sum(axis=1)), pa.array(chances.argmax(axis=1).astype(np.int32))],
                ["doc_id", "toxic_chance", "expected_severity", "severity"])

    scored = in_arrow(source, score, f"doc_id {dict(source.dtypes)['doc_id']}, {SCORES}")
    return scored.withColumn("toxic", F.col("toxic_chance") >= limit).withColumn("kept", F.col("toxic_chance") < limit)


def drop_toxic(docs: DataFrame, model: OrdinalModel, limit: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not toxic; judged in place without a join."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    at = docs.columns.index(text)

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        table = Slots(model.slots, model.bits)
        for piece in pieces(batch, names[at]):
            points = np.array([sum(model.weights[s] * amount(n) for s, n in table.counts(t).items()) for t in piece.column(at).to_pylist()], float)
            yield piece.filter(pa.array(model.above(points)[:, -1] < limit))

    return in_arrow(plain, keep, plain.schema).toDF(*docs.columns)

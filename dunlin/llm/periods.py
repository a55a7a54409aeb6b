"""Periodic runs of words, found with minimizers at several scales.

A run is a stretch of words that repeats with its smallest period q, has at least
``exponent`` periods and ``min_length`` words, and is extended by neither
neighbour. Periods up to :data:`SHORT` are found by comparing the words with
themselves at each lag. Longer ones are split into scales of periods Q..R with R
near 1.5 Q, and each scale takes windows of R starts of grams of K words, K near Q / 3:

* A gram may be a minimum only if its next equal gram begins more than K / 2
  words later. Were no gram of one whole period allowed, neighbouring grams would
  share a period of K / 2 at most (Fine and Wilf), and so would the run.
* A run of three periods holds two windows at a distance of q whose grams are all
  equal. Both have the same least hash, so its grams at places m and m + q are
  both minima: an equal pair at distance q, which is a seed.
* Equal minima are more than K / 2 words apart, so each has at most about ten
  partners within R; no gram meets all its copies.

Seeds are extended on both sides by hashes of 1, 2, 4, ... words. What is long
enough is compared word by word, and of several periods of one stretch the
smallest counts. The search is thus exact but for equal 64-bit hashes of unequal grams.

Documents are joined in chunks with a word of its own between two of them; each
document is worked on whole. A null text has no words. Rows are neither joined nor
grouped, so ids may be null or repeat and other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dunlin.llm.common import in_arrow, mixed, pieces, sliding, text_of

#: Periods that are found by direct comparison at each lag.
SHORT = 12
#: Words of small documents that share one chunk.
CHUNK = 1 << 16
#: Hashes of up to 2 ** TOP words are kept for extending seeds.
TOP = 12


def lag_stretches(words: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all maximal stretches of ``least`` places or more that equal the place ``lag`` further on."""
    equal = np.zeros(max(len(words) - lag, 0) + 2, np.int8)
    equal[1:-1] = words[lag:] == words[:-lag]
    edges = np.flatnonzero(np.diff(equal))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return start[long], end[long]


def scales(longest: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """Smallest and largest period and gram length of each scale for documents of ``longest`` words."""
    low = SHORT + 1
    while low * exponent <= longest:
        high = low + low // 2
        yield low, high, 2 * (2 * low - high + 1) // 3
        low = high + 1


class Grams:
    """Hashes of all grams of 1, 2, 4, ... words; those above 2 ** TOP words are only kept while they are the largest."""

    def __init__(self, words: np.ndarray):
        self.levels = [mixed(words.astype(np.uint64), np.uint64(7))]
        self.power, self.largest = 0, self.levels[0]

    def of(self, length: int) -> np.ndarray:
        """Hashes of all grams of ``length`` words; lengths must be asked for in rising order."""
        while 2 << self.power <= length:
            step = 1 << self.power
            self.largest = mixed(self.largest[:-step], self.largest[step:])
            self.power += 1
            if self.power <= TOP:
                self.levels.append(self.largest)
        rest = length - (1 << self.power)
        return mixed(self.largest[: len(self.largest) - rest], self.largest[rest:]) if rest else self.largest

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and j on are the same."""
        same = np.zeros(len(i), np.int64)
        for power in range(len(self.levels) - 1, -1, -1):
            level, going = self.levels[power], np.arange(len(i))
            while len(going):
                a, b = i[going] + same[going], j[going] + same[going]
                inside = np.maximum(a, b) < len(level)
                going, a, b = going[inside], a[inside], b[inside]
                going = going[level[a] == level[b]]
                same[going] += 1 << power
                if power < len(self.levels) - 1:
                    break
        return same

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words right before i and j are the same."""
        same = np.zeros(len(i), np.int64)
        for power in range(len(self.levels) - 1, -1, -1):
            level, going, step = self.levels[power], np.arange(len(i)), 1 << power
            while len(going):
                a, b = i[going] - same[going] - step, j[going] - same[going] - step
                inside = np.minimum(a, b) >= 0
                going, a, b = going[inside], a[inside], b[inside]
                going = going[level[a] == level[b]]
                same[going] += step
                if power < len(self.levels) - 1:
                    break
        return same


def seeds(gram: np.ndarray, length: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of minimizers that have an equal one ``low`` to ``high`` words later, and those distances."""
    order = np.argsort(gram, kind="stable")
    near = (gram[order[1:]] == gram[order[:-1]]) & (np.diff(order) <= length // 2)
    last = np.iinfo(np.uint64).max
    value = gram.copy()
    value[order[:-1][near]] = last
    least = sliding(value, high, np.minimum, last)
    # A place is a minimizer if it is the least of any window that holds it.
    most = sliding(np.concatenate([np.zeros(high - 1, np.uint64), least]), high, np.maximum, 0)[: len(value)]
    place = np.flatnonzero((value == most) & (value != last))
    place = place[np.argsort(value[place], kind="stable")]
    value = value[place]
    found, step = [(np.empty(0, np.int64), np.empty(0, np.int64))], 1
    while step < len(place):
        apart = place[step:] - place[:-step]
        close = (value[step:] == value[:-step]) & (apart <= high)
        if not close.any():
            break
        close &= apart >= low
        found.append((place[:-step][close], apart[close]))
        step += 1
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(words: np.ndarray, longest: int, min_length: int, exponent: int) -> np.ndarray:
    """Start, length and period of every run, one row each, by start and period.

    ``longest`` is the number of words of the longest document in ``words``.
    """
    rows = []
    for lag in range(1, min(SHORT, longest // exponent) + 1):
        start, end = lag_stretches(words, lag, max(min_length, exponent * lag) - lag)
        rows.append(np.column_stack([start, end + lag, np.full(len(start), lag)]))
    grams = Grams(words)
    for low, high, length in scales(longest, exponent):
        place, period = seeds(grams.of(length), length, low, high)
        if not len(place):
            continue
        start = place - grams.behind(place, place + period)
        end = place + period + grams.ahead(place, place + period)
        long = end - start >= np.maximum(min_length, exponent * period)
        rows.append(np.unique(np.column_stack([start, end, period])[long], axis=0))
    if not rows:
        return np.empty((0, 3), np.int64)
    found = np.concatenate(rows)
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    found = found[np.r_[True, (np.diff(found[:, :2], axis=0) != 0).any(axis=1)][: len(found)]]
    found = found[[bool((words[s: e - q] == words[s + q: e]).all()) for s, e, q in found.tolist()]] if len(found) else found
    found[:, 1] -= found[:, 0]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def chunks(sizes: list[int]) -> Iterator[list[int]]:
    """Documents by size, so that those of a chunk need about the same scales."""
    chunk, held = [], 0
    for i in sorted(range(len(sizes)), key=sizes.__getitem__):
        if chunk and held + sizes[i] > CHUNK:
            yield chunk
            chunk, held = [], 0
        chunk.append(i)
        held += sizes[i]
    if chunk:
        yield chunk


def document_runs(texts: list[list[bytes]], min_length: int, exponent: int) -> list[np.ndarray]:
    """The runs of each list of words."""
    out: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(texts)
    for chunk in chunks([len(t) for t in texts]):
        number: dict[bytes, int] = {}
        joined, begin = [], []
        for k, i in enumerate(chunk):
            begin.append(len(joined))
            joined += [number.setdefault(w, len(number)) for w in texts[i]]
            joined.append(-1 - k)
        begin = np.array(begin)
        found = runs_of(np.array(joined, np.int64), max(len(texts[i]) for i in chunk), min_length, exponent)
        of = np.searchsorted(begin, found[:, 0], "right") - 1
        for k in np.unique(of).tolist():
            own = found[of == k]
            own[:, 0] -= begin[k]
            out[chunk[k]] = own
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that any run holds after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join(w for w, held in zip(words, np.cumsum(edges[:-1]).tolist()) if not held)


def periodic_runs(docs: DataFrame, min_length: int = 24, exponent: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, all ``runs`` (start, length, period in words) and the ``collapsed`` text of every row.

    ``exponent`` must be 3 or more: seeds need three periods.
    """
    if exponent < 3:
        raise ValueError("runs of fewer than three periods have no seeds")
    source = text_of(docs, doc_id, text)

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batch, "text"):
            words = [(t or "").encode("utf-8", "surrogatepass").split() for t in piece.column("text").to_pylist()]
            runs = document_runs(words, min_length, exponent)
            flat = np.concatenate(runs)
            ends = np.cumsum([0, *map(len, runs)])
            structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), pa.array(list(map(len, words)), pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(source.dtypes)["doc_id"]
    return in_arrow(source, find, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")

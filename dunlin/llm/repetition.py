"""Quality rule on repeated passages inside a document, by suffix arrays.

The words of a piece of documents are numbered and their suffixes sorted by
prefix doubling; each document's number is part of its first rank, so suffixes
of different documents never share a prefix.  Only suffixes whose rank is still
shared are sorted again.  The stored ranks give the longest common prefix of
neighbours in the suffix array.

Every suffix lies in a chain of nested LCP intervals, each of which is a
maximal repeated substring.  The innermost has the value max(LCP with the
neighbour before, LCP with the neighbour after); the spans of the outer ones
are prefixes of its span.  The union of the spans of all maximal repeats of at
least ``min_words`` words is thus the union of the innermost spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.llm.common import in_arrow, pieces, text_of

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_DOC_WORDS = 10
MAX_REPEATED_PERCENT = 20

SCHEMA = (
    "doc_id {id}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long, spans array<struct<start:long,length:long>>"
)


class _Numbers(dict):
    """Give each new word the next number."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def suffix_order(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of all documents and the ranks after 1, 2, 4, ... words.

    A rank is the place of its group's first suffix; one place more, with rank
    -1, stands for the end.
    """
    n = len(words)
    key = doc * np.int64(words.max() + 1) + words
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    heads = np.r_[True, ordered[1:] != ordered[:-1]]
    place = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    rank = np.full(n + 1, -1, np.int64)
    rank[order] = place
    last = np.r_[np.nonzero(np.diff(doc))[0], n - 1]
    end = (last + 1)[np.searchsorted(last, np.arange(n))]
    levels, width = [rank.astype(np.int32)], 1
    slots = np.nonzero(~(heads & np.r_[heads[1:], True]))[0]
    while len(slots):
        at = order[slots]
        after = at + width
        key = rank[at] * np.int64(n + 2) + 1 + np.where(after < end[at], rank[np.minimum(after, n)], -1)
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        heads = np.r_[True, key[1:] != key[:-1]]
        order[slots] = at
        rank[at] = np.maximum.accumulate(np.where(heads, slots, 0))
        slots = slots[~(heads & np.r_[heads[1:], True])]
        levels.append(rank.astype(np.int32))
        width *= 2
    return order, levels


def longest_repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each place, the length of the longest repeat that starts there.

    Lengths under four words are given as 0.
    """
    n = len(words)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    order, levels = suffix_order(words, doc)
    if len(levels) < 3:
        return out
    pairs = np.nonzero(levels[2][order[1:]] == levels[2][order[:-1]])[0]
    a, b = order[pairs], order[pairs + 1]
    common = np.zeros(len(pairs), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        same = levels[j][a + common] == levels[j][b + common]
        common += same.astype(np.int64) << j
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def _covered(repeats: np.ndarray, least: int) -> np.ndarray:
    starts = np.nonzero(repeats >= least)[0]
    step = np.zeros(len(repeats) + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + repeats[starts], -1)
    return np.cumsum(step[:-1]) > 0


def _describe(batch: pa.RecordBatch, min_words: int) -> pa.RecordBatch:
    texts = batch.column("text").to_pylist()
    numbers, flat, n_words, chars, symbols, lines = _Numbers(), [], [], [], [], []
    for text in texts:
        text = text or ""
        words = text.encode("utf-8", "surrogatepass").split()
        flat.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        n_words.append(len(words))
        chars.append(len(text) - sum(map(text.count, SPACES)))
        symbols.append(sum(map(text.count, SYMBOLS)))
        held = [line for line in text.split("\n") if line.strip(SPACES)]
        lines.append(len(held) - len(set(held)))
    sizes = np.array(n_words, np.int64)
    words = np.concatenate(flat) if flat else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    repeats = longest_repeats(words, doc)
    inside = _covered(repeats, min_words)
    per_doc = lambda mask: np.bincount(doc[mask], minlength=len(texts))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc, np.where(repeats >= min_words, repeats, 0))
    # Runs of covered words, cut where a document begins.
    before = np.r_[False, inside[:-1] & (doc[1:] == doc[:-1])] if len(doc) else inside
    after = np.r_[inside[1:] & (doc[1:] == doc[:-1]), False] if len(doc) else inside
    first, final = np.nonzero(inside & ~before)[0], np.nonzero(inside & ~after)[0]
    offsets = np.r_[0, np.cumsum(np.bincount(doc[first], minlength=len(texts)))].astype(np.int32)
    begin = np.r_[0, np.cumsum(sizes)]
    spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
        [pa.array(first - begin[doc[first]], pa.int64()), pa.array(final - first + 1, pa.int64())], ["start", "length"]))
    columns = [batch.column("doc_id")]
    columns += [pa.array(x, pa.int64()) for x in (n_words, chars, symbols, lines, per_doc(_covered(repeats, WINDOW)), per_doc(inside), longest)]
    return pa.RecordBatch.from_arrays([*columns, spans], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat", "spans"])


def repetition(docs: DataFrame, min_words: int = 10, max_covered: float = 0.15, max_repeat: int = 50,
               doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words, base rules and repeated passages of each document, and whether it is kept.

    Rows: one per row of ``docs``; nothing is shuffled.  ``spans`` are the
    merged word spans of all maximal repeats of ``min_words`` words or more
    (first copies included), ``covered_words`` their size and ``longest_repeat``
    the longest.  A document is kept if the base rules hold, the covered share is
    at most ``max_covered`` and no repeat is longer than ``max_repeat`` words.

    Null and empty texts have no words and fail the base rule.  Repeated rows
    are judged each for itself.  Other columns of ``docs`` are ignored.  An empty
    table gives an empty result.  Memory is that of one piece of texts (about
    2 MB, or one long document).
    """
    source = text_of(docs, doc_id, text)
    schema = SCHEMA.format(id=dict(source.dtypes)["doc_id"])

    def describe(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batch, "text"):
            yield _describe(piece, min_words)

    found = in_arrow(source, describe, schema)
    failed = (F.col("n_words") < MIN_DOC_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    good = (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_repeat)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & good)

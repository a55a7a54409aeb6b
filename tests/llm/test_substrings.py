import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from dunlin.llm import substrings
from dunlin.llm.queries import op13_substring_dedup
from dunlin.llm.substrings import drop_repeated_passages, repeated_windows, spans_of, suffix_ranks
from dunlin.session import scratch_root
from tests.llm.common import ODD, docs_of, prose


def brute(texts, window=35):
    """Kept words and numbers of words, by counting all windows as they are."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i: i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i: i + window])] > 1 for j in range(i, i + window)}
        out.append(([x for i, x in enumerate(w) if i not in gone], len(w), len(gone)))
    return out


def corpus(seed):
    """Copies, shared passages at and around the window's length, periodic texts and small vocabularies."""
    draw = random.Random(seed)
    passages = [prose(1000 + i, n) for i, n in enumerate((34, 35, 36, 50, 80, 400))]
    texts = list(ODD)
    for i in range(120):
        parts = [prose(seed * 1000 + i, draw.randrange(200), draw.choice([3, 400, 5000]))]
        for _ in range(draw.randrange(3)):
            parts.append(draw.choice(passages))
            parts.append(prose(seed * 7777 + i, draw.randrange(20)))
        texts.append(draw.choice([" ", "\n"]).join(parts))
    texts += texts[20:30] + ["a " * 300, "a " * 40, "b " * 35, "c " * 36, "a b " * 700, "x y z " * 12, " ".join(map(str, range(90))) + " " + " ".join(map(str, range(90)))]
    return texts


@pytest.mark.parametrize("seed, limit", [(1, 2000), (2, 2000), (3, 3), (4, 1)])
def test_equals_counting_all_windows(spark, seed, limit):
    """With a low limit most groups are too large for a tree and take the long prefixes."""
    texts = corpus(seed)
    rows = drop_repeated_passages(docs_of(spark, texts), limit=limit).orderBy("doc_id").collect()
    for row, (kept, n, gone) in zip(rows, brute(texts), strict=True):
        assert (row.kept.encode().split(), row.n_words, sum(s.length for s in row.spans)) == (kept, n, gone), row.doc_id


def test_another_window_and_short_stretches(spark, monkeypatch):
    monkeypatch.setattr(substrings, "STRETCH", 3)
    texts = corpus(5)
    rows = drop_repeated_passages(docs_of(spark, texts), window=13).orderBy("doc_id").collect()
    assert [(r.kept.encode().split(), r.n_words) for r in rows] == [(k, n) for k, n, _ in brute(texts, 13)]
    with pytest.raises(ValueError):
        drop_repeated_passages(None, window=12)


def test_query_with_null_and_repeated_ids(spark, tmp_path):
    texts = corpus(6)
    ids = [None, None, 5, 5, *range(10, len(texts) + 6)]
    docs_of(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in op13_substring_dedup(spark, str(tmp_path)).collect()]
    wanted = [(i, n, gone, hashlib.sha256(b" ".join(kept)).hexdigest()) for i, (kept, n, gone) in zip(ids, brute(texts))]
    assert sorted(rows, key=repr) == sorted(wanted, key=repr)


def test_only_the_tables_that_are_still_read_stay(spark):
    folder = Path(scratch_root(spark).removeprefix("file://"))
    before = set(folder.glob("*"))
    drop_repeated_passages(docs_of(spark, corpus(7)), limit=3).collect()
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before if any(p.rglob("*.parquet"))} == {"anchors", "windows"}


def test_without_repeats_and_without_rows(spark):
    assert drop_repeated_passages(docs_of(spark, [])).count() == 0
    rows = drop_repeated_passages(docs_of(spark, [prose(1, 100, 5000), None])).collect()
    assert [r.spans for r in rows] == [[], []]


@pytest.mark.parametrize("depth", [13, 32, 35, 40])
def test_ranks_are_those_of_whole_windows(depth):
    draw = random.Random(depth)
    words = np.array([draw.randrange(2) for _ in range(50)] * 2 + [7] * 60)
    ranks = suffix_ranks(words, depth).tolist()
    windows = [tuple(words[i: i + depth].tolist()) for i in range(len(words) - depth + 1)]
    assert [ranks.index(r) for r in ranks] == [windows.index(w) for w in windows]


def test_windows_do_not_cross_segments():
    a, b = [b" ".join(b"%d" % i for i in range(lo, lo + 20)) for lo in (0, 20)]
    assert [p.tolist() for p in repeated_windows([a, b, a + b" " + b], 13)] == [list(range(8)), list(range(8)), [*range(8), *range(20, 28)]]


def test_spans_are_merged():
    windows = [{"first": f, "last": t} for f, t in ((90, 90), (3, 5), (5, 9), (44, 44), (44, 44))]
    assert spans_of(windows, 35) == [(3, 79), (90, 125)] and spans_of(None, 35) == []

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from dunlin.llm.periods import CHUNK, document_runs, periodic_runs
from dunlin.llm.queries import op12_periodic_runs
from tests.llm.common import ODD, docs_of, prose


def all_runs(words, least=24, exponent=3):
    """Every run, by comparing the words with themselves at every lag."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def periodic_words(draw):
    letters = draw.choice([1, 2, 3, 5, 50])
    words = [draw.randrange(letters) for _ in range(draw.randrange(500))]
    for _ in range(draw.randrange(4)):
        period = draw.randrange(1, 100)
        block = [draw.randrange(letters) for _ in range(period)]
        if draw.random() < 0.4 and period > 6:
            block = (block[: draw.randrange(1, 6)] * period)[: period - 1] + [99]
        at = draw.randrange(len(words) + 1)
        words[at:at] = (block * 9)[: int(period * draw.uniform(2.8, 6))]
    if draw.random() < 0.1:
        a, b = [0], [0, 1]
        while len(b) < 400:
            a, b = b, b + a
        words = b * draw.choice([1, 3])
    return [b"%d" % w for w in words]


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_comparison_at_every_lag(seed):
    draw = random.Random(seed)
    texts = [periodic_words(draw) for _ in range(60)]
    for words, found in zip(texts, document_runs(texts, 24, 3)):
        assert [tuple(r) for r in found.tolist()] == all_runs(words)


def test_other_bounds():
    draw = random.Random(9)
    texts = [periodic_words(draw) for _ in range(40)]
    for words, found in zip(texts, document_runs(texts, 40, 4)):
        assert [tuple(r) for r in found.tolist()] == all_runs(words, 40, 4)
    with pytest.raises(ValueError):
        periodic_runs(None, exponent=2)


def test_a_long_text_with_long_periods():
    draw = random.Random(3)
    block = [b"%d" % draw.randrange(9) for _ in range(30_000)]
    words = block[:1000] + block * 3 + [b"end"] + [b"x"] * 5000
    assert len(words) > CHUNK
    assert document_runs([words], 24, 3)[0].tolist()[-2:] == [[1000, 90_000, 30_000], [91_001, 5000, 1]]


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, text)
    runs = all_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest("".join("%d,%d,%d\n" % r for r in runs)), digest(kept), len(words))


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(5)
    texts = ODD + [" ".join(w.decode() for w in periodic_words(draw)) for _ in range(80)] + [prose(i, 300) for i in range(30)]
    ids = [*range(len(texts) - 3), None, 7, 7]
    docs_of(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in ids) > 5
    assert sorted(rows, key=repr) == sorted((expected(i, t) for i, t in zip(ids, texts)), key=repr)


def test_empty_table(spark):
    assert periodic_runs(docs_of(spark, [])).count() == 0

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dunlin.llm.repetition import longest_repeats, repetition
from tests.llm.common import ODD, docs_of, prose


def brute(words):
    n = len(words)
    out = [0] * n
    for i in range(n):
        for j in range(n):
            if i != j:
                k = 0
                while max(i, j) + k < n and words[i + k] == words[j + k]:
                    k += 1
                out[i] = max(out[i], k)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=24), min_size=1, max_size=4))
def test_longest_repeats_match_brute_force(docs):
    words = np.array([w for d in docs for w in d], np.int64)
    doc = np.array([i for i, d in enumerate(docs) for _ in d], np.int64)
    want = [k if k >= 4 else 0 for d in docs for k in brute(d)]
    assert longest_repeats(words, doc).tolist() == want


def covered(words, k):
    seen, held = {}, set()
    for i in range(len(words) - k + 1):
        seen.setdefault(tuple(words[i:i + k]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            held |= {p + j for p in places for j in range(k)}
    return len(held)


def test_rules_match_brute_force(spark):
    passage = prose(5, 30)
    draw = random.Random(3)
    texts = [*ODD, passage + " " + prose(6, 200) + "\n" + passage, "spam spam spam " * 100, "\n".join([prose(7, 9)] * 3 + [prose(8, 40)]),
             " ".join(draw.choice("ab") for _ in range(120)), prose(9, 60) + " " + prose(10, 400) + " " + prose(9, 60)]
    got = {r.doc_id: r for r in repetition(docs_of(spark, texts)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        r = got[i]
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text or ""))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert (r.n_repeat_words, r.covered_words) == (covered(words, 5), covered(words, 10))
        longest = max(brute(words), default=0) if len(words) < 700 else r.longest_repeat
        assert r.longest_repeat == (longest if longest >= 10 else 0)
        assert sum(s.length for s in r.spans) == r.covered_words
        failed = len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words)
        assert r.base_failed == failed
        assert r.kept == (not failed and r.covered_words <= 0.15 * len(words) and longest <= 50)
    assert got[len(ODD) + 4].kept is False and got[len(ODD) + 4].base_failed is True


def test_empty_table(spark):
    assert repetition(docs_of(spark, [])).count() == 0

import random
import re

import numpy as np
import xxhash

from dunlin.llm.simhash import BKForest, _sets_of, components, fingerprint, keep_one_of_each, near_duplicates, near_links, similar_classes, similar_links, spanning_links
from tests.llm.common import ODD, docs_of, prose


def brute_print(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(values, ids, radius):
    up = list(range(len(values)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                up[find(i)] = find(j)
    group = {}
    for i in range(len(values)):
        group.setdefault(find(i), []).append(ids[i])
    return [min(group[find(i)]) for i in range(len(values))]


def test_components_match_brute_force(spark):
    base = prose(60, 300)
    draw = random.Random(1)

    def variant(text):
        words = text.split()
        words[draw.randrange(len(words))] = "changed"
        return " ".join(words)

    texts = [*ODD, base, *[variant(base) for _ in range(12)], variant(variant(base)), base, base.upper(), *[prose(70 + i, 80) for i in range(8)], "A b c", "a B c"]
    got = {r.doc_id: r for r in near_duplicates(docs_of(spark, texts), tree=3).collect()}
    prints = [brute_print(t, 4) for t in texts]
    want = brute_roots(prints, list(range(len(texts))), 4)
    assert [int(got[i].fingerprint, 16) for i in range(len(texts))] == prints
    assert [got[i].component_id for i in range(len(texts))] == want


def test_links_find_every_component(spark):
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(40)]
    values = {c for c in centres}
    for c in centres[:20]:
        for _ in range(15):
            values.add(c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(1, 6))))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    for tree, group in ((2048, 4096), (2, 1), (5, 50)):
        frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
        roots = {r.node: r.root for r in components(near_links(frame, 4, tree, group)).collect()}
        want = brute_roots(values, signed, 4)
        assert [roots.get(v, v) for v in signed] == want


def test_forest_finds_what_is_within():
    draw = np.random.default_rng(0)
    values = np.unique(draw.integers(0, 1 << 12, 300))
    shard = values % 3
    forest = BKForest(values, shard)
    found = {(int(values[q]), int(v)) for qs, vs in forest.within(values, shard, 2) for q, v in zip(qs, vs)}
    want = {(int(a), int(b)) for a in values for b in values if a % 3 == b % 3 and int(a ^ b).bit_count() <= 2}
    assert found == want
    a, b = spanning_links(values, shard, np.zeros(len(values), int), 0, 0, 2)
    assert len(a) < len(values) and (a > b).all()


def test_one_of_each_stays(spark):
    base = prose(80, 200)
    docs = docs_of(spark, [base, base + " end", prose(81, 90), None, "", prose(81, 90), base, prose(82, 50)], [7, 3, 9, 1, 2, 9, None, 11])
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in kept.collect()) == [-1, 1, 2, 3, 9, 11]
    assert keep_one_of_each(docs_of(spark, [])).count() == 0


def test_empty_and_null_ids(spark):
    assert near_duplicates(docs_of(spark, [])).count() == 0
    got = near_duplicates(docs_of(spark, ["a b c d e", "a b c d e"], [None, 4])).collect()
    assert {r.component_id for r in got} == {4}


def test_fingerprint_of_long_text():
    words = [b"w%d" % (i % 1000) for i in range(70_000)]
    assert fingerprint(words, 4) == brute_print(" ".join(w.decode() for w in words), 4)


def test_one_of_each_matches_jaccard_brute_force(spark):
    draw = random.Random(11)

    def variant(text, edits):
        words = text.split()
        for at in draw.sample(range(len(words)), edits):
            words[at] = f"v{draw.randrange(10**6)}"
        return " ".join(words)

    texts = []
    for i in range(24):
        base = prose(400 + i, 200, 3000)
        # Up to 7 separate edits of 200 words leave a similarity from 0.97 down to about 0.7.
        texts += [base, *[variant(base, edits) for edits in (1, 2, 3, 4, 5, 7)]]
    texts += [prose(500, 3), prose(500, 3) + " x", prose(500, 3)]
    draw.shuffle(texts)
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))})
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert len(set(root)) < len(texts) - 60
    docs = docs_of(spark, texts)
    assert {r.doc_id: r.component_id for r in similar_classes(docs).collect()} == dict(enumerate(root))
    assert sorted(r.doc_id for r in keep_one_of_each(docs).collect()) == sorted(set(root))


def test_texts_that_share_an_id_are_judged_each_for_itself(spark):
    first, second, third = prose(90, 120), prose(91, 120), prose(92, 120)
    texts = [first, second, second, None, first + " end", third, third, "  ", second + " end", first]
    docs = docs_of(spark, texts, [5, 5, 5, 5, 6, 7, 4, 6, 5, 5])
    kept = sorted((r.doc_id, r.text or "") for r in keep_one_of_each(docs).collect())
    groups = sorted((i, "first" if t.startswith(first) else "second" if t.startswith(second) else "third" if t == third else t) for i, t in kept)
    assert groups == [(4, "third"), (5, ""), (5, "first"), (5, "second"), (6, "  ")]


def test_a_large_mixed_bucket_loses_no_pair(spark):
    bases = [prose(900 + i, 120, 3000) for i in range(60)]
    docs = docs_of(spark, [text for base in bases for text in (base, base + " end")])
    rows = _sets_of(docs.select("doc_id", "text"), 5, bands=False).collect()
    # All in one bucket, as texts with a common passage can be.
    nodes = spark.createDataFrame([(r.node, r.doc_id, [7]) for r in rows], "node long, least_id long, keys array<long>")
    of = {r.doc_id: r.node for r in rows}
    got = {frozenset((r.a, r.b)) for r in similar_links(docs.select("doc_id", "text"), nodes).collect()}
    assert got == {frozenset((of[i], of[i + 1])) for i in range(0, 120, 2)}

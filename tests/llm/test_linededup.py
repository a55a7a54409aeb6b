import random
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F

from dunlin.llm import linededup
from dunlin.llm.linededup import drop_similar_lines, line_report
from dunlin.session import scratch_root
from tests.llm.common import ODD, docs_of, prose


def brute(texts, ids, t=0.8, least=1):
    lines = [(i, p, line) for i, text in zip(ids, texts) if i is not None for p, line in enumerate((text or "").split("\n") if text is not None else [])]
    sets = [(i, p, line, frozenset(line.split())) for i, p, line in lines if len(line.split()) >= least and len(set(line.split())) >= min(2, least)]
    sets.sort(key=lambda x: x[:2])
    gone = set()
    for k, (i, p, line, s) in enumerate(sets):
        for j, q, other, o in sets[:k]:
            if (j, q) < (i, p) and (line == other or 10 * len(s & o) >= 10 * t * len(s | o)):
                gone.add((i, p))
                break
    return gone


def corpus(seed):
    draw = random.Random(seed)
    base = [prose(100 + i, draw.randint(5, 60), 3000) for i in range(25)]

    def variant(line, edits):
        words = line.split()
        for _ in range(edits):
            words[draw.randrange(len(words))] = f"v{draw.randrange(10**6)}"
        return " ".join(words)

    texts = []
    for _ in range(40):
        lines = [variant(draw.choice(base), draw.choice([0, 0, 1, 2, 4, 8])) for _ in range(draw.randint(1, 6))] + [prose(draw.randrange(10**6), 12, 60)]
        draw.shuffle(lines)
        texts.append("\n".join(lines))
    # One line with many variants, each of its own.
    texts += [variant(base[0] + " " + base[1], 2) for _ in range(60)]
    return texts


def test_removed_lines_match_brute_force(spark):
    texts = [*ODD, *corpus(1), "b a d c e f g", "a b c d e f g", "same same same same same", "same same same same same", "x\t y  z q r", "r q z y x"]
    ids = list(range(len(texts)))
    random.Random(2).shuffle(ids)
    want = brute(texts, ids)
    got = line_report(docs_of(spark, texts, ids)).collect()
    assert len(got) == len(texts)
    assert {(r.doc_id, int(p)) for r in got for p in r.removed.split(",") if p} == want
    by = dict(zip(ids, texts))
    for r in got:
        assert r.n_lines == (0 if by[r.doc_id] is None else by[r.doc_id].count("\n") + 1)
        assert r.n_removed == len([p for p in r.removed.split(",") if p])
    docs = docs_of(spark, texts, ids)
    left = drop_similar_lines(docs)
    assert left.columns == docs.columns
    left = {r.doc_id: r for r in left.collect()}
    for i, text in by.items():
        lost = {p for d, p in want if d == i}
        if not lost:
            assert left[i].text == text and left[i].n_chars == (None if text is None else len(text))
        else:
            rest = "\n".join(line for p, line in enumerate(text.split("\n")) if p not in lost)
            assert (i in left) == bool(rest.split())
            if i in left:
                assert left[i].text == rest and left[i].n_chars == len(rest)


def test_large_list_of_ids_is_joined_by_shuffle(spark, monkeypatch):
    texts = corpus(3)
    want = brute(texts, range(len(texts)))
    monkeypatch.setattr(linededup, "SHIPPED_IDS", 0)
    got = line_report(docs_of(spark, texts)).collect()
    assert {(r.doc_id, int(p)) for r in got for p in r.removed.split(",") if p} == want


def test_only_the_tables_that_are_still_read_stay(spark):
    folder = Path(scratch_root(spark).removeprefix("file://"))
    before = set(folder.glob("*"))
    line_report(docs_of(spark, corpus(3))).collect()
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before if any(p.rglob("*.parquet"))} == {"ranks", "sets", "settled"}


def test_ids(spark):
    line = prose(7, 20)
    got = line_report(docs_of(spark, [line, line, line, line + "\n" + line], [None, 3, 3, 4])).collect()
    assert {(r.doc_id, r.removed) for r in got} == {(None, ""), (3, ""), (4, "0,1")}
    assert line_report(docs_of(spark, [])).count() == 0
    assert drop_similar_lines(docs_of(spark, [])).count() == 0


def test_copies_and_variants_do_not_list_their_pairs(spark):
    """The prefix join asks only for sets that their leader leaves open."""
    texts = corpus(4)
    from dunlin.llm.common import text_of
    from fractions import Fraction
    t = Fraction("0.8")
    plain = text_of(docs_of(spark, [*texts, *texts]), "doc_id", "text")
    sets = linededup._sets(plain, t, 1).cache()
    assert sets.count() == len({line for x in texts for line in x.split("\n") if line.split()})
    settled = linededup._settled(plain, sets, t).cache()
    everything = linededup._prefix_pairs(sets, settled.limit(0), t).count()
    assert linededup._prefix_pairs(sets, settled, t).count() < everything / 5


def test_lines_of_any_length_are_compared(spark):
    texts = ["All rights reserved.\n- - - - -\na b c d\nend", "a b c d e\nAll rights reserved.\n\n- - - - -", "x y\n  \n- -\nAll rights\n\n", "end", "x y\nnew", None, ""]
    lines = [(i, p, set(line.split())) for i, text in enumerate(texts) for p, line in enumerate((text or "").split("\n")) if line.split()]
    want = {(i, p) for k, (i, p, s) in enumerate(lines) if any(5 * len(s & o) >= 4 * len(s | o) for _, _, o in lines[:k])}
    assert {(1, 0), (1, 1), (1, 3), (2, 2), (3, 0), (4, 0)} == want
    docs = docs_of(spark, texts)
    got = line_report(docs, min_words=1).collect()
    assert {(r.doc_id, int(p)) for r in got for p in r.removed.split(",") if p} == want
    left = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert left == {0: texts[0], 2: "x y\n  \nAll rights\n\n", 4: "new", 5: None, 6: ""}


def test_sets_that_share_only_frequent_words_are_not_shipped_again(spark, monkeypatch):
    """A crowded signature is searched further only if its first set met one like it."""
    words = [f"w{i}" for i in range(600)]
    a, b, *rest = [r.w for r in spark.createDataFrame([(w,) for w in words], "w string").orderBy(F.xxhash64("w")).collect()]
    apart = [" ".join([a, b, *rest[k * 12: k * 12 + 12]]) for k in range(40)]
    line = rest[480:510]
    close = [" ".join([*line, f"n{k}"]) for k in range(20)]
    rows = {}

    def kept(df, label="stage", held=linededup.materialize):
        out = held(df, label)
        rows[label] = rows.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(linededup, "materialize", kept)
    texts = [*apart, *close]
    got = line_report(docs_of(spark, texts)).collect()
    assert {(r.doc_id, int(p)) for r in got for p in r.removed.split(",") if p} == brute(texts, range(len(texts))) == {(k, 0) for k in range(41, 60)}
    assert 0 < rows["crowded"] <= 4 * len(close)


def test_sets_at_the_bound_are_found_whichever_is_larger(spark):
    """Fronts hold a shared word of every similar pair, and the table of sets counts equal lines."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(90)]
    texts = []
    for n in (4, 5, 8, 9, 10, 12, 18, 20, 27):
        for m in range(n, n * 5 // 4 + 1):
            # The least overlap that is similar, and one less.
            need = -(-4 * (n + m) // 9)
            for common in (need, need - 1):
                own = draw.sample(words, n + m - common)
                pair = [" ".join(own[:n]), " ".join(own[n - common:])]
                draw.shuffle(pair)
                texts += pair
    texts += texts[:3]
    docs = docs_of(spark, texts)
    got = line_report(docs).collect()
    assert {(r.doc_id, int(p)) for r in got for p in r.removed.split(",") if p} == brute(texts, range(len(texts)))
    from dunlin.llm.common import text_of
    from fractions import Fraction
    t = Fraction("0.8")
    sets = linededup._sets(text_of(docs, "doc_id", "text"), t, 1).cache()
    assert {r.doc_id: r.copies for r in sets.collect()} == {i: texts.count(x) for i, x in enumerate(texts) if texts.index(x) == i}
    # Without signatures the prefix join alone finds the same sets.
    none = sets.select("doc_id", "pos").limit(0)
    plain = text_of(docs, "doc_id", "text")
    found = linededup._verified(plain, linededup.materialize(linededup._prefix_pairs(sets, none, t), "pairs"), t)
    lone = [x if texts.index(x) == i else None for i, x in enumerate(texts)]
    assert {(r.doc_id, r.pos) for r in found.collect()} == brute(lone, range(len(texts)))

import random
import re
import zlib
from collections import Counter

import pytest

from dunlin.llm import oracles
from dunlin.llm.queries import op11_spelling_variants
from dunlin.llm.spelling import count_words, neighbour_groups, near_in_group, near_words, roots, variant_groups
from tests.llm.common import ODD, docs_of


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    form, rows = {}, {}
    for word, n in counts.items():
        near = sorted(((-m, other) for other, m in counts.items() if is_near(word, other)))
        rows[word] = [n, len(near), None]
        if near and -near[0][0] >= ratio * n:
            form[word], rows[word][2] = near[0][1], -near[0][0]
    out = []
    for word, row in rows.items():
        root = word
        while root in form:
            root = form[root]
        out.append((word, form.get(word), root, *row))
    return sorted(out)


def vocabulary(seed, words, letters):
    draw = random.Random(seed)
    return {"".join(draw.choice(letters) for _ in range(draw.randrange(1, 9))): draw.choice([5, 6, 25, 30, 150, 900, 4500]) for _ in range(words)}


def table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.mark.parametrize("letters, limit", [("ab", 4096), ("abcdeéÿ", 4096), ("ab", 5), ("abc", 2), ("abcdefg", 20)])
def test_equals_comparing_all_pairs(spark, letters, limit):
    """With a low limit most groups are cut down to a region of one letter."""
    counts = vocabulary(3, 250, letters)
    rows = variant_groups(table(spark, counts), limit=limit)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, rows.collect())) == brute(counts)


def test_groups_are_bounded_and_copies_do_not_grow(spark):
    """A third of the words share a beginning; cut groups stay within the limit or have one open letter."""
    draw = random.Random(1)
    words = {"commonstart" + "".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(1500)}
    words |= {"".join(draw.choice("abcdefghij") for _ in range(12)) for _ in range(3000)}
    groups = neighbour_groups(table(spark, dict.fromkeys(words, 5)), limit=50).cache()
    sizes = groups.groupBy("t", "low", "high", "key").count().where("high - low > 1").agg({"count": "max"}).first()[0]
    assert sizes <= 50
    assert groups.count() <= 8 * len(words)


def test_words_of_very_different_lengths(spark):
    counts = {"x" * 50_000: 5, "x" * 49_999: 25, "x" * 49_998: 125, "y": 5, "": 5, "é": 25, "ab": 5}
    assert sorted(map(tuple, variant_groups(table(spark, counts)).collect())) == brute(counts)


def test_long_chains_reach_their_root(spark):
    links = spark.createDataFrame([(str(i), str(i + 1)) for i in range(40)] + [("a", "7"), ("b", "c")], "word string, form string")
    found = {r.word: r.root for r in roots(links).collect()}
    assert found == {**{str(i): "40" for i in range(40)}, "a": "40", "b": "c"}


def test_ties_go_to_the_smallest_in_code_points(spark):
    rows = near_words(table(spark, {"ba": 9, "éa": 9, "za": 9, "aa": 1, "a": 9})).where("word = 'aa'").collect()
    assert [(r.n_near, tuple(r.best)) for r in rows] == [(4, (9, "a"))]


def test_insertion_at_the_end_of_the_open_region():
    assert near_in_group(["abc", "abcd", "abca"], 3, 1, 3) == {0: [2, 1], 1: [1, 0], 2: [1, 0]}


def noisy_counts(ids, texts):
    counts = Counter()
    for doc, text in zip(ids, texts):
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(8)
    stems = ["".join(draw.choice("aeinrstÉéÈ") for _ in range(draw.randrange(5, 11))) for _ in range(60)]
    texts = ODD + ["É" * 9 + "×" + "÷a1b" + " ".join(draw.choice(stems[: draw.choice([5, 60])]) for _ in range(300)) for _ in range(150)]
    ids = [None, None, 4, 4, *range(100, len(texts) + 96)]
    docs_of(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op11_spelling_variants(spark, str(tmp_path))
    wanted = brute(noisy_counts(ids, texts))
    assert sum(r[1] is not None for r in wanted) > 10
    assert sorted(map(tuple, rows.collect())) == wanted


def test_sql_knows_the_checksum(spark, data_dir):
    """The SQL works out CRC-32 from its polynomial; its rows equal those of the query on the smallest table."""
    import duckdb

    folder = data_dir.replace("sf0.01", "sf0.001")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet'")
    assert sorted(con.sql(oracles.SQL["op11_spelling_variants"]).fetchall()) == sorted(map(tuple, op11_spelling_variants(spark, folder).collect()))


def test_without_rows_and_without_links(spark):
    assert variant_groups(count_words(docs_of(spark, []))).count() == 0
    assert variant_groups(table(spark, {"alone": 5})).collect()[0].root == "alone"
    with pytest.raises(ValueError):
        variant_groups(table(spark, {"alone": 5}), ratio=1)

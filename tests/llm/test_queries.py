"""The registered queries over whole tables, and the pipeline against a brute-force version."""

import importlib
import os

import duckdb
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from dunlin.llm.packing import binary_lengths
from dunlin.llm.queries import QUERIES, SQL
from dunlin.llm.toxicity import fit_toxicity, score_toxicity
from tests.llm.common import prose
from tests.llm.test_decontamination import brute as windows
from tests.llm.test_linededup import brute as similar_lines

def jaccard_roots(texts, k=5, least=0.8):
    """Smallest id of each group of texts whose sets of word shingles are linked by a similarity of ``least``."""
    sets = {}
    for i, t in texts.items():
        words = t.lower().split()
        sets[i] = {tuple(words[j:j + k]) for j in range(max(1, len(words) - k + 1))}
    root = {i: i for i in texts}
    for _ in texts:
        before = dict(root)
        for i, a in sets.items():
            for j, b in sets.items():
                if len(a & b) >= least * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
        if root == before:
            return root
    return root


TABLES = "documents embeddings pages benchmark labels conversations".split()


def text(x):
    return "" if x is None or x != x else str(int(x)) if isinstance(x, float) and x == int(x) else str(x)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    if not os.path.exists(folder):
        pytest.skip("test tables are not present")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = con.execute(SQL[name])
    columns = [c[0] for c in found.description]
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(map(text, r)) for r in got.select(*columns).collect()) == sorted(tuple(map(text, r)) for r in found.fetchall())


def test_all_are_registered():
    entry = importlib.import_module("__spark_entry__")
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_pipeline_matches_brute_force(spark, tmp_path):
    base = prose(1, 60, 2000)
    texts = {i: prose(100 + i, 30, 2000) + "\n" + prose(300 + i, 25, 2000) for i in range(40)}
    short = "one short line"
    near = prose(11, 45, 2000).split()
    texts |= {50: "own words of text fifty\n" + short, 51: "own words of text fiftyone here\n" + short, 52: "- - -\nother words of its own", 53: "- - -\nyet other words"}
    # The same words in other lines, so that line dedup leaves them: 37 of 45 shingles shared (0.82), then 36 of 46 (0.78).
    wrapped = lambda words, first: "\n".join([" ".join(words[:first])] + [" ".join(words[i:i + 9]) for i in range(first, 45, 9)])
    far = prose(12, 45, 2000).split()
    texts |= {54: wrapped(near, 9), 55: wrapped(near[:-4] + ["changed"] + near[-3:], 4), 56: wrapped(far, 9), 57: wrapped(far[:-5] + ["changed"] + far[-4:], 4)}
    texts |= {40: base, 41: base + " tail", 42: base, 43: None, 44: "", 45: prose(7, 12, 900) + "\n" + prose(9, 30, 900), 46: prose(8, 30, 900) + "\nvile vile " + prose(10, 8, 900)}
    for i in range(100, 160):
        texts[i] = prose(900 + i, 20, 2000) + (" vile awful" if i % 3 == 0 else "")
    bench = [(1, prose(7, 12, 900)), (2, "nothing of it here at all anywhere in any of the texts")]
    spark.createDataFrame([(i, t, "en", "s", 0 if t is None else len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(100, 160)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()

    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = fit_toxicity(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    left = {i: texts[i] for i in (r.doc_id for r in score_toxicity(docs, model).where("kept").collect())}
    assert 46 not in left and not any(i in left for i in range(102, 160, 3)) and set(range(46)) <= set(left)
    gone = similar_lines(list(left.values()), list(left), least=1)
    assert (51, 1) in gone and (53, 0) in gone
    for i, value in list(left.items()):
        lost = {p for d, p in gone if d == i}
        if lost:
            left[i] = "\n".join(line for p, line in enumerate(value.split("\n")) if p not in lost)
            if not left[i].split():
                del left[i]
    held = {i: t for i, t in left.items() if (t or "").split()}
    roots = jaccard_roots(held)
    left = {i: t for i, t in left.items() if i not in roots or roots[i] == i}
    assert {54, 56, 57} <= set(left) and 55 not in left
    hit = dict(zip(left, windows(list(left.values()), bench)))
    left = {i: t for i, t in left.items() if not hit[i][1]}
    assert 45 not in left and {43, 44, 40} <= set(left) and not {41, 42} & set(left)
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((i, n) for i, t in left.items() for n in binary_lengths(len(whole.encode(t or "", add_special_tokens=False).ids) + 1))
    assert sorted((r.doc_id, r.length) for r in rows) == want


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0

import hashlib

from dunlin.llm.sharding import assign_shards, write_shards
from tests.llm.common import ODD, docs_of, prose


def brute(texts, ids, limit):
    bits = [format(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), "060b") for i in ids]
    size = [len((t or "").encode()) for t in texts]
    out = []
    for mine in bits:
        for k in range(61):
            group = [n for b, n in zip(bits, size) if b[:k] == mine[:k]]
            if sum(group) <= limit or len(group) == 1:
                out.append((mine[:k], k, sum(group), len(group)))
                break
    return out


def test_shards_match_brute_force(spark):
    texts = [*ODD, *[prose(i, 20 + i % 90) for i in range(300)]]
    for limit in (500, 5_000, 10**9):
        got = {r.doc_id: (r.shard, r.depth, r.shard_bytes, r.shard_docs) for r in assign_shards(docs_of(spark, texts), limit).collect()}
        assert [got[i] for i in range(len(texts))] == brute(texts, range(len(texts)), limit)


def test_one_key_with_most_rows_is_split(spark):
    docs = docs_of(spark, ["0123456789"] * 400 + ["x" * 10] * 50, [7] * 400 + list(range(100, 150)))
    rows = assign_shards(docs, 100).collect()
    assert len(rows) == 450 and max(r.shard_bytes for r in rows) <= 100
    sums = {}
    for r in rows:
        sums[r.shard] = sums.get(r.shard, 0) + r.bytes
    assert {r.shard: r.shard_bytes for r in rows} == sums
    names = sorted(sums)
    assert not any(b.startswith(a) and a != b for a, b in zip(names, names[1:]))


def test_null_ids_empty_and_written(spark, tmp_path):
    assert assign_shards(docs_of(spark, [])).count() == 0
    assert {r.shard for r in assign_shards(docs_of(spark, ["a", "b"], [None, 1])).collect()} == {""}
    docs = docs_of(spark, [prose(i, 30) for i in range(60)])
    write_shards(docs, f"{tmp_path}/s", 2_000)
    assert spark.read.parquet(f"{tmp_path}/s").count() == 60
    docs = docs_of(spark, [prose(i, 30) for i in range(30)], [None] * 10 + [4] * 10 + list(range(10)))
    write_shards(docs, f"{tmp_path}/t", 500)
    left = spark.read.parquet(f"{tmp_path}/t")
    assert sorted(r.text for r in left.collect()) == sorted(r.text for r in docs.collect())
    assert left.where("doc_id IS NULL").count() == 10 and left.select("shard_bits").distinct().count() > 1

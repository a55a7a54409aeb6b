"""Plans on tables in which one key holds a third of all rows."""

from pathlib import Path

import duckdb
import pytest

from check import TABLES, canon
from dunlin.plans import PLANS, Tables

HOT = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END::BIGINT AS o_custkey)",
    "lineitem": "* REPLACE (CASE WHEN hash(l_extendedprice) % 3 = 0 THEN 5 ELSE l_orderkey END::BIGINT AS l_orderkey, "
                "CASE WHEN hash(l_extendedprice) % 3 = 0 THEN 7 ELSE l_partkey END::BIGINT AS l_partkey)",
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 8 ELSE user_id END::BIGINT AS user_id)",
    "documents": "* REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'same text. of the and' ELSE text END AS text)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    source = Path("/root/testdata/sf0.001")
    if not source.exists():
        pytest.skip("test tables are not present")
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        path = folder / f"{name}.parquet"
        con.execute(f"COPY (SELECT {HOT.get(name, '*')} FROM '{source}/{name}.parquet') TO '{path}' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return str(folder), con


@pytest.mark.parametrize("name", [
    "J07_join_duplicate_build_keys", "J14_segment_revenue", "W01_latest_per_key", "W05_linear_fill", "Y03_linear_fill",
    "Z05_exact_stratified_sample", "A16_quantiles_exact", "E05_sentiment", "G05f_zigzag", "G10_triangle_count", "X04_grouped_apply",
    "W02_random_k_per_stratum", "E03_dictionary_match", "T17_polled_source", "G09_strongly_connected", "G14_bfs", "A17_pivot"])
def test_hot_keys(spark, skewed, name):
    folder, con = skewed
    got = PLANS[name].build(Tables(spark, folder))
    cols = sorted(got.columns)
    rel = con.execute(PLANS[name].sql)
    names = [d[0] for d in rel.description]
    want = sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in rel.fetchall())
    assert sorted(tuple(canon(r[c]) for c in cols) for r in got.collect()) == want

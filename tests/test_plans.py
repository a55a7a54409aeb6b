"""Oracle comparison of plans and assertions on their physical form."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canon
from dunlin.plans import PLANS, Tables, registry

SAMPLE = """P07 P12 J05 J09 J14_segment J16_merge_shared O05_drop_duplicates U02 F05 F15 M03 M08
A06 A11 A13 A16_quantiles_exact A20 W01 W03 Y03 Z05 S04 S16 S17 K04 C05 T05_watermark_append T15
X05 G05f G10 L13 N10 N13_area E01 E05""".split()


def chosen():
    if os.environ.get("DUNLIN_FULL"):
        return sorted(PLANS)
    return sorted(n for n in PLANS if any(n.startswith(s) for s in SAMPLE) and PLANS[n].sql)


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", chosen())
def test_plan_matches_oracle(spark, data_dir, duck, name):
    got = entry.queries()[name](spark, data_dir)
    cols = sorted(got.columns)
    rows = sorted(tuple(canon(r[c]) for c in cols) for r in got.collect())
    assert rows
    rel = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    assert rows == sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in rel.fetchall())


def physical(spark, folder, name):
    return PLANS[name].build(Tables(spark, folder))._jdf.queryExecution().executedPlan().toString()


def test_every_section_is_covered():
    sections = {n[0] for n in PLANS}
    assert sections == set("PJOUFMAWYZSKCTXGLNE")
    # The training-text queries come on top where their folder is present.
    assert set(entry.queries()) == set(PLANS) | set(entry.LLM_QUERIES) and not set(PLANS) & set(entry.LLM_QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_does_without_a_missing_package():
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] in ("tiktoken", "xxhash", "public_tokenizers"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
from dunlin.plans import PLANS
assert set(entry.queries()) == set(PLANS) and entry.LLM_QUERIES == {}
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(entry.__file__).parent)


def test_join_forms(spark, data_dir):
    assert "CartesianProduct" not in physical(spark, data_dir, "J04_join_then_where")
    assert "BroadcastHashJoin" in physical(spark, data_dir, "J08_broadcast_join")
    assert "SortMergeJoin" in physical(spark, data_dir, "J13_sort_merge_join_scrambled")


def test_stored_order_is_used(spark, data_dir):
    """Neither side of the merge join is shuffled or sorted again."""
    plan = physical(spark, data_dir, "J12_merge_join_ordered")
    join = plan[plan.index("SortMergeJoin"):]
    assert join.count("Bucketed: true") == 2 and "Exchange" not in join and "Sort [" not in join


def test_scans_are_pruned(spark, data_dir):
    plan = physical(spark, data_dir, "P07_filter_predicates")
    assert "PushedFilters: [IsNotNull" in plan
    assert "l_shipdate" not in plan and "l_suppkey" not in plan
    assert "PartitionFilters: [isnotnull(l_returnflag" in physical(spark, data_dir, "K04_partitioned_write")
    assert "WindowGroupLimit" in physical(spark, data_dir, "W01_latest_per_key")


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["c_mktsegment", "revenue", "n_orders"]


def test_partitions_grow_with_the_files(spark, data_dir, monkeypatch):
    size = (Path(data_dir) / "lineitem.parquet").stat().st_size
    monkeypatch.setattr(registry, "SPREAD_BYTES", size // 40, raising=False)
    table = Tables(spark, data_dir)
    spread = table.spread("lineitem")
    assert spread.rdd.getNumPartitions() >= 40 and spread.count() == table.lineitem.count()

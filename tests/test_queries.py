"""Every registered query of the library against its DuckDB SQL on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from tallyard.plans import ORACLES, QUERIES
from tallyard.plans.registry import Warehouse
from tallyard.sources import shape
from tallyard.sources.shape import Lake

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}") if math.isfinite(v) else str(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(norm, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(repr(tuple(norm(r[c]) for c in columns)) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(norm(r[names.index(c)]) for c in columns)) for r in result.fetchall())
    assert got == want


@pytest.mark.parametrize("name", ["c15_fact_sales", "c19_gl", "b5_inventory_cat", "k8_headline", "g17_hashed_bag"])
def test_spread_tables_give_the_same(spark, duck, name, monkeypatch):
    """Small tables, dealt over the cores."""
    monkeypatch.setattr(shape, "TASK_BYTES", 1 << 10)
    test_same_as_sql(spark, duck, name)


def test_only_small_tables_are_spread(spark, monkeypatch):
    assert Lake(spark, str(DATA)).spread("lineitem", "l_orderkey").rdd.getNumPartitions() == 1  # not worth a task more
    monkeypatch.setattr(shape, "TASK_BYTES", 1 << 10)
    lines = Lake(spark, str(DATA)).spread("lineitem", "l_orderkey")
    assert lines.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    numbered = Lake(spark, str(DATA)).lines.select("l_orderkey", "line_no")._jdf.queryExecution().executedPlan().toString()
    assert numbered.count("Exchange hashpartitioning(l_orderkey") == 1  # numbering uses the same exchange
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:  # each core has splits enough
        plan = Lake(spark, str(DATA)).spread("lineitem", "l_orderkey")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_dealt_tasks_stay_small(spark, monkeypatch):
    """A task's share of a table that is dealt doesn't grow with the table: more tasks than cores."""
    monkeypatch.setattr(shape, "TASK_BYTES", 1 << 10)
    monkeypatch.setattr(shape, "DEALT_BYTES", 8 << 10)
    lake = Lake(spark, str(DATA))
    tasks = lake.spread("lineitem", "l_orderkey").rdd.getNumPartitions()
    assert tasks > spark.sparkContext.defaultParallelism
    assert (tasks - 1) * (8 << 10) < lake.size("lineitem") <= tasks * (8 << 10)


def test_facts_of_marts_meet_crosswalks_once(spark):
    """Lines meet crosswalks with their master data, before they are written: marts join no line with them again."""
    facts = Warehouse(spark, str(DATA)).facts
    for name in ("invoices", "sales", "purchases", "inventory", "places"):
        plan = facts[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and plan.count("Relation") == 1, name


def test_headline_of_awkward_masters(spark, tmp_path):
    """Keys that a master table repeats or lacks, and a nation that no table knows: as in SQL."""
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    changes = {
        "customer": "SELECT * REPLACE (CASE WHEN c_custkey % 50 = 7 THEN 99 ELSE c_nationkey END AS c_nationkey) FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey < 4",
        "supplier": "SELECT * FROM supplier WHERE s_suppkey <> 5 UNION ALL SELECT * FROM supplier WHERE s_suppkey < 3",
        "part": "SELECT * FROM part WHERE p_partkey % 40 <> 3 UNION ALL SELECT * FROM part WHERE p_partkey % 30 = 1 UNION ALL SELECT * FROM part WHERE p_partkey % 60 = 1",
    }
    for t in ("nation", "region", "customer", "supplier", "part", "orders", "lineitem"):
        c.sql(f"COPY ({changes.get(t, f'SELECT * FROM {t}')}) TO '{tmp_path}/{t}.parquet'")
    for t in changes:
        c.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    for name in ("k8_headline", "k8_states"):
        got = QUERIES[name](spark, str(tmp_path))
        want = c.execute(ORACLES[name]).fetchall()
        assert len(want) == 1 and [norm(v) for v in got.first()] == [norm(v) for v in want[0]]
        assert got.columns == [d[0] for d in c.description]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_invariants(spark):
    growth = QUERIES["k5_growth"](spark, str(DATA)).first()
    assert abs(growth.organic_share + growth.acquired_share - 1) < 1e-12
    gone = {r[0] for r in QUERIES["r3_tombstones"](spark, str(DATA)).collect()}
    assert gone and not gone & {r[0] for r in QUERIES["r1_source_keys"](spark, str(DATA)).collect()}


def test_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())

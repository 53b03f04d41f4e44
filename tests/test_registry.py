"""Every query of the library against its SQL in DuckDB."""

import math

import duckdb
import pytest

from glossmill.plans import registry, registry_files, registry_jobs

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = (registry.QUERIES | registry_files.QUERIES | registry_jobs.QUERIES)[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.sql(registry.ORACLES[name])
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    got = sorted((plain(tuple(r)) for r in df.select(*columns).collect()), key=repr)
    assert got == sorted((plain(tuple(r[i] for i in order)) for r in want.fetchall()), key=repr)


def test_flagship_and_hash(spark):
    assert registry.flagship(spark, SF).count() > 0
    first = registry.QUERIES["manifest_hash"](spark, SF).collect()
    assert first == registry.QUERIES["manifest_hash"](spark, SF).collect() and len(first) == 1


def test_relational_queries_stay_in_the_jvm(spark):
    for name in registry.QUERIES:
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan, name


def test_filters_and_columns_reach_the_scan(spark):
    plan = registry.QUERIES["split_filter"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan

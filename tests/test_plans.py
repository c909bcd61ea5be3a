"""Plan checks: broadcast lookups, pushed filters, partition pruning, top-k limit, no Python UDFs."""

import pytest

import __spark_entry__ as E
from strata.plans import driver as D
from strata.plans import queries as Q

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_lookups_are_broadcast(spark):
    p = plan(D.enriched(spark, SF))
    assert p.count("BroadcastHashJoin") >= 5


def test_top_routes_uses_window_group_limit(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "WindowGroupLimit" in plan(Q.top_routes(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_slice_scan_prunes_partitions(spark):
    df = E.queries()["slice_scan"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [source_year_month" in p and "IN (1998-12,1999-01,1999-02)" in p


@pytest.mark.parametrize("name", sorted(set(Q.registry()) - {"load_metrics", "replace_slices", "upsert",
                                                              "clustered_layout", "drift_normalize",
                                                              "parallel_arrays_to_rows", "slice_scan"}))
def test_no_python_udf(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_column_pruning_on_lineitem(spark):
    p = D.bronze(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "l_partkey" not in p and "l_comment" not in p


def test_ingest_rules_reach_the_scan(spark, tmp):
    from strata.operators.rules import trip_rules
    from strata.sources import readers as R
    from strata.sources import schemas as S
    from test_pipeline import _month_file
    _month_file(f"{tmp}/m.parquet", 2025, 1, 10)
    df = R.read_drifting(spark, {"2025-01": f"{tmp}/m.parquet"}, S.TRIP_DRIFT)
    valid, _ = trip_rules(slice_value="2025-01").split(df)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        p = plan(valid)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = p[p.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "LessThan(tpep_pickup_datetime" in pushed
    assert "GreaterThanOrEqual(trip_distance,0.0)" in pushed

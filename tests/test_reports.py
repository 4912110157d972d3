"""Every report against its SQL twin, and the shape of the plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from adtally.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")

# The reports of this library alone, whatever else is registered.
QUERIES = {name: entry.queries()[name] for name in catalog()}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
WRITES = ("src", "snk", "str")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_every_report_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) > 110


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_report_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    cursor = db.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, map(tuple, df.collect())) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITES)))
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "ExistingRDD"):
        assert forbidden not in plan, forbidden


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_period_reports_shuffle_once_by_user(spark):
    assert plan_of(QUERIES["rx1_first_in_period"](spark, SF)).count("Exchange hashpartitioning") == 1


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["rx3_gaps"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_filters_reach_the_files(spark, tmp_path):
    from adtally.operators import arppu
    from adtally.plans import frames
    from adtally.sources import writers as wr

    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    path = str(tmp_path / "events")
    wr.copy_table(frames.user_events(spark, SF), path)
    stored = spark.read.parquet(path)
    plan = plan_of(arppu.first_period(stored, "1998-08-01"))
    assert "LessThanOrEqual(event_date" in plan and "EqualTo(event_type,deposit)" in plan
    pruned = plan_of(arppu.trend(stored.filter("event_month >= '1998-01'"), "brand_a"))
    assert "PartitionFilters: [isnotnull(event_month" in pruned


def test_listed_users_are_filtered_before_the_shuffle(spark):
    """A short list is broadcast and applied below the aggregation."""
    plan = plan_of(QUERIES["rx6_user_list_report"](spark, SF))
    assert plan.index("partial_min") < plan.index("LeftSemi")  # plans print from the top down


def test_top_k_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["bd6_format_extremes"](spark, SF))


def test_no_window_sees_a_whole_group_when_trimming(spark):
    plan = plan_of(QUERIES["sp4_trimmed"](spark, SF))
    assert "percent_rank" not in plan


def test_hot_keys_join_on_more_than_the_key(spark):
    types = plan_of(QUERIES["dp1_deposit_types"](spark, SF))
    cohorts = plan_of(QUERIES["ar3_first_week"](spark, SF))
    brands = plan_of(QUERIES["att9_map_by_user"](spark, SF))
    assert "external_user_id" in types and "event_date" in types
    assert "_slot" in cohorts and "_part" in brands

"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from landstrata.plans.registry import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    made = []

    def make(*given):
        made.append(entry.queries()[name](*given))
        return made[0]

    assert compare(spark, con, sf, make, SQL.get(name)) is None
    # No pairing of every row with every row, and no row-at-a-time Python.
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan(made[0]))


def test_partition_and_columns_are_pruned(spark, sf):
    found = plan(entry.queries()["scan_partition"](spark, sf))
    assert "PartitionFilters: [isnotnull(part_key" in found
    assert "ReadSchema: struct<fid:bigint,huc12:string,area_km2:double>" in found


def test_box_reaches_the_scan(spark, sf):
    found = plan(entry.queries()["units_in_box"](spark, sf))
    for side in ("GreaterThanOrEqual(bbox.xmax", "LessThanOrEqual(bbox.xmin", "GreaterThanOrEqual(bbox.ymax", "LessThanOrEqual(bbox.ymin"):
        assert side in found
    assert "geometry" not in found


def test_curve_key_stays_in_generated_code(spark, sf):
    found = entry.queries()["hilbert_key"](spark, sf)
    text = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "codegen")
    assert "WholeStageCodegen" in text and "Python" not in plan(found)


def test_entry(spark):
    assert entry.entry(spark).columns == ["part_key", "units", "area", "first_fid"]


def test_every_query_is_checked():
    assert set(QUERIES) <= set(SQL) and set(QUERIES) <= set(entry.queries())

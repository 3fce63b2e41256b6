"""Every query against its SQL counterpart on the smallest tables, and the shape of some plans."""

import os
import re

import pytest

import __spark_entry__ as entry
from tests.compare import assert_same
from tidewright.plans import job_queries, workload
from tidewright.plans.oracle import ORACLE
from tidewright.session import shuffle_partitions

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {**workload.QUERIES, **job_queries.QUERIES}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert assert_same(QUERIES[name](spark, FOLDER), FOLDER, ORACLE[name]) > 0


def test_views(spark):
    workload.create_sales_views(spark, FOLDER)
    assert spark.table("v_stock_by_brand").count() == 25 and spark.table("v_stock_by_year").count() == 5


def test_entry(spark, monkeypatch):
    monkeypatch.setenv("ENTRY_SF_DIR", FOLDER)
    assert entry.entry(spark).columns == ["p_brand", "y1995", "y1996", "y1997", "y1998", "y1999"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "qj"))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for bad in ("NestedLoop", "Cartesian", "Python", "ArrowEval", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] in "qj"))
def test_no_join_is_forced_to_broadcast(spark, name):
    """With broadcasting by size switched off, only rows bounded by construction are still broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Numbering shares the sizes of its partitions: a row each.
    numbered = ("q25_json_export", "q26_xml_export", "q27_json_per_date", "q28_customer_documents")
    assert ("Broadcast" in text) == (name in numbered)


@pytest.mark.parametrize(
    "name, column",
    [
        ("q04_item_qty_year", "o_orderdate"),
        ("q10_few_mugs", "o_orderdate"),
        ("q11_updated_since", "o_orderdate"),
        ("q12_order_detail", "l_shipdate"),
        ("q14_top_delivery", "o_orderdate"),
        ("q18_pivot_year", "o_orderdate"),
        ("i01_cutoff_extract", "ts"),
    ],
)
def test_date_filters_reach_the_scan(spark, name, column):
    assert f"GreaterThanOrEqual({column}" in plan(QUERIES[name](spark, FOLDER)) or f"GreaterThan({column}" in plan(
        QUERIES[name](spark, FOLDER)
    )


def test_scans_read_only_the_columns_used(spark):
    text = plan(QUERIES["q18_pivot_year"](spark, FOLDER))
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "struct<p_partkey:bigint,p_brand:string>" in text


def test_the_sql_function_becomes_a_join(spark):
    text = plan(QUERIES["q20_order_total"](spark, FOLDER))
    assert "LeftOuter" in text and "Subquery" not in text


def test_shuffle_partitions_grow_with_the_input():
    assert shuffle_partitions(10**9) == 200
    assert shuffle_partitions(10**12) == 3726
    assert shuffle_partitions(100 * 10**12) == 372_530


def scans(df, table):
    return plan(df).count(f"/{table}.parquet")


@pytest.mark.parametrize(
    "name, table, most",
    [("q04_item_qty_fanout", "lineitem", 2), ("o01_table_checks", "lineitem", 5)],
)
def test_scans_of_the_largest_table(spark, name, table, most):
    """As planned, before equal exchanges are merged when the query runs."""
    assert scans(QUERIES[name](spark, FOLDER), table) <= most


def test_lines_of_all_years_are_not_sorted_beside_the_sums(spark):
    text = plan(QUERIES["q04_item_qty_fanout"](spark, FOLDER))
    assert "ShuffledHashJoin" in text and "Sort" not in text and "keys=[l_orderkey#" in text
    assert not re.search(r"keys=\[l_orderkey#\d+L?, l_partkey", text)


def test_nested_rows_become_text_after_they_are_sorted(spark):
    import pyarrow.parquet as pq

    files = QUERIES["q27_json_per_date"](spark, FOLDER).inputFiles()
    columns = pq.read_schema(files[0].removeprefix("file:").replace("///", "/")).names
    assert "text" not in columns and "_first" not in columns


def test_chained_lookups_read_their_left_side_once(spark):
    text = QUERIES["q01_contact_lookup"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    # Once for the rows, and once per lookup for the keys alone.
    assert text.count("c_mktsegment#") >= 1 and sum("Relation [c_custkey" in line for line in text.splitlines()) == 3

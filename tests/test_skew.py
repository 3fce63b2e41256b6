"""Tables in which one key holds a third of the rows: results stay whole, and hot keys are cut up."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.compare import assert_same
from tests.test_queries import ORACLE, QUERIES
from tidewright import schemas
from tidewright.operators import any_key_left_join, nest_by, null_safe_not_in, without
from tidewright.plans import medallion

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The small tables with a third of the lines on one order and one part, a third of the orders on one
    customer and one day, a third of the events on one user, and exact copies among all of them."""
    folder = str(tmp_path_factory.mktemp("skewed"))

    def third(column, value):
        hot = F.pmod(F.xxhash64("l_shipdate", "l_extendedprice"), F.lit(3)) == 0
        return F.when(hot, F.lit(value).cast("bigint")).otherwise(F.col(column)).alias(column)

    for name in TABLES:
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        if name == "lineitem":
            hot = third("l_orderkey", 7), third("l_partkey", 11)
            df = df.select(*[hot[0] if c == "l_orderkey" else hot[1] if c == "l_partkey" else F.col(c) for c in df.columns])
            copies = df.orderBy("l_orderkey", "l_extendedprice").limit(1).withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(1500)))).drop("_n")
            df = df.unionByName(copies)
        elif name == "orders":
            hot = F.pmod(F.col("o_orderkey"), F.lit(3)) == 0
            df = df.withColumn("o_custkey", F.when(hot, F.lit(5)).otherwise(F.col("o_custkey")).cast("bigint"))
            df = df.withColumn("o_orderdate", F.when(hot, F.expr("TIMESTAMP_NTZ'1996-01-06'")).otherwise(F.col("o_orderdate")))
        elif name == "events":
            hot = F.pmod(F.col("event_id"), F.lit(3)) == 0
            df = df.withColumn("user_id", F.when(hot, F.lit(3)).otherwise(F.col("user_id")).cast("bigint"))
        elif name == "supplier":
            df = df.withColumn("s_nationkey", F.lit(4))
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder




@pytest.mark.parametrize("name", sorted(QUERIES))
def test_results_on_skewed_tables(spark, skewed, name, monkeypatch):
    import duckdb

    from tests import compare

    def rows(folder, sql):
        connection = duckdb.connect()
        for table in TABLES:
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        result = connection.execute(sql)
        return [c[0] for c in result.description], result.fetchall(), None

    monkeypatch.setattr(compare, "oracle_rows", rows)
    assert_same(QUERIES[name](spark, skewed), skewed, ORACLE[name])


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def eager_skew_handling(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW_SETTINGS}
    for key, value in SKEW_SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def splits(df):
    return final_plan(df).split("== Initial Plan ==")[0].count("skew=true")


@pytest.fixture
def hot(spark, folder):
    """60,000 rows, every third of them with key 7, in eight files."""
    spark.range(60_000).selectExpr("IF(id % 3 = 0, 7, id) AS a", "id AS b", "sha2(CAST(id AS STRING), 256) AS r").repartition(
        8
    ).write.parquet(f"{folder}/hot")
    return spark.read.parquet(f"{folder}/hot")


def test_hot_right_key_of_the_any_key_join_is_split(spark, hot, eager_skew_handling):
    joined = any_key_left_join(spark.range(2000).toDF("k"), hot, "k", ["a", "b"])
    counted = joined.groupBy("k").agg(F.count("r").alias("n"))
    # Key 7: every third row, and the row whose b is 7. Key 8: a and b agree. Key 9: only b.
    assert {r["k"]: r["n"] for r in counted.filter("k IN (7, 8, 9)").collect()} == {7: 20_001, 8: 1, 9: 1}
    assert splits(joined)


def test_hot_left_key_of_not_in_is_split(spark, hot, eager_skew_handling):
    kept = null_safe_not_in(hot, "a", spark.range(8, 30_000).toDF("v"))
    assert kept.count() == 20_000 + 20_000 + 5
    assert splits(kept)


def test_hot_order_of_the_lines_is_split(spark, folder, eager_skew_handling):
    larger = "/root/testdata/sf0.01"
    hot_order = F.when(F.col("l_returnflag") == "N", 7).otherwise(F.col("l_orderkey")).cast("bigint")
    lines = spark.read.parquet(f"{larger}/lineitem.parquet").withColumn("l_orderkey", hot_order)
    lines.repartition(8).write.parquet(f"{folder}/lineitem.parquet")
    for name in ("orders", "part"):
        spark.read.parquet(f"{larger}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    assert splits(QUERIES["j02_bridge_sum"](spark, folder))


def test_copies_of_one_document_are_split_in_the_merge(spark, hot, eager_skew_handling):
    bronze = hot.selectExpr("named_struct('Id', a, 'x', NULL) AS value", "r", "'new' AS status")
    updates = bronze.filter("value.Id < 10").select("value", F.lit("loaded").alias("status"))
    merged = medallion.merge_status(bronze, updates)
    assert Counter(r["status"] for r in merged.select("status").collect()) == Counter(loaded=20_000 + 6, new=39_994)
    assert splits(merged)


def test_rows_of_one_id_are_split_in_the_status_join(spark, hot, eager_skew_handling):
    columns = {f.name: F.lit(None).cast(f.dataType) for f in schemas.MOVIE} | {"Id": F.col("a"), "RunTime": F.lit(5)}
    value = F.struct(*[column.alias(name) for name, column in columns.items()])
    bronze = hot.select(value.alias("value"), F.col("r").alias("datasource"), F.lit("new").alias("status")).selectExpr(
        "*", "current_timestamp() AS ingesttime", "current_date() AS p_ingestdate"
    )
    joined = medallion.status_by_id(bronze)
    assert joined.filter("status = 'loaded'").count() == 60_000
    assert splits(joined)


def test_a_hot_parent_and_a_hot_group_are_split_when_nested(spark, hot, eager_skew_handling):
    parents = spark.range(60_000).selectExpr("id AS p", "IF(id % 3 = 0, 'd', CAST(id DIV 100 AS STRING)) AS d")
    pieces = nest_by(parents, hot, "p", "a", "d", ["p"], ["b"], "kids")
    kids = pieces.filter("text LIKE '%\"b\":%'")
    assert kids.count() == 60_000
    # A third of the children have one parent.
    assert pieces.filter("d = '0'").count() > 20_000
    parts = pieces.groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) >= 4 and max(r["count"] for r in parts) < pieces.count() / 2
    assert pieces.agg(F.max(F.length("text"))).first()[0] < 60
    first = pieces.filter("d = '0'").orderBy("seq").limit(4).collect()
    assert [r["text"] for r in first] == ["[", '{"p":1,"kids":[', '{"b":1}', "]}"]


def test_a_hot_key_reaches_the_final_aggregate_as_partial_rows(spark, skewed):
    """Grouping by a hot key shuffles at most one partial row per task and key."""
    text = QUERIES["m09_dedupe_by_key"](spark, skewed)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in text and "Window" not in text


def test_grouped_keys_stay_grouped_below_the_exclusion(spark, hot):
    """An anti join would be pushed below the grouping, and every row of a hot key would be shuffled."""
    grouped = hot.groupBy("a").agg(F.count("*").alias("n"))
    anti = grouped.join(spark.range(100).toDF("v"), F.col("a") == F.col("v"), "left_anti")
    kept = without(grouped, "a", spark.range(100).toDF("v"))

    def joins_before_grouping(df):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        return text.index("Aggregate [a") < text.index("Join")

    assert joins_before_grouping(anti) and not joins_before_grouping(kept)
    assert Counter(map(tuple, kept.collect())) == Counter(map(tuple, anti.collect()))

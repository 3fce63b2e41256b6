import json
import random
import xml.etree.ElementTree as ET
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewright.functions import any_case
from tidewright.operators import (
    any_key_left_join,
    as_json_array,
    as_xml,
    check,
    chunk,
    fanout_sum,
    first_per_key,
    heavy_keys,
    json_lines,
    nest_by,
    null_safe_not_in,
    number_rows,
    pivot_sum,
    salted_join,
    split,
    tag,
    upsert,
)


def rows(df):
    return Counter(tuple(row) for row in df.collect())


# --- joins -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(4))
def test_any_key_join_equals_or_join(spark, seed):
    rnd = random.Random(seed)
    some = lambda: rnd.choice([None, *range(6)])
    left = spark.createDataFrame([(some(), i) for i in range(12)], "k int, l int")
    right = spark.createDataFrame([(some(), some(), i) for i in range(15)], "a int, b int, r int")
    direct = left.join(right, (F.col("k") == F.col("a")) | (F.col("k") == F.col("b")), "left")
    assert rows(any_key_left_join(left, right, "k", ["a", "b"]).select("k", "l", "a", "b", "r")) == rows(direct)


def test_any_key_join_counts_a_row_with_equal_keys_once(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, 1, "both"), (1, None, "one"), (None, None, "none")], "a int, b int, r string")
    assert rows(any_key_left_join(left, right, "k", ["a", "b"]).select("k", "r")) == Counter(
        [(1, "both"), (1, "one"), (2, None), (None, None)]
    )


def test_any_key_join_has_no_nested_loop(spark):
    left, right = spark.range(10).toDF("k"), spark.range(10).selectExpr("id AS a", "id + 1 AS b")
    plan = any_key_left_join(left, right, "k", ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("seed", range(4))
def test_fanout_sum_equals_naive_join(spark, seed):
    rnd = random.Random(seed)
    some = lambda: rnd.choice([None, 1, 2, 3, 4])
    a = spark.createDataFrame([(some(),) for _ in range(20)], "k int")
    b = spark.createDataFrame([(some(), rnd.choice([None, 1, 5, 7])) for _ in range(20)], "k int, v int")
    naive = a.join(b, "k").groupBy("k").agg(F.sum("v").alias("s"))
    assert rows(fanout_sum(a, b, "k", "v", "s")) == rows(naive)


@pytest.mark.parametrize(
    "listed, expected",
    [([2, 3], [1, 1]), ([2, None], []), ([], [1, 1, 2, None]), ([None], []), ([9, 9], [1, 1, 2])],
)
def test_not_in_treats_null_as_sql_does(spark, listed, expected):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    values = spark.createDataFrame([(v,) for v in listed], "v int")
    assert rows(null_safe_not_in(left, "k", values)) == Counter((v,) for v in expected)
    left.createOrReplaceTempView("l")
    values.createOrReplaceTempView("v")
    assert rows(spark.sql("SELECT k FROM l WHERE k NOT IN (SELECT v FROM v)")) == Counter((v,) for v in expected)


def test_not_in_uses_no_nested_loop(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = null_safe_not_in(spark.range(10).toDF("k"), "k", spark.range(5))
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Broadcast" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- dedupe ----------------------------------------------------------------------------------------


def test_first_per_key_is_independent_of_row_order(spark):
    data = [(1, 5, "b"), (1, 5, "a"), (1, 7, "c"), (2, None, "z"), (2, 1, "y"), (None, 1, "n"), (None, 0, "m")]
    expected = Counter([(1, 5, "a"), (2, None, "z"), (None, 0, "m")])
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, o int, v string").repartition(3)
        assert rows(first_per_key(df, ["k"], ["o"])) == expected
        assert rows(first_per_key(df, ["k"], ["o"], latest=True)) == Counter([(1, 7, "c"), (2, 1, "y"), (None, 1, "n")])


def test_first_per_key_equals_a_window(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").drop("l_shipdate")
    lines.createOrReplaceTempView("lines_for_window")
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    window = spark.sql(
        f"SELECT * EXCEPT (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
        f"{','.join(rest)}) AS rn FROM lines_for_window) WHERE rn = 1"
    )
    assert rows(first_per_key(lines, ["l_orderkey", "l_linenumber"])) == rows(window)


def test_first_per_key_of_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(first_per_key(df, ["k"])) == Counter([(1,), (2,)])


def test_upsert_takes_the_latest_staged_row(spark):
    target = spark.createDataFrame([(1, 1, "old"), (2, 1, "stays")], "k int, at int, v string")
    staged = spark.createDataFrame([("x", 1, 5), ("newest", 1, 9), ("new", 3, 2)], "v string, k int, at int")
    assert rows(upsert(target, staged, ["k"], ["at"])) == Counter([(1, 9, "newest"), (2, 1, "stays"), (3, 2, "new")])


# --- split -----------------------------------------------------------------------------------------


def test_split_sends_null_where_asked(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,), (0,)], "x int")
    kept, rest = split(df, F.col("x") >= 0)
    assert rows(kept) == Counter([(1,), (0,)]) and rows(rest) == Counter([(-1,), (None,)])
    _, rest = split(df, F.col("x") >= 0, null_to_default=False)
    assert rows(rest) == Counter([(-1,)])


# --- numbering -------------------------------------------------------------------------------------


def test_numbers_are_consecutive_and_ordered_with_ties(spark, folder):
    data = [(random.Random(1).randrange(5) if i % 3 else 2, i) for i in range(1000)]
    spark.createDataFrame(data, "k int, v int").repartition(4).write.parquet(f"{folder}/t")
    numbered = number_rows(spark.read.parquet(f"{folder}/t"), ["k"], "n", start=10).collect()
    assert sorted(row["n"] for row in numbered) == list(range(10, 1010))
    keys = [row["k"] for row in sorted(numbered, key=lambda row: row["n"])]
    assert keys == sorted(keys)
    assert Counter((row["k"], row["v"]) for row in numbered) == Counter(data)


def test_numbers_of_nothing(spark, folder):
    spark.createDataFrame([], "k int").write.parquet(f"{folder}/t")
    assert number_rows(spark.read.parquet(f"{folder}/t"), ["k"], "n").count() == 0


def test_numbers_with_the_flag_of_the_row_before(spark, folder):
    rows = [(i, i % 3 == 0) for i in range(1000)]
    spark.createDataFrame(rows, "k long, is_third boolean").repartition(7).write.parquet(f"{folder}/t")
    numbered = number_rows(spark.read.parquet(f"{folder}/t"), ["k"], "n", flag="is_third")
    found = {r["k"]: (r["n"], r["_before_is_third"]) for r in numbered.collect()}
    assert found == {k: (k + 1, k > 0 and rows[k - 1][1]) for k, _ in rows}


def test_a_hot_key_is_numbered_by_several_tasks(spark, folder):
    # A third of the rows share one key; ties are cut by scan position.
    spark.range(30_000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id").repartition(4).write.parquet(f"{folder}/t")
    frame = spark.read.parquet(f"{folder}/t").withColumn("_tie", F.monotonically_increasing_id())
    spread = frame.repartitionByRange(8, "k", "_tie").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(row["count"] for row in spread) < 30_000 / 4


@pytest.mark.parametrize("n, k", [(1003, 8), (1000, 8), (16, 8), (7, 8), (0, 8), (10, 3)])
def test_chunks_equal_list_slices(spark, n, k):
    values = [3 * i for i in range(n)]
    df = spark.createDataFrame([(v,) for v in random.Random(0).sample(values, n)], "v long").repartition(3)
    size = n // k
    expected = {v: i for i in range(k) for v in values[i * size : (i + 1) * size]}
    assert {row["v"]: row["chunk"] for row in chunk(df, k, "v", keep_remainder=False).collect()} == expected
    for v in values[k * size :]:
        expected[v] = k - 1
    assert {row["v"]: row["chunk"] for row in chunk(df, k, "v", keep_remainder=True).collect()} == expected


def test_chunk_refuses_a_key_that_cannot_be_cut(spark):
    with pytest.raises(ValueError, match="unique"):
        chunk(spark.createDataFrame([(1,)] * 8 + [(2,)] * 8, "v int"), 4, "v", False)
    with pytest.raises(ValueError, match="unique"):
        chunk(spark.createDataFrame([(i,) for i in range(8)] + [(None,)], "v int"), 2, "v", False)


# --- shaping ---------------------------------------------------------------------------------------


def test_pivot_keeps_listed_values_and_leaves_missing_cells_null(spark):
    df = spark.createDataFrame([("a", "x 1", 1), ("a", "x 1", 2), ("b", "y", 5), ("c", "z", 9)], "r string, c string, v int")
    wide = pivot_sum(df, "r", "c", ["x 1", "y"], "v")
    assert wide.columns == ["r", "x_1", "y"]
    assert rows(wide) == Counter([("a", 3, None), ("b", None, 5), ("c", None, None)])


def report(spark):
    return spark.createDataFrame(
        [(2, "a & b", None), (1, "<c>", 5)], "`Year` int, `Novelty Items` string, `T-Shirts` int"
    )


def put_together(pieces, column):
    return "".join(row[column] for row in pieces.orderBy("seq").collect())


def test_json_array_is_ordered_and_omits_nulls(spark):
    assert json.loads(put_together(as_json_array(report(spark), "Year"), "json")) == [
        {"Year": 1, "Novelty Items": "<c>", "T-Shirts": 5},
        {"Year": 2, "Novelty Items": "a & b"},
    ]
    assert put_together(as_json_array(report(spark).filter("Year > 9"), "Year"), "json") == "[]"
    assert sorted(json.loads(r["json"])["Year"] for r in json_lines(report(spark)).collect()) == [1, 2]


def test_xml_has_no_row_wrapper_and_omits_nulls(spark):
    text = put_together(as_xml(report(spark), "Year"), "xml")
    parsed = [(e.tag, e.text) for e in ET.fromstring(f"<r>{text}</r>")]
    assert parsed == [("Year", "1"), ("Novelty_Items", "<c>"), ("T-Shirts", "5"), ("Year", "2"), ("Novelty_Items", "a & b")]


@pytest.mark.parametrize("n", [5, 20_000])
def test_reports_have_one_shape_at_every_size(spark, n):
    pieces = as_json_array(spark.range(n), "id").collect()
    assert sorted(r["seq"] for r in pieces) == list(range(n + 2))
    texts = [r["json"] for r in sorted(pieces, key=lambda r: r["seq"])]
    assert max(map(len, texts)) < 30 and json.loads("".join(texts)) == [{"id": i} for i in range(n)]
    assert as_xml(spark.range(n), "id").count() == n


def nested(spark, children):
    parents = spark.createDataFrame([(1, "d1", "x"), (2, "d1", "y"), (3, "d2", None), (4, "d2", "none"), (5, None, "z")], "p int, d string, t string")
    kids = spark.createDataFrame(children, "c int, n int").repartition(4)
    rows = nest_by(parents, kids, "p", "c", "d", ["p", "t"], ["n"], "kids").orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(1, len(rows) + 1))
    texts = {}
    for row in rows:
        texts[row["d"]] = texts.get(row["d"], "") + row["text"]
    return rows, {d: json.loads(t) for d, t in texts.items()}


def test_nested_documents_per_group(spark):
    rows, got = nested(spark, [(1, 2), (1, 1), (1, 1), (2, 3), (3, 4), (5, 1), (9, 9)])
    assert got == {
        "d1": [{"p": 1, "t": "x", "kids": [{"n": 1}, {"n": 1}, {"n": 2}]}, {"p": 2, "t": "y", "kids": [{"n": 3}]}],
        "d2": [{"p": 3, "kids": [{"n": 4}]}],
    }
    assert len(rows) == 2 * 2 + 2 * 3 + 5


def test_a_group_of_any_size_has_the_same_shape(spark):
    children = [(1, i % 19_000) for i in range(20_000)] + [(3, 1)]
    rows, got = nested(spark, children)
    assert max(len(r["text"]) for r in rows) < 40
    assert [kid["n"] for kid in got["d1"][0]["kids"]] == sorted(n for p, n in children if p == 1)
    assert got["d2"] == [{"p": 3, "kids": [{"n": 1}]}]


# --- checks ----------------------------------------------------------------------------------------


def test_checks_count_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, None), (None, 9)], "a int, b int")
    known = spark.createDataFrame([(1,), (1,)], "k int")
    got = rows(check(df, not_null=["a", "b"], unique=[["a"], ["a", "b"]], references=[("b", known, "k")]))
    assert got == Counter(
        [
            ("not_null", "a", 1),
            ("not_null", "b", 1),
            ("unique", "a", 2),
            ("unique", "a,b", 2),
            ("reference", "b", 1),
        ]
    )
    assert rows(check(df.filter("a > 5"), not_null=["a"], unique=[["a"]])) == Counter(
        [("not_null", "a", 0), ("unique", "a", 0)]
    )


# --- tagged rows, hot keys, names in any case ---------------------------------------------------------


def test_tagged_rows_are_as_many_as_counted(spark, folder):
    rows = [(1, "a", 5), (1, "a", 5), (1, "a", 4), (2, None, 1), (None, None, 2), (None, None, 2), (3, "z", None), (3, "b", 7)]
    spark.createDataFrame(rows, "k int, v string, n int").repartition(3).write.parquet(f"{folder}/t")
    table, other = spark.read.parquet(f"{folder}/t"), spark.createDataFrame([("a",), ("b",), (None,)], "w string")
    rules = {"not_null": ["k", "n"], "unique": [["k", "v"], ["n"]], "references": [("v", other, "w")]}
    tagged = tag(table, **rules)
    assert tagged.columns == ["k", "v", "n", "broken"] and tagged.count() == len(rows)
    counted = {f"{r['rule']}:{r['columns']}": r["violations"] for r in check(table, **rules).collect()}
    found = Counter(x for r in tagged.collect() for x in r["broken"])
    assert {rule: n for rule, n in counted.items() if n} == found
    assert Counter((r["n"], "unique:k,v" in r["broken"]) for r in tagged.filter("k = 1").collect()) == Counter([(4, False), (5, True), (5, True)])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_a_hot_key_is_spread_over_tasks(spark, how):
    left = spark.range(30_000).selectExpr("if(id % 3 = 0, 7L, if(id % 50 = 1, null, id % 997)) AS k", "id")
    right = spark.range(0, 990, 2).selectExpr("id AS k", "id * 10 AS w").unionByName(spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "k long, w long"))
    assert heavy_keys(left, "k") == [7]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for key, value in zip(before, ("false", "-1", "16"), strict=True):
            spark.conf.set(key, value)
        joined = salted_join(left, right, "k", how)
        assert Counter(map(tuple, joined.select(sorted(joined.columns)).collect())) == Counter(
            map(tuple, left.join(right, "k", how).select(sorted(joined.columns)).collect())
        )
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        plain = [r["n"] for r in left.join(right, "k", how).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        if how in ("inner", "left"):
            assert max(sizes) < 3 * sum(sizes) / 16 and max(plain) > 0.4 * sum(plain)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    with pytest.raises(ValueError, match="full"):
        salted_join(left, right, "k", "full")


def test_names_in_any_case(spark):
    names = spark.createDataFrame([("Ann", 1), ("ANN", 2), ("ÄGIR", 3), ("ägir", 4), (None, 5)], "n string, i int").withColumn("n", any_case("n"))
    assert names.select("n").distinct().count() == 3 and names.filter("n = 'ann'").count() == 2
    assert Counter(r["count"] for r in names.groupBy("n").count().collect()) == Counter([2, 2, 1])
    other = spark.createDataFrame([("aNn",), ("Ägir",)], "n string").withColumn("n", any_case("n"))
    assert names.join(other, "n").count() == 4

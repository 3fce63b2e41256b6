import csv
import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright import schemas
from tidewright.plans import files, incremental, ods
from tidewright.sources import VersionedTable, conform, scratch

ROW = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("v", T.StringType()),
    ]
)


def at(day):
    return dt.datetime(2024, 1, day)


# --- incremental load ------------------------------------------------------------------------------


def changing(spark, rows):
    return incremental.LoadedTable("Things", lambda s: s.createDataFrame(rows, ROW), "at", ["k"], ROW)


def target(warehouse, table):
    return Counter((r["k"], r["v"]) for r in warehouse.target(table).read().collect())


def test_two_loads_meet_at_the_cutoff(spark, folder):
    warehouse = incremental.Warehouse(spark, folder)
    rows = [(1, at(1), "a"), (1, at(2), "b"), (2, at(2), "c"), (2, at(3), "d"), (3, at(4), "e")]
    table = changing(spark, rows)
    incremental.incremental_load(warehouse, [table], at(2))
    assert target(warehouse, table) == Counter([(1, "b"), (2, "c")])
    assert warehouse.last_cutoff("Things") == at(2)
    incremental.incremental_load(warehouse, [table], at(4))
    assert target(warehouse, table) == Counter([(1, "b"), (2, "d"), (3, "e")])
    assert sorted(r["v"] for r in warehouse.staging(table).read().collect()) == ["d", "e"]
    assert sorted((r["lineage_key"], r["cutoff"]) for r in warehouse.lineage.read().collect()) == [(1, at(2)), (2, at(4))]
    incremental.incremental_load(warehouse, [table], at(4))
    assert warehouse.staging(table).read().count() == 0 and target(warehouse, table)[(3, "e")] == 1


def test_the_first_load_takes_old_and_undated_rows(spark, folder):
    warehouse = incremental.Warehouse(spark, folder)
    table = changing(spark, [(1, dt.datetime(1850, 1, 1), "old"), (2, None, "undated"), (3, at(3), "later"), (2, at(4), "dated")])
    control = spark.createDataFrame([("Things", "Thing key")], "Name string, Col string")
    incremental.incremental_load(warehouse, [table], at(2), control)
    assert target(warehouse, table) == Counter([(1, "old"), (2, "undated")])
    assert warehouse.last_cutoff("Thing key") == at(2) and warehouse.last_cutoff("Things") is None
    assert [r["table_name"] for r in warehouse.lineage.read().collect()] == ["Thing key"]
    incremental.incremental_load(warehouse, [table], at(5), control)
    assert target(warehouse, table) == Counter([(1, "old"), (2, "dated"), (3, "later")])


def test_a_load_writes_only_the_parts_it_falls_into(spark, folder):
    warehouse = incremental.Warehouse(spark, folder, buckets=8)
    table = changing(spark, [(k, at(1), "a") for k in range(100)] + [(7, at(3), "b")])
    incremental.incremental_load(warehouse, [table], at(2))
    before = {p: sorted(os.listdir(f"{folder}/target/Things/{p}")) for p in warehouse.target(table).partitions()}
    incremental.incremental_load(warehouse, [table], at(4))
    after = {p: sorted(os.listdir(f"{folder}/target/Things/{p}")) for p in warehouse.target(table).partitions()}
    assert len(before) == 8 and sum(before[p] != after[p] for p in before) == 1
    assert target(warehouse, table)[(7, "b")] == 1 and warehouse.target(table).read().count() == 100


def test_the_cutoff_stays_when_a_load_fails(spark, folder, monkeypatch):
    warehouse = incremental.Warehouse(spark, folder)
    table = changing(spark, [(1, at(1), "a")])
    monkeypatch.setattr(incremental, "upsert", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        incremental.incremental_load(warehouse, [table], at(2))
    assert warehouse.last_cutoff("Things") is None
    monkeypatch.undo()
    incremental.incremental_load(warehouse, [table], at(2))
    assert target(warehouse, table) == Counter([(1, "a")])


def test_tables_load_side_by_side_and_fail_alone(spark, folder):
    warehouse = incremental.Warehouse(spark, folder)
    sources = {"Things": [(1, at(1), "a"), (None, at(1), "n")], "Others": [(1, at(1), "x"), (2, at(1), "y")], "Broken": [(3, at(1), "z")]}
    broken = [True]

    def table(name, keys):
        def source(spark):
            if name == "Broken" and broken[0]:
                raise OSError("no such store")
            return spark.createDataFrame(sources[name], ROW)

        return incremental.LoadedTable(name, source, "at", keys, ROW)

    tables = [table("Things", ["k"]), table("Broken", ["k"]), table("Others", ["k", "v"])]
    with pytest.raises(incremental.LoadsFailed, match="Broken") as caught:
        incremental.incremental_load(warehouse, tables, at(2), at_once=3)
    assert list(caught.value.failures) == ["Broken"]
    assert {t.name: warehouse.last_cutoff(t.name) for t in tables} == {"Things": at(2), "Broken": None, "Others": at(2)}
    assert target(warehouse, tables[0]) == Counter([(1, "a"), (None, "n")])
    broken[0] = False
    incremental.incremental_load(warehouse, tables, at(3), at_once=2)
    incremental.incremental_load(warehouse, tables, at(2), at_once=8)
    assert target(warehouse, tables[1]) == Counter([(3, "z")]) and target(warehouse, tables[2]) == Counter([(1, "x"), (2, "y")])
    # A NULL key is one row, however often it is loaded.
    sources["Things"] = [(None, at(4), "later"), (None, at(4), "earlier")]
    incremental.incremental_load(warehouse, tables, at(5), at_once=3)
    incremental.load_table(warehouse, tables[0], lambda *_: spark.createDataFrame([(None, at(5), "last")], ROW), at(6))
    assert target(warehouse, tables[0]) == Counter([(1, "a"), (None, "last")])
    keys = [r["lineage_key"] for r in warehouse.lineage.read().collect()]
    assert sorted(keys) == list(range(1, 14))


def test_control_table_picks_the_tables(spark, folder):
    warehouse = incremental.Warehouse(spark, folder)
    control = spark.createDataFrame([("Others", "k")], "Name string, Col string")
    with pytest.raises(ValueError, match="Others"):
        incremental.incremental_load(warehouse, [changing(spark, [])], at(2), control)
    assert incremental.staging_name("Things") == "Things_Staging"
    assert list(incremental.extracts([changing(spark, [])])) == ["GetThingsUpdates"]


def test_date_dimension_is_idempotent(spark):
    years = spark.createDataFrame([(2022,), (2024,), (2022,)], "year int")
    dim = incremental.date_dimension(years)
    assert dim.count() == 365 + 366
    assert incremental.date_dimension(years, dim).count() == 0
    assert dim.filter("date = DATE'2022-01-01'").first() == (dt.date(2022, 1, 1), 2022, 1, 1, 1, 1, 52, 6)


# --- operational data store ------------------------------------------------------------------------


def orders_and_lines(spark):
    orders = spark.createDataFrame(
        [(1, 10, at(1)), (2, 10, at(1)), (3, 11, at(2)), (4, 12, at(8)), (5, 12, at(9)), (6, 13, at(10)), (7, 14, None)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    ).withColumn("o_orderstatus", F.lit("O"))
    lines = spark.createDataFrame(
        [(1, 1, 5.0), (1, 2, 2.0), (3, 1, 4.0), (4, 1, 1.0), (5, 1, 9.0), (6, 1, 3.0), (7, 1, 1.0)],
        "l_orderkey long, l_linenumber int, l_quantity double",
    )
    return orders, lines


def stored(table):
    return {r["OrderId"]: (r["OrderDate"].day, r["OrderTotal"], r["CustomerId"]) for r in table.read().collect()}


def test_a_day_loads_once(spark, folder):
    orders, lines = orders_and_lines(spark)
    table = ods.ods_orders(spark, folder)
    ods.load_day(orders, lines, table, dt.date(2024, 1, 1))
    # Order 2 has no lines.
    assert stored(table) == {1: (1, 7, 10)}
    with pytest.raises(ValueError, match="already loaded"):
        ods.load_day(orders, lines, table, dt.date(2024, 1, 1))
    ods.load_day(orders, lines, table, dt.date(2024, 1, 2))
    assert stored(table) == {1: (1, 7, 10), 3: (2, 4, 11)}


def test_reload_replaces_the_past_and_the_window(spark, folder):
    orders, lines = orders_and_lines(spark)
    table = ods.ods_orders(spark, folder)
    for day in (1, 2, 8, 10):
        ods.load_day(orders, lines, table, dt.date(2024, 1, day))
    expected = {3: (2, 4, 11), 4: (8, 1, 12), 5: (9, 9, 12), 6: (10, 3, 13)}
    for _ in range(2):
        ods.reload_week(orders, lines, table, dt.date(2024, 1, 2))
        assert stored(table) == expected
    assert table.partitions() == {f"OrderDate=2024-01-{day}" for day in ("02", "08", "09", "10")}


def test_reload_leaves_later_days_alone_unless_an_order_moved(spark, folder):
    orders, lines = orders_and_lines(spark)
    table = ods.ods_orders(spark, folder)
    row = "OrderId long, OrderTotal long, CustomerId long, OrderDate date"
    table.replace(spark.createDataFrame([(5, 1, 12, dt.date(2024, 2, 1)), (9, 1, 1, dt.date(2024, 2, 2)), (8, 1, 1, dt.date(2024, 1, 5))], row))
    before = os.listdir(f"{folder}/OrderDate=2024-02-02")
    ods.reload_week(orders, lines, table, dt.date(2024, 1, 2))
    # Order 5 moved into the window; order 8 is gone at the source, but its day is later than the given one.
    assert stored(table) == {3: (2, 4, 11), 4: (8, 1, 12), 5: (9, 9, 12), 8: (5, 1, 1), 9: (2, 1, 1)}
    assert "OrderDate=2024-02-01" not in table.partitions()
    assert os.listdir(f"{folder}/OrderDate=2024-02-02") == before


# Missed purchase orders, one value per declared field; the second element has a date of another form.
VALUES = ["Garden lantern", 12, 3, 9, "Lumen", 21, 4, 19.5, 18.4, 27.1, 1.25, "Portugal", "Outdoor", "2021-09-30", "Courier"]
VALUES += ["2021-10-14", "PT-0042"]
ELEMENT = {key: str(value) for (_, key, _), value in zip(schemas.PURCHASE_ORDER_FIELDS, VALUES, strict=True)}
SECOND = {**ELEMENT, "Supplier": "31", "OrderDate": "30.09.2021", "SupplierReference": "PT-0043"}


def test_backfill_reads_the_first_order_of_each_document(spark, folder):
    documents = [(1, json.dumps({"PurchaseOrders": [ELEMENT, SECOND]})), (2, json.dumps({"PurchaseOrders": [SECOND]}))]
    spark.createDataFrame(documents, "id int, doc string").write.parquet(f"{folder}/docs")
    shredded = ods.shred_purchase_orders(spark.read.parquet(f"{folder}/docs"), "doc", "id")
    items, purchase_orders = ods.backfill(shredded, ["id"], 227)
    got = {r["StockItemID"]: r for r in items.collect()}
    assert sorted(got) == [228, 229]
    assert (got[228]["SupplierID"], str(got[228]["TaxRate"]), str(got[228]["UnitPrice"])) == (12, "19.500", "18.40")
    assert got[228]["CustomFields"] == '{"CountryOfManufacture":"Portugal"}'
    found = {r["SupplierReference"]: r for r in purchase_orders.collect()}
    assert found["PT-0042"]["OrderDate"] == dt.date(2021, 9, 30) and found["PT-0043"]["OrderDate"] is None
    assert (found["PT-0042"]["DeliveryMethodID"], found["PT-0042"]["IsOrderFinalized"]) == (0, 1)


def test_migrated_attributes(spark):
    items = spark.createDataFrame(
        [(1, '{"CountryOfManufacture":"Norway","Range":"Outdoor","Shelf Life":"40 weeks","Tags":["a"]}'), (2, None)],
        "id int, custom string",
    )
    got = ods.migrate_items(items, "custom", {"country": "CountryOfManufacture", "life": "Shelf Life", "tags": "Tags"})
    assert {tuple(r) for r in got.collect()} == {(1, "Norway", "40 weeks", None), (2, None, None, None)}


def test_a_json_column_is_parsed_once(spark):
    texts = [
        '{"a": "x", "b c": 1.5, "d": {"e": 1}, "f": [1], "g": null, "h": "{\\"q\\": 1}", "i": true}',
        '{"a": "cut off"', '{"a": 1, "a": 2}', "[1]", "", "null", '"a"', None,
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "id int, custom string")
    got = ods.migrate_items(items, "custom", {name: name for name in ("a", "b c", "d", "f", "g", "h", "i", "j")})
    rows = {r[0]: tuple(r)[1:] for r in got.collect()}
    assert rows.pop(0) == ("x", "1.5", None, None, None, '{"q": 1}', "true", None)
    assert rows == {i: (None,) * 8 for i in range(1, 8)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "get_json_object" not in plan


def test_migrated_items_go_into_a_typed_table(spark, folder):
    items = spark.createDataFrame([(1, "Mug", "15.0", '{"Range":"Outdoor"}')], "id long, name string, tax string, custom string")
    kinds = [("id", T.LongType()), ("name", T.StringType()), ("tax", T.DecimalType(18, 3)), ("range", T.StringType())]
    schema = T.StructType([T.StructField(*kind) for kind in kinds])
    table = VersionedTable(spark, folder, schema)
    table.clear()
    table.append(conform(ods.migrate_items(items, "custom", {"range": "Range"}), schema))
    assert [tuple(map(str, row)) for row in table.read().collect()] == [("1", "Mug", "15.000", "Outdoor")]


def joined(pieces, *keys, value="text"):
    """The texts of each key, put together in order."""
    out = {}
    for row in pieces.orderBy(*keys, "seq").collect():
        key = tuple(row[k] for k in keys)
        out[key] = out.get(key, "") + row[value]
    return out


def test_customer_documents_repeat_per_order_of_the_customer(spark):
    orders, lines = orders_and_lines(spark)
    got = joined(ods.customer_documents(orders, lines, 12, ["o_orderkey"], ["l_linenumber"]), "ID", "InvoiceDate", value="InvoiceValue")
    assert [(i, day.day) for i, day in sorted(got)] == [(1, 8), (2, 9)]
    # Two orders of one customer on one day: the day's document twice.
    got = joined(ods.customer_documents(orders, lines, 10, ["o_orderkey"], ["l_linenumber"]), "ID", value="InvoiceValue")
    assert sorted((i, json.loads(text)) for (i,), text in got.items()) == [
        (i, [{"o_orderkey": 1, "lines": [{"l_linenumber": 1}, {"l_linenumber": 2}]}]) for i in (1, 2)
    ]


def test_customer_documents_equal_the_loop(spark):
    orders, lines = orders_and_lines(spark)
    for customer in (10, 11, 12, 13):
        looped = Counter()
        for row in orders.filter(F.col("o_custkey") == customer).collect():
            day = orders.filter(F.to_date("o_orderdate") == F.lit(row["o_orderdate"].date()))
            for (date,), text in joined(ods.invoice_documents(day, lines, ["o_orderkey"], ["l_linenumber"]), "OrderDate").items():
                looped[(date, text)] += 1
        got = joined(ods.customer_documents(orders, lines, customer, ["o_orderkey"], ["l_linenumber"]), "ID", "InvoiceDate", value="InvoiceValue")
        assert Counter((date, text) for (_, date), text in got.items()) == looped


def test_repeating_a_row_many_times(spark):
    df = spark.createDataFrame([("a", 2500), ("b", 1)], "k string, n long")
    got = ods._repeat(df, "n", "i").groupBy("k").agg(F.count("*"), F.min("i"), F.max("i")).collect()
    assert {tuple(r) for r in got} == {("a", 2500, 1, 2500), ("b", 1, 1, 1)}


# --- files -----------------------------------------------------------------------------------------

HEADER = "first\tlast\temail\tphone\taddress\n"
PEOPLE_1 = " anna\tO'NEIL\ta@x\t0123456789\tMain St 1\nAnna \to'neil\ta@x\t012-345-6789\tMain St 1\nbob\tray\tb@x\t123\tX\n"
PEOPLE_2 = "BOB\tRAY\tb@x\t123\tX\n"


@pytest.fixture
def people(folder):
    os.makedirs(f"{folder}/people")
    for name, text in (("people_1.txt", PEOPLE_1), ("people_2.txt", PEOPLE_2)):
        with open(f"{folder}/people/{name}", "w") as file:
            file.write(HEADER + text)
    return f"{folder}/people"


def test_people_are_deduplicated_over_all_files(spark, folder, people):
    files.clean_people_files(spark, people, f"{folder}/out", per_file=False)
    back = spark.read.option("header", True).csv(f"{folder}/out")
    assert Counter(map(tuple, back.collect())) == Counter(
        [("Anna", "O'Neil", "a@x", "012-345-6789", "Main St 1"), ("Bob", "Ray", "b@x", "123", "X")]
    )


def test_people_per_file_keep_the_duplicates_between_files(spark, folder, people):
    with open(f"{people}/people_2.txt", "w") as file:
        file.write("Given\tFamily\tMail\tPhone\tStreet\n" + PEOPLE_2)
    with open(f"{people}/people_2.csv", "w") as file:
        file.write(HEADER + "eve\tlo\te@x\t1\tY\n")
    files.clean_people_files(spark, people, f"{folder}/out")
    found = {name: spark.read.option("header", True).csv(f"{folder}/out/{name}") for name in os.listdir(f"{folder}/out")}
    assert {name: sorted(r[0] for r in df.collect()) for name, df in found.items()} == {
        "people_1": ["Anna", "Bob"],
        "people_2.txt": ["Bob"],
        "people_2.csv": ["Eve"],
    }
    # Every file keeps its own header.
    assert found["people_2.txt"].columns == ["Given", "Family", "Mail", "Phone", "Street"]
    assert found["people_1"].columns == HEADER.strip().split("\t")
    with open(f"{people}/people_3.txt", "w") as file:
        file.write("first\tlast\nx\ty\n")
    with pytest.raises(ValueError, match="2 columns"):
        files.clean_people_files(spark, people, f"{folder}/other")


def test_csv_is_read_back_by_a_plain_csv_reader(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/people.txt", "w") as file:
        file.write("First Name\tLast Name\tEmail\tPhone\tAddress\n")
        file.write('ann\tlee\t  a@x \t\t1 "Main", St\nbob\tray\tb@x\t0123456789\tX\n')
    files.clean_people_files(spark, f"{folder}/in", f"{folder}/out", per_file=False)
    rows, headers = [], set()
    for name in os.listdir(f"{folder}/out"):
        if name.endswith(".csv"):
            with open(f"{folder}/out/{name}", newline="") as file:
                header, *body = csv.reader(file)
                headers.add(tuple(header))
                rows += map(tuple, body)
    assert headers == {("First Name", "Last Name", "Email", "Phone", "Address")}
    assert sorted(rows) == [("Ann", "Lee", "  a@x ", "", '1 "Main", St'), ("Bob", "Ray", "b@x", "012-345-6789", "X")]


def test_documents_split_into_equal_files(spark, folder):
    df = spark.range(1003).selectExpr("id", "concat('text ', id) AS text")
    files.split_documents(df, f"{folder}/out", "id", keep_remainder=False)
    back = spark.read.schema("id long, text string, chunk int").json(f"{folder}/out")
    counts = {r["chunk"]: (r["count"], r["lo"]) for r in back.groupBy("chunk").agg(F.count("*").alias("count"), F.min("id").alias("lo")).collect()}
    assert counts == {i: (125, 125 * i) for i in range(8)}


def test_an_array_file_splits_like_list_slices(spark, folder):
    movies = [{"Id": 7 * i % 101, "Title": f"t{i}"} for i in range(43)]
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/movie.json", "w") as file:
        json.dump({"movie": movies}, file)
    files.split_array_file(spark, f"{folder}/in", f"{folder}/out", keep_remainder=False, multi_line=True)
    for i in range(8):
        back = spark.read.schema("Id long, Title string").json(f"{folder}/out/chunk={i}")
        assert sorted(map(tuple, back.collect())) == sorted((m["Id"], m["Title"]) for m in movies[5 * i : 5 * i + 5])


def test_jobs_leave_nothing_in_the_shared_folder(spark, folder, people, monkeypatch):
    monkeypatch.setattr(scratch, "shared_folder", lambda _: f"{folder}/shared")
    orders, lines = orders_and_lines(spark)
    table = ods.ods_orders(spark, f"{folder}/ods")
    ods.load_day(orders, lines, table, dt.date(2024, 1, 1))
    ods.reload_week(orders, lines, table, dt.date(2024, 1, 2))
    warehouse = incremental.Warehouse(spark, f"{folder}/warehouse")
    incremental.incremental_load(warehouse, [changing(spark, [(1, at(1), "a")])], at(2))
    files.split_documents(spark.range(20).selectExpr("id", "'x' AS text"), f"{folder}/out", "id", 3, keep_remainder=True)
    files.clean_people_files(spark, people, f"{folder}/people-out")
    assert os.listdir(f"{folder}/shared/tidewright") == []

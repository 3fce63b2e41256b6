import contextlib
import json
import os
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright import schemas
from tidewright.sources import (
    FILE,
    PartitionedTable,
    VersionedTable,
    batch_writer,
    changed_between,
    check_schema,
    conform,
    materialize,
    read_documents,
    read_people,
    read_table,
    register_table,
    write_chunks,
)
from tidewright.sources.arrays import _BRACE, _LINE_END, _runs, _short_pieces, array_elements
from tidewright.sources.drift import differences, holds
from tidewright.sources.readers import read_parquet, read_raw, rejected_documents
from tidewright.sources.scratch import scratch_path, shared_folder

PAIR = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as file:
        file.write(text)


def test_multi_line_envelope_is_exploded(spark, folder):
    movies = [{"Id": 1, "Title": "a", "genres": [{"id": 5, "name": "x"}]}, {"Id": 2, "RunTime": -3}]
    write_text(f"{folder}/raw/one.json", json.dumps({"movie": movies}, indent=2))
    write_text(f"{folder}/raw/array.json", json.dumps([{"movie": [{"Id": 3}]}, {"movie": []}, {"movie": None}], indent=2))
    raw = read_raw(spark, f"{folder}/raw", multi_line=True)
    assert raw.schema["value"].dataType == schemas.MOVIE
    assert sorted(row[0] for row in raw.select("value.Id").collect()) == [1, 2, 3]
    assert raw.filter("value.Id = 1").select("value.genres").first()[0] == [(5, "x")]


def test_drift_keeps_extra_fields_only_if_allowed(spark, folder):
    write_text(f"{folder}/raw/one.json", json.dumps({"movie": [], "extra": 7}))
    assert read_documents(spark, f"{folder}/raw").columns == ["movie"]
    drifted = read_documents(spark, f"{folder}/raw", allow_drift=True)
    assert drifted.columns == ["movie", "extra"] and drifted.first()["extra"] == 7


def test_drift_inside_of_documents_is_kept(spark, folder):
    movies = [{"Id": 1, "More": {"a": 1}, "genres": [{"id": 5, "name": "x", "weight": 2}]}]
    write_text(f"{folder}/raw/one.json", json.dumps({"movie": movies}))
    assert "More" not in read_raw(spark, f"{folder}/raw").schema["value"].dataType.fieldNames()
    row = read_raw(spark, f"{folder}/raw", allow_drift=True).select("value.Id", "value.More.a", "value.genres").first()
    assert (row["Id"], row["a"], row["genres"][0]["weight"]) == (1, 1, 2)


def test_what_is_no_document_is_found(spark, folder):
    write_text(f"{folder}/raw/one.json", '{"movie": [{"Id": 1}]}\n{"movie": oh no}\n{"movie": [{"Id": 2}]}\n')
    assert read_raw(spark, f"{folder}/raw").count() == 2
    found = rejected_documents(spark, f"{folder}/raw").collect()
    assert [r["rejected"] for r in found] == ['{"movie": oh no}'] and found[0]["file"].endswith("one.json")


def test_partitions_are_replaced_one_by_one(spark, folder):
    table = PartitionedTable(spark, f"{folder}/t", PAIR, ["v"])
    assert not table.exists() and table.read().count() == 0
    table.replace(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], PAIR))
    before = os.listdir(f"{folder}/t/v=b")
    # A job may read what it replaces.
    table.replace(table.read().filter("v = 'a'").withColumn("k", F.col("k") + 10))
    assert sorted(map(tuple, table.read().collect())) == [(2, "b"), (3, None), (11, "a")]
    assert os.listdir(f"{folder}/t/v=b") == before
    table.replace(table.read().filter("v = 'a' AND k < 0"), {"v=a"})
    assert table.partitions() == {"v=b", "v=__HIVE_DEFAULT_PARTITION__"}
    table.publish(spark.createDataFrame([(5, "c")], PAIR))
    assert table.read().collect() == [(5, "c")]
    with pytest.raises(ValueError, match="schema differs"):
        table.replace(spark.createDataFrame([(1.5, "a")], "k double, v string"))


@pytest.mark.parametrize("dies_at", range(7))
def test_a_write_that_dies_loses_nothing(spark, folder, monkeypatch, dies_at):
    """Whatever step of the write fails, the table has either its former rows or the new ones."""
    table = PartitionedTable(spark, f"{folder}/t", PAIR, ["v"])
    table.replace(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], PAIR))
    steps = []

    def failing(method):
        def step(*args, **kwargs):
            steps.append(method)
            if len(steps) > dies_at:
                raise RuntimeError("lost")
            return method(*args, **kwargs)

        return step

    monkeypatch.setattr(table, "_move", failing(table._move))
    monkeypatch.setattr(table, "_listed", failing(table._listed))
    with contextlib.suppress(RuntimeError):
        table.replace(table.read().filter("v <> 'c'").withColumn("k", F.col("k") + 10), {"v=c"}, done=["step"])
    monkeypatch.undo()
    again = PartitionedTable(spark, f"{folder}/t", PAIR, ["v"])
    rows = sorted(map(tuple, again.read().collect()))
    planned = any(step.__name__ == "_move" for step in steps[:dies_at])
    assert rows == ([(11, "a"), (12, "b")] if planned else [(1, "a"), (2, "b"), (3, "c")])
    assert again.done() == ({"step"} if planned else set())
    again.replace(spark.createDataFrame([(4, "d")], PAIR))
    assert os.listdir(f"{folder}/t/_pending") == [] and again.read().count() == len(rows) + 1


def test_a_merge_writes_only_the_files_it_hits(spark, folder):
    table = PartitionedTable(spark, f"{folder}/t", PAIR, ["v"])
    table.replace(spark.range(1000).selectExpr("id AS k", "cast(id % 100 AS string) AS v"))
    before = table.read(files=True).select(FILE).distinct().count()
    hit = [r[0] for r in table.read(files=True).filter("k = 707").select(FILE).collect()]
    assert before == 100 and len(hit) == 1
    table.rewrite(hit, table.read_files(hit).withColumn("k", F.when(F.col("k") == 707, -707).otherwise(F.col("k"))))
    after = {r[0] for r in table.read(files=True).select(FILE).distinct().collect()}
    assert len(after) == 100 and hit[0] not in after
    assert table.read().agg(F.sum("k")).first()[0] == 999 * 500 - 2 * 707
    assert table.read().filter("v = '7'").count() == 10


def test_partition_values_with_odd_characters(spark, folder):
    table = PartitionedTable(spark, f"{folder}/a b", PAIR, ["v"])
    values = ["x y", "a/b", "50%", "k=v", "é*?[", None]
    table.replace(spark.createDataFrame(list(enumerate(values)), PAIR))
    files = [r[0] for r in table.read(files=True).filter("k > 0").select(FILE).collect()]
    table.rewrite(files, table.read_files(files).withColumn("k", F.col("k") * 10))
    assert sorted(map(tuple, table.read().collect())) == [(10 * i, v) for i, v in enumerate(values)]


def test_parquet_source_checks_and_drifts(spark, folder):
    spark.createDataFrame([(1, "a", 2.0)], "k long, v string, w double").write.parquet(f"{folder}/t")
    assert read_parquet(spark, f"{folder}/t", PAIR).columns == ["k", "v"]
    assert read_parquet(spark, f"{folder}/t", PAIR, allow_drift=True).columns == ["k", "v", "w"]
    wider = T.StructType([*PAIR.fields, T.StructField("gone", T.StringType())])
    assert read_parquet(spark, f"{folder}/t", wider).first()["gone"] is None
    with pytest.raises(ValueError, match="gone"):
        read_parquet(spark, f"{folder}/t", wider, validate=True)


def test_catalog_table_by_schema_and_name(spark, folder):
    spark.createDataFrame([(1, "new"), (2, "old")], "k long, v string").write.parquet(f"{folder}/t")
    register_table(spark, "sales", "things", f"{folder}/t")
    assert read_table(spark, "sales", "things", "v = 'new'").collect() == [(1, "new")]
    assert read_table(spark, "sales", "things", F.col("v") == "old").collect() == [(2, "old")]
    spark.createDataFrame([(9, "x")], "k long, v string").write.parquet(f"{folder}/t2")
    register_table(spark, "sales", "things", f"{folder}/t2")
    assert read_table(spark, "sales", "things").collect() == [(9, "x")]
    assert spark.read.parquet(f"{folder}/t").count() == 2


def test_change_window_is_open_below_and_closed_above(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01' + MAKE_DT_INTERVAL(CAST(id AS INT)) AS ts, id FROM range(5)")
    assert [r["id"] for r in changed_between(df, "ts", "2024-01-02", "2024-01-04").orderBy("id").collect()] == [2, 3]


def test_people_file_keeps_text_as_it_is(spark, folder):
    write_text(f"{folder}/people.txt", "first\tlast\temail\tphone\taddress\n anna \to'neil\ta@x\t0123456789\t1 \"Main\" St\n")
    assert read_people(spark, f"{folder}/people.txt").collect() == [(" anna ", "o'neil", "a@x", "0123456789", '1 "Main" St')]


def test_partitioned_writer_drops_columns_and_appends(spark, folder):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, p string, x int")
    for _ in range(2):
        batch_writer(df, "p", ["x"]).save(f"{folder}/t")
    assert sorted(f for f in os.listdir(f"{folder}/t") if f.startswith("p=")) == ["p=a", "p=b"]
    back = spark.read.parquet(f"{folder}/t")
    assert back.columns == ["k", "p"] and back.count() == 4
    batch_writer(df, "p", mode="overwrite").save(f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").count() == 2


def test_writer_makes_as_many_files_as_asked(spark, folder):
    batch_writer(spark.range(100).repartition(4), files=1).save(f"{folder}/t")
    assert len([f for f in os.listdir(f"{folder}/t") if f.endswith(".snappy.parquet")]) == 1


def test_one_file_per_partition_value_when_gathered(spark, folder):
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 5 AS p")
    batch_writer(df, "p").save(f"{folder}/t")
    for p in range(5):
        assert len([f for f in os.listdir(f"{folder}/t/p={p}") if f.endswith(".parquet")]) == 1


def test_schema_check_stops_before_the_write(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", PAIR)
    with pytest.raises(ValueError, match="schema differs"):
        table.publish(spark.createDataFrame([(1.5, "a")], "k double, v string"))
    assert not table.exists()
    with pytest.raises(ValueError):
        check_schema(spark.createDataFrame([(1, "a", 1)], "k long, v string, w int"), PAIR)
    check_schema(spark.createDataFrame([(1, "a", 1)], "k long, v string, w int"), PAIR, allow_drift=True)


def test_conform_converts_cuts_and_refuses_booleans(spark):
    target = T.StructType(
        [
            T.StructField("n", T.IntegerType()),
            T.StructField("d", T.DecimalType(6, 2)),
            T.StructField("c", T.VarcharType(3)),
        ]
    )
    df = spark.createDataFrame([("abcdef", 1.239, "7"), ("x", 2.0, "seven")], "c string, d double, n string")
    assert [tuple(map(str, r)) for r in conform(df, target).collect()] == [("7", "1.24", "abc"), ("None", "2.00", "x")]
    with pytest.raises(TypeError, match="boolean"):
        conform(spark.createDataFrame([(True,)], "n boolean"), T.StructType([T.StructField("n", T.IntegerType())]))


def test_versions_replace_each_other_and_can_read_their_predecessor(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", PAIR)
    assert table.read().count() == 0 and not table.exists()
    table.publish(spark.createDataFrame([(1, "a"), (2, "b")], PAIR))
    table.publish(table.read().withColumn("k", F.col("k") + 10))
    assert sorted(r["k"] for r in table.read().collect()) == [11, 12]
    assert sorted(r["k"] for r in table.read(1).collect()) == [1, 2]
    table.append(spark.createDataFrame([(3, "c")], PAIR))
    assert table.read().count() == 3 and table.versions() == [1, 2]
    table.delete(F.col("k") > 11)
    assert sorted(r["k"] for r in table.read().collect()) == [3, 11]
    table.clear()
    assert table.read().count() == 0
    table.expire(keep=1)
    assert table.versions() == [4]


def test_an_unfinished_version_is_invisible_and_overwritten(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", PAIR)
    table.publish(spark.createDataFrame([(1, "a")], PAIR))
    spark.createDataFrame([(9, "half")], PAIR).write.parquet(table.location(2))
    os.remove(f"{table.location(2)}/_SUCCESS")
    assert table.read().collect() == [(1, "a")]
    table.publish(spark.createDataFrame([(2, "b")], PAIR))
    assert table.versions() == [1, 2] and table.read().collect() == [(2, "b")]


def test_chunk_files_hold_their_rows(spark, folder):
    df = spark.range(40).selectExpr("id", "CAST(id DIV 10 AS INT) AS chunk")
    write_chunks(df, f"{folder}/chunks")
    back = spark.read.schema("id long").json(f"{folder}/chunks/chunk=2")
    assert sorted(r["id"] for r in back.collect()) == list(range(20, 30))


def test_intermediate_tables_go_to_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert materialize(spark.range(5)).count() == 5


# --- one JSON array in many tasks ---------------------------------------------------------------------

ODD = ['}', '{', ']}', '"', '\\', '\\"', '\\\\"}', 'a"}],[{"movie":[{', "é漢}\n{", "", '"movie": [', "x" * 300]


def elements(n):
    return [
        {"id": i, "t": ODD[i % len(ODD)], "list": [{"a": ODD[(i + k) % len(ODD)]} for k in range(i % 4)], ODD[i % 5] + "k": {"o": {}}}
        for i in range(n)
    ]


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("split", ["1k", "9k"])
def test_an_array_is_cut_by_many_tasks(spark, folder, split, indent):
    items = elements(200)
    other = [{"id": -1, "movie": [{"id": -2}]}]
    shapes = {
        "array": (None, items),
        "document": ("movie", {"before": other, "movie": items, "info": {"movie": other, "x": {"y": {}}}, "after": other, "n": [1, [{}]]}),
        "documents": ("movie", [{"movie": items[:70], "z": {"a": other}}, {}, {"movie": []}, {"q": other, "movie": items[70:]}, {"movie": None}]),
    }
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for shape, (key, content) in shapes.items():
            os.makedirs(f"{folder}/{shape}")
            with open(f"{folder}/{shape}/a.json", "w") as file:
                json.dump(content, file, indent=indent, ensure_ascii=False)
            found = array_elements(spark, f"{folder}/{shape}", key)
            got = [json.loads(row["value"]) for row in found.collect()]
            assert sorted(got, key=lambda x: x["id"]) == items, shape
            if split == "1k":
                assert found.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_cut_array_equals_the_read_of_one_task(spark, folder):
    movies = [{"Id": i, "Title": ODD[i % len(ODD)], "genres": [{"id": i, "name": "}"}] * (i % 3)} for i in range(50)]
    for n in range(3):
        os.makedirs(f"{folder}/raw", exist_ok=True)
        with open(f"{folder}/raw/movie_{n}.json", "w") as file:
            json.dump({"movie": [m for m in movies if m["Id"] % 3 == n]}, file, indent=2)
    open(f"{folder}/raw/empty.json", "w").close()
    plain, cut = (read_raw(spark, f"{folder}/raw", multi_line=True, cut=c) for c in (False, True))
    assert plain.schema == cut.schema and cut.count() == 50
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))
    with pytest.raises(ValueError, match="braces"):
        array_elements(spark, f"{folder}/raw", "a}")


@pytest.mark.parametrize("lines", [False, True])
def test_arrays_among_the_elements_are_left_out_at_the_ends_of_splits(spark, folder, lines):
    items = [{"id": i, "t": ODD[i % len(ODD)]} if i % 3 else [{"id": -i, "t": "x" * 200}, [{"a": "}"}]] for i in range(200)]
    with open(f"{folder}/a.json", "w") as file:
        file.write('{"movie": [' + (",\n" if lines else ", ").join(map(json.dumps, items)) + "]}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = [json.loads(row["value"]) for row in array_elements(spark, f"{folder}/a.json", "movie").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got, key=lambda x: x["id"]) == [x for x in items if isinstance(x, dict)]


def test_a_filter_on_a_cut_array_parses_once(spark, folder):
    write_text(f"{folder}/raw/a.json", '{"movie": [{"Id": 1, "Title": "a"},\n{"Id": "x"}, {"Id": null}, {}]}')
    cut = read_raw(spark, f"{folder}/raw", cut=True)
    assert sorted(str(r["value"]["Id"]) for r in cut.collect()) == ["1", "None", "None", "None"]
    kept = cut.filter("value.Id IS NOT NULL").select("value.Id", "value.Title")
    assert "isnotnull(from_json" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.collect() == [(1, "a")]


def test_pieces_are_lines_where_no_line_is_long(spark, folder):
    short, long = (f"{folder}/{name}" for name in ("short", "long"))
    for path, text in ((short, "x"), (long, "x" * (1 << 21))):
        os.makedirs(path)
        for n, tail in enumerate(("", "\n", "},\n")):
            with open(f"{path}/{n}.json", "w") as file:
                file.write(",\n".join(json.dumps({"movie": {"Id": i, "é漢": text if i == 7 else ""}}) for i in range(20)) + tail)
    write_text(f"{folder}/only/a.json", "x" * (1 << 21))
    write_text(f"{folder}/only/empty.json", "")
    assert _short_pieces(spark, short, _LINE_END)
    assert not _short_pieces(spark, long, _LINE_END) and not _short_pieces(spark, f"{folder}/only", _LINE_END)
    items = [{"Id": i, "t": "x" * (1 << 21) if i == 7 else "}"} for i in range(20)]
    write_text(f"{folder}/one/a.json", ",\n".join(map(json.dumps, items)).join(["[", "]"]))
    assert sorted((json.loads(r["value"]) for r in array_elements(spark, f"{folder}/one").collect()), key=lambda x: x["Id"]) == items


def test_texts_of_a_split_are_bounded_and_lose_nothing():
    pieces = [f'{{"a": "{"y" * 90000}{i}"' for i in range(100)]
    batch = pa.RecordBatch.from_pydict({"file": [1] * 60 + [2] * 40, "start": [0] * 100, "value": pieces})
    runs = [(file, start, [text.data.to_pybytes() for text in run]) for file, start, run in _runs(iter([batch]), _BRACE)]
    assert [run[:2] for run in runs] == [(1, 0), (2, 0)]
    assert b"".join(text for run in runs for text in run[2]).decode() == "".join(p + "}" for p in pieces)
    assert max(len(text) for run in runs for text in run[2]) < 1.2 * (1 << 20)


# --- drift ------------------------------------------------------------------------------------------------


def test_drift_is_found_at_any_depth():
    declared = T._parse_datatype_string("id long, at struct<x: double, day: timestamp_ntz, m: map<string, struct<n: long>>>, l array<struct<a: int, b: string>>, d decimal(10,2)")
    found = T._parse_datatype_string("ID int, at struct<x: float, m: map<string, struct<n: string, o: int>>>, l array<struct<a: long, c: int>>, d decimal(12,2), z int")
    got = {(d.place, d.kind) for d in differences(declared, found)}
    assert got == {
        ("id", "case"), ("id", "widened"), ("at.x", "widened"), ("at.day", "missing"), ("at.m[value].n", "clash"), ("at.m[value].o", "extra"),
        ("l[].a", "clash"), ("l[].b", "missing"), ("l[].c", "extra"), ("d", "clash"), ("z", "extra"),
    }
    assert not list(differences(declared, declared))
    assert holds(T.DecimalType(12, 3), T.DecimalType(10, 2)) and not holds(T.DecimalType(12, 3), T.DecimalType(12, 2))


def test_nested_loss_and_clashes_raise_and_narrow_types_widen(spark, folder):
    declared = T._parse_datatype_string("id long, at struct<x: double, n: long>")
    spark.createDataFrame([(1, (1.5, 2))], "id int, at struct<X: float, n: int>").coalesce(1).write.parquet(f"{folder}/ok")
    for allow in (False, True):
        assert [r.asDict(True) for r in read_parquet(spark, f"{folder}/ok", declared, allow, True).collect()] == [{"id": 1, "at": {"x": 1.5, "n": 2}}]
    spark.createDataFrame([(1, (1.5,))], "id long, at struct<x: double>").coalesce(1).write.parquet(f"{folder}/lost")
    with pytest.raises(ValueError, match="at.n missing"):
        read_parquet(spark, f"{folder}/lost", declared, validate=True)
    assert read_parquet(spark, f"{folder}/lost", declared).first()["at"]["n"] is None
    spark.createDataFrame([("a", (1.5, 2))], "id string, at struct<x: double, n: long>").coalesce(1).write.parquet(f"{folder}/clash")
    with pytest.raises(ValueError, match="id clash, declared bigint, found string"):
        read_parquet(spark, [f"{folder}/ok", f"{folder}/clash"], declared, validate=True, sample=None)
    for name, kind in (("e1", "int"), ("e2", "string")):
        spark.createDataFrame([(1, (1.5, 2, None))], f"id long, at struct<x: double, n: long, e: {kind}>").coalesce(1).write.parquet(f"{folder}/{name}")
    assert read_parquet(spark, f"{folder}/e1", declared, allow_drift=True).schema["at"].dataType.fieldNames() == ["x", "n", "e"]
    with pytest.raises(ValueError, match="at.e clash"):
        read_parquet(spark, [f"{folder}/e1", f"{folder}/e2"], declared, allow_drift=True)


def test_one_document_is_written_without_sorting(spark, folder):
    from tidewright.plans.job_queries import _one_document

    lines = spark.range(0, 5000, 1, 6).selectExpr("to_json(struct(id as Id)) as line")
    document = _one_document(lines)
    assert "Sort" not in document._jdf.queryExecution().executedPlan().toString()
    document.write.text(f"{folder}/one")
    (file,) = Path(f"{folder}/one").glob("part-*")
    movies = json.loads(file.read_text())["movie"]
    assert sorted(m["Id"] for m in movies if m["Id"] is not None) == list(range(5000)) and len(movies) == 5001


def test_the_writer_of_one_document_handles_few_large_rows(spark):
    from tidewright.plans.job_queries import _one_document

    lines = spark.range(0, 5000, 1, 6).selectExpr("to_json(struct(id as Id)) as line")
    rows = [row["value"] for row in _one_document(lines).collect()]
    assert len(rows) == 8 and [m["Id"] for m in json.loads("\n".join(rows))["movie"]][-1] is None
    assert sorted(m["Id"] for m in json.loads("\n".join(rows))["movie"][:-1]) == list(range(5000))

import datetime as dt
import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewright import schemas
from tidewright.plans import medallion as m

NOW = dt.datetime(2022, 3, 4, 5, 6, 7)


def movie(id, run_time=90, budget=200000.0, language="en", genres=((1, "Drama"),), created="2021-04-03T16:51:30.16"):
    return {
        "Id": id,
        "RunTime": run_time,
        "Budget": budget,
        "OriginalLanguage": language,
        "CreatedDate": created,
        "Title": f"t{id}",
        "genres": None if genres is None else [{"id": i, "name": n} for i, n in genres],
    }


MOVIES = [
    movie(1),
    movie(1),
    movie(2, run_time=-50, budget=5.0),
    movie(3, run_time=None, budget=None),
    movie(4, run_time=0, budget=99999.0, language="fr", genres=((2, ""), (3, "War"), (1, "Drama"))),
    movie(5, run_time=-1, genres=()),
    movie(6, run_time=10, genres=None, created="not a date"),
]


def frame(spark, movies=MOVIES):
    return m.to_bronze(spark.createDataFrame([(x,) for x in movies], f"value {schemas.MOVIE.simpleString()}"), NOW)


def drop(folder, movies=MOVIES, name="movie.json"):
    os.makedirs(f"{folder}/raw", exist_ok=True)
    with open(f"{folder}/raw/{name}", "w") as file:
        json.dump({"movie": movies}, file, indent=1)
    return f"{folder}/raw"


def statuses(lake):
    return Counter((r["Id"], r["status"]) for r in lake.bronze.read().select("value.Id", "status").collect())


def test_bronze_keeps_documents_whole_and_stamps_them(spark, folder):
    lake = m.Lakehouse(spark, folder)
    m.raw_to_bronze(lake, drop(folder), NOW, multi_line=True)
    bronze = lake.bronze.read()
    assert bronze.drop("p_load").schema.simpleString() == schemas.BRONZE.simpleString()
    assert bronze.count() == 7
    row = bronze.filter("value.Id = 4").first()
    assert (row["datasource"], row["status"], row["p_ingestdate"]) == ("movie.json", "new", dt.date(2022, 3, 4))
    assert row["ingesttime"] == NOW
    assert lake.bronze.partitions() == {"p_ingestdate=2022-03-04/p_load=20220304050607000"}


def test_ingest_time_defaults_to_the_clock(spark):
    row = m.to_bronze(frame(spark).select("value")).first()
    assert abs((dt.datetime.now(dt.UTC).replace(tzinfo=None) - row["ingesttime"]).total_seconds()) < 3600


def test_movie_projection(spark):
    got = {r["Id"]: r for r in m.transform(frame(spark), "movie").drop("value").collect()}
    assert [f.name for f in schemas.SILVER_MOVIE] == m.silver_movie(frame(spark)).drop("value").columns
    assert {i: r["Budget"] for i, r in got.items()} == {1: 200000.0, 2: 100000.0, 3: None, 4: 100000.0, 5: 200000.0, 6: 200000.0}
    assert got[4]["Genres_Id"] == [2, 3, 1] and got[5]["Genres_Id"] == [] and got[6]["Genres_Id"] is None
    assert got[1]["p_CreatedDate"] == dt.date(2021, 4, 3) and got[6]["p_CreatedDate"] is None
    assert {r["Language_Id"] for r in got.values()} == {1}


def test_genres_drop_blanks_and_empty_arrays(spark):
    got = m.transform(frame(spark), "genres")
    assert Counter(map(tuple, got.collect())) == Counter([(1, "Drama"), (3, "War")])
    first = m.silver_genres(frame(spark), mode="first")
    assert Counter(map(tuple, first.collect())) == Counter([(1, "Drama"), (2, ""), (None, None)])


def test_languages_all_have_id_one(spark):
    assert Counter(map(tuple, m.transform(frame(spark), "language").collect())) == Counter([(1, "en"), (1, "fr")])


def test_unknown_table_is_an_error(spark):
    with pytest.raises(ValueError, match="actors"):
        m.transform(frame(spark), "actors")


def test_classification(spark):
    movies = m.silver_movie(frame(spark))
    ids = lambda df: sorted(r["Id"] for r in df.collect())
    clean, quarantined = m.classify(movies)
    assert ids(clean) == [1, 4, 6] and ids(quarantined) == [2, 5]
    _, quarantined = m.classify(movies, null_to_quarantine=True)
    assert ids(quarantined) == [2, 3, 5]


def test_status_merge_compares_whole_documents(spark):
    bronze = frame(spark)
    updates = bronze.filter("value.Id IN (1, 3)").select("value", F.lit("loaded").alias("status"))
    updates = updates.unionByName(updates.withColumn("status", F.lit("quarantined")).filter("value.Id = 1"))
    merged = m.merge_status(bronze, updates)
    assert merged.columns == bronze.columns
    # Id 3 has NULL fields; they compare equal inside the document.
    assert Counter((r["Id"], r["status"]) for r in merged.select("value.Id", "status").collect()) == Counter(
        [(1, "loaded"), (1, "loaded"), (2, "new"), (3, "loaded"), (4, "new"), (5, "new"), (6, "new")]
    )


@pytest.mark.parametrize("batch, outcome", [("new", m.bronze_outcome), ("quarantined", m.repair_outcome)])
def test_settle_equals_the_merge_of_the_whole_table(spark, batch, outcome):
    # Every document under every status, and one document that only one status has.
    parts = [frame(spark).withColumn("status", F.lit(s)) for s in ("new", "loaded", "quarantined")]
    parts.append(frame(spark, [movie(7, run_time=-9)]).withColumn("status", F.lit("loaded")))
    parts.append(frame(spark, [movie(None, run_time=-9)]).withColumn("status", F.lit("new")))
    parts.append(frame(spark, [movie(None, run_time=-9)]).withColumn("status", F.lit("loaded")))
    parts.append(frame(spark, [movie(None, run_time=-9)]).withColumn("status", F.lit("quarantined")))
    bronze = parts[0]
    for part in parts[1:]:
        bronze = bronze.unionByName(part)
    updates = bronze.filter((F.col("status") == batch) & outcome().isNotNull()).select("value", outcome().alias("status"))
    count = lambda df: Counter((str(r["value"]), r["status"]) for r in df.collect())
    assert count(m.settle(bronze, batch, outcome())) == count(m.merge_status(bronze, updates))


@pytest.mark.parametrize("batch, outcome", [("new", m.bronze_outcome), ("quarantined", m.repair_outcome)])
def test_settling_files_equals_the_merge_of_the_whole_table(spark, folder, batch, outcome):
    # Every document under every status, each status in a load of its own, and a load that nothing concerns.
    table = m.Lakehouse(spark, folder).bronze
    for n, status in enumerate(("new", "loaded", "quarantined")):
        part = frame(spark).unionByName(frame(spark, [movie(None, run_time=-9)]))
        table.replace(part.withColumn("status", F.lit(status)).withColumn("p_load", F.lit(str(n))))
    table.replace(frame(spark, [movie(8), movie(None, run_time=9), movie(2, run_time=-51)]).withColumn("status", F.lit("loaded")).withColumn("p_load", F.lit("3")))
    before, bronze = files_of(folder), spark.createDataFrame(table.read().collect(), table.schema)
    updates = bronze.filter((F.col("status") == batch) & outcome().isNotNull()).select("value", outcome().alias("status"))
    count = lambda df: Counter((str(r["value"]), r["status"], r["p_load"]) for r in df.collect())
    want = count(m.merge_status(bronze, updates))
    m.settle_files(table, batch, outcome(), ["x,silver,1"])
    assert count(table.read()) == want and table.done() == {"x,silver,1"}
    assert {f for f in before if "p_load=3" in f} == {f for f in files_of(folder) if "p_load=3" in f}


def test_medallion_from_files(spark, folder):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.run_medallion(lake, drop(folder), NOW, multi_line=True)
    # Everything with a run time is loaded in the end.
    assert statuses(lake) == Counter(
        [(1, "loaded"), (1, "loaded"), (2, "loaded"), (3, "new"), (4, "loaded"), (5, "loaded"), (6, "loaded")]
    )
    silver = {r["Id"]: r for r in lake.movie.read().collect()}
    assert lake.movie.read().count() == 5
    assert {i: r["RunTime"] for i, r in silver.items()} == {1: 90, 2: 50, 4: 0, 5: 1, 6: 10}
    # The floor is not applied again on repair.
    assert silver[2]["Budget"] == 5.0 and silver[4]["Budget"] == 100000.0
    lake.register("movie_test")
    assert spark.table("movie_test.movie_bronze").filter("status = 'loaded'").count() == 6
    assert spark.table("movie_test.genres_silver").count() == 2
    assert spark.table("movie_test.movie_silver").filter("p_CreatedDate = DATE'2021-04-03'").count() == 4

    before = lake.movie.read().collect(), statuses(lake)
    m.run_medallion(lake, f"{folder}/raw", NOW, multi_line=True)
    assert (sorted(map(str, lake.movie.read().collect())), statuses(lake)) == (sorted(map(str, before[0])), before[1])


def test_steps_between(spark, folder):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.raw_to_bronze(lake, drop(folder), NOW, multi_line=True)
    m.bronze_to_silver(lake)
    assert statuses(lake) == Counter(
        [(1, "loaded"), (1, "loaded"), (2, "quarantined"), (3, "new"), (4, "loaded"), (5, "quarantined"), (6, "loaded")]
    )
    assert sorted(r["Id"] for r in lake.movie.read().collect()) == [1, 4, 6]


def test_append_mode_adds_a_second_drop(spark, folder):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.run_medallion(lake, drop(folder), NOW, multi_line=True)
    os.rename(f"{folder}/raw", f"{folder}/first")
    second = [movie(10, run_time=-7), movie(2, run_time=-50, budget=5.0), movie(11)]
    m.raw_to_bronze(lake, drop(folder, second), NOW + dt.timedelta(days=1), mode="append", multi_line=True)
    m.bronze_to_silver(lake, mode="append")
    # Document 2 came again, so its earlier copy goes back to quarantine with it, as a merge by value does.
    assert statuses(lake)[(2, "quarantined")] == 2 and statuses(lake)[(11, "loaded")] == 1
    m.silver_update(lake)
    assert statuses(lake)[(2, "loaded")] == 2 and statuses(lake)[(10, "loaded")] == 1
    assert Counter(r["Id"] for r in lake.movie.read().collect()) == Counter([1, 4, 6, 2, 5, 10, 11, 2])


def test_append_without_a_newer_drop_keeps_silver(spark, folder):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    tables = {"genres": lake.genres, "language": lake.language, "movie": lake.movie}
    # Two loads go into silver at once; only the second has a document without a run time.
    first = [movie(1), movie(2, language="de", genres=((5, "Crime"),))]
    second = [movie(1), movie(3, language="fr", genres=((6, "War"),)), movie(4, run_time=None, genres=((7, "Noir"),))]
    m.raw_to_bronze(lake, drop(folder, first), NOW, multi_line=True)
    os.rename(f"{folder}/raw", f"{folder}/first")
    m.raw_to_bronze(lake, drop(folder, second), NOW + dt.timedelta(days=1), mode="append", multi_line=True)
    m.bronze_to_silver(lake)
    rows = lambda name: Counter(tuple(r)[:2] for r in tables[name].read().drop("p_load").collect())
    assert rows("genres") == Counter([(1, "Drama"), (5, "Crime"), (6, "War"), (7, "Noir")])
    assert rows("language") == Counter([(1, "en"), (1, "de"), (1, "fr")])
    assert sorted(r["Id"] for r in lake.movie.read().collect()) == [1, 2, 3]
    before = {name: set(rows(name)) for name in tables}
    for _ in range(2):
        m.bronze_to_silver(lake, mode="append")
        assert {name: set(rows(name)) for name in tables} == before
    assert sorted(r["Id"] for r in lake.movie.read().collect()) == [1, 2, 3]
    assert statuses(lake)[(4, "new")] == 1


def test_a_job_that_dies_before_the_status_can_run_again(spark, folder, monkeypatch):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.raw_to_bronze(lake, drop(folder), NOW, multi_line=True)
    monkeypatch.setattr(lake.bronze, "rewrite", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        m.bronze_to_silver(lake)
    monkeypatch.undo()
    assert {s for _, s in statuses(lake)} == {"new"}
    m.bronze_to_silver(lake)
    assert sorted(r["Id"] for r in lake.movie.read().collect()) == [1, 4, 6]


def test_rank_and_status_by_id(spark):
    ranked = m.rank_key(spark.createDataFrame([("en",), ("fr",), ("en",)], "lang string"), "lang")
    assert Counter(map(tuple, ranked.collect())) == Counter([(1, "en"), (1, "fr")])
    got = m.status_by_id(frame(spark)).select("value.Id", "status").collect()
    assert Counter(map(tuple, got)) == Counter(
        [(1, "loaded"), (1, "loaded"), (2, "quarantined"), (3, "quarantined"), (4, "loaded"), (5, "quarantined"), (6, "loaded")]
    )


def test_documents_that_differ_in_the_sign_of_zero_are_equal(spark):
    bronze = frame(spark, [movie(1, budget=0.0), movie(2, budget=float("nan"))])
    updates = frame(spark, [movie(1, budget=-0.0), movie(2, budget=float("nan"))]).select("value", F.lit("loaded").alias("status"))
    assert {r["status"] for r in m.merge_status(bronze, updates).collect()} == {"loaded"}


def files_of(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def test_loads_without_changed_rows_are_not_written(spark, folder):
    """Three drops, all with a document without a run time, which stays new."""
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.run_medallion(lake, drop(folder), NOW, multi_line=True)
    for n in (1, 2):
        before = {name: files_of(f"{folder}/lake/{name}") for name in ("bronze", "silver")}
        os.rename(f"{folder}/raw", f"{folder}/drop{n}")
        again = [movie(20 + n), movie(30 + n, run_time=-4), movie(40 + n, run_time=None), movie(2, run_time=-51 - n)]
        m.run_medallion(lake, drop(folder, again), NOW + dt.timedelta(days=n), "append", multi_line=True)
        for name, files in before.items():
            assert files and files.items() <= files_of(f"{folder}/lake/{name}").items()
        assert statuses(lake)[(20 + n, "loaded")] == statuses(lake)[(30 + n, "loaded")] == statuses(lake)[(40 + n, "new")] == 1
    ledger = Counter((r["step"], r["run"], r["state"]) for r in lake.ledger().collect())
    assert ledger == Counter({("silver", 1, "done"): 3, ("repair", 1, "done"): 3})
    # A true copy of an old document writes the file that holds it, and no other.
    os.rename(f"{folder}/raw", f"{folder}/drop3")
    m.raw_to_bronze(lake, drop(folder, [movie(31, run_time=-4)]), NOW + dt.timedelta(days=3), "append", multi_line=True)
    assert Counter(r["state"] for r in lake.ledger().collect())["pending"] == 1
    before = files_of(f"{folder}/lake/bronze")
    m.bronze_to_silver(lake, mode="append")
    gone = {f for f in before if f not in files_of(f"{folder}/lake/bronze")}
    assert {f.split("p_ingestdate=")[1][:10] for f in gone} == {"2022-03-05", "2022-03-07"}
    assert statuses(lake)[(31, "quarantined")] == 2


def test_two_repairs_of_one_load_keep_all_rows(spark, folder):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.run_medallion(lake, drop(folder), NOW, multi_line=True)
    assert sorted(r["Id"] for r in lake.movie.read().collect()) == [1, 2, 4, 5, 6]
    m.bronze_to_silver(lake, mode="append", null_to_quarantine=True)
    assert statuses(lake)[(3, "quarantined")] == 1
    for _ in range(2):
        m.silver_update(lake)
        assert sorted(r["Id"] for r in lake.movie.read().collect()) == [1, 2, 3, 4, 5, 6]
    assert {s for _, s in statuses(lake)} == {"loaded"}
    loads = {r["p_load"] for r in lake.movie.read().select("p_load").collect()}
    assert loads == {"20220304050607000", "20220304050607000-repaired-1", "20220304050607000-repaired-2"}


def test_a_load_that_comes_again_replaces_its_silver_rows(spark, folder):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.run_medallion(lake, drop(folder), NOW, multi_line=True)
    os.rename(f"{folder}/raw", f"{folder}/first")
    m.run_medallion(lake, drop(folder, [movie(1), movie(9, created="2020-01-01")]), NOW, "append", multi_line=True)
    assert sorted(r["Id"] for r in lake.movie.read().collect()) == [1, 9]
    assert lake.runs("silver") == {"20220304050607000": 1} and lake.runs("repair") == {}


def test_a_status_write_that_dies_is_carried_out_by_the_next_reader(spark, folder, monkeypatch):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.raw_to_bronze(lake, drop(folder), NOW, multi_line=True)
    m.bronze_to_silver(lake)
    move, moved = lake.bronze._move, []

    def dying(source, target):
        if not target.endswith("plan"):
            moved.append(target)
            raise RuntimeError("lost")
        move(source, target)

    with monkeypatch.context() as patch:
        patch.setattr(lake.bronze, "_move", dying)
        with pytest.raises(RuntimeError):
            m.silver_update(lake)
    assert moved
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.silver_update(lake)
    assert statuses(lake)[(2, "loaded")] == 1 and statuses(lake)[(1, "loaded")] == 2
    assert Counter(r["Id"] for r in lake.movie.read().collect()) == Counter([1, 4, 6, 2, 5])


def test_a_repair_that_dies_before_the_status_adds_nothing_twice(spark, folder, monkeypatch):
    lake = m.Lakehouse(spark, f"{folder}/lake")
    m.raw_to_bronze(lake, drop(folder), NOW, multi_line=True)
    m.bronze_to_silver(lake)
    with monkeypatch.context() as patch:
        patch.setattr(lake.bronze, "rewrite", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            m.silver_update(lake)
    m.silver_update(lake)
    m.silver_update(lake)
    assert Counter(r["Id"] for r in lake.movie.read().collect()) == Counter([1, 4, 6, 2, 5])

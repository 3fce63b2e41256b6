"""The table and file jobs as queries: one movie per order, events as changing rows, customers as people.

Jobs that write run for real, in a new folder below the shared one, and the result is read back.
"""

import datetime as dt
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright import schemas
from tidewright.operators import check, first_per_key, split, tag
from tidewright.plans import files, incremental, medallion
from tidewright.sources import FILE, batch_writer, open_tables, read_table, scratch_path
from tidewright.sources.readers import read_parquet, read_raw

INGESTED = dt.datetime(2022, 1, 1)
FIRST_CUTOFF = dt.datetime(2024, 1, 10)
SECOND_CUTOFF = dt.datetime(2024, 1, 20)

EVENT_ROW = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


# --- movies ----------------------------------------------------------------------------------------


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """Movie documents of the orders, in `value`.

    Run time is the shortest lead time of its lines, genres are the distinct (size, type) of its parts;
    the name of size 1 is blank. Orders without lines have neither. Every tenth order gives an exact copy
    too, and every seventh another document under its Id, with the opposite sign of the run time.
    """
    lineitem, orders, part = open_tables(spark, folder, "lineitem", "orders", "part")
    genre = F.struct(
        F.col("p_size").cast("bigint").alias("id"),
        F.when(F.col("p_size") == 1, F.lit("")).otherwise(F.col("p_type")).alias("name"),
    )
    per_order = (
        lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("shipped"), F.sort_array(F.collect_set(genre)).alias("genres"))
    )
    key = F.col("o_orderkey")
    kinds = F.array(F.lit("first"), F.when(key % 10 == 0, "copy"), F.when(key % 7 == 0, "other"))
    joined = orders.join(per_order, key == F.col("l_orderkey"), "left").withColumn(
        "days", F.date_diff("shipped", "o_orderdate")
    )
    joined = joined.withColumn("kind", F.explode(F.array_compact(kinds)))
    day = F.to_date("o_orderdate").cast("string")
    known = {
        "Budget": F.col("o_totalprice"),
        "CreatedBy": F.col("o_orderstatus"),
        "CreatedDate": day,
        "Id": F.col("o_orderkey"),
        "OriginalLanguage": F.col("o_orderpriority"),
        "ReleaseDate": day,
        "RunTime": F.when(F.col("kind") == "other", -1 - F.col("days")).otherwise(F.col("days")),
        "Title": F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.when(F.col("kind") == "other", " again").otherwise("")),
        "genres": F.col("genres"),
    }
    fields = [known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.MOVIE]
    return joined.select(F.struct(*fields).alias("value"))


def bronze(spark, folder) -> DataFrame:
    return medallion.to_bronze(movies(spark, folder), INGESTED)


def _raw_drop(spark, folder) -> str:
    """The movies as a folder of raw JSON, one document with one movie per line, in files that split."""
    return _write_drop(movies(spark, folder))


def _write_drop(documents: DataFrame) -> str:
    path = scratch_path(documents.sparkSession, "raw-movies")
    documents.select(F.array("value").alias("movie")).write.json(path)
    return path


def s01_multi_line_documents(spark, folder) -> DataFrame:
    """Movies read from multi-line arrays of documents, with a field that the schema does not declare."""
    path = scratch_path(spark, "raw-arrays")
    extra = F.concat(F.lit("about "), F.col("value.Title")).alias("Extra")
    grouped = movies(spark, folder).select(F.struct("value.*", extra).alias("value"))
    # Files of bounded size: some hundreds of movies each.
    grouped = grouped.groupBy(F.floor(F.col("value.Id") / 500).alias("file")).agg(F.collect_list("value").alias("movie"))
    text = F.concat(F.lit("[\n"), F.to_json(F.struct("movie")), F.lit(',\n{"movie": []},\n{}\n]'))
    grouped.select("file", text.alias("text")).write.partitionBy("file").text(path)
    return read_raw(spark, path, multi_line=True, allow_drift=True).select("value.Id", "value.RunTime", "value.Extra")


def _one_document(lines: DataFrame) -> DataFrame:
    """The lines of one file that is a single document with an array of them, as its one writer lays them down: they stream
    through its task in any order, many to a row, and nothing is sorted or held."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                ended = pc.binary_join_element_wise(batch.column(0), "", ",")
                together = pa.ListArray.from_arrays(pa.array([0, len(ended)], pa.int32()), ended)
                yield pa.RecordBatch.from_arrays([pc.binary_join(together, "\n")], ["value"])

    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": ['{"count": {"of": [{}]},\n"movie": [']})
        yield from batches
        yield pa.RecordBatch.from_pydict({"value": ['{"Id": null}]}']})

    # Shuffled, so that the rows are made by many tasks; joined before, so that the writer handles few large ones.
    return lines.mapInArrow(blocks, "value string").repartition(1).mapInArrow(document, "value string")


def s04_one_large_array(spark, folder) -> DataFrame:
    """Movies of one file that is a single document, read by many tasks, with titles full of quotes and brackets."""
    title = F.concat(F.lit('"}],[{ \\ '), F.col("value.Title"), F.lit(' {"movie": [{'))
    lines = movies(spark, folder).select(F.to_json(F.col("value").withField("Title", title)).alias("line"))
    path = scratch_path(spark, "raw-array")
    _one_document(lines).write.text(path)
    read = read_raw(spark, path, cut=True).filter("value.Id IS NOT NULL")
    return read.select("value.Id", "value.RunTime", "value.Title", F.size("value.genres").alias("genres"))


def s02_catalog_flow(spark, folder) -> DataFrame:
    """New bronze rows and silver rows by table name, after a medallion that registers its tables."""
    lake, database = _new_lake(spark), f"lake_{uuid.uuid4().hex}"
    medallion.raw_to_bronze(lake, _raw_drop(spark, folder), INGESTED, database=database)
    medallion.bronze_to_silver(lake)
    medallion.silver_update(lake)
    lake.register(database)
    new = read_table(spark, database, "movie_bronze", "status = 'new'").select("value.Id")
    silver = read_table(spark, database, "movie_silver", F.col("RunTime") >= 0).select("Id")
    return new.withColumn("found", F.lit("bronze")).unionByName(silver.withColumn("found", F.lit("silver")))


def s03_parquet_drift(spark, folder) -> DataFrame:
    """Parts written to two files and read under a shorter declared schema that must hold, extra columns kept."""
    part = open_tables(spark, folder, "part")
    path = scratch_path(spark, "parts")
    batch_writer(part, mode="overwrite", files=2).save(path)
    declared = T.StructType([T.StructField("p_size", T.IntegerType()), T.StructField("p_partkey", T.LongType())])
    return read_parquet(spark, path, declared, allow_drift=True, validate=True)


def s05_nested_drift(spark, folder) -> DataFrame:
    """Movies in files of several types: one lacks nothing, one has narrower numbers and names in other letters, one
    has further fields inside of its documents."""
    path = scratch_path(spark, "drifted")
    rows = movies(spark, folder).filter("value.RunTime >= 0").select("value.*")
    key = F.col("Id") % 3
    plain = rows.select("Id", "RunTime", "Budget", "genres")
    narrow = F.transform("genres", lambda g: F.struct(g["id"].cast("int").alias("ID"), g["name"].alias("name")))
    more = F.transform("genres", lambda g: F.struct(g["id"], g["name"], F.struct(F.upper(g["name"]).alias("loud")).alias("said")))
    plain.filter(key == 0).write.parquet(f"{path}/a")
    plain.filter(key == 1).select(F.col("Id").cast("int").alias("id"), "RunTime", F.col("Budget").cast("float"), narrow.alias("Genres")).write.parquet(f"{path}/b")
    plain.filter(key == 2).select("Id", "RunTime", "Budget", more.alias("genres"), F.lit("new").alias("note")).write.parquet(f"{path}/c")
    declared = plain.schema
    read = read_parquet(spark, [f"{path}/{x}" for x in "abc"], declared, allow_drift=True, validate=True, sample=None)
    loud = F.array_join(F.transform("genres", lambda g: g["said"]["loud"]), ",")
    return read.select("Id", "RunTime", F.round("Budget", -2).alias("budget"), _genre_text("genres").alias("genres"), loud.alias("loud"), "note")


def _genre_text(column: str):
    return F.array_join(F.transform(column, lambda g: F.concat_ws(":", g["id"].cast("string"), g["name"])), ",")


def m01_raw_to_bronze(spark, folder) -> DataFrame:
    """Bronze after a raw folder was loaded."""
    lake = _new_lake(spark)
    medallion.raw_to_bronze(lake, _raw_drop(spark, folder), INGESTED)
    return lake.bronze.read().select(
        "value.Id",
        "value.Budget",
        "value.RunTime",
        "value.OriginalLanguage",
        "value.CreatedDate",
        "value.Title",
        _genre_text("value.genres").alias("genres"),
        "datasource",
        "status",
        "p_ingestdate",
    )


def m02_movie_projection(spark, folder) -> DataFrame:
    """Silver columns of the new bronze rows."""
    new = bronze(spark, folder).filter(F.col("status") == medallion.NEW)
    return medallion.transform(new, "movie").select(
        "Id",
        "Budget",
        "RunTime",
        "Title",
        "ReleaseDate",
        "p_CreatedDate",
        "CreatedBy",
        F.array_join(F.transform("Genres_Id", lambda i: i.cast("string")), ",").alias("Genres_Id"),
        F.try_element_at("Genres_Id", F.lit(1)).alias("first_genre"),
        "Language_Id",
    )


def _classified(spark, folder):
    clean, quarantined = medallion.classify(medallion.silver_movie(bronze(spark, folder)))
    columns = ["Id", "Budget", "RunTime", "p_CreatedDate"]
    return clean.select(*columns), quarantined.select(*columns)


def m03_clean(spark, folder) -> DataFrame:
    return _classified(spark, folder)[0]


def m04_quarantine(spark, folder) -> DataFrame:
    return _classified(spark, folder)[1]


def m05_genres(spark, folder) -> DataFrame:
    return medallion.transform(bronze(spark, folder), "genres").orderBy("Id", "name")


def m06_language(spark, folder) -> DataFrame:
    return medallion.transform(bronze(spark, folder), "language")


def _new_lake(spark) -> medallion.Lakehouse:
    # The orders of one day are few, so silver has no folder per day here.
    return medallion.Lakehouse(spark, scratch_path(spark, "lake"), movie_partition=None)


def _lake_with_bronze(spark, folder) -> medallion.Lakehouse:
    lake = _new_lake(spark)
    lake.bronze.publish(bronze(spark, folder))
    return lake


def m07_status_merge(spark, folder) -> DataFrame:
    """Status of every bronze row after the load into silver."""
    lake = _lake_with_bronze(spark, folder)
    medallion.bronze_to_silver(lake)
    return lake.bronze.read().select("value.Id", "status")


def m07_value_merge(spark, folder) -> DataFrame:
    """The same status from a merge by whole document of the classified movies."""
    rows = bronze(spark, folder)
    updates = rows.select("value", medallion.bronze_outcome().alias("status")).dropna(subset=["status"])
    return medallion.merge_status(rows, updates).select("value.Id", "status")


def m08_repair(spark, folder) -> DataFrame:
    """The silver movie table after load and repair."""
    lake = _lake_with_bronze(spark, folder)
    medallion.bronze_to_silver(lake)
    medallion.silver_update(lake)
    return lake.movie.read().select("Id", "Budget", "RunTime", "p_CreatedDate", "Language_Id")


def m08_repair_status(spark, folder) -> DataFrame:
    """Bronze rows by status after the whole medallion ran from the raw folder."""
    lake = _new_lake(spark)
    medallion.run_medallion(lake, _raw_drop(spark, folder), INGESTED)
    return lake.bronze.read().groupBy("status").agg(F.count("*").alias("n"))


def m13_second_drop(spark, folder) -> DataFrame:
    """Status of all bronze rows after a second drop brought some of the documents again and went into silver."""
    lake = _lake_with_bronze(spark, folder)
    medallion.bronze_to_silver(lake)
    medallion.silver_update(lake)
    again = movies(spark, folder).filter(F.col("value.Id") % 5 == 0)
    medallion.raw_to_bronze(lake, _write_drop(again), INGESTED + dt.timedelta(days=1), mode="append")
    medallion.bronze_to_silver(lake, mode="append")
    return lake.bronze.read().select("value.Id", "value.RunTime", "status", "p_ingestdate")


def m14_file_merge(spark, folder) -> DataFrame:
    """A merge by whole document into a bronze table with a load per month: status of every row, and whether the file
    that it lay in was written again."""
    lake = _new_lake(spark)
    month = F.date_format(F.to_date("value.CreatedDate"), "yyyy-MM")
    rows = bronze(spark, folder).withColumn(medallion.LOAD, month)
    lake.bronze.publish(rows.repartition(medallion.LOAD))
    before = [row[0] for row in lake.bronze.read(files=True).select(FILE).distinct().collect()]  # a file a month
    march = rows.filter(month.isin("1996-03", "1997-03") & (F.col("value.Id") % 3 == 0))
    updates = march.select("value", F.lit(medallion.QUARANTINED).alias("status"))
    medallion.merge_status_files(lake.bronze, updates)
    merged = lake.bronze.read(files=True)
    return merged.select("value.Id", "value.RunTime", "status", (~F.col(FILE).isin(before)).alias("rewritten"))


def m15_repair_twice(spark, folder) -> DataFrame:
    """Silver movies after a load and its repair, and after the documents left over were quarantined and repaired too."""
    lake = _lake_with_bronze(spark, folder)
    medallion.bronze_to_silver(lake)
    medallion.silver_update(lake)
    medallion.bronze_to_silver(lake, mode="append", null_to_quarantine=True)
    medallion.silver_update(lake)
    movies_of = lake.movie.read()
    run = F.coalesce(F.regexp_extract(medallion.LOAD, "-repaired-([0-9]+)$", 1).try_cast("int"), F.lit(0))
    return movies_of.select("Id", "Budget", "RunTime", "p_CreatedDate", run.alias("run"))


def m16_ledger(spark, folder) -> DataFrame:
    """Steps by load after two drops, of which the second is not in silver yet, and the silver rows of each load."""
    lake = _lake_with_bronze(spark, folder)
    medallion.bronze_to_silver(lake)
    medallion.silver_update(lake)
    again = movies(spark, folder).filter(F.col("value.Id") % 5 == 0)
    medallion.raw_to_bronze(lake, _write_drop(again), INGESTED + dt.timedelta(days=1), mode="append")
    held = lake.movie.read().groupBy(F.col(medallion.LOAD).alias("held")).agg(F.count("*").alias("n"))
    own = F.when(F.col("step") == medallion.REPAIR, F.concat(medallion.LOAD, F.lit("-repaired-"), F.col("run").cast("string")))
    rows = lake.ledger().withColumn("own", F.coalesce(own, medallion.LOAD)).join(held, F.col("own") == F.col("held"), "left")
    return rows.select(medallion.LOAD, "step", "run", "state", F.coalesce("n", F.lit(0)).alias("silver_rows"))


def m09_dedupe_by_key(spark, folder) -> DataFrame:
    """The first line of each (order, line number), all other columns breaking ties."""
    lineitem = open_tables(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return first_per_key(lineitem, ["l_orderkey", "l_linenumber"])


def m10_split_default(spark, folder) -> DataFrame:
    """Movies by stream: run time of at least 0, and all others with NULL among them."""
    flat = movies(spark, folder).select("value.Id", "value.RunTime")
    clean, rest = split(flat, F.col("RunTime") >= 0)
    return clean.withColumn("stream", F.lit("clean")).unionByName(rest.withColumn("stream", F.lit("rest")))


def m11_rank_key(spark, folder) -> DataFrame:
    """One language per ranked Id; the rank is 1 for all, so one row is left."""
    documents = open_tables(spark, folder, "documents")
    return first_per_key(medallion.rank_key(documents, "lang"), ["Id"])


def m11_rank_rows(spark, folder) -> DataFrame:
    """Every distinct language with its rank."""
    return medallion.rank_key(open_tables(spark, folder, "documents"), "lang")


def m12_status_join(spark, folder) -> DataFrame:
    """Bronze rows with the status joined by nested Id."""
    return medallion.status_by_id(bronze(spark, folder)).select("value.Id", "value.RunTime", "status", "datasource")


# --- incremental load ------------------------------------------------------------------------------


def i01_cutoff_extract(spark, folder) -> DataFrame:
    """Events changed between two cutoffs, through the named extract."""
    extract = incremental.extracts([_events_table(folder)])[incremental.extract_name("Events")]
    return extract(spark, FIRST_CUTOFF, SECOND_CUTOFF).select("event_id", "user_id", "event_type", "value")


def _events_table(folder: str) -> incremental.LoadedTable:
    return incremental.LoadedTable(
        "Events", lambda spark: open_tables(spark, folder, "events"), "ts", ["user_id"], EVENT_ROW
    )


def _untyped_events(folder: str) -> incremental.LoadedTable:
    """Events with values as text, some without a time and some of long ago."""

    def source(spark):
        events = open_tables(spark, folder, "events")
        old = F.expr("TIMESTAMP_NTZ'1850-06-01'")
        ts = F.when(F.col("event_id") % 97 == 0, None).when(F.col("event_id") % 89 == 0, old).otherwise(F.col("ts"))
        return events.withColumn("ts", ts).withColumn("value", F.col("value").cast("string"))

    return incremental.LoadedTable("Events", source, "ts", ["user_id"], EVENT_ROW)


def _loaded_warehouse(spark, folder):
    warehouse = incremental.Warehouse(spark, scratch_path(spark, "warehouse"))
    table = _untyped_events(folder)
    control = spark.createDataFrame([("Events", "Event key")], "Name string, Col string")
    for cutoff in (FIRST_CUTOFF, SECOND_CUTOFF):
        incremental.incremental_load(warehouse, [table], cutoff, control)
    return warehouse, table


def i02_staged_upsert(spark, folder) -> DataFrame:
    """The latest event per user after two loads, the second on top of the first."""
    warehouse, table = _loaded_warehouse(spark, folder)
    return warehouse.target(table).read().select("user_id", "event_id", "event_type", "value")


def i04_lineage(spark, folder) -> DataFrame:
    """What the two loads noted, next to the number of rows that the last one staged."""
    warehouse, table = _loaded_warehouse(spark, folder)
    staged = warehouse.staging(table).read().agg(F.count("*").alias("n")).first()["n"]
    notes = warehouse.lineage.read().join(warehouse.cutoffs.read().withColumnRenamed("cutoff", "last"), "table_name")
    return notes.select("lineage_key", "table_name", "cutoff", "last", F.when(F.col("cutoff") == F.col("last"), staged).alias("staged"))


def i05_side_by_side(spark, folder) -> DataFrame:
    """Rows and key sums of the tables of a control list, loaded side by side in two windows, next to one that fails."""

    def table(name: str, changed: str, keys: list[str], *columns: str) -> incremental.LoadedTable:
        def source(spark):
            return open_tables(spark, folder, name).select(*columns)

        schema = source(spark).schema
        return incremental.LoadedTable(name, source, changed, keys, schema)

    def nothing(spark):
        raise OSError("this source cannot be reached")

    tables = [
        table("orders", "o_orderdate", ["o_custkey"], "o_custkey", "o_orderkey", "o_orderdate"),
        table("lineitem", "l_shipdate", ["l_partkey", "l_suppkey"], "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate"),
        table("events", "ts", ["user_id"], "user_id", "event_id", "ts"),
    ]
    broken = incremental.LoadedTable("broken", nothing, "ts", ["user_id"], EVENT_ROW)
    warehouse = incremental.Warehouse(spark, scratch_path(spark, "warehouse"))
    listed = [*tables[:1], broken, *tables[1:]]
    control = spark.createDataFrame([(t.name, f"{t.name} key") for t in listed], "Name string, Col string")
    windows, failed = (dt.datetime(1997, 1, 1), SECOND_CUTOFF), set()
    for cutoff in windows:
        try:
            incremental.incremental_load(warehouse, listed, cutoff, control, at_once=3)
        except incremental.LoadsFailed as error:
            failed |= set(error.failures)
    found = []
    for loaded, value in zip(tables, ("o_orderkey", "l_orderkey", "event_id"), strict=True):
        rows = warehouse.target(loaded).read()
        figures = rows.agg(F.count("*").alias("rows"), F.sum(value).cast("bigint").alias("total"), F.max(loaded.changed_at).cast("date").alias("latest"))
        found.append(figures.withColumn("name", F.lit(loaded.name)).withColumn("state", F.lit("loaded")))
    lost = spark.createDataFrame([(name, "failed") for name in sorted(failed)], "name string, state string")
    rows = reduce(DataFrame.unionByName, found).unionByName(lost, allowMissingColumns=True)
    kept = F.regexp_replace("table_name", " key$", "").alias("name")
    cutoffs = warehouse.cutoffs.read().select(kept, F.year("cutoff").alias("cutoff_year"))
    return rows.join(cutoffs, "name", "left").select("name", "state", "rows", "total", "latest", "cutoff_year")


def i03_date_dimension(spark, folder) -> DataFrame:
    """All days of the years in which orders were placed, without the days of 1998, which count as loaded before."""
    orders = open_tables(spark, folder, "orders")
    years = orders.select(F.year("o_orderdate").alias("year")).distinct()
    loaded = incremental.date_dimension(years.filter(F.col("year") == 1998))
    return incremental.date_dimension(years, loaded)


# --- checks and files ------------------------------------------------------------------------------


def o01_table_checks(spark, folder) -> DataFrame:
    """Counts of missing, repeated and dangling values of the lines, and of orders that no line refers to."""
    lineitem, orders, part = open_tables(spark, folder, "lineitem", "orders", "part")
    lines = check(
        lineitem,
        not_null=["l_orderkey", "l_partkey", "l_quantity"],
        unique=[["l_orderkey", "l_linenumber"]],
        references=[("l_orderkey", orders, "o_orderkey"), ("l_partkey", part, "p_partkey")],
    )
    return lines.unionByName(check(orders, references=[("o_orderkey", lineitem, "l_orderkey")]))


def o02_tagged_rows(spark, folder) -> DataFrame:
    """Lines and repeated lines with the rules that each breaks: keys that are missing, come twice or refer to nothing."""
    lineitem, orders, part = open_tables(spark, folder, "lineitem", "orders", "part")
    # Some lines come again with another quantity, some have no part, some a part or an order that does not exist.
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    again = F.explode(F.when(key % 11 == 0, F.array(F.lit(0), F.lit(5))).otherwise(F.array(F.lit(0))))
    lines = lineitem.select(
        F.when(key % 29 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        "l_linenumber",
        F.when(key % 13 == 0, None).when(key % 17 == 0, F.col("l_partkey") + 10**9).otherwise(F.col("l_partkey")).alias("l_partkey"),
        "l_quantity",
        again.alias("more"),
    )
    path = scratch_path(spark, "lines")
    lines.withColumn("l_quantity", F.col("l_quantity") + F.col("more")).drop("more").write.parquet(path)
    tagged = tag(
        spark.read.parquet(path),
        not_null=["l_partkey"],
        unique=[["l_orderkey", "l_linenumber"]],
        references=[("l_orderkey", orders, "o_orderkey"), ("l_partkey", part, "p_partkey")],
    )
    return tagged.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.array_join("broken", " ").alias("broken"))


def f01_people_dedupe(spark, folder) -> DataFrame:
    """Distinct people of a tab-separated drop with untidy names and undashed phone numbers."""
    customer, orders = open_tables(spark, folder, "customer", "orders")
    untidy = F.when(F.col("o_orderstatus") == "F", F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    # One line per order: customers with several orders are the duplicates.
    drop = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit(" "), untidy).alias("first"),
        F.lower("c_name").alias("last"),
        F.concat(F.col("c_custkey").cast("string"), F.lit("@example.org")).alias("email"),
        F.lpad(F.col("c_nationkey").cast("string"), 10, "0").alias("phone"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("address"),
    )
    path = scratch_path(spark, "people")
    drop.write.options(sep="\t", header=True, quote="", ignoreLeadingWhiteSpace=False).csv(path)
    files.clean_people_files(spark, path, f"{path}-clean", per_file=False)
    return spark.read.options(header=True, escape='"').csv(f"{path}-clean")


def _chunk_files(spark, folder, keep_remainder: bool) -> DataFrame:
    documents = open_tables(spark, folder, "documents").select("doc_id", "text")
    path = scratch_path(spark, "chunks")
    files.split_documents(documents, path, "doc_id", 7, keep_remainder=keep_remainder)
    back = spark.read.schema("doc_id long, text string, chunk int").json(path)
    return back.select("doc_id", "chunk", F.length("text").alias("characters"))


def f02_chunk_split(spark, folder) -> DataFrame:
    """Documents in seven files of equal length by id, the remainder left out."""
    return _chunk_files(spark, folder, keep_remainder=False)


def f03_chunk_keep(spark, folder) -> DataFrame:
    """The same with the remainder in the last file."""
    return _chunk_files(spark, folder, keep_remainder=True)


QUERIES = {
    function.__name__: function
    for function in (
        m01_raw_to_bronze,
        m02_movie_projection,
        m03_clean,
        m04_quarantine,
        m05_genres,
        m06_language,
        m07_status_merge,
        m07_value_merge,
        m08_repair,
        m08_repair_status,
        m09_dedupe_by_key,
        m10_split_default,
        m11_rank_key,
        m11_rank_rows,
        m12_status_join,
        m13_second_drop,
        m14_file_merge,
        m15_repair_twice,
        m16_ledger,
        s01_multi_line_documents,
        s02_catalog_flow,
        s03_parquet_drift,
        s04_one_large_array,
        s05_nested_drift,
        i01_cutoff_extract,
        i02_staged_upsert,
        i03_date_dimension,
        i04_lineage,
        i05_side_by_side,
        o01_table_checks,
        o02_tagged_rows,
        f01_people_dedupe,
        f02_chunk_split,
        f03_chunk_keep,
    )
}

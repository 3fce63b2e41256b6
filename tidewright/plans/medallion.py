"""Raw movie documents to bronze, bronze to silver, and repair of quarantined rows."""

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright import schemas
from tidewright.operators import first_per_key, group_apart, key_bitmap, may_contain, split
from tidewright.sources import FILE, PartitionedTable
from tidewright.sources.readers import read_raw

# The budget floor, the data source name and the row states.
BUDGET_FLOOR = 100000.0
DATASOURCE = "movie.json"
NEW, LOADED, QUARANTINED = "new", "loaded", "quarantined"

#: Every table has a partition for each load, so that a load that runs again replaces its own rows.
LOAD = "p_load"
#: Steps that the ledger knows.
SILVER, REPAIR = "silver", "repair"


def note(load: str, step: str, run: int = 1) -> str:
    """The name under which bronze notes that a step is done with a load."""
    return f"{load},{step},{run}"


def repaired(load: str, run: int) -> str:
    """The silver load of the documents that a repair run took from a bronze load."""
    return f"{load}-repaired-{run}"

# Silver columns that are not simply the document field of the same name.
_DERIVED = {
    "Budget": lambda: floored_budget(F.col("value.Budget")),
    "p_CreatedDate": lambda: F.col("value.CreatedDate"),
    "Genres_Id": lambda: F.col("value.genres.id"),
    "Language_Id": lambda: F.lit(1),
}


class Lakehouse:
    """The tables of one medallion, below one folder.

    Folders per created date suit tables with a good deal of data per day; movie_partition=None leaves
    them out for smaller ones.
    """

    def __init__(self, spark: SparkSession, root: str, movie_partition: str | None = "p_CreatedDate"):
        def table(name: str, schema: T.StructType, *by: str, gather=True) -> PartitionedTable:
            schema = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
            return PartitionedTable(spark, f"{root}/{name}", schema, list(by), gather)

        self.spark = spark
        # A load has one ingest date and a status change reads few files, so bronze needs no gathering.
        self.bronze = table("bronze", schemas.BRONZE, "p_ingestdate", LOAD, gather=False)
        self.movie = table("silver/movie", schemas.SILVER_MOVIE, LOAD, *([movie_partition] if movie_partition else []))
        # A folder per genre or language would hold a handful of rows each.
        self.genres = table("silver/genres", schemas.SILVER_GENRES, LOAD)
        self.language = table("silver/language", schemas.SILVER_LANGUAGE, LOAD)

    def loads(self) -> set[str]:
        """The loads that bronze holds."""
        return {unquote(name.rpartition(f"{LOAD}=")[2]) for name in self.bronze.partitions()}

    def ledger(self) -> DataFrame:
        """(load, step, run, state): every load with its steps, the `done` ones as noted together with the statuses that
        they set, and `pending` where silver has not taken the load yet."""
        done = [tuple(name.split(",")) for name in self.bronze.done()]
        rows = [(load, step, int(run), "done") for load, step, run in done]
        taken = {load for load, step, *_ in rows if step == SILVER}
        rows += [(load, SILVER, 1, "pending") for load in self.loads() - taken]
        return self.spark.createDataFrame(sorted(rows), f"{LOAD} string, step string, run int, state string")

    def runs(self, step: str) -> dict[str, int]:
        """How often a step was done with each load; loads without one are left out."""
        found: dict[str, int] = {}
        for load, name, run in (note.split(",") for note in self.bronze.done()):
            if name == step:
                found[load] = max(found.get(load, 0), int(run))
        return found

    def register(self, database="Movie") -> None:
        for name, table in (
            ("movie_bronze", self.bronze),
            ("movie_silver", self.movie),
            ("genres_silver", self.genres),
            ("language_silver", self.language),
        ):
            if table.exists():
                table.register(database, name)


# --- raw to bronze ---------------------------------------------------------------------------------


def to_bronze(raw: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Keep each document whole in `value` and stamp where and when it came in."""
    at = (F.lit(str(now)) if now else F.current_timestamp()).cast("timestamp")
    return raw.select(
        "value",
        F.lit(DATASOURCE).alias("datasource"),
        at.alias("ingesttime"),
        F.lit(NEW).alias("status"),
        at.cast("date").alias("p_ingestdate"),
        F.date_format(at, "yyyyMMddHHmmssSSS").alias(LOAD),
    )


def raw_to_bronze(lake: Lakehouse, raw_path: str, now=None, mode="overwrite", database=None, **read_options) -> None:
    """Load a folder of raw documents, and register the table in a database.

    Overwrite replaces everything. Append adds a load, or replaces the load with the same `now`, which is then
    pending again.
    """
    if now is None:
        clock = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        now = dt.datetime.fromisoformat(lake.spark.range(1).select(clock).first()[0])
    bronze = to_bronze(read_raw(lake.spark, raw_path, **read_options), now)
    if mode == "append":
        load = f"{now:%Y%m%d%H%M%S}{now.microsecond // 1000:03d}"
        lake.bronze.replace(bronze, undone=[name for name in lake.bronze.done() if name.startswith(f"{load},")])
    else:
        lake.bronze.publish(bronze)
    if database:
        lake.register(database)


# --- silver projections ----------------------------------------------------------------------------


def floored_budget(budget: Column) -> Column:
    """Raise small budgets to the floor; NULL stays NULL."""
    return F.when(budget < BUDGET_FLOOR, F.lit(BUDGET_FLOOR)).otherwise(budget)


def silver_movie(bronze: DataFrame, floor_budget=True, keep=()) -> DataFrame:
    """Flat movie columns next to the `value` they come from, and the columns to `keep`. Dirty dates become NULL."""
    columns = []
    for field in schemas.SILVER_MOVIE:
        derived = field.name in _DERIVED and (floor_budget or field.name != "Budget")
        column = _DERIVED[field.name]() if derived else F.col(f"value.{field.name}")
        if isinstance(field.dataType, T.DateType):
            column = column.try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return bronze.select("value", *columns, *keep)


def silver_genres(bronze: DataFrame, mode="all", keep=()) -> DataFrame:
    """Distinct genres with a name, for each value of the columns to `keep`; documents without genres add none.

    mode="first" takes the first genre of each document only, one row per id, blank names kept.
    """
    if mode == "first":
        first = F.try_element_at(F.col("value.genres"), F.lit(1))
        named = bronze.select(first["id"].alias("Id"), first["name"].alias("name"))
        return first_per_key(named, ["Id"])
    genres = bronze.select(F.explode("value.genres").alias("genre"), *keep)
    return genres.select(F.col("genre.id").alias("Id"), F.col("genre.name").alias("name"), *keep).filter(
        F.col("name") != ""
    ).distinct()


def silver_language(bronze: DataFrame, keep=()) -> DataFrame:
    """Distinct languages, all under Id 1, for each value of the columns to `keep`."""
    language = F.col("value.OriginalLanguage").alias("OriginalLanguage")
    return bronze.select(F.lit(1).alias("Id"), language, *keep).distinct()


_SILVER = {"movie": silver_movie, "genres": silver_genres, "language": silver_language}


def transform(bronze: DataFrame, table: str) -> DataFrame:
    if table not in _SILVER:
        raise ValueError(f"no silver table {table!r}; known: {sorted(_SILVER)}")
    return _SILVER[table](bronze)


def classify(movies: DataFrame, null_to_quarantine=False) -> tuple[DataFrame, DataFrame]:
    """Distinct movies with a run time of at least 0, and the quarantined ones below 0.

    A NULL run time is in neither part, unless null_to_quarantine sends it to the second.
    """
    return split(movies.distinct(), F.col("RunTime") >= 0, null_to_default=null_to_quarantine)


# --- status ----------------------------------------------------------------------------------------


def merge_status(bronze: DataFrame, updates: DataFrame, on="value") -> DataFrame:
    """Set the status of every bronze row whose `on` equals that of an update; keep all other rows.

    `updates` has `on` and `status`; where updates contradict each other, the later state of the life
    cycle wins. Structs compare field by field, with NULL fields equal.
    """
    # Reduced as a number: Spark can then aggregate by hash, without sorting whole documents.
    states = F.array(*[F.lit(state) for state in (NEW, QUARANTINED, LOADED)])
    state = F.array_position(states, F.col("status"))
    updates = updates.select(F.col(on).alias("_on"), state.alias("_state"))
    found = group_apart(updates, "_on").agg(F.max("_state").cast("int").alias("_state")).drop("_apart")
    # The digest decides nearly all comparisons of the sort; equality of the documents decides the match.
    found = found.withColumn("_digest", F.xxhash64("_on"))
    same = (F.xxhash64(on) == F.col("_digest")) & (F.col(on) == F.col("_on"))
    merged = bronze.join(found, same, "left")
    status = F.coalesce(F.try_element_at(states, F.col("_state")), F.col("status")).alias("status")
    return merged.select(*[status if name == "status" else F.col(name) for name in bronze.columns])


def _settled(rows: DataFrame, batch: str, outcome: Column) -> DataFrame:
    """Rows with the outcome of the batch in place; rows outside of it as they are."""
    status = F.when(F.col("status") == batch, F.coalesce(outcome, F.col("status"))).otherwise(F.col("status")).alias("status")
    return rows.select(*[status if name == "status" else F.col(name) for name in rows.columns])


def _would_move(batch: str, outcome: Column) -> Column:
    """Rows outside of the batch whose status an equal document of the batch would change."""
    return F.coalesce((F.col("status") != batch) & outcome.isNotNull() & (F.col("status") != outcome), F.lit(False))


def settle(bronze: DataFrame, batch: str, outcome: Column) -> DataFrame:
    """Merge the outcome of one batch back onto bronze, without joining the whole table to itself.

    `batch` is the status of the rows just processed, `outcome` their new status as an expression over
    `value` (NULL: unchanged). As it depends on the document alone, batch rows get theirs in place. A merge by value
    also reaches equal documents outside the batch; only rows that would change status are compared.
    """
    moves, processed = _would_move(batch, outcome), (F.col("status") == batch) & outcome.isNotNull()
    updates = bronze.filter(processed).select("value", outcome.alias("status"))
    return _settled(bronze.filter(~moves), batch, outcome).unionByName(merge_status(bronze.filter(moves), updates))


def _names(files: DataFrame) -> list[str]:
    """The files that a write has to replace; it names each of them in its plan."""
    return [row[0] for row in files.select(FILE).distinct().collect()]


def _files_with(rows: DataFrame, values: DataFrame, key: str) -> list[str]:
    """Files of rows whose `value` equals one of `values`.

    Rows are sought by `key` first: a bitmap of the keys leaves most of them out where they lie, the others are
    compared by key. Whole documents are read only from the files that are left, mostly none.
    """
    keys = values.select(F.col(key).alias("_key")).distinct()
    likely = rows.select(F.col(key).alias("_own"), FILE).filter(may_contain(key_bitmap(keys, "_key"), F.col("_own")))
    files = _names(likely.join(keys, F.col("_own").eqNullSafe(F.col("_key")), "left_semi"))
    if not files:
        return []
    sought = values.select(F.col("value").alias("_on"), F.xxhash64("value").alias("_digest"))
    same = (F.xxhash64("value") == F.col("_digest")) & (F.col("value") == F.col("_on"))
    return _names(rows.filter(F.col(FILE).isin(files)).join(sought, same, "left_semi"))


def settle_files(bronze: PartitionedTable, batch: str, outcome: Column, done=(), key="value.Id") -> list[str]:
    """settle() on the stored table: only files with a row that changes are written again, and their names returned.

    The steps in `done` are noted in the same write, also where no row changes.
    """
    rows = bronze.read(files=True)
    processed = rows.filter((F.col("status") == batch) & outcome.isNotNull())
    changed = _names(processed.filter(outcome != F.lit(batch)))
    twins = _files_with(rows.filter(_would_move(batch, outcome)), processed, key)
    files = sorted({*changed, *twins})
    stored = bronze.read_files(files) if files else rows.drop(FILE)
    # All rows of the batch that change are in these files.
    bronze.rewrite(files, settle(stored, batch, outcome) if twins else _settled(stored, batch, outcome), done)
    return files


def merge_status_files(bronze: PartitionedTable, updates: DataFrame, key="value.Id") -> list[str]:
    """merge_status() by whole document on the stored table: only files that hold a document of `updates` are written
    again, and their names returned."""
    files = _files_with(bronze.read(files=True), updates, key)
    if files:
        bronze.rewrite(files, merge_status(bronze.read_files(files), updates))
    return files


def bronze_outcome() -> Column:
    run_time = F.col("value.RunTime")
    return F.when(run_time >= 0, LOADED).when(run_time < 0, QUARANTINED)


def repair_outcome() -> Column:
    return F.when(F.col("value").isNotNull(), LOADED)


# --- jobs ------------------------------------------------------------------------------------------


def _once(rows: DataFrame, loads: list[str]) -> DataFrame:
    """Distinct rows, each under its first load, which is found as a number as in merge_status."""
    names = F.array(*[F.lit(name) for name in loads]).cast("array<string>")
    first = F.min(F.array_position(names, F.col(LOAD))).cast("int").alias("_load")
    found = rows.groupBy(*[name for name in rows.columns if name != LOAD]).agg(first)
    return found.withColumn(LOAD, F.try_element_at(names, F.col("_load"))).drop("_load")


def _partitions_of(table: PartitionedTable, wanted) -> set[str]:
    """The partitions of a silver table whose load is wanted."""
    return {name for name in table.partitions() if wanted(unquote(name.split("/")[0].removeprefix(f"{LOAD}=")))}


def bronze_to_silver(lake: Lakehouse, mode="overwrite", null_to_quarantine=False) -> None:
    """Load new bronze rows into the silver tables, then mark them loaded or quarantined.

    Append takes the loads that the ledger has as pending, overwrite all new rows. Silver rows lie under the load of their
    bronze row, and a pending load's former silver rows, repaired ones among them, go. Sinks run in order; the
    statuses come last, in one write with the ledger, so a job that dies before it finds the same loads and rows
    again. Rows without a run time stay new: they are in genres and language with their load, and a later run has
    nothing to do with them, unless null_to_quarantine marks them. Each sink reads only the columns it needs.
    """
    bronze = lake.bronze.read()
    pending = sorted(lake.loads() - lake.runs(SILVER).keys()) if mode == "append" else sorted(lake.loads())
    if pending or mode != "append":
        new = bronze.filter((F.col("status") == NEW) & F.col(LOAD).isin(pending))
        # Distinct documents first: their flat columns are functions of the document.
        clean = _once(new.select("value", LOAD).filter(F.col("value.RunTime") >= 0), pending)
        for table, frame in (
            (lake.genres, silver_genres(new, keep=[LOAD])),
            (lake.language, silver_language(new, keep=[LOAD])),
            (lake.movie, silver_movie(clean, keep=[LOAD]).drop("value")),
        ):
            if mode == "append":
                table.replace(frame, _partitions_of(table, lambda load: load.split("-repaired-")[0] in pending))
            else:
                table.publish(frame if table is lake.movie else _once(frame, pending))
    outcome = bronze_outcome()
    if null_to_quarantine:
        outcome = F.coalesce(outcome, F.lit(QUARANTINED))
    settle_files(lake.bronze, NEW, outcome, [note(load, SILVER) for load in pending])


def repair(quarantined: DataFrame, keep=()) -> DataFrame:
    """Silver rows of quarantined documents with the sign of the run time dropped, and the columns to `keep`.

    The budget floor is not applied again.
    """
    fixed = F.abs(F.col("RunTime")).alias("RunTime")
    movies = silver_movie(quarantined.select("value", *keep).distinct(), floor_budget=False, keep=keep)
    return movies.select(*[fixed if name == "RunTime" else F.col(name) for name in movies.columns])


def silver_update(lake: Lakehouse) -> None:
    """Add the repaired movies to silver, and mark their bronze rows loaded.

    What a run takes from a bronze load is a silver load of its own, named by that load and the number of the run,
    so later repairs of the same load add to it. The statuses are written in one step with the note that the run is
    done: a job that dies before that finds the same rows and replaces the same silver loads. NULL documents stay.
    """
    quarantined = lake.bronze.read().filter((F.col("status") == QUARANTINED) & F.col("value").isNotNull())
    loads = sorted(row[0] for row in quarantined.select(LOAD).distinct().collect())
    if not loads:
        return
    before = lake.runs(REPAIR)
    run = {load: before.get(load, 0) + 1 for load in loads}
    names = F.create_map(*[F.lit(x) for load in loads for x in (load, repaired(load, run[load]))])
    fixed = repair(_once(quarantined.select("value", LOAD), loads), keep=[LOAD]).drop("value")
    fixed = fixed.withColumn(LOAD, F.try_element_at(names, F.col(LOAD)))
    unfinished = {repaired(load, run[load]) for load in loads}
    lake.movie.replace(fixed, _partitions_of(lake.movie, unfinished.__contains__))
    settle_files(lake.bronze, QUARANTINED, repair_outcome(), [note(load, REPAIR, run[load]) for load in loads])


def run_medallion(lake: Lakehouse, raw_path: str, now=None, mode="overwrite", **read_options) -> None:
    """Raw to bronze, bronze to silver, repair: each step starts when the one before has finished."""
    raw_to_bronze(lake, raw_path, now, mode, **read_options)
    bronze_to_silver(lake, mode)
    silver_update(lake)


# --- the second dialect: one row per Id, status joined by Id -----------------------------------------


def rank_key(languages: DataFrame, column: str) -> DataFrame:
    """Distinct languages with their rank inside their own language, which is always 1.

    Ranked after deduplication: the rank of a row among equal rows does not need the copies.
    """
    window = W.partitionBy(column).orderBy(column)
    return languages.select(column).distinct().select(F.rank().over(window).alias("Id"), column)


def status_by_id(bronze: DataFrame) -> DataFrame:
    """Bronze rows of new documents with the status of the one document kept per Id.

    Loaded and quarantined documents (NULL run times are quarantined here), the first of each Id of either
    kind, are joined to bronze on the nested Id; bronze rows without a partner are not in the result.
    """
    kind = F.when(F.col("value.RunTime") >= 0, LOADED).otherwise(QUARANTINED).alias("status")
    new = bronze.filter(F.col("status") == NEW).select(F.col("value.Id").alias("Id"), kind, "value")
    statuses = first_per_key(new, ["Id", "status"], for_join=True)
    arrived = bronze.select(F.col("value.Id").alias("Id"), "datasource", "ingesttime", "p_ingestdate")
    return statuses.join(arrived, "Id").select("value", "datasource", "ingesttime", "status", "p_ingestdate")

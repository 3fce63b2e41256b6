"""Incremental load of operational tables into a warehouse between cutoff times."""

import datetime as dt
from collections.abc import Callable
from contextlib import suppress
from dataclasses import dataclass
from queue import Empty, Queue
from threading import Lock

from pyspark import InheritableThread
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright import schemas
from tidewright.operators import upsert
from tidewright.sources import PartitionedTable, VersionedTable, changed_between, conform


@dataclass
class LoadedTable:
    """A table of the load: where its rows come from, how they are keyed and dated, what is stored."""

    name: str
    source: Callable[[SparkSession], DataFrame]
    changed_at: str
    keys: list[str]
    schema: T.StructType


def staging_name(name: str) -> str:
    return f"{name}_Staging"


def extract_name(name: str) -> str:
    return f"Get{name}Updates"


def extracts(tables: list[LoadedTable]) -> dict[str, Callable]:
    """Change extracts under their procedure-like names: (spark, last cutoff, new cutoff) to rows."""

    def extract(table):
        return lambda spark, last, new: changed_between(table.source(spark), table.changed_at, last, new)

    return {extract_name(table.name): extract(table) for table in tables}


#: The column that places a row of a target in one of its parts.
BUCKET = "p_bucket"


class Warehouse:
    """Targets, staging tables and the control tables of the load, below one folder.

    Targets are cut into `buckets` parts by a hash of their keys; a load writes the parts that its rows fall into.
    The number belongs to the stored table: some tens of GB per part suit large ones.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root
        self.buckets = buckets
        self.lineage = VersionedTable(spark, f"{root}/control/lineage", schemas.LINEAGE)
        self.cutoffs = VersionedTable(spark, f"{root}/control/cutoffs", schemas.CUTOFFS)
        # Loads that run side by side write the control tables one after the other.
        self.control = Lock()

    def target(self, table: LoadedTable) -> PartitionedTable:
        schema = T.StructType([*table.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        return PartitionedTable(self.spark, f"{self.root}/target/{table.name}", schema, [BUCKET])

    def bucket(self, table: LoadedTable) -> Column:
        return F.pmod(F.xxhash64(*table.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def staging(self, table: LoadedTable) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/staging/{staging_name(table.name)}", table.schema)

    def last_cutoff(self, name: str) -> dt.datetime | None:
        """None for a table that was never loaded: its first load has no lower bound."""
        with self.control:  # an older version may be dropped by a load beside this one
            row = self.cutoffs.read().filter(F.col("table_name") == name).first()
        return row["cutoff"] if row else None

    def record_lineage(self, name: str, cutoff: dt.datetime) -> int:
        """Note the start of a load and return its key, one above the highest so far."""
        with self.control:
            known = self.lineage.read()
            key = (known.agg(F.max("lineage_key")).first()[0] or 0) + 1
            row = self.spark.createDataFrame([(key, name, cutoff, cutoff)], schemas.LINEAGE)
            self.lineage.publish(known.unionByName(row))
            self.lineage.expire()
        return key

    def advance(self, name: str, cutoff: dt.datetime) -> None:
        with self.control:
            row = self.spark.createDataFrame([(name, cutoff)], schemas.CUTOFFS)
            others = self.cutoffs.read().filter(F.col("table_name") != name)
            self.cutoffs.publish(others.unionByName(row))
            self.cutoffs.expire()


def merge(warehouse: Warehouse, table: LoadedTable, staged: DataFrame) -> None:
    """Upsert staged rows into the parts of the target that they fall into; the other parts are not read."""
    target = warehouse.target(table)
    bucket = warehouse.bucket(table)
    touched = [row[0] for row in staged.select(bucket).distinct().collect()]  # at most the number of parts
    if touched:
        old = target.read().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
        target.replace(upsert(old, staged, table.keys, [table.changed_at]).select("*", bucket))


def load_table(
    warehouse: Warehouse, table: LoadedTable, extract: Callable, now: dt.datetime, key: str | None = None
) -> None:
    """Lineage, clear staging, extract the window, stage, merge; the cutoff moves only after the merge.

    Lineage and cutoffs are kept under `key`, the control table's second column. A load that dies on the way
    takes the same window again: its rows replace the same rows of the target once more.
    """
    key = key or table.name
    warehouse.record_lineage(key, now)
    last = warehouse.last_cutoff(key)
    staging = warehouse.staging(table)
    # A new version replaces what was staged before.
    staging.publish(conform(extract(warehouse.spark, last, now), table.schema))
    merge(warehouse, table, staging.read())
    warehouse.advance(key, now)
    staging.expire()


class LoadsFailed(RuntimeError):
    """Some tables were not loaded; `failures` has the error of each."""

    def __init__(self, failures: dict[str, Exception]):
        super().__init__(f"not loaded: {', '.join(f'{name} ({error})' for name, error in failures.items())}")
        self.failures = failures


def incremental_load(
    warehouse: Warehouse, tables: list[LoadedTable], now: dt.datetime, control: DataFrame | None = None, at_once: int = 1
) -> None:
    """Load every table listed in the control table (all of them without one), `at_once` of them side by side.

    The cutoff is fixed before the first table. The control table has one line per table, with its name and the
    name under which lineage and cutoffs are kept (Name, Col), so it is read to the driver. The tables do not depend on each other:
    each has its own lineage, cutoff and scheduler pool, so that a fair scheduler shares the executors among them. One that fails
    keeps its cutoff and does not hold up the others; at the end all failures are raised, and a further call takes up
    the same window of those tables. A table that is listed twice is loaded once for each line, in turn.
    """
    by_name = {table.name: table for table in tables}
    procedures = extracts(tables)
    lines = [(row["Name"], row["Col"]) for row in control.select("Name", "Col").collect()] if control is not None else [
        (name, name) for name in by_name
    ]
    unknown = [name for name, _ in lines if name not in by_name]
    if unknown:
        raise ValueError(f"the control table lists unknown tables {unknown}")
    failures: dict[str, Exception] = {}
    waiting: Queue = Queue()
    for name in dict.fromkeys(name for name, _ in lines):
        waiting.put((name, [key for other, key in lines if other == name]))

    def work(pool: int) -> None:
        warehouse.spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{pool}")
        with suppress(Empty):
            while True:
                name, keys = waiting.get_nowait()
                try:
                    for key in keys:
                        load_table(warehouse, by_name[name], procedures[extract_name(name)], now, key)
                except Exception as error:
                    failures[name] = error

    workers = [InheritableThread(target=work, args=(i,)) for i in range(min(at_once, waiting.qsize()))]
    for worker in workers:
        worker.start()
    for worker in workers:
        worker.join()
    if failures:
        raise LoadsFailed(failures) from next(iter(failures.values()))


def date_dimension(years: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per day of the given years (one column `year`), without the dates that exist already.

    Running it again for the same year adds nothing. The columns are our choice: the body of the
    populating procedure is not public.
    """
    first = F.make_date("year", F.lit(1), F.lit(1))
    last = F.make_date("year", F.lit(12), F.lit(31))
    days = years.select("year").distinct().select(F.explode(F.sequence(first, last)).alias("date"))
    if existing is not None:
        days = days.join(existing.select("date").distinct(), "date", "left_anti")
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.dayofyear("date").alias("day_of_year"),
        F.weekofyear("date").alias("iso_week"),
        (F.weekday("date") + 1).alias("iso_weekday"),
    )

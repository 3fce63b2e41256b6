"""Sinks: partitioned writers, schema checks, catalog registration, CSV and JSON files."""

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_writer(
    df: DataFrame, partition_column=None, exclude_columns=(), mode="append", files=None, gather=True
) -> DataFrameWriter:
    """A writer that is not saved yet.

    Rows of one partition value are brought together first, or every task would write a file for every
    value. The rebalance hint does that and splits a value that holds much of the table over several
    tasks. Where the tasks already hold few values each, gather=False saves that shuffle. `files` instead
    asks for that many output files.
    """
    df = df.drop(*exclude_columns)
    if files:
        df = df.repartition(files)
    elif partition_column and gather:
        df = df.hint("rebalance", F.col(partition_column))
    writer = df.write.format("parquet").option("compression", "snappy").mode(mode)
    return writer.partitionBy(partition_column) if partition_column else writer


def check_schema(df: DataFrame, declared: T.StructType, allow_drift=False) -> DataFrame:
    """Raise before anything is written if a declared column is missing or of another type."""
    found = {field.name: field.dataType.simpleString() for field in df.schema}
    wrong = {
        field.name: (field.dataType.simpleString(), found.get(field.name))
        for field in declared
        if found.get(field.name) != field.dataType.simpleString()
    }
    extra = [] if allow_drift else [name for name in found if name not in declared.fieldNames()]
    if wrong or extra:
        raise ValueError(f"schema differs: declared and found {wrong}, not declared {extra}")
    return df


def conform(df: DataFrame, declared: T.StructType) -> DataFrame:
    """Columns in the declared order and types, for a staging insert.

    Text is cut to a declared length, numbers are rounded to a declared scale, values that cannot be
    converted become NULL. A boolean is never taken for a number.
    """
    columns = []
    for field in declared:
        source, target = df.schema[field.name].dataType, field.dataType
        if isinstance(source, T.BooleanType) and isinstance(target, T.NumericType):
            raise TypeError(f"{field.name}: a boolean is not a number")
        column = F.col(field.name)
        if isinstance(target, (T.VarcharType, T.CharType)):
            column = F.substring(column.cast("string"), 1, target.length)
        elif source != target:
            column = column.try_cast(target) if _castable(target) else column.cast(target)
        columns.append(column.alias(field.name))
    return df.select(columns)


def _castable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def register_table(spark: SparkSession, database: str, name: str, path: str, partitioned=False) -> None:
    """Make `database.name` point at the files of `path`; a former registration goes, its files stay."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
    spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
    if partitioned and spark.catalog.getTable(f"{database}.{name}").tableType == "EXTERNAL":
        spark.catalog.recoverPartitions(f"{database}.{name}")


def write_csv(df: DataFrame, path: str, mode="overwrite", partition_column=None) -> None:
    """CSV with a header; quotes are doubled, blanks and empty texts stay as they are."""
    writer = df.hint("rebalance", F.col(partition_column)).write if partition_column else df.write
    writer = writer.mode(mode).options(
        header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    (writer.partitionBy(partition_column) if partition_column else writer).csv(path)


def write_chunks(df: DataFrame, path: str, column="chunk", mode="overwrite") -> None:
    """JSON lines, one folder per chunk. A chunk may span many files, so a task's size stays bounded."""
    df.hint("rebalance", F.col(column)).write.mode(mode).partitionBy(column).json(path)

"""Sources: JSON documents, catalog tables, change extracts, tab-separated files."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright import schemas
from tidewright.sources.arrays import read_array
from tidewright.sources.drift import read_declared as read_parquet


def open_tables(spark: SparkSession, folder: str, *names: str):
    """The named Parquet tables of a folder, in the order asked for."""
    frames = [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]
    return frames[0] if len(frames) == 1 else frames


def read_documents(
    spark: SparkSession, path: str, schema: T.StructType = schemas.MOVIE_DOCUMENT, multi_line=False, allow_drift=False
) -> DataFrame:
    """JSON documents of a folder, one row per document.

    The default is one document per line, which splits freely. A multi-line file is one document (or one
    array of documents) and one task reads it; read_raw can cut it.
    With allow_drift, fields outside the schema, at any depth, are kept after the declared ones; finding
    them costs a pass over the files. What is no document of this schema is a row of NULLs here and has its
    text in `rejected_documents`.
    """
    reader = spark.read.option("multiLine", multi_line)
    if allow_drift:
        schema = widened(schema, reader.json(path).schema)
    return reader.schema(schema).json(path)


def widened(declared: T.DataType, found: T.DataType) -> T.DataType:
    """The declared type with the fields that only the found one has, inside of arrays and structs too."""
    if isinstance(declared, T.StructType) and isinstance(found, T.StructType):
        own = {field.name: field.dataType for field in found}
        fields = [
            T.StructField(f.name, widened(f.dataType, own[f.name]) if f.name in own else f.dataType, f.nullable)
            for f in declared
        ]
        known = set(declared.fieldNames())
        return T.StructType([*fields, *[f for f in found if f.name not in known]])
    if isinstance(declared, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(widened(declared.elementType, found.elementType), declared.containsNull)
    return declared


def rejected_documents(
    spark: SparkSession, path: str, schema: T.StructType = schemas.MOVIE_DOCUMENT, multi_line=False
) -> DataFrame:
    """The texts that are no documents of the schema, with their file: (rejected, file)."""
    corrupt = "_corrupt_record"
    declared = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    texts = spark.read.option("wholetext", multi_line).text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", declared, {"columnNameOfCorruptRecord": corrupt})
    return texts.filter(parsed[corrupt].isNotNull()).select(F.col("value").alias("rejected"), F.input_file_name().alias("file"))


def read_raw(spark: SparkSession, path: str, key="movie", cut=False, **options) -> DataFrame:
    """The elements of the array under one key, one row each; empty and missing arrays give no row.

    With `cut`, many tasks share a multi-line file, however large it is; its fields are the declared ones.
    """
    if cut:
        schema = options.get("schema", schemas.MOVIE_DOCUMENT)
        if options.get("allow_drift"):
            raise ValueError("a file is cut into elements of the declared type only")
        return read_array(spark, path, schema[key].dataType.elementType, key)
    documents = read_documents(spark, path, **options)
    return documents.select(F.explode(F.col(key)).alias("value"))


def read_table(spark: SparkSession, schema: str, name: str, predicate=None, jdbc=None) -> DataFrame:
    """A table by schema and name, from the catalog, or over JDBC where a url is given in `jdbc`."""
    if jdbc:
        frame = spark.read.format("jdbc").options(**jdbc, dbtable=f"{schema}.{name}").load()
    else:
        frame = spark.read.table(f"{schema}.{name}" if schema else name)
    return frame if predicate is None else frame.filter(predicate)


def changed_between(df: DataFrame, ts: str, last, new) -> DataFrame:
    """Rows changed after `last` and up to `new`: the bounds of successive windows meet without overlap.

    The first window (last=None) has no lower bound, and takes the rows without a change time too.

    The extract procedures behind this step are not public; the half-open window is our rule.
    """
    kind = df.schema[ts].dataType
    # From text, so that the zone of the Python process has no say.
    bound = lambda at: F.lit(str(at)).cast("timestamp_ntz").cast(kind)
    if last is None:
        return df.filter((F.col(ts) <= bound(new)) | F.col(ts).isNull())
    return df.filter((F.col(ts) > bound(last)) & (F.col(ts) <= bound(new)))


# Tabs separate, nothing quotes, blanks count.
_TABBED = {"sep": "\t", "header": True, "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated people with a header line, every field as text; an empty field is an empty text."""
    people = spark.read.schema(schemas.PEOPLE).options(**_TABBED).csv(path)
    return people.select(*[F.coalesce(name, F.lit("")).alias(name) for name in people.columns])


def people_header(spark: SparkSession, path: str) -> list[str]:
    """The column names that the files themselves give; only a header line is read."""
    return spark.read.options(**_TABBED).csv(path).columns

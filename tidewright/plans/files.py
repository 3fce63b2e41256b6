"""File jobs: clean and dedupe people files, split documents into equal chunks."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright import schemas
from tidewright.functions import dashed_phone, title_case
from tidewright.operators import chunk
from tidewright.sources import Scratch, read_people, write_chunks, write_csv
from tidewright.sources.readers import people_header, read_raw


def dedupe_people(people: DataFrame, per_file=False) -> DataFrame:
    """Distinct people after names are title-cased and phone numbers dashed.

    per_file keeps a person once for every file they are in, next to the file's name.
    """
    cleaned = {"first": title_case("first"), "last": title_case("last"), "phone": dashed_phone("phone")}
    columns = [cleaned.get(name, F.col(name)).alias(name) for name in people.columns]
    if per_file:
        columns.append(F.input_file_name().alias("file"))
    return people.select(*columns).distinct()


def people_files(spark: SparkSession, source: str) -> list[str]:
    """The files of a folder (or the one file), in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(source)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = [status.getPath() for status in files.listStatus(path) if status.isFile()]
    return sorted(p.toString() for p in listed if not p.getName().startswith(("_", ".")))


def _titles(spark: SparkSession, path: str) -> list[str]:
    """The header of people files; one of another width would cut or shift columns, and is an error."""
    titles = people_header(spark, path)
    if len(titles) != len(schemas.PEOPLE):
        raise ValueError(f"{path} has {len(titles)} columns, not {len(schemas.PEOPLE)}")
    return titles


def clean_people_files(spark: SparkSession, source: str, target: str, per_file=True) -> None:
    """Cleaned people as CSV: in one folder, or in one folder per source file under the header of that file.

    In one folder the header is that of the first file. With per_file each file is a Spark job of its own, as
    such drops are few files. Folders are named by the file, without its ending where that tells files apart.
    """
    files = people_files(spark, source)
    if not per_file:
        people = dedupe_people(read_people(spark, source))
        write_csv(people.toDF(*_titles(spark, files[0])) if files else people, target)
        return
    names = {path: path.rsplit("/", 1)[-1] for path in files}
    stems = {path: re.sub(r"\.[^.]*$", "", name) for path, name in names.items()}
    for path in files:
        alone = list(stems.values()).count(stems[path]) == 1
        people = dedupe_people(read_people(spark, path)).toDF(*_titles(spark, path))
        write_csv(people, f"{target}/{stems[path] if alone else names[path]}")


def split_documents(df: DataFrame, target: str, order_by: str, k: int = 8, *, keep_remainder: bool) -> None:
    write_chunks(chunk(df, k, order_by, keep_remainder), target)


def split_array_file(
    spark: SparkSession, source: str, target: str, key="movie", k: int = 8, *, keep_remainder: bool, **read_options
) -> None:
    """Split the array under one key into k runs of equal length, in the order of the file.

    The position of an element in the read is stored with it once, and both passes of the split use it.
    """
    elements = read_raw(spark, source, key, **read_options).withColumn("position", F.monotonically_increasing_id())
    with Scratch(spark, "array") as scratch:
        chunked = chunk(scratch.cut(elements), k, "position", keep_remainder)
        write_chunks(chunked.select("value.*", "chunk"), target)

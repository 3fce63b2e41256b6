"""Intermediate tables in the shared folder of the cluster."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Stands in for the shared folder of a local master that names none.
LOCAL_FOLDER = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local master has one where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = f"{LOCAL_FOLDER}/{context.applicationId}"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, used by nobody else."""
    return f"{shared_folder(spark)}/tidewright/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


_opened: list[list["Scratch"]] = []


@contextmanager
def used_up() -> Iterator[None]:
    """Closes, at the end, every Scratch that was opened inside: for steps whose result is written there."""
    _opened.append([])
    try:
        yield
    finally:
        for scratch in _opened.pop():
            scratch.close()


class Scratch:
    """Intermediate tables of one call.

    cut() writes a frame and reads it back: later steps see the same rows in the same files, also after a lost
    executor. drop() removes a table that nothing reads any more, close() all of them; as a context manager it
    closes itself. Tables that a returned, lazy frame still reads must stay; who uses that frame up can
    do so inside of used_up().
    """

    def __init__(self, spark: SparkSession, label: str = "cut"):
        self.spark, self.label, self.paths = spark, label, {}
        if _opened:
            _opened[-1].append(self)

    def cut(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.label)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path, _ = self.paths.pop(id(frame))
            drop_path(self.spark, path)

    def close(self) -> None:
        self.drop(*[frame for _, frame in self.paths.values()])

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.close()


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write once, read back, for a frame that is returned."""
    return Scratch(df.sparkSession, label).cut(df)

"""Parquet tables that are rewritten: every rewrite is a new folder, the newest finished one is current.

Overwriting the folder a job reads from would delete its own input. A version folder counts once Spark
has committed it (its success marker exists), so a job that dies half-way leaves the former version in
place and can simply run again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.sources.writers import batch_writer, check_schema, register_table


class VersionedTable:
    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None, gather=True
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by
        self.gather = gather

    def versions(self) -> list[int]:
        """Numbers of the finished versions, oldest first."""
        files, root = self._files()
        if not files.exists(root):
            return []
        names = [status.getPath().getName() for status in files.listStatus(root) if status.isDirectory()]
        numbers = sorted(int(name[1:]) for name in names if name.startswith("v") and name[1:].isdigit())
        return [n for n in numbers if files.exists(self._hadoop_path(f"{self.location(n)}/_SUCCESS"))]

    def location(self, version: int) -> str:
        return f"{self.path}/v{version:08d}"

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or an empty frame where nothing was published yet."""
        if version is None:
            versions = self.versions()
            if not versions:
                return self.spark.createDataFrame([], self.schema)
            version = versions[-1]
        return self.spark.read.schema(self.schema).parquet(self.location(version))

    def publish(self, df: DataFrame) -> int:
        """Write the next version; it becomes current when its last task is committed."""
        version = max(self.versions(), default=0) + 1
        # Overwrite only clears what an unfinished run may have left under this number.
        self._write(df, version, "overwrite")
        return version

    def append(self, df: DataFrame) -> int:
        """Add rows to the current version, or publish the first one."""
        versions = self.versions()
        if not versions:
            return self.publish(df)
        self._write(df, versions[-1], "append")
        return versions[-1]

    def clear(self) -> int:
        return self.publish(self.spark.createDataFrame([], self.schema))

    def delete(self, predicate) -> int:
        """Keep the rows for which the predicate is false or unknown."""
        return self.publish(self.read().filter(~F.coalesce(predicate, F.lit(False))))

    def expire(self, keep: int = 2) -> None:
        """Drop all but the newest versions, once no reader uses them."""
        files, _ = self._files()
        for version in self.versions()[:-keep]:
            files.delete(self._hadoop_path(self.location(version)), True)

    def register(self, database: str, name: str) -> None:
        """Repoint the catalog table at the current version."""
        register_table(self.spark, database, name, self.location(self.versions()[-1]), bool(self.partition_by))

    def _write(self, df: DataFrame, version: int, mode: str) -> None:
        df = check_schema(df.select(*self.schema.fieldNames()), self.schema)
        batch_writer(df, self.partition_by, mode=mode, gather=self.gather).save(self.location(version))

    def _hadoop_path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        root = self._hadoop_path(self.path)
        return root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), root

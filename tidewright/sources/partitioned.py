"""Parquet tables of which only the partitions, or the files, that change are written.

Rows are written into a hidden folder of the table first. Then a plan is noted that names the files to move in, the
files to remove and the steps that are done with it, and is carried out. A job that dies before the plan is complete
leaves the table as it was; one that dies later leaves a plan, which the next reader or writer of the table carries out
to its end, as each part of it can be repeated. So no state between is ever all that is left. There is no version,
log or lock: one job writes a table at a time, and reads of a frame made before a write may miss its files.
"""

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.sources.scratch import drop_path
from tidewright.sources.writers import batch_writer, check_schema, register_table

#: Hidden folders: rows and plans of unfinished writes, and the names of steps that are done.
PENDING, DONE = "_pending", "_done"
#: The column of the file that a row lies in, for read(files=True).
FILE = "_file"
_MOVES_AT_ONCE = 16


class PartitionedTable:
    """A table below one folder, with a folder for each value of its partition columns.

    `gather` brings the rows of a partition together before they are written; leave it out where the tasks
    already hold few partitions each.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_by: list[str], gather=True):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by
        self.gather = gather

    # --- reading ---

    def partitions(self) -> set[str]:
        """The partitions as relative paths such as day=2024-01-01."""
        self._carry_on()
        files, root = self._at("")
        found = [("", root)] if files.exists(root) else []
        for column in self.partition_by:
            below = [(prefix, status) for prefix, folder in found for status in files.listStatus(folder)]
            named = [(prefix, status.getPath()) for prefix, status in below if status.isDirectory()]
            found = [
                (f"{prefix}/{folder.getName()}".lstrip("/"), folder)
                for prefix, folder in named
                if folder.getName().startswith(f"{column}=")
            ]
        return {prefix for prefix, _ in found}

    def exists(self) -> bool:
        return bool(self.partitions())

    def read(self, files: bool = False) -> DataFrame:
        """All rows; filters on partition columns read only the partitions they name. files=True adds the file of
        each row, as rewrite() takes it."""
        if not self.exists():
            empty = self.spark.createDataFrame([], self.schema)
            return empty.withColumn(FILE, F.lit("")) if files else empty
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.withColumn(FILE, F.col("_metadata.file_path")) if files else rows

    def read_files(self, names: list[str]) -> DataFrame:
        """The rows of some files, named as in read(files=True)."""
        paths = [f"{self.path}/{name}" for name in self._relative(names)]
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths)

    # --- writing ---

    def replace(self, df: DataFrame, emptied: set[str] = frozenset(), done=(), undone=()) -> None:
        """Put these rows in place of the partitions they fall into. Of the partitions named in `emptied`, those
        without a new row are removed. The names in `done` are noted and those in `undone` deleted with the same plan."""
        name, added = self._stage(df)
        touched = {path.rpartition("/")[0] for path in added} | set(emptied)
        self._commit(name, added, [path for folder in touched for path in self._listed(folder)], done, undone)

    def rewrite(self, files: list[str], df: DataFrame, done=()) -> None:
        """Put these rows in place of the files, named as in read(files=True)."""
        name, added = self._stage(df) if files else (uuid.uuid4().hex, [])
        self._commit(name, added, self._relative(files), done)

    def publish(self, df: DataFrame) -> None:
        """Put these rows in place of all others; no step is done with them."""
        name, added = self._stage(df)
        removed = [path for folder in self.partitions() for path in self._listed(folder)]
        self._commit(name, added, removed, undone=self.done())

    def remove(self, partitions: set[str]) -> None:
        for name in sorted(partitions):
            drop_path(self.spark, f"{self.path}/{name}")

    def done(self) -> set[str]:
        """Names that were noted together with a write."""
        self._carry_on()
        files, folder = self._at(DONE)
        return {status.getPath().getName() for status in files.listStatus(folder)} if files.exists(folder) else set()

    def register(self, database: str, name: str) -> None:
        register_table(self.spark, database, name, self.path, True)

    # --- the write itself ---

    def _stage(self, df: DataFrame) -> tuple[str, list[str]]:
        """Write the rows aside; the name of the write, and its files as they are to be named in the table."""
        self._carry_on(writing=True)
        df = check_schema(df.select(*self.schema.fieldNames()), self.schema)
        if self.gather:
            df = df.hint("rebalance", *[F.col(c) for c in self.partition_by])
        name = uuid.uuid4().hex
        batch_writer(df, mode="errorifexists").partitionBy(*self.partition_by).save(f"{self.path}/{PENDING}/{name}/rows")
        return name, self._listed(f"{PENDING}/{name}/rows", deep=True)

    def _commit(self, name: str, added: list[str], removed: list[str], done=(), undone=()) -> None:
        plan = {"add": sorted(added), "remove": sorted(removed), "done": sorted(done), "undone": sorted(set(undone) - set(done))}
        files, unfinished = self._at(f"{PENDING}/{name}/plan.part")
        stream = files.create(unfinished, True)
        stream.write(bytearray(json.dumps(plan).encode()))
        stream.close()
        self._move(f"{PENDING}/{name}/plan.part", f"{PENDING}/{name}/plan")
        self._carry_out(name)

    def _carry_out(self, name: str) -> None:
        files, at = self._at(f"{PENDING}/{name}/plan")
        stream = files.open(at)
        plan = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        for folder in {path.rpartition("/")[0] for path in plan["add"]}:
            files.mkdirs(self._at(folder)[1])
        with ThreadPoolExecutor(_MOVES_AT_ONCE) as pool:
            list(pool.map(lambda path: self._move(f"{PENDING}/{name}/rows/{path}", path), plan["add"]))
            list(pool.map(lambda path: files.delete(self._at(path)[1], False), plan["remove"]))
        for path in sorted({path.rpartition("/")[0] for path in plan["remove"]}):
            while path and files.exists(self._at(path)[1]) and not len(files.listStatus(self._at(path)[1])):
                files.delete(self._at(path)[1], False)
                path = path.rpartition("/")[0]
        for step in plan["undone"]:
            files.delete(self._at(f"{DONE}/{step}")[1], False)
        for step in plan["done"]:
            files.create(self._at(f"{DONE}/{step}")[1], True).close()
        drop_path(self.spark, f"{self.path}/{PENDING}/{name}")

    def _carry_on(self, writing: bool = False) -> None:
        """Carry out what a dead job has left planned; a writer also clears what was left without a plan."""
        files, folder = self._at(PENDING)
        if not files.exists(folder):
            return
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if files.exists(self._at(f"{PENDING}/{name}/plan")[1]):
                self._carry_out(name)
            elif writing:
                drop_path(self.spark, f"{self.path}/{PENDING}/{name}")

    def _move(self, source: str, target: str) -> None:
        """Rename a file below the table; one that was moved before is left where it is."""
        files, old = self._at(source)
        new = self._at(target)[1]
        if not files.exists(old):
            if not files.exists(new):
                raise FileNotFoundError(f"{self.path}: neither {source} nor {target} is there")
        elif not files.rename(old, new):
            raise OSError(f"{self.path}: {source} cannot be renamed to {target}")

    # --- paths ---

    def _at(self, name: str):
        """The file system and the path of something below the table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _listed(self, folder: str, deep: bool = False) -> list[str]:
        """Parquet files of a folder below the table, relative to the table, or to the folder with `deep`."""
        files, root = self._at(folder)
        if not files.exists(root):
            return []
        if not deep:
            names = [status.getPath().getName() for status in files.listStatus(root)]
            return [f"{folder}/{name}" for name in names if name.endswith(".parquet")]
        base, found, listing = files.makeQualified(root).toString(), [], files.listFiles(root, True)
        while listing.hasNext():
            path = listing.next().getPath().toString()
            if path.endswith(".parquet"):
                found.append(path[len(base) + 1 :])
        return found

    def _relative(self, names: list[str]) -> list[str]:
        """Files as Spark's metadata column writes them, relative to the table."""
        files, root = self._at("")
        base = files.makeQualified(root).toString()
        jvm = self.spark._jvm
        return [files.makeQualified(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))).toString()[len(base) + 1 :] for name in names]

"""All-or-nothing replacement of catalog tables and of their partitions.

New rows are written beside the stored ones, into a folder of their own, and the
catalog is then pointed at it: one table location, or one location per replaced
partition.  Until then the old rows stay where they are and readable.  A folder
holds a mark that says how far its load came:

    (none)     being written; a load that finds it later removes it (undone)
    _commit    complete; the catalog may point at some of it (finished by the next load)
    _done      the catalog points at it; what it replaced is still there for readers
    _live      as ``_done``, and what it replaced is gone

Every write to a table first brings its folders into order, so a load that was
killed at any point is undone or finished by the next one.  One load at a time
writes to a table.

Loads that touch days say so in a ledger table (fact, load, day): the mark carries
the days, and the ledger gets them before the mark becomes ``_done``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.sources.readers import align_to_table

LEDGER = "LOAD_LEDGER"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
#: Days that are moved in the catalog at a time.
MOVES = 8


class Store:
    """The few file operations on folders of the library's own making, in any store."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def folders(self, path: str) -> list[str]:
        files, target = self._at(path)
        if not files.exists(target):
            return []
        return sorted(s.getPath().toString() for s in files.listStatus(target) if s.isDirectory())

    def has_folders(self, path: str) -> bool:
        files, target = self._at(path)
        return files.exists(target) and any(s.isDirectory() for s in files.listStatus(target))

    def exists(self, path: str) -> bool:
        files, target = self._at(path)
        return files.exists(target)

    def remove(self, path: str) -> None:
        files, target = self._at(path)
        files.delete(target, True)

    def make(self, path: str) -> None:
        files, target = self._at(path)
        files.mkdirs(target)

    def read(self, path: str) -> str:
        files, target = self._at(path)
        stream = files.open(target)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Appears whole under its name or not at all."""
        files, target = self._at(f"{path}.part")
        stream = files.create(target, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.rename(f"{path}.part", path)

    def rename(self, path: str, to: str) -> None:
        files, target = self._at(path)
        self.remove(to)
        if not files.rename(target, self._at(to)[1]):
            raise OSError(f"could not rename {path}")


class Versions:
    """The stored versions of one catalog table."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.store = spark, name, Store(spark)
        schema, _, table = name.rpartition(".")
        schema = schema or spark.catalog.currentDatabase()
        where = spark.sql(f"DESCRIBE DATABASE {schema}").where("info_name = 'Location'").first()[1]
        self.base = f"{where.rstrip('/')}/{table.lower()}__versions"
        self.ledger = f"{schema}.{LEDGER}"

    # --- writes ---

    def replace(self, df: DataFrame, day: str | None = None, load: str | None = None) -> None:
        """The frame takes the place of the whole table, partitioned by ``day`` if given."""
        self.recover()
        path = self._write(df, day)
        days = None if day is None else self._days_in(path, day)
        fields = [f.jsonValue() for f in df.schema]
        old = [self._location()] if self.exists() else []
        old += [f for f in self.store.folders(self.base) if f.rpartition("/")[2] != path.rpartition("/")[2]]
        self._commit(path, {"kind": "table", "schema": fields, "day": day, "days": days, "old": old, "load": load})

    def replace_days(
        self, df: DataFrame, day: str, days: Iterable | None = None, load: str | None = None
    ) -> None:
        """The frame takes the place of the days it has rows for, or of ``days``; others stay.

        A day of ``days`` without rows becomes empty.  With ``load`` the days go to the ledger.
        """
        self.recover()
        if not self.exists():
            self._create(df.schema, day)
        path = self._write(align_to_table(df, self.spark.read.table(self.name), self.name), day)
        touched = set(self._days_in(path, day)) | {str(d) for d in days or ()}
        for empty in touched - set(self._days_in(path, day)):
            self.store.make(f"{path}/{day}={empty}")
        old = [f for f in self._day_folders(day, touched) if f.split("/")[-2] != path.rpartition("/")[2]]
        self._commit(path, {"kind": "days", "day": day, "days": sorted(touched), "old": old, "load": load})

    def append_days(self, df: DataFrame, day: str, load: str) -> None:
        """Adds the frame's rows to their days, which go to the ledger."""
        self.recover()
        if not self.exists():
            self._create(df.schema, day)
        days = sorted(str(r[0]) for r in df.select(day).distinct().collect())  # one row a day
        if not days:
            return
        mark = f"{self.base}/{uuid.uuid4().hex}"
        self.store.make(mark)
        # Written first: if the append dies, the ledger names days that may not have changed.
        self.store.write(f"{mark}/_commit", json.dumps({"kind": "append", "days": days, "old": [], "load": load}))
        align_to_table(df, self.spark.read.table(self.name), self.name).write.insertInto(self.name)
        self._apply(mark)

    def recover(self) -> None:
        """Finishes or undoes what earlier loads left, and removes what they replaced."""
        for path in self._folders():
            if self.store.exists(f"{path}/_commit"):
                self._apply(path)
            if self.store.exists(f"{path}/_done"):
                for old in json.loads(self.store.read(f"{path}/_done"))["old"]:
                    self.store.remove(old)
                self.store.rename(f"{path}/_done", f"{path}/_live")
            elif not self.store.exists(f"{path}/_live"):
                self.store.remove(path)
        # Folders all of whose days have been replaced.
        here = self._location() if self.exists() else ""
        for path in self._folders():
            if not self.store.has_folders(path) and not here.endswith(path.rpartition("/")[2]):
                self.store.remove(path)

    def _folders(self) -> list[str]:
        return [f for f in self.store.folders(self.base) if not f.rpartition("/")[2].startswith("root-")]

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    # --- steps ---

    def _write(self, df: DataFrame, day: str | None) -> str:
        path = f"{self.base}/{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd")  # ids of hexadecimal digits take half the room
        (writer if day is None else writer.partitionBy(day)).parquet(path)
        return path

    def _commit(self, path: str, mark: dict) -> None:
        self.store.write(f"{path}/_commit", json.dumps(mark))
        self._apply(path)

    def _apply(self, path: str) -> None:
        """Points the catalog at a complete folder; may be done again."""
        mark = json.loads(self.store.read(f"{path}/_commit"))
        if mark["kind"] == "table":
            self._apply_table(path, mark)
        elif mark["kind"] == "days":
            self._point(mark["day"], mark["days"], path)
        if mark.get("load"):
            self._note(mark["load"], mark["days"])
        self.store.write(f"{path}/_done", json.dumps(mark))
        self.store.remove(f"{path}/_commit")
        self.spark.catalog.refreshTable(self.name)

    def _apply_table(self, path: str, mark: dict) -> None:
        schema, day = T.StructType([T.StructField.fromJson(f) for f in mark["schema"]]), mark["day"]
        if self.exists():
            stored = {f.name: f.dataType for f in self.spark.read.table(self.name).schema}
            same = list(stored.items()) == [(f.name, f.dataType) for f in schema]
            if same and day is None and not self._partitions():
                self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{path}'")
                return
            self.spark.sql(f"DROP TABLE {self.name}")
        if day is None:
            self.spark.catalog.createTable(self.name, path, "parquet", schema)
            return
        self._create(schema, day)
        self._point(day, mark["days"], path)

    def _create(self, schema: T.StructType, day: str) -> None:
        """An empty table partitioned by day."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        root = f"{self.base}/root-{uuid.uuid4().hex}"  # days that are first appended to go here
        self.store.make(root)
        self.spark.sql(
            f"CREATE TABLE {self.name} ({columns}) USING parquet PARTITIONED BY (`{day}`) LOCATION '{root}'"
        )

    def _point(self, column: str, days: list[str], path: str) -> None:
        """New days are added in few commands; a stored one is moved from folder to folder."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()  # as many as days
        stored = {r[0].partition("=")[2] for r in rows}
        new = [f"PARTITION ({_spec(column, d)}) LOCATION '{path}/{column}={d}'" for d in days if d not in stored]
        for i in range(0, len(new), 500):
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {' '.join(new[i : i + 500])}")

        def move(d: str) -> None:
            where = f"{path}/{column}={d}"
            self.spark.sql(f"ALTER TABLE {self.name} PARTITION ({_spec(column, d)}) SET LOCATION '{where}'")

        # Each is a command of its own that mostly waits, so several are under way; any error is raised.
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(move, [d for d in days if d in stored]))

    def _note(self, load: str, days: list[str]) -> None:
        """Adds a load's days to the ledger; twice the same is once."""
        rows = [(self.name.rpartition(".")[2], load, d) for d in days]
        frame = self.spark.createDataFrame(rows, "FactTable string, LoadID string, LoadedDay string")
        frame = frame.withColumn("LoadedDay", F.col("LoadedDay").cast("date")).coalesce(1)
        frame.write.mode("append").format("parquet").saveAsTable(self.ledger)

    # --- what the catalog says ---

    def _partitions(self) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name) if c.isPartition]

    def partitioned_by(self, day: str) -> bool:
        return self._partitions() == [day]

    def _location(self) -> str:
        return self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Location'").first()[1]

    def _day_folders(self, column: str, days: Iterable[str]) -> list[str]:
        """Where the days' rows are or were."""
        names = {f"{column}={d}" for d in days}
        found = (f for version in self.store.folders(self.base) for f in self.store.folders(version))
        return [f for f in found if f.rpartition("/")[2] in names]

    def _days_in(self, path: str, day: str) -> list[str]:
        days = [f.rpartition("/")[2].partition("=")[2] for f in self.store.folders(path)]
        if _NO_DAY in days:
            raise ValueError(f"{self.name}: rows without {day}")
        return days


def _spec(column: str, day: str) -> str:
    return f"`{column}` = DATE '{day}'"

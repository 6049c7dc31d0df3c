"""Versioned tables: upserts write a new version beside the old and move a pointer."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from captionlake.functions.text import stem
from captionlake.operators.summaries import GateError, check_records, dedup_first, record_key


def merge_upsert(target: DataFrame, source: DataFrame, key: str = "chunk_id", replace_within: str | None = None) -> DataFrame:
    """Matched rows are replaced, others inserted; with ``replace_within``, target rows of the source's values there that it lacks go."""
    kept = target.join(source.select(key), key, "left_anti")
    if replace_within:
        kept = kept.join(source.select(replace_within).distinct(), replace_within, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


class VersionedTable:
    """Parquet versions in folders of their own and a pointer file ``CURRENT`` (version and folder); readers see whole versions only.

    A writer lost at any moment leaves at most a folder that nothing points to and a lock that others
    take over after ``lock_sec``; the next write, or the same one run again, is not in its way. The lock
    is held only while the pointer moves.
    """

    def __init__(self, spark: SparkSession, path: str, attempts: int = 10, wait_sec: float = 1.0, lock_sec: float = 120.0):
        self.spark, self.path, self.attempts, self.wait_sec, self.lock_sec = spark, path.rstrip("/"), attempts, wait_sec, lock_sec
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._pointer, self._lock = self._at("CURRENT"), self._at("LOCK")
        self._fs = self._pointer.getFileSystem(self._conf)

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _current(self) -> tuple[int, str | None]:
        if not self._fs.exists(self._pointer):
            return 0, None
        version, _, folder = self.spark.read.text(self._pointer.toString()).first()[0].partition(" ")
        return int(version), folder

    def version(self) -> int:
        """0 before the first write."""
        return self._current()[0]

    def read(self) -> DataFrame:
        folder = self._current()[1]
        if folder is None:
            raise GateError(f"no table at {self.path}")
        return self.spark.read.parquet(f"{self.path}/{folder}")

    def _put(self, name: str, text: str, overwrite: bool) -> None:
        out = self._fs.create(self._at(name), overwrite)
        out.writeBytes(text)
        out.close()

    def _acquire(self) -> None:
        """Take the lock file; wait 1, 2, 4, ... times ``wait_sec`` (30 s at most) between attempts."""
        for n in range(self.attempts):
            try:
                self._put("LOCK", uuid.uuid4().hex, False)
                return
            except Py4JJavaError:
                if not self._fs.exists(self._lock):
                    continue
                age = time.time() - self._fs.getFileStatus(self._lock).getModificationTime() / 1000
                if age > self.lock_sec:
                    self._fs.delete(self._lock, False)
                elif n + 1 < self.attempts:
                    time.sleep(min(self.wait_sec * 2**n, 30.0))
        raise GateError(f"{self.path} is locked")

    def write(self, rows: DataFrame, expected: int | None = None) -> int:
        """Write the next version and move the pointer by one rename; fails if another writer was first."""
        v = self.version() if expected is None else expected
        folder = f"v{v + 1}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{folder}")
        self._acquire()
        try:
            if self.version() != v:
                raise GateError("the table has changed meanwhile")
            self._put(f"CURRENT.{folder}", f"{v + 1} {folder}", True)
            fs = self.spark._jvm.org.apache.hadoop.fs
            how = self.spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
            how[0] = getattr(fs, "Options$Rename").OVERWRITE
            fs.FileContext.getFileContext(self._pointer.toUri(), self._conf).rename(self._at(f"CURRENT.{folder}"), self._pointer, how)
        finally:
            self._fs.delete(self._lock, False)
        return v + 1

    def update(self, change: Callable[[DataFrame | None], DataFrame | None]) -> int:
        """Write what ``change`` makes of the rows (None before the first write); if it makes None, nothing is written.

        If another writer is first, the change is made again on what that one wrote.
        """
        for n in range(self.attempts):
            v = self.version()
            rows = change(self.read() if v else None)
            if rows is None:
                return v
            try:
                return self.write(rows, v)
            except GateError:
                if n + 1 == self.attempts:
                    raise
        return self.version()

    def upsert(self, source: DataFrame, key: str = "chunk_id", replace_within: str | None = None) -> int:
        return self.update(lambda rows: source if rows is None else merge_upsert(rows, source, key, replace_within))

    def vacuum(self) -> None:
        """Delete folders of versions that the pointer has left, and of writers that were lost."""
        _, current = self._current()
        for found in self._fs.listStatus(self._at("")):
            if found.isDirectory() and found.getPath().getName() != current:
                self._fs.delete(found.getPath(), True)


def load_records(table: VersionedTable, records: DataFrame, dim: int, replace: bool = True) -> int:
    """Dedup (first wins), validate, and upsert a batch of records; an empty batch changes nothing."""
    if records.isEmpty():
        return table.version()
    # without a position of its own, a record's place is that in the input
    placed = records if "position" in records.columns else records.withColumn("position", F.monotonically_increasing_id())
    keyed = placed.withColumn("_key", record_key(F.col("chunk_id"), F.col("file_name"), F.col("start_time")))
    rows = check_records(dedup_first(keyed, ["_key"], ["position"]), dim).drop("_key", "position")
    return table.upsert(rows, replace_within="file_id" if replace else None)


def backup_name(file_id: Column, file_name: Column) -> Column:
    """``{id}_{stem}``: a file's backup."""
    return F.concat_ws("_", file_id.cast("string"), stem(file_name))


def write_backup(records: DataFrame, path: str) -> None:
    """Records without vectors as JSON, a folder ``backup={id}_{stem}`` for each file."""
    records.drop("vector").withColumn("backup", backup_name(F.col("file_id"), F.col("file_name"))).write.mode("overwrite").partitionBy("backup").json(path)

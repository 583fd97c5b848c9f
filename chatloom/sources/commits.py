"""Batches of several tables that become visible together.

A batch writes the files of each of its tables into a fresh folder of that table. Readers never list those
folders: they read what the batch's marker names. The marker is one small file that is renamed into place
when all tables are written, so a crash between two tables shows nothing, and a retried batch, whose marker
gets the next number, replaces its former one in all tables at once, whatever partitions it wrote then.

    <root>/<table>/part=<id>/...            data files of one attempt, partitioned as the table says
    <root>/_commits/<batch>.<number>.json   {"tables": {table: id}, "replaces": [batches]}

The driver reads one marker per batch (``compact`` merges batches), never rows.
"""
from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NAME = re.compile(r"[\w=+-]+")


class BatchStore:
    """``tables`` maps a name to (schema, partition columns); the partition columns are part of the schema."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple[T.StructType | str, list[str]]]):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables = {n: (T.StructType.fromDDL(s) if isinstance(s, str) else s, list(p)) for n, (s, p) in tables.items()}
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._log = f"{self.root}/_commits"

    # ------------------------------------------------------------------ markers

    def _listed(self, folder: str) -> list:
        path = self._path(folder)
        return list(self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _numbers(self) -> dict[str, int]:
        """The highest marker number of each batch."""
        last: dict[str, int] = {}
        for status in self._listed(self._log):
            batch, _, rest = status.getPath().getName().rpartition(".json")[0].rpartition(".")
            if batch and rest.isdigit():
                last[batch] = max(last.get(batch, -1), int(rest))
        return last

    def commits(self) -> dict[str, dict]:
        """batch -> marker, for the batches that are visible."""
        last = self._numbers()
        if not last:
            return {}
        files = [f"{self._log}/{b}.{n:09d}.json" for b, n in last.items()]
        lines = self.spark.read.text(files).collect()                                  # one line per batch
        found = {}
        for row in lines:
            marker = json.loads(row["value"])
            found[marker["batch"]] = marker
        gone = {b for m in found.values() for b in m["replaces"]}
        return {b: m for b, m in sorted(found.items()) if b not in gone}

    def _publish(self, batch: str, marker: dict) -> None:
        """One rename makes the batch visible. Of two writers of one batch the later number counts; a number
        that another writer took meanwhile fails the rename, and the next one is tried."""
        draft = self._path(f"{self._log}/.{uuid.uuid4().hex}")
        body = (json.dumps(marker, sort_keys=True) + "\n").encode()
        out = self._fs.create(draft, False)
        out.write(body)
        out.close()
        number = self._numbers().get(batch, -1) + 1
        while True:
            target = self._path(f"{self._log}/{batch}.{number:09d}.json")
            if not self._fs.exists(target) and self._fs.rename(draft, target):
                return
            number += 1

    # ------------------------------------------------------------------ batches

    def stage(self, frames: dict[str, DataFrame]) -> dict[str, str]:
        """Writes the data of one attempt; nothing of it is visible yet."""
        parts = {}
        for name, df in frames.items():
            schema, partitions = self.tables[name]
            part = uuid.uuid4().hex
            rows = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
            writer = rows.write.mode("error")
            if partitions:
                writer = writer.partitionBy(*partitions)
            writer.parquet(f"{self.root}/{name}/part={part}")
            parts[name] = part
        return parts

    def write(self, batch: int | str, frames: dict[str, DataFrame | Callable[[], DataFrame]], replaces: Iterable[str] = ()) -> None:
        """All tables of a batch, or nothing. The same batch written again replaces itself. A table that is known only
        when the others are written, such as what was counted meanwhile, is given as a function."""
        batch = str(batch)
        if not NAME.fullmatch(batch):
            raise ValueError(f"a batch is named by letters, digits, _, =, + and -: {batch!r}")
        unknown = set(frames) - set(self.tables)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        later = {t: f for t, f in frames.items() if callable(f)}
        parts = self.stage({t: f for t, f in frames.items() if t not in later})
        parts |= self.stage({t: f() for t, f in later.items()})
        self._publish(batch, {"batch": batch, "tables": parts, "replaces": sorted(set(map(str, replaces)) - {batch})})

    def read(self, table: str, without: Iterable[int | str] = ()) -> DataFrame:
        """The visible rows of a table, without those of some batches. Filters on its partition columns prune folders."""
        schema, partitions = self.tables[table]
        skipped = {str(b) for b in without}
        parts = [m["tables"][table] for b, m in self.commits().items() if table in m["tables"] and b not in skipped]
        names = [f.name for f in schema.fields]
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        # partition values come from folder names: say their types, so that none is guessed
        full = T.StructType([*schema.fields, T.StructField("part", T.StringType())])
        return self.spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/part={p}" for p in parts]).select(*names)

    def compact(self, batch: str) -> None:
        """Rewrites all visible batches as one, which replaces them in the same rename."""
        old = list(self.commits())
        self.write(batch, {t: self.read(t) for t in self.tables}, replaces=old)

    def unused(self) -> list[str]:
        """Data folders that no visible marker names: attempts that failed, or that others replaced."""
        live = {(t, p) for m in self.commits().values() for t, p in m["tables"].items()}
        return [str(s.getPath().toString()) for t in self.tables for s in self._listed(f"{self.root}/{t}")
                if (t, s.getPath().getName().removeprefix("part=")) not in live]

    def vacuum(self, older_than_seconds: float = 7 * 86_400) -> int:
        """Deletes unused folders that have not changed for so long (a running batch's are younger)."""
        now = self.spark.sparkContext._jvm.System.currentTimeMillis()
        removed = 0
        for folder in self.unused():
            path = self._path(folder)
            if now - self._fs.getFileStatus(path).getModificationTime() >= older_than_seconds * 1000:
                removed += bool(self._fs.delete(path, True))
        return removed

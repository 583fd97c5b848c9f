"""The second access path of the training table: which sources a (revision, trainer) is done with.

A bucketed table (source) in folders by (revision, trainer, part), where ``part`` is the data folder of the commit the
rows come from. Asking for the inputs that are still pending moves the inputs to the index's buckets; the stored side is
read in place, pruned to its folders, whatever has been stored so far.

The index follows the store: rows whose commit is no longer visible (a retry or ``compact`` replaced it) are not read,
and commits that are not in the index yet are read from the store itself. So ``pending`` is right before, between and
after runs of ``refresh``, also of one that died.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import scratch_path
from chatloom.sources.commits import BatchStore

FOLDERS = ["revision", "trainer", "part"]


class DoneIndex:
    """``name`` is the index's table in the catalog, ``path`` its folder (a fresh one in the shared folder if there is none).
    ``buckets`` is fixed when the index is made: choose it for the sources of one (revision, trainer)."""

    def __init__(self, store: BatchStore, name: str, buckets: int = 64, path: str | None = None, table: str = "training"):
        self.store, self.name, self.buckets, self.table = store, name, buckets, table
        self.spark: SparkSession = store.spark
        if not self.spark.catalog.tableExists(name):
            empty = self.spark.createDataFrame([], "source long, revision string, trainer string, part string")
            self._write(empty, path or scratch_path(self.spark, name))

    def _write(self, rows: DataFrame, path: str | None = None) -> None:
        writer = rows.write.mode("append").format("parquet").partitionBy(*FOLDERS).bucketBy(self.buckets, "source").sortBy("source")
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(self.name)

    def _live(self) -> dict[str, str]:
        """part -> batch of the visible commits."""
        return {m["tables"][self.table]: b for b, m in self.store.commits().items() if self.table in m["tables"]}

    def indexed(self) -> set[str]:
        """The parts in the index (one name per commit; Spark registers them when a write is whole)."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return {r[0].rpartition("part=")[2] for r in listed}

    def behind(self) -> DataFrame:
        """(source, revision, trainer) of the commits that are not in the index."""
        known = [b for p, b in self._live().items() if p in self.indexed()]
        return self.store.read(self.table, without=known).select("source", "revision", "trainer")

    def refresh(self) -> int:
        """Adds the commits that are missing, each source once; the number of them. A commit is one write: either all of
        its folders are registered, or it is read from the store as before."""
        known = self.indexed()
        added = 0
        for part, batch in self._live().items():
            if part in known:
                continue
            others = [b for b in self.store.commits() if b != batch]
            rows = self.store.read(self.table, without=others).select("source", "revision", "trainer")
            rows = rows.where("source IS NOT NULL").distinct().withColumn("part", F.lit(part))
            # one task per bucket and folder, so a commit adds at most one file to each
            self._write(rows.repartition(self.buckets, "source"))
            added += 1
        return added

    def done(self, revision: str, trainer: str) -> DataFrame:
        """The index's sources of one (revision, trainer): folders of visible commits only."""
        live = sorted(self._live())
        rows = self.spark.table(self.name).where((F.col("revision") == revision) & (F.col("trainer") == trainer))
        return rows.where(F.col("part").isin(live)).select("source") if live else rows.where("false").select("source")

    def pending(self, inputs: DataFrame, revision: str, trainer: str, key: str) -> DataFrame:
        """The inputs (one row or more per ``key``) without any training row of (revision, trainer). An input without a key
        is pending. The key is compared as a long, like ``source``."""
        keyed = inputs.withColumn("_source", F.col(key).cast("long"))
        own = self.behind().where((F.col("revision") == revision) & (F.col("trainer") == trainer))
        left = keyed.join(self.done(revision, trainer).withColumnRenamed("source", "_source"), "_source", "left_anti")
        return left.join(own.select(F.col("source").alias("_source")), "_source", "left_anti").drop("_source")

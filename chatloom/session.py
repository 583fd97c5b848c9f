"""Session helpers: one place that decides Spark settings and the lineage-cut folder."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every job in the library relies on. They are defaults: a value that the cluster sets
# (spark-defaults.conf, --conf) stays, see ``get_spark``.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # plans name all filters of a scan, also when the numbers of their columns are long
    "spark.sql.maxMetadataStringLength": "1000",
    # only takes effect when this process starts the JVM (local runs, tests)
    "spark.driver.memory": "8g",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "chatloom", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # builder options would override what spark-submit or spark-defaults.conf say: set absent keys only
    given = SparkConf()
    for k, v in conf.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and round tables.

    A cluster names it in ``spark.checkpoint.dir``; we read it from the session. Only a local
    master (tests) gets a folder of its own when it is unset; any other master raises.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="chatloom-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some sessions refuse runtime changes to core settings
            pass
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def write_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a small frame that several branches read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, key: str) -> str:
    """``df`` as a table in the shared folder, dealt out by ``key`` so that joins on it read the rows in place. The
    caller drops the table of the returned name."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex[:12]}"
    df.write.bucketBy(default_parallelism(spark), key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return table


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover
        return os.cpu_count() or 8

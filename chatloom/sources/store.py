"""Page scans, insert rules, keys, parametrised selects, batch commits, table layout."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.extract import doc_key
from chatloom.schemas import DOCUMENT, RECIPE, TRAINING

TABLE_SCHEMAS = {"document": DOCUMENT, "recipe": RECIPE, "training": TRAINING}
# access paths of the training table: partition columns, then the in-file sort order
TRAINING_PARTITIONS = ["revision", "trainer"]
TRAINING_SORT = ["conversation", "position"]


def scan_page_files(spark: SparkSession, path: str) -> DataFrame:
    """S1 (batch): every file of a folder as one record (whole text) with its path and slug.
    Zero-byte files are skipped by Spark's file source itself."""
    df = spark.read.text(path, wholetext=True).select(F.col("value").alias("html"),
                                                       F.col("_metadata.file_path").alias("source"))
    name = F.element_at(F.split("source", "/", -1), -1)
    return df.select(F.regexp_replace(name, r"\.html?$", "").alias("slug"), "html", "source")


def split_empty(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Non-empty pages, and empty ones for the quarantine (never deleted)."""
    empty = F.coalesce(F.length(html) == 0, F.lit(True))
    return pages.where(~empty), pages.where(empty)


def new_pages(pages: DataFrame, indexed: DataFrame, key: str = "source") -> DataFrame:
    """S3: pages whose source is not indexed yet."""
    return pages.join(indexed.select(key), key, "left_anti")


def first_by(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in ``order`` (an aggregate: partial per partition, so a key
    shared by a third of the rows is reduced map-side rather than collected)."""
    cols = [c for c in df.columns]
    best = df.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_r"))
    return best.select("_r.*")


def not_stored(df: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is already stored."""
    return df.join(stored.select(key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose foreign key has no parent row."""
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(pk).alias(fk)), fk, "left_anti")


def assert_no_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> None:
    """Write gate: raise if any child row is an orphan (one bounded job)."""
    if not orphans(child, parent, fk, pk).limit(1).isEmpty():
        raise ValueError(f"{fk} refers to missing {pk}")


def with_key(df: DataFrame, *natural_key: str, name: str = "id") -> DataFrame:
    """A deterministic key from the natural key, so child rows can compute it too."""
    parts = [F.col(c).cast("string") for c in natural_key]
    return df.withColumn(name, doc_key(parts[0] if len(parts) == 1 else F.concat_ws("\u001f", *parts)))


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows (nulls are just nulls in columnar files)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def select(spark: SparkSession, query: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Parametrised SQL. ``:name`` markers take ``args``; ``{name}`` takes DataFrames."""
    return spark.sql(query, args=args or {}, **frames)


def commit_batch(df: DataFrame, path: str, batch_id: int | str, partition_by: list[str] | None = None) -> None:
    """Write one batch so that it becomes visible whole, and a rerun of the same batch replaces
    it: the batch id is a partition column and only the partitions written are overwritten."""
    parts = ["batch"] + list(partition_by or [])
    (df.withColumn("batch", F.lit(str(batch_id)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))


def write_training(df: DataFrame, path: str, mode: str = "append") -> None:
    """Training rows partitioned by (revision, trainer) and sorted by (conversation, position)
    inside each file, so selection prunes partitions and read-back is ordered."""
    (df.repartition(*[F.col(c) for c in TRAINING_PARTITIONS + ["conversation"]])
       .sortWithinPartitions(*TRAINING_PARTITIONS, *TRAINING_SORT)
       .write.mode(mode).partitionBy(*TRAINING_PARTITIONS).parquet(path))


def read_training(spark: SparkSession, path: str, revision: str | None = None,
                  trainer: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    cond: Column | None = None
    for col, val in (("revision", revision), ("trainer", trainer)):
        if val is not None:
            c = F.col(col) == val
            cond = c if cond is None else cond & c
    return df if cond is None else df.where(cond)


def create_tables(spark: SparkSession, path: str) -> dict[str, str]:
    """Empty tables with the declared schemas (no schema evolution)."""
    out = {}
    for name, schema in TABLE_SCHEMAS.items():
        p = f"{path.rstrip('/')}/{name}"
        spark.createDataFrame([], schema).write.mode("ignore").parquet(p)
        out[name] = p
    return out

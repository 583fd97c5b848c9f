"""S4 against a growing store: which titles are stored already, by an index that is read in part.

The index has a row per stored title, (title_key, id), in folders by ``bucket``, a few bits of the key. A micro
batch collects the numbers of the buckets its own titles fall into (at most ``buckets`` numbers) and
reads these folders only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
INDEX = "title_key binary, id long, bucket int"


def title_key(title: str | Column) -> Column:
    """The whole md5 digest: 16 bytes, whatever the title's length."""
    return F.unhex(F.md5(title))


def bucket_of(key: str | Column, buckets: int = BUCKETS) -> Column:
    """From the first four bytes of the digest."""
    return F.pmod(F.conv(F.substring(F.hex(key), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def index_rows(docs: DataFrame, title: str = "title", id: str = "id", buckets: int = BUCKETS) -> DataFrame:
    keyed = docs.select(title_key(F.col(title)).alias("title_key"), F.col(id).alias("id"))
    return keyed.withColumn("bucket", bucket_of("title_key", buckets))


def bucket_part(index: DataFrame, numbers: list[int]) -> DataFrame:
    """The rows of some buckets: a filter on the folder column."""
    return index.where(F.col("bucket").isin([int(n) for n in numbers])) if numbers else index.limit(0)


def first_titles(docs: DataFrame, index: DataFrame, order: list[str], title: str = "title", buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``docs`` whose title is not in the index, one per title: the first by ``order``. Only keys
    and order columns are grouped, so a title of very many rows is an aggregate of small rows; ``order`` tells
    the rows of a title apart. Rows without a title go. ``docs`` is read twice: materialise it if that is dear."""
    keyed = docs.where(F.col(title).isNotNull()).withColumn("_key", title_key(F.col(title)))
    numbers = [r["b"] for r in keyed.select(bucket_of("_key", buckets).alias("b")).distinct().collect()]   # at most ``buckets``
    known = bucket_part(index, numbers).select(F.col("title_key").alias("_key"))
    first = keyed.groupBy("_key").agg(F.min(F.struct(*order)).alias("_first")).join(known, "_key", "left_anti")
    return keyed.withColumn("_first", F.struct(*order)).join(first, ["_key", "_first"], "left_semi").drop("_key", "_first")

"""Dense 1-based rank over the whole DataFrame without a single-partition window.

Pass 1 range-partitions on the ordering, records each row's partition and position, and is
written once to the checkpoint folder; pass 2 counts rows per partition (one row per partition)
and adds each partition's offset (a broadcast of ``num_partitions`` rows) to the row's position.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import cut_lineage, default_parallelism


def global_rank(df: DataFrame, order: list[str | Column], rank_col: str = "rank",
                num_partitions: int | None = None, total_col: str | None = None) -> DataFrame:
    """``order`` must be a unique key of ``df`` (ties would make the rank depend on the run).
    ``total_col`` also attaches the row count of the whole frame."""
    n = num_partitions or default_parallelism(df.sparkSession)
    # Range bounds are sampled; two separate range exchanges over large data can cut differently.
    # Materialise the partition id and in-partition position once (reliable checkpoint) so the
    # counts and the rows below read the same assignment.
    ranged = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_mid", F.monotonically_increasing_id()))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by n, so the window below is tiny
    cols = ["_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off")]
    if total_col:
        cols.append(F.sum("_n").over(Window.partitionBy()).alias(total_col))
    offsets = counts.select(*cols)
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(rank_col, F.col("_off") + local + 1)
            .drop("_pid", "_mid", "_off"))


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast only behind a checked bound; larger inputs take a shuffle join.

    The check runs one bounded job (``limit(max_rows + 1)``), never a full count.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df

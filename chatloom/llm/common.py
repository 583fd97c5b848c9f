"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import gc
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.session import scratch_path

# words of the contracts: runs of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z only; ``lower`` would also change other alphabets (and the length of some letters)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small fixed table as literals: no Python rows, no file."""
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    types = [part.strip().split(" ", 1)[1] for part in schema.split(",")]

    def lit(value, kind):
        if isinstance(value, (list, tuple)):
            value = F.array(*[F.lit(v) for v in value]) if value else F.array()
        else:
            value = F.lit(value)
        return value.cast(kind)

    if not rows:
        return spark.range(0).select(*[F.lit(None).cast(t).alias(n) for n, t in zip(names, types)])
    structs = [F.struct(*[lit(r[n], t).alias(n) for n, t in zip(names, types)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def settled(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``df.select(keep, columns)`` whose columns later filters use as they are. Catalyst moves a
    filter below a projection by copying the column's expression into it, which for expressions
    over a whole text means evaluating them again, inside lambdas even per element. A generator of
    exactly one row keeps filters above."""
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline_outer(F.array(row)))


def map_batches(df: DataFrame, schema: str, run) -> DataFrame:
    """``run(batches)`` per partition on Arrow batches. A batch comes and goes as a dict of column
    name -> list, so long ids keep their digits beside nulls."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def task(batches):
        for out in run({n: b.column(n).to_pylist() for n in b.schema.names} for b in batches):
            if isinstance(out, dict):
                out = pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
            yield out

    return df.mapInArrow(task, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back: cuts lineage like a
    checkpoint, with far smaller files for wide or numerous rows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def if_few(df: DataFrame, most: int) -> DataFrame:
    """``df`` (materialised) to be sent to all tasks if it has at most ``most`` rows; else joined by a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps. It does so when the driver's JVM collects
    the objects of a step, which in a job of many steps it may not do before the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()

"""Table shapes of the data model and the key expressions that tie them together."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Message role codes of the stored training table.
ROLE_CODES = {"system": 0, "user": 1, "assistant": 2, "none": 3}
ROLE_NAMES = ["system", "user", "assistant", "none"]

PAGE = T.StructType([
    T.StructField("url", T.StringType(), True),
    T.StructField("slug", T.StringType(), True),
    T.StructField("html", T.StringType(), True),
    T.StructField("source", T.StringType(), False),
])

DOCUMENT = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("text", T.StringType(), False),
    T.StructField("author", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("subtitle", T.StringType(), True),
])

RECIPE = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("document", T.LongType(), False),
    T.StructField("ingredients", T.ArrayType(T.StringType()), False),
    T.StructField("directions", T.ArrayType(T.StringType()), False),
    T.StructField("nutrition", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("review_score", T.DoubleType(), True),
    T.StructField("review_count", T.LongType(), False),
    T.StructField("reviews", T.ArrayType(T.StringType()), False),
    T.StructField("category", T.ArrayType(T.StringType()), False),
    T.StructField("cuisine", T.ArrayType(T.StringType()), False),
    T.StructField("prep_time", T.LongType(), True),
    T.StructField("total_time", T.LongType(), True),
    T.StructField("recipe_yield", T.StringType(), True),
])

TRAINING = T.StructType([
    T.StructField("conversation", T.StringType(), False),
    T.StructField("position", T.IntegerType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("role", T.StringType(), False),
    T.StructField("trainer", T.StringType(), False),
    T.StructField("revision", T.StringType(), False),
    T.StructField("source", T.LongType(), True),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
])
MESSAGES = T.ArrayType(MESSAGE)

TRAINING_COLUMNS = [f.name for f in TRAINING.fields]


def md5_key(*parts: Column | str) -> Column:
    """Deterministic text key: md5 over the parts joined by a unit separator.

    md5 is used (rather than xxhash64) because an SQL oracle can compute the same value.
    """
    cols = [F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")).cast("string") for p in parts]
    return F.md5(F.concat_ws("\u001f", *cols))


def hex_fraction(hex8: Column) -> Column:
    """Eight hex digits read as a number in [0, 1)."""
    return F.conv(hex8, 16, 10).cast("double") / F.lit(4294967296.0)


def conform(df, schema: T.StructType):
    """Select and cast to a schema's columns, in its order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])

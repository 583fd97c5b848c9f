"""Rotating phrase pools.

A slot's phrase for a row is ``pool[slot][i mod size]``. Two ways to get ``i``:

* ``hash`` (default): ``i`` = a hash of (slot, row key). No ordering, no shuffle; every row
  gets a stable phrase, spread evenly over the pool.
* ``rank``: ``i`` = the row's rank among the slot's users ordered by key, minus one - the same
  rotation a sequential loop gives. The rank is distributed (see ``global_rank``).

``Pools`` inlines its phrases as array literals, so it reads at most ``MAX_INLINE`` rows of a table and
raises beyond. A larger pool is a ``PoolTable``, joined on (slot, idx), which has ``assign`` only.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.operators.ranking import global_rank

MAX_INLINE = 10_000


def _lit(v) -> Column:
    if isinstance(v, (list, tuple)):
        return F.array(*[F.lit(x) for x in v])
    return F.lit(v)


def hash_index(slot: str, key: Column, size: int | Column) -> Column:
    h = F.md5(F.concat(F.lit(slot + ":"), key.cast("string")))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(size) if isinstance(size, int) else size)


class Pools:
    def __init__(self, phrases: dict[str, list]):
        self.phrases = {k: list(v) for k, v in phrases.items()}
        self._arrays: dict[str, Column] = {}

    def _array(self, slot: str) -> Column:
        """The slot's phrases as one literal array column, built once (Columns are immutable)."""
        if slot not in self._arrays:
            self._arrays[slot] = F.array(*[_lit(x) for x in self.phrases[slot]])
        return self._arrays[slot]

    @classmethod
    def from_table(cls, pools: DataFrame, max_rows: int = MAX_INLINE) -> "Pools":
        """``pools(slot, idx, text)`` of at most ``max_rows`` rows."""
        if pools.limit(max_rows + 1).count() > max_rows:
            raise ValueError(f"a pool table of more than {max_rows} phrases is joined: use PoolTable(pools).assign")
        rows = pools.select("slot", "idx", "text").collect()  # bounded by max_rows just above
        out: dict[str, list] = {}
        for r in sorted(rows, key=lambda r: (r["slot"], r["idx"])):
            text = r["text"]
            out.setdefault(r["slot"], []).append(text[1:].split("\u001f") if text.startswith("\u001f") else text)
        return cls(out)

    def to_table(self, spark) -> DataFrame:
        """The table that ``from_table`` reads; each phrase of a pair follows a U+001F."""
        rows = [(s, i, t if isinstance(t, str) else "".join("\u001f" + x for x in t))
                for s, items in self.phrases.items() for i, t in enumerate(items)]
        return spark.createDataFrame(rows, "slot string, idx int, text string")

    def size(self, slot: str) -> int:
        return len(self.phrases[slot])

    def pick(self, slot: str, key: Column) -> Column:
        """Hash mode: a column expression, no join."""
        items = self.phrases[slot]
        return F.element_at(self._array(slot), (hash_index(slot, key, len(items)) + 1).cast("int"))

    def by_index(self, slot: str, idx0: Column) -> Column:
        items = self.phrases[slot]
        return F.element_at(self._array(slot), (F.pmod(idx0, F.lit(len(items))) + 1).cast("int"))

    def assign(self, df: DataFrame, slot: str, key: str, out: str, mode: str = "hash") -> DataFrame:
        if mode == "hash":
            return df.withColumn(out, self.pick(slot, F.col(key)))
        ranked = global_rank(df, [F.col(key)], "_rank")
        return ranked.withColumn(out, self.by_index(slot, F.col("_rank") - 1)).drop("_rank")


class PoolTable:
    """A pool too large to inline: joined by (slot, idx)."""

    def __init__(self, pools: DataFrame):
        self.pools = pools.select("slot", "idx", "text")

    def assign(self, df: DataFrame, slot: str, key: str, out: str, mode: str = "hash") -> DataFrame:
        p = self.pools.where(F.col("slot") == slot)
        size = p.count()  # one number
        if mode == "hash":
            staged = df.withColumn("_idx", hash_index(slot, F.col(key), size))
        else:
            staged = global_rank(df, [F.col(key)], "_rank")
            staged = staged.withColumn("_idx", F.pmod(F.col("_rank") - 1, F.lit(size))).drop("_rank")
        joined = staged.join(p.select(F.col("idx").alias("_idx"), F.col("text").alias(out)), "_idx", "left")
        return joined.drop("_idx")

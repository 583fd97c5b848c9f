"""T3 across runs: a rotation that goes on where the last run stopped.

Each batch of a ``BatchStore`` commits, with its rows, how far it turned every slot: (slot, start, used). The
next batch starts behind the furthest of the others, so runs one after the other give what one run over their inputs
in that order gives. A batch that is run again starts where it started before.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.operators.pools import Pools
from chatloom.operators.ranking import global_rank
from chatloom.sources.commits import BatchStore

#: the table that a store keeps for this; one row per batch and slot
ROTATION = "slot string, start long, used long"
TURN = "_turn"


class TurnPools(Pools):
    """Phrases by the number of the row's turn (a column of the inputs, see ``Rotation.turns``) instead of a hash of its
    key, for generators that take pools: each of their slots is turned once per input."""

    def pick(self, slot: str, key: Column) -> Column:
        return self.by_index(slot, F.col(TURN))


class Rotation:
    def __init__(self, store: BatchStore, batch: int | str, table: str = "rotation"):
        self.store, self.batch, self.table = store, str(batch), table
        self._used: dict[str, tuple[int, int]] = {}

    def start(self, slot: str) -> int:
        """The number of turns before this batch. Whatever the number of batches, one row comes to the driver."""
        others = [b for b in self.store.commits() if b != self.batch]
        own = self.store.read(self.table, without=others).where(F.col("slot") == slot).agg(F.max("start")).first()[0]
        if own is not None:
            return own
        before = self.store.read(self.table, without=[self.batch]).where(F.col("slot") == slot)
        return before.agg(F.max(F.col("start") + F.col("used"))).first()[0] or 0

    def turns(self, inputs: DataFrame, key: str, slot: str = "", out: str = TURN) -> DataFrame:
        """``inputs`` with the number of each row's turn, in the order of ``key`` (unique) from the batch's start on."""
        if slot in self._used:
            raise ValueError(f"slot {slot!r} was turned already in batch {self.batch}")
        start = self.start(slot)
        ranked = global_rank(inputs, [F.col(key)], "_rank")         # materialised there: counting it is one more read
        self._used[slot] = (start, ranked.count())
        return ranked.withColumn(out, F.col("_rank") - 1 + F.lit(start)).drop("_rank")

    def assign(self, inputs: DataFrame, pools: Pools, slot: str, key: str, out: str) -> DataFrame:
        """``inputs`` with the slot's phrases in turn."""
        return self.turns(inputs, key, slot).withColumn(out, pools.by_index(slot, F.col(TURN))).drop(TURN)

    def frame(self) -> DataFrame:
        """The rows to commit with the batch: one per slot that was turned."""
        return self.store.spark.createDataFrame([(s, a, n) for s, (a, n) in self._used.items()], ROTATION)

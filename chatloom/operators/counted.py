"""What was left out, counted while the rest is written (``DataFrame.observe``: no further pass).

The counts are exact if the observed frame reaches the write without an exchange above it: tasks of a
write count once each however often they are tried, those of an earlier stage may be counted again when a lost
executor makes Spark repeat the stage. Observe above the last exchange.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: one row per reason: ``what`` is counted (lines, pages), ``reason`` why it was left out
COUNTS = "what string, reason string, n long"


class Counted:
    """Counts the rows of a frame by the value of ``reason``, one of ``reasons`` (null: kept); any other value is counted as
    ``other``. Each instance serves one frame and one write of it."""

    def __init__(self, what: str, reasons: list[str], reason: str | Column = "reason"):
        self.what, self.reasons = what, list(reasons)
        self._reason = F.col(reason) if isinstance(reason, str) else reason
        self._seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        r = self._reason
        named = [F.count_if(r == name).alias(f"r{i}") for i, name in enumerate(self.reasons)]
        other = F.count_if(r.isNotNull() & ~r.isin(self.reasons))
        return df.observe(self._seen, *named, other.alias("other"), F.count_if(r.isNull()).alias("kept"))

    def frame(self, spark: SparkSession) -> DataFrame:
        """The counts, after the write; reasons that did not occur count 0. Waits for the write to end."""
        seen = self._seen.get
        rows = [(self.what, name, seen.get(f"r{i}", 0)) for i, name in enumerate(self.reasons)]
        rows += [(self.what, name, seen.get(name, 0)) for name in ("other", "kept")]
        return spark.createDataFrame(rows, COUNTS)

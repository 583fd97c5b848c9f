"""The bucketed done-index: what it reads, and that it is right whatever has been indexed."""
import re
import uuid

import pytest

from chatloom.operators.select import done_sources
from chatloom.schemas import TRAINING
from chatloom.session import scratch_path
from chatloom.sources.commits import BatchStore
from chatloom.sources.done_index import DoneIndex


def training(spark, *sources, trainer="evaluator", revision="base"):
    return spark.createDataFrame([(f"c{s}-{i}", i, "x", "user", trainer, revision, s) for s in sources for i in range(2)],
                                 "conversation string, position int, content string, role string, trainer string, revision string, source long")


@pytest.fixture
def index(spark):
    store = BatchStore(spark, scratch_path(spark, "done"), {"training": (TRAINING, ["revision", "trainer"])})
    found = DoneIndex(store, f"done_{uuid.uuid4().hex[:8]}", buckets=4)
    yield found
    spark.sql(f"DROP TABLE {found.name}")


def pending(index, inputs, revision="base", trainer="evaluator"):
    return sorted(r["id"] for r in index.pending(inputs, revision, trainer, "id").collect())


def test_right_before_between_and_after_refreshes(spark, index):
    inputs = spark.range(8)
    assert pending(index, inputs) == list(range(8))
    index.store.write("a", {"training": training(spark, 1, 2)})
    assert pending(index, inputs) == [0, 3, 4, 5, 6, 7]                  # read from the store
    assert index.refresh() == 1 and index.refresh() == 0
    assert index.behind().isEmpty() and pending(index, inputs) == [0, 3, 4, 5, 6, 7]
    index.store.write("b", {"training": training(spark, 3).unionByName(training(spark, 4, trainer="recipe"))})
    assert pending(index, inputs) == [0, 4, 5, 6, 7]                     # one part from the index, one from the store
    assert index.refresh() == 1
    assert pending(index, inputs) == [0, 4, 5, 6, 7]
    assert pending(index, inputs, trainer="recipe") == [0, 1, 2, 3, 5, 6, 7]
    assert pending(index, inputs, revision="next") == list(range(8))


def test_a_retried_or_compacted_batch_leaves_nothing_behind(spark, index):
    inputs = spark.range(6)
    index.store.write("a", {"training": training(spark, 1, 2)})
    index.store.write("b", {"training": training(spark, 5)})
    index.refresh()
    index.store.write("a", {"training": training(spark, 2, 3)})          # a retry: 1 is not done any more
    assert pending(index, inputs) == [0, 1, 4]
    index.refresh()
    assert pending(index, inputs) == [0, 1, 4]
    index.store.compact("all")
    assert pending(index, inputs) == [0, 1, 4]
    assert index.refresh() == 1 and pending(index, inputs) == [0, 1, 4]


def test_awkward_inputs(spark, index):
    index.store.write("a", {"training": training(spark, 1)})
    index.store.write("empty", {"training": training(spark, 1).limit(0)})
    index.refresh()
    odd = spark.createDataFrame([(1, "x"), (None, "x"), (2, "x"), (2, "y")], "id long, source string")   # a clashing name
    got = index.pending(odd, "base", "evaluator", "id")
    assert got.columns == ["id", "source"] and sorted(map(tuple, got.collect()), key=str) == [(2, "x"), (2, "y"), (None, "x")]
    assert index.pending(odd.limit(0), "base", "evaluator", "id").isEmpty()


def _stored_side(plan, name):
    """Operators from the first anti-join down to the scan of the index."""
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Scan parquet" in line and name in line)
    depth = lambda line: len(re.match(r"[ :+\-]*", line)[0])
    side, at = [lines[scan]], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            at = depth(line)
            if "Join" in line:
                return side
            side.append(line)
    return side


def test_the_stored_side_is_read_in_place(spark, index):
    index.store.write("a", {"training": training(spark, *range(40)).unionByName(training(spark, *range(9), trainer="recipe"))})
    index.refresh()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_index = index.pending(spark.range(50), "base", "evaluator", "id")
        plan = by_index._jdf.queryExecution().executedPlan().toString()
        plain = spark.range(50).join(done_sources(index.store.read("training"), "evaluator", "base", "id"), "id", "left_anti")
        other = plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = "\n".join(_stored_side(plan, index.name))
    assert "Bucketed: true" in side and "Exchange" not in side, plan
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", side)[1]
    assert re.search(r"\(revision#\d+ = base\)", pruned), side
    assert other.count("Exchange") == 2                                  # without the index both sides move
    assert pending(index, spark.range(50)) == list(range(40, 50))

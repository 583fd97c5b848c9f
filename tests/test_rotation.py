"""Rotation over several runs, against one loop over all inputs in the order of the runs."""
import pytest
from pyspark.sql import functions as F

from chatloom.operators import generate as G
from chatloom.operators.pools import Pools
from chatloom.operators.rotation import ROTATION, Rotation, TurnPools
from chatloom.schemas import TRAINING
from chatloom.session import scratch_path
from chatloom.sources.commits import BatchStore

PHRASES = Pools({"s": ["a", "b", "c"], "t": ["x", "y"]})


@pytest.fixture
def store(spark):
    return BatchStore(spark, scratch_path(spark, "turns"), {"phrase": ("id long, p string", []), "rotation": (ROTATION, []),
                                                            "training": (TRAINING, [])})


def run(store, batch, ids, slot="s"):
    turn = Rotation(store, batch)
    frame = store.spark.createDataFrame([(i,) for i in ids], "id long")
    store.write(batch, {"phrase": turn.assign(frame, PHRASES, slot, "id", "p"), "rotation": turn.frame()})


def phrases(store):
    return {r["id"]: r["p"] for r in store.read("phrase").collect()}


def test_runs_go_on_where_the_last_one_stopped(store):
    runs = [[5, 1, 9, 7], [], [2, 8], [0, 3, 4, 6, 10]]
    for i, ids in enumerate(runs):
        run(store, i, ids)
    order = [i for ids in runs for i in sorted(ids)]
    assert phrases(store) == {k: "abc"[n % 3] for n, k in enumerate(order)}


def test_slots_turn_apart_and_a_retry_starts_where_it_started(store):
    run(store, "one", [1, 2])
    run(store, "two", [3, 4], slot="t")
    run(store, "three", [5])
    want = {1: "a", 2: "b", 3: "x", 4: "y", 5: "c"}
    assert phrases(store) == want
    run(store, "one", [1, 2])                      # again, after later batches
    run(store, "three", [5])
    assert phrases(store) == want
    run(store, "four", [6])
    assert phrases(store) == want | {6: "a"}
    store.compact("all")
    run(store, "five", [7])
    assert phrases(store) == want | {6: "a", 7: "b"}


def test_a_run_that_was_not_committed_turned_nothing(store):
    run(store, "one", [1])
    lost = Rotation(store, "lost")
    lost.assign(store.spark.range(4), PHRASES, "s", "id", "p")
    run(store, "two", [2])
    assert phrases(store) == {1: "a", 2: "b"}
    with pytest.raises(ValueError, match="turned already"):
        lost.turns(store.spark.range(1), "id", "s")


def test_a_generator_turns_its_pools(spark, store):
    recipes = spark.createDataFrame(
        [(i, f"r{i}", ["i"], ["d"], 4.9, 20, ["good"]) for i in range(7)],
        "document long, title string, ingredients array<string>, directions array<string>, review_score double, review_count long, reviews array<string>")
    pools = TurnPools(G.DEFAULT_POOLS.phrases)
    asked = []
    for batch, part in (("a", "document < 3"), ("b", "document >= 3")):
        turn = Rotation(store, batch)
        rows = G.evaluator(turn.turns(recipes.where(part), "document"), pools=pools)
        store.write(batch, {"training": rows, "rotation": turn.frame()})
    mine = pools.phrases["ask_rating"]
    for r in store.read("training").where(F.col("content").isin(mine)).collect():
        asked.append((r["source"], r["content"]))
    assert sorted(asked) == [(i, mine[i % len(mine)]) for i in range(7)]

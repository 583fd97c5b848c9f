"""The distributed replacements for sequential logic agree with the sequential versions."""
import hashlib
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chatloom.operators import dataset as X
from chatloom.operators.pools import Pools
from chatloom.operators.ranking import global_rank


def test_global_rank_equals_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id"))
    ranked = global_rank(df, [F.col("k"), F.col("id")], "r", num_partitions=7, total_col="n")
    got = {(r["k"], r["id"]): (r["r"], r["n"]) for r in ranked.collect()}
    expect = df.withColumn("r", F.row_number().over(Window.orderBy("k", "id")))
    for r in expect.collect():
        assert got[(r["k"], r["id"])] == (r["r"], 5000)


def test_rank_rotation_equals_sequential_loop(spark):
    pools = Pools({"s": ["a", "b", "c"]})
    df = spark.range(0, 50).select((F.col("id") * 37 % 101).alias("key"))
    got = {r["key"]: r["p"] for r in pools.assign(df, "s", "key", "p", mode="rank").collect()}
    rotation = ["a", "b", "c"]
    for i, k in enumerate(sorted(got)):
        assert got[k] == rotation[i % 3]


def py_pack(samples, length, shards, eos="</s>"):
    """Sequential packer: per shard, samples in md5 order, concatenated, cut, tail dropped."""
    per = {}
    for key, text in samples:
        h = hashlib.md5(key.encode()).hexdigest()
        shard = int(h[:8], 16) % shards
        per.setdefault(shard, []).append((h, key, text.split() + [eos]))
    out = {}
    for shard, items in per.items():
        stream = [t for _, _, toks in sorted(items) for t in toks]
        for b in range(len(stream) // length):
            out[(shard, b)] = stream[b * length:(b + 1) * length]
    return out


@pytest.mark.parametrize("leaf_rows", [1, 7, 4096])
def test_pack_equals_sequential_packer_at_any_depth(spark, leaf_rows):
    words = [f"w{i}" for i in range(97)]
    samples = [(f"k{i}", " ".join(words[(i * 7) % 50:(i * 7) % 50 + 5 + i % 40])) for i in range(120)]
    df = spark.createDataFrame(samples, "conversation string, text string")
    got = {(r["shard"], r["block"]): r["tokens"]
           for r in X.pack(df, length=16, shards=3, leaf_rows=leaf_rows).collect()}
    assert got == py_pack(samples, 16, 3)


def test_level_widths_follow_the_number_of_rows():
    assert X.level_widths(0) == X.level_widths(4096) == []
    assert X.level_widths(4097) == [1] and X.level_widths(4096 * 16 ** 3) == [3]
    assert X.level_widths(4096 * 16 ** 3 + 1) == [3, 4] and X.level_widths(4096 * 16 ** 8) == [3, 6, 8]


def test_running_ends_over_three_levels_equal_one_window(spark):
    rows = spark.range(0, 900).select((F.col("id") % 2).cast("int").alias("g"), F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 13).alias("n"))
    read = lambda widths: sorted(map(tuple, X.running_ends(rows, "g", "h", "n", widths).select("g", "h", "n", "end", "total").collect()))
    assert read([]) == read([1]) == read([1, 2]) == read([1, 2, 3])


def test_pack_moves_texts_by_key_without_sorting_them(spark):
    df = spark.createDataFrame([(f"k{i}", "a b c") for i in range(50)], "conversation string, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = X.pack(df, length=8, shards=2, leaf_rows=4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan.split("ShuffledHashJoin", 1)
    assert len(above) == 2 and "Window" not in above[0] and "_text" not in above[1].split("Window", 1)[1], plan


def test_pack_awkward_samples(spark):
    schema = "conversation string, text string"
    assert X.pack(spark.createDataFrame([], schema), length=4).collect() == []
    got = X.pack(spark.createDataFrame([("a", None), ("b", ""), ("c", "x " * 500)], schema), length=4, shards=1).collect()
    assert len(got) == 503 // 4 and all(r["n_tokens"] == 4 for r in got)
    for bad in ([("a", "x"), ("a", "y")], [(None, "x"), ("b", "y")]):
        with pytest.raises(Exception, match="without a key of their own"):
            X.pack(spark.createDataFrame(bad, schema), length=1, shards=1).collect()


@pytest.mark.parametrize("test", [0.0, 0.07, 0.1, 0.5, 1.0])
def test_exact_split_equals_sorting(spark, test):
    keys = [f"c{i}" for i in range(230)]
    df = spark.createDataFrame([(k,) for k in keys], "conversation string")
    got = {r["conversation"] for r in X.split(df, test=test, seed=3, exact=True).where("split = 'test'").collect()}
    order = sorted(keys, key=lambda k: (hashlib.md5(f"3:{k}".encode()).hexdigest()[:8], k))
    assert got == set(order[:math.ceil(round(test * 100) * len(keys) / 100)])


def test_exact_split_decides_equal_hashes_by_key(spark, monkeypatch):
    monkeypatch.setattr(X, "_split_digits", lambda key, seed: F.lit("0badcafe"))      # every hash is the same
    df = spark.createDataFrame([(f"c{i}",) for i in range(10)] + [("c3",), (None,)], "conversation string")
    got = [r["conversation"] for r in X.split(df, test=0.3, exact=True).where("split = 'test'").collect()]
    assert sorted(got) == ["c0", "c1", "c2", "c3", "c3"]                              # 4 of 11; a key's rows stay together


def test_exact_split_of_few_rows(spark):
    empty = spark.createDataFrame([], "conversation string")
    assert X.split(empty, exact=True).collect() == []
    one = spark.createDataFrame([("a",)], "conversation string")
    assert [r["split"] for r in X.split(one, test=0.1, exact=True).collect()] == ["test"]


def _single_partition_inputs(df):
    """The plan line under each SinglePartition exchange."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            out.append(lines[i + 1] if i + 1 < len(lines) else "")
    return out


def test_no_single_partition_on_the_data_path(spark):
    import __spark_entry__ as E
    from conftest import SF
    for name in ["train_test_split_exact", "round_robin", "pack_sequences"]:
        df = E.queries()[name](spark, SF)
        for child in _single_partition_inputs(df):
            # only the per-partition row counts (one row per range partition) may meet in one task
            assert "HashAggregate(keys=[_pid" in child, (name, child)

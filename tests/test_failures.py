"""Missing answers and pool tables."""
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chatloom.functions.chat import message
from chatloom.operators import select as W
from chatloom.operators.complete import BatchModel, TableModel, prompts_table
from chatloom.operators.generate import explode_messages
from chatloom.operators.pools import Pools, PoolTable


def asked(spark):
    return spark.createDataFrame([(i, f"q{i}") for i in range(6)], "document long, q string")


def chat(df):
    return F.array(message("user", F.col("q")))


def generated(inputs, model):
    r = model.answer(inputs, chat(inputs), "reply", when=F.col("document") != 5)
    msgs = F.when(F.col("document") != 5, F.array(message("user", F.col("q")), message("assistant", F.col("reply"))))
    return explode_messages(r.withColumn("messages", msgs), "t", "base", "document")


def check_stage(inputs, model):
    out = W.stage_output(inputs, generated(inputs, model), "t", "base", "document").collect()
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r.role)
    assert sorted(by) == [0, 1, 3, 4, 5]                       # 2 had no answer: neither rows nor a sentinel
    assert by[5] == ["none"] and all(sorted(by[i]) == ["assistant", "user"] for i in (0, 1, 3, 4))
    assert all(r.content is not None and r.content != "None" for r in out)


def test_batch_model_without_an_answer(spark):
    def fn(prompts, params):
        return pd.Series([None if "q2" in p else "yes" for p in prompts])

    check_stage(asked(spark), BatchModel(fn))


def test_table_model_without_an_answer_and_with_repeated_rows(spark):
    inputs = asked(spark)
    table = prompts_table(inputs, chat(inputs)).select("prompt_id", F.when(~F.col("prompt").contains("q2"), "yes").alias("text"))
    check_stage(inputs, TableModel(table.unionByName(table)))
    check_stage(inputs, TableModel(table.where("text IS NOT NULL")))


def test_pool_table_round_trip_and_bound(spark):
    pools = Pools({"one": ["a", "b"], "pair": [("x", "y"), ("z",)]})
    table = pools.to_table(spark)
    assert Pools.from_table(table).phrases == {"one": ["a", "b"], "pair": [["x", "y"], ["z"]]}
    with pytest.raises(ValueError, match="PoolTable"):
        Pools.from_table(table, max_rows=3)
    got = PoolTable(table).assign(spark.range(8), "one", "id", "phrase")
    want = pools.assign(spark.range(8), "one", "id", "phrase")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

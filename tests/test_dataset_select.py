from pyspark.sql import functions as F

from chatloom.operators import dataset as X
from chatloom.operators import generate as G
from chatloom.operators import select as W
from chatloom.plans.q_select import pending_recipe_inputs
from chatloom.sources.tables import training_view

from conftest import SF, rows


def test_assemble_orders_and_decodes(spark):
    t = spark.createDataFrame([
        ("c1", 2, "third", "assistant", "t", "r", 1), ("c1", 0, "first", "system", "t", "r", 1),
        ("c1", 1, "second", "user", "t", "r", 1), ("c1", 3, "odd", "robot", "t", "r", 1),
        ("c2", 0, "", "none", "t", "r", 2), ("c3", 0, "other rev", "user", "t", "r2", 3)],
        "conversation string, position int, content string, role string, trainer string, revision string, source long")
    out = rows(X.assemble(t, revision="r", system="SYS"))
    assert len(out) == 1
    msgs = out[0]["messages"]
    assert [m["content"] for m in msgs] == ["SYS", "first", "second", "third", "odd"]
    assert msgs[-1]["role"] == "assistant"
    try:
        X.assemble(t, revision="r", strict=True).collect()
        raise AssertionError("strict must reject unknown roles")
    except Exception as e:  # noqa: BLE001
        assert "unknown role" in str(e)


def test_split_keeps_conversations_whole_and_exact_size(spark):
    convs = X.assemble(training_view(spark, SF), revision="base")
    n = convs.count()
    ex = X.split(convs, test=0.1, exact=True)
    assert ex.where("split = 'test'").count() == -(-n // 10)
    assert ex.select("conversation").distinct().count() == n
    # selection: the rows themselves go through no exchange and no sort that assembling them does not need
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for step in ("Exchange", "Sort", "Join", "Window"):
        assert plan(ex).count(step) == plan(convs).count(step), step


def test_pack_token_accounting(spark):
    convs = X.assemble(training_view(spark, SF), revision="base")
    texts = X.render_dataset(convs).select("conversation", "text")
    packed = X.pack(texts, length=64, shards=3)
    got = packed.agg(F.sum("n_tokens"), F.min("n_tokens"), F.max("n_tokens")).first()
    assert got[1] == got[2] == 64
    toks = texts.select("conversation", (F.size(X.whitespace_tokens(F.col("text"))) + 1).alias("n"),
                        (F.conv(F.substring(F.md5("conversation"), 1, 8), 16, 10).cast("long") % 3).alias("shard"))
    per = toks.groupBy("shard").agg(F.sum("n").alias("t")).collect()
    assert got[0] == sum((r["t"] // 64) * 64 for r in per)


def test_rerun_is_idempotent_and_sentinels_disjoint(spark):
    training = training_view(spark, SF)
    p = pending_recipe_inputs(spark, SF, "evaluator", training=training)
    produced = G.evaluator(p)
    sent = W.sentinels(p, produced, None, "evaluator", "base", key="document")
    ids = p.select(F.col("document").alias("source"))
    prod_ids = produced.select("source").distinct()
    assert sent.join(prod_ids, "source").count() == 0
    assert ids.count() == prod_ids.count() + sent.count()
    stored = training.unionByName(produced).unionByName(sent)
    assert pending_recipe_inputs(spark, SF, "evaluator", training=stored).count() == 0
    from chatloom.sources.tables import recipe_view
    assert pending_recipe_inputs(spark, SF, "evaluator", "other", training=stored).count() == \
        recipe_view(spark, SF).count()


def test_failed_inputs_get_no_sentinel(spark):
    p = pending_recipe_inputs(spark, SF, "evaluator")
    failed = p.select("document").limit(3)
    sent = W.sentinels(p, G.evaluator(p), failed, "evaluator", "base", key="document")
    assert sent.join(failed.withColumnRenamed("document", "source"), "source").count() == 0


def test_pending_plan_uses_anti_join(spark):
    plan = pending_recipe_inputs(spark, SF, "evaluator")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan

import re

import numpy as np
from pyspark.sql import functions as F

from chatloom.operators import prompts as P
from chatloom.operators import generate as G
from chatloom.operators.complete import BatchModel, ExpressionModel, STAND_IN, plan_batches

from conftest import SF, rows


def test_parse_questions_cases(spark):
    ans = "1. What is salt?\n- Why knead?\nWhy rest?\n2. What other herbs?\n"
    df = spark.createDataFrame([(1, ans)], "source long, answer string")
    got = rows(G.parse_questions(df).orderBy("ordinal"))
    assert [r["question"] for r in got] == ["What is salt?", "Why knead?"]
    strict = G.parse_questions(df, strict=True)
    try:
        strict.collect()
        raise AssertionError("strict mode must fail on an unnumbered line")
    except Exception as e:  # noqa: BLE001
        assert "unnumbered" in str(e)


def brute_diverse(vecs, keep):
    idx = list(range(len(vecs)))
    while len(idx) > keep:
        mean = np.mean([vecs[i] for i in idx], axis=0)
        cos = [float(np.dot(vecs[i], mean) / np.linalg.norm(mean)) for i in idx]
        best = max(range(len(idx)), key=lambda j: (cos[j], j))
        del idx[best]
    return idx


def test_diverse_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    data = []
    for g, n in [(0, 6), (1, 7), (2, 12)]:
        v = rng.normal(size=(n, 5))
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for i in range(n):
            data.append((g, i, v[i].tolist()))
    v = rng.normal(size=5)
    v /= np.linalg.norm(v)
    data += [(3, i, v.tolist()) for i in range(7)]  # all equal: the later one goes
    df = spark.createDataFrame(data, "g long, i int, v array<double>")
    got = {}
    for r in G.diverse(df, "g", "i", "v", keep=6).collect():
        got.setdefault(r["g"], set()).add(r["i"])
    for g in range(3):
        vecs = [np.array(x[2]) for x in data if x[0] == g]
        assert got[g] == set(brute_diverse(vecs, 6)), g
    assert got[3] == {0, 1, 2, 3, 4, 5}
    # the distributed rounds (forced with a tiny local bound) give the same result
    dist = {}
    for r in G.diverse(df, "g", "i", "v", keep=6, max_local=6).collect():
        dist.setdefault(r["g"], set()).add(r["i"])
    assert dist == got


def test_secrets_take_until(spark):
    # judgements scripted by the last answer: answer 2 starts with "No" -> only the first secret is kept
    def fn(prompt, options=None, max_tokens=400):
        n = F.size(F.split(prompt, re.escape(P.SECRET_MORE)))
        if options:
            return F.lit("no")
        return F.when(n == 2, F.lit("No, nothing else")).otherwise(F.concat(F.lit("tip"), n.cast("string")))
    base = spark.createDataFrame([(1,)], "document long")
    out = G.secrets_rounds(base, ExpressionModel(fn), [F.struct(F.lit("system").alias("role"),
                                                                F.lit("s").alias("content"))])
    assert out.first()["secrets"] == ["tip1"]


def test_batch_model_equals_expression_model(spark):
    import hashlib
    import pandas as pd

    def py_model(prompts: pd.Series, params: dict) -> pd.Series:
        return prompts.map(lambda p: "r" + hashlib.md5(p.encode()).hexdigest()[:8])

    from chatloom.plans.q_select import pending_recipe_inputs
    inputs = pending_recipe_inputs(spark, SF, "evaluator")
    a = G.evaluator(inputs, model=STAND_IN).where("role = 'assistant'")
    # the free-text rounds agree; the yes/no round uses options, so compare only the why-answers
    r1 = G.evaluator_rounds(inputs, STAND_IN).select("document", "why")
    r2 = G.evaluator_rounds(inputs, BatchModel(py_model)).select("document", F.col("why").alias("why2"))
    j = r1.join(r2, "document")
    assert j.where("why <> why2").count() == 0 and j.count() > 0 and a.count() > 0


def test_positions_dense_and_one_conversation_per_recipe(spark):
    from chatloom.plans.q_select import pending_recipe_inputs
    rows_ = G.recipe_chat(pending_recipe_inputs(spark, SF, "recipe"))
    g = rows_.groupBy("conversation").agg(F.count("*").alias("n"), F.max("position").alias("m"),
                                          F.countDistinct("source").alias("s"))
    assert g.where("m <> n - 1 OR s <> 1").count() == 0


def test_plan_batches_bounds(spark):
    data = [(f"p{i}", "a" if i % 3 else "b", int(5 + (i * 37) % 300)) for i in range(200)] + [("huge", "a", 20000)]
    df = spark.createDataFrame(data, "prompt_id string, params string, n_tokens long")
    plan = plan_batches(df, size=4, max_pad=0.2, context=16384, max_tokens=400, num_partitions=3)
    got = plan.collect()
    assert len(got) == len(data)
    assert [r["batch"] for r in got if r["prompt_id"] == "huge"] == [None]
    by = {}
    for r in got:
        if r["batch"] is not None:
            by.setdefault(r["batch"], []).append(r)
    for members in by.values():
        assert len(members) <= 4 and len({m["params"] for m in members}) == 1
        longest = max(m["n_tokens"] for m in members)
        pad = sum(longest - m["n_tokens"] for m in members) / (longest * len(members))
        assert pad <= 0.2 + 1e-9


def test_null_score_is_not_eligible_and_gets_a_sentinel(spark):
    from chatloom.operators import select as W
    from chatloom.plans.q_select import pending_recipe_inputs
    p = pending_recipe_inputs(spark, SF, "evaluator").limit(3)
    p = p.withColumn("review_score", F.lit(None).cast("double")).withColumn("review_count", F.lit(20).cast("long"))
    out = G.evaluator(p)
    assert out.count() == 0
    assert W.sentinels(p, out, None, "evaluator", "base", key="document").count() == 3


def test_first_secret_judged_common_gives_no_pair(spark):
    def fn(prompt, options=None, max_tokens=400):
        return F.lit("yes") if options else F.lit("a trick")
    base = spark.createDataFrame([(1,)], "document long")
    out = G.secrets_rounds(base, ExpressionModel(fn), [F.struct(F.lit("system").alias("role"),
                                                                F.lit("s").alias("content"))])
    assert out.first()["secrets"] == []

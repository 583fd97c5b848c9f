"""Answers that are missing or outside the options: asked again, failed whole, counted, retried."""
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chatloom.functions.chat import message
from chatloom.operators import generate as G
from chatloom.operators import prompts as P
from chatloom.operators import select as W
from chatloom.operators.complete import FLAKY, BatchModel, answer_rates, ask, reask
from chatloom.operators.prompts import YES_NO

from conftest import rows

ASKED = [(0, "fine"), (1, "slow"), (2, "never"), (3, "silent"), (4, "skipped"), (5, None)]


def model():
    """Answers by what the prompt says; ``slow`` is only valid once it was told the options twice."""
    seen = []

    def fn(prompts, params):
        seen.extend(prompts)
        out = []
        for p in prompts:
            told = p.count(reask(YES_NO))
            out.append(" YES\n" if "fine" in p or "slow" in p and told == 2 else None if "silent" in p else "maybe")
        return pd.Series(out, dtype=object)

    return BatchModel(fn), seen


def asked(spark, retries=2):
    m, _ = model()
    df = spark.createDataFrame(ASKED, "id long, q string")
    return ask(m, df, F.array(message("user", F.col("q"))), "gate", options=YES_NO, when=F.col("q") != "skipped", retries=retries)


def test_only_invalid_answers_are_asked_again(spark):
    got = {r["id"]: r for r in rows(asked(spark))}
    assert [got[i]["gate"] for i in range(6)] == ["yes", "yes", None, None, None, None]
    assert [got[i]["error"] for i in range(6)] == [None, None, "invalid:gate", "no_answer:gate", None, None]
    tries = {i: [(a["kind"], a["tries"], a["valid"]) for a in got[i]["asked"]] for i in range(6)}
    assert tries == {0: [("gate", 1, True)], 1: [("gate", 3, True)], 2: [("gate", 3, False)], 3: [("gate", 1, False)], 4: [], 5: []}
    assert [tuple(r) for r in answer_rates(asked(spark)).collect()] == [("gate", 4, 8, 2)]
    assert {r["id"]: r["error"] for r in rows(asked(spark, retries=1))}[1] == "invalid:gate"


def test_an_input_that_failed_is_asked_nothing_more(spark):
    m, _ = model()
    df = ask(m, asked(spark), F.array(message("user", F.concat(F.lit("fine "), F.coalesce("q", F.lit(""))))), "more")
    got = {r["id"]: (r["more"], r["error"], len(r["asked"])) for r in rows(df)}
    assert got[2] == (None, "invalid:gate", 1) and got[3] == (None, "no_answer:gate", 1) and got[0] == (" YES\n", None, 2)


def articles(spark):
    return spark.createDataFrame([(i, f"article {i} " + w) for i, w in enumerate(["ok", "classless", "listless", "one reply short", "story", "odd class"])],
                                 "id long, text string")


def article_model():
    def fn(prompts, params):
        out = []
        for p in prompts:
            if params["options"]:
                out.append(None if "classless" in p else "poem" if "odd class" in p else "Story " if "story" in p.split("article 4")[-1][:12] and "article 4" in p else "knowledge")
            elif params["max_tokens"] == 600:
                out.append(None if "listless" in p else "1. What is it?\n2. Why is it?")
            else:
                out.append(None if "reply short" in p and "Why is it?" in p else "because")
        return pd.Series(out, dtype=object)
    return BatchModel(fn)


def test_a_missing_class_list_or_reply_fails_the_article(spark):
    inputs = articles(spark)
    stage = W.settle_stage(inputs, G.question_chat(inputs, article_model(), errors=True), "summarizer", "base", "id")
    attempts = {r["source"]: (r["outcome"], r["error"]) for r in rows(stage.attempts)}
    assert attempts == {0: ("rows", None), 1: ("failed", "no_answer:article_class"), 2: ("failed", "no_answer:question_list"),
                        3: ("failed", "no_answer:reply"), 4: ("empty", None), 5: ("failed", "invalid:article_class")}
    by = {}
    for r in rows(stage.rows):
        by.setdefault(r["source"], []).append(r["role"])
    assert {k: sorted(v) for k, v in by.items()} == {0: ["assistant", "assistant", "user", "user"], 4: ["none"]}


def recipes(spark, n=60):
    rows_ = [(i, i + 1000, f"t{i}", f"text {i}", 4.5 if i % 2 else 3.0, 20 if i % 5 else 3, [f"i{i}"], ["d"], {"energy": str(i)} if i % 3 else {}, [f"r{i}"],
              ["cat"], [], 60, None) for i in range(n)]
    return spark.createDataFrame(rows_, "reid long, document long, title string, text string, review_score double, review_count long, "
                                 "ingredients array<string>, directions array<string>, nutrition map<string,string>, reviews array<string>, "
                                 "category array<string>, cuisine array<string>, prep_time long, total_time long")


@pytest.mark.parametrize("generator,name", [(G.evaluator, "evaluator"), (G.recipe_chat, "recipe")])
def test_every_input_has_one_outcome(spark, generator, name):
    inputs = recipes(spark)
    stage = W.settle_stage(inputs, generator(inputs, FLAKY, trainer=name, errors=True), name, "base", "document", run="r1")
    attempts = rows(stage.attempts)
    assert sorted(a["source"] for a in attempts) == list(range(1000, 1060)) and {a["run"] for a in attempts} == {"r1"}
    outcome = {a["source"]: a["outcome"] for a in attempts}
    assert set(outcome.values()) == {"rows", "empty", "failed"}
    got = rows(stage.rows)
    assert {r["source"] for r in got if r["role"] != "none"} == {s for s, o in outcome.items() if o == "rows"}
    assert sorted(r["source"] for r in got if r["role"] == "none") == sorted(s for s, o in outcome.items() if o == "empty")
    assert all(r["content"] is not None and "perhaps" not in r["content"] for r in got)
    assert all((a["error"] is not None) == (a["outcome"] == "failed") for a in attempts)
    assert {a["error"].split(":")[0] for a in attempts if a["error"]} <= {"no_answer", "invalid"}


def test_attempts_are_counted_and_bounded(spark):
    ledger = spark.createDataFrame([("t", "base", 1, "r1", "failed", "no_answer:x"), ("t", "base", 1, "r2", "failed", "invalid:y"),
                                    ("t", "base", 2, "r1", "failed", "no_answer:x"), ("t", "base", 2, "r2", "rows", None),
                                    ("t", "next", 3, "r1", "failed", "e"), ("u", "base", 3, "r1", "failed", "e")], W.ATTEMPTS)
    assert sorted(map(tuple, W.failures(ledger, "t", "base").collect())) == [(1, 2, "invalid:y"), (2, 1, "no_answer:x")]
    pending = spark.createDataFrame([(1,), (2,), (3,)], "document long")
    left = W.within_attempts(pending, ledger, "t", "base", "document", most=2)
    assert sorted(r.document for r in left.collect()) == [2, 3]


def test_stages_commit_one_by_one(spark):
    inputs = recipes(spark, 10)
    done = []

    def broken(*args, **kwargs):
        raise RuntimeError("the second stage breaks")

    with pytest.raises(RuntimeError):
        W.run_stages([("evaluator", inputs, G.evaluator, "document"), ("x", inputs, broken, "document")], "base", model=FLAKY,
                     commit=lambda name, stage: done.append((name, stage.rows.count(), stage.attempts.count())))
    assert len(done) == 1 and done[0][0] == "evaluator" and done[0][2] == 10
    assert P.YES_NO == YES_NO

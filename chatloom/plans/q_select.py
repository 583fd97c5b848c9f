"""Pending work, sampling, sentinels, idempotence, the stage runner."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chatloom.operators import complete as C
from chatloom.operators import generate as G
from chatloom.operators import select as W
from chatloom.operators.complete import FLAKY
from chatloom.plans.registry import register
from chatloom.plans import sql_gen as S
from chatloom.schemas import TRAINING
from chatloom.session import scratch_path
from chatloom.sources.commits import BatchStore
from chatloom.sources.done_index import DoneIndex
from chatloom.sources.tables import (BASE_REVISION, document_view, recipe_document_view, recipe_flags,
                                     recipe_view, training_view)


def pending_recipe_inputs(spark, sf_dir, trainer, revision=BASE_REVISION, training=None):
    recipes = recipe_view(spark, sf_dir)
    training = training if training is not None else training_view(spark, sf_dir)
    return W.pending_recipes(recipes, recipe_document_view(recipes), training, trainer, revision)


def pending_article_inputs(spark, sf_dir, trainer="summarizer", revision=BASE_REVISION, training=None):
    training = training if training is not None else training_view(spark, sf_dir)
    return W.pending_articles(document_view(spark, sf_dir), recipe_flags(spark, sf_dir), training, trainer, revision)


@register("pending_recipes", S.with_ctes(S.base_ctes(("p", S.pending_recipes_view("evaluator")))) + """
SELECT reid, document, title, review_score, review_count FROM p""")
def pending_recipes(spark, sf_dir):
    return pending_recipe_inputs(spark, sf_dir, "evaluator").select(
        "reid", "document", "title", "review_score", "review_count")


@register("pending_articles", S.with_ctes(S.base_ctes(("p", S.pending_articles_view()))) + """
SELECT id, title, CAST(strlen(text) AS BIGINT) AS n_bytes FROM p""")
def pending_articles(spark, sf_dir):
    return pending_article_inputs(spark, sf_dir).select("id", "title", F.octet_length("text").cast("long").alias("n_bytes"))


_BY_INDEX = S.base_ctes(("pr", S.pending_recipes_view("evaluator")), ("ps", S.pending_articles_view()))


@register("pending_by_index", S.with_ctes(_BY_INDEX) + """
SELECT 'evaluator' AS trainer, CAST(document AS BIGINT) AS source FROM pr
UNION ALL SELECT 'summarizer', CAST(id AS BIGINT) FROM ps""")
def pending_by_index(spark, sf_dir):
    """S9/W1, W2 over a store of two commits, one of them in the done-index: the inputs that are pending."""
    store = BatchStore(spark, scratch_path(spark, "runs"), {"training": (TRAINING, ["revision", "trainer"])})
    index = DoneIndex(store, f"done_{uuid.uuid4().hex[:12]}")
    stored = training_view(spark, sf_dir)
    store.write("first", {"training": stored.where("source % 2 = 0")})
    index.refresh()
    store.write("second", {"training": stored.where("source % 2 <> 0")})
    recipes = pending_recipe_inputs(spark, sf_dir, "evaluator", training=index)
    articles = pending_article_inputs(spark, sf_dir, training=index)
    return (recipes.select(F.lit("evaluator").alias("trainer"), F.col("document").cast("long").alias("source"))
            .unionByName(articles.select(F.lit("summarizer").alias("trainer"), F.col("id").cast("long").alias("source"))))


@register("pending_counts", S.with_ctes(S.base_ctes(
    ("pe", S.pending_recipes_view("evaluator")), ("pr", S.pending_recipes_view("recipe")),
    ("ps", S.pending_articles_view()))) + """
SELECT 'evaluator' AS trainer, count(*) AS n_pending FROM pe
UNION ALL SELECT 'summarizer', count(*) FROM ps
UNION ALL SELECT 'recipe', count(*) FROM pr""")
def pending_counts(spark, sf_dir):
    return W.pending_counts(evaluator=pending_recipe_inputs(spark, sf_dir, "evaluator"),
                            summarizer=pending_article_inputs(spark, sf_dir),
                            recipe=pending_recipe_inputs(spark, sf_dir, "recipe"))


@register("quick_sample", S.with_ctes(S.base_ctes(("p", S.pending_recipes_view("evaluator")))) + """
SELECT reid, document FROM p ORDER BY md5(CAST(document AS VARCHAR) || ':0') LIMIT 50""")
def quick_sample(spark, sf_dir):
    p = pending_recipe_inputs(spark, sf_dir, "evaluator")
    return W.quick_sample(p, 50, seed=0, key="document").select("reid", "document")


@register("quick_sample_random")
def quick_sample_random(spark, sf_dir):
    """W4 as in the original quick mode: 50 pending inputs at random (seeded; rows-only check)."""
    p = pending_recipe_inputs(spark, sf_dir, "evaluator")
    return W.quick_sample(p, 50, seed=7).select("reid", "document")


_SENTINEL_SQL = """SELECT md5(concat_ws(chr(31), 'evaluator', 'base', CAST(document AS VARCHAR), 'none')) AS conversation,
       0 AS position, '' AS content, 'none' AS role, 'evaluator' AS trainer, 'base' AS revision,
       CAST(document AS BIGINT) AS source
FROM p WHERE NOT (review_count >= 10 AND review_score IS NOT NULL)"""


@register("sentinels", S.with_ctes(S.base_ctes(("p", S.pending_recipes_view("evaluator")))) + _SENTINEL_SQL)
def sentinels(spark, sf_dir):
    p = pending_recipe_inputs(spark, sf_dir, "evaluator")
    out = G.evaluator(p)
    return W.sentinels(p, out, None, "evaluator", "base", key="document")


@register("rerun_stage", S.with_ctes(S.base_ctes(("p", S.pending_recipes_view("evaluator")))) + """
SELECT 'base' AS revision, CAST(0 AS BIGINT) AS n_pending
UNION ALL SELECT 'next', count(*) FROM recipe""")
def rerun_stage(spark, sf_dir):
    """After one evaluator stage (rows + sentinels) is stored, the same revision has nothing
    pending and a new revision has everything pending again."""
    training = training_view(spark, sf_dir)
    p = pending_recipe_inputs(spark, sf_dir, "evaluator", training=training)
    stored = training.unionByName(W.stage_output(p, G.evaluator(p), "evaluator", "base", key="document"))
    again = pending_recipe_inputs(spark, sf_dir, "evaluator", "base", training=stored)
    fresh = pending_recipe_inputs(spark, sf_dir, "evaluator", "next", training=stored)
    return W.pending_counts(base=again, next=fresh).withColumnRenamed("trainer", "revision")


def _ev_rows():
    return S.explode_sql("ev_msgs", "evaluator", "base", "document")


def _rc_rows():
    return S.explode_sql("rc_msgs", "recipe", "base", "document")


@register("run_stages", S.with_recursive(S.base_ctes(
    ("ev_in", S.pending_recipes_view("evaluator")), *S.evaluator_ctes("ev_in"), ("ev_msgs", S.evaluator_messages()),
    ("ev_rows", _ev_rows()),
    ("rc_in", S.pending_recipes_view("recipe")), *S.recipe_ctes("rc_in"), ("rc_msgs", S.recipe_messages()),
    ("rc_rows", _rc_rows()),
    ("ar_in", S.pending_articles_view()), *S.article_ctes("ar_in"),
    ("q_lines", S.question_lines_sql("ar1", "id", "question_list")),
    *S.question_ctes("q_lines", "ar1"),
    ("all_rows", """SELECT trainer, conversation, role, source FROM ev_rows
UNION ALL SELECT trainer, conversation, role, source FROM rc_rows
UNION ALL SELECT trainer, conversation, role, source FROM q_rows
UNION ALL SELECT 'evaluator', 'x' || CAST(document AS VARCHAR), 'none', document FROM ev_in
  WHERE document NOT IN (SELECT source FROM ev_rows)
UNION ALL SELECT 'recipe', 'x' || CAST(document AS VARCHAR), 'none', document FROM rc_in
  WHERE document NOT IN (SELECT source FROM rc_rows)
UNION ALL SELECT 'summarizer', 'x' || CAST(id AS VARCHAR), 'none', id FROM ar_in
  WHERE id NOT IN (SELECT source FROM q_rows)"""),
)) + """
SELECT trainer, count(*) AS n_rows, count(DISTINCT conversation) AS n_conversations,
       count(*) FILTER (WHERE role = 'none') AS n_sentinels
FROM all_rows GROUP BY trainer""")
def run_stages(spark, sf_dir):
    """Evaluator -> summarizer -> recipe over their own pending sets; counts per stage."""
    training = training_view(spark, sf_dir)
    stages = [
        ("evaluator", pending_recipe_inputs(spark, sf_dir, "evaluator", training=training), G.evaluator, "document"),
        ("summarizer", pending_article_inputs(spark, sf_dir, training=training), G.question_chat, "id"),
        ("recipe", pending_recipe_inputs(spark, sf_dir, "recipe", training=training), G.recipe_chat, "document"),
    ]
    return W.stage_counts(W.run_stages(stages, "base"))


# ------------------------------------------------------------------ failures, with a model that fails by its prompt

_FAILING = S.base_ctes(
    ("ev_in", S.pending_recipes_view("evaluator")), *S.failing_evaluator_ctes("ev_in"),
    ("fv_msgs", S.evaluator_messages("(SELECT * FROM fv WHERE error IS NULL)")),
    ("fv_rows", S.explode_sql("fv_msgs", "evaluator", "base", "document")),
    ("ar_in", S.pending_articles_view()), *S.failing_article_ctes("ar_in"),
    ("q_lines", S.question_lines_sql("(SELECT * FROM fa WHERE question_list IS NOT NULL)", "id", "question_list")),
    *S.failing_question_ctes("q_lines", "fa"),
    ("tried", """SELECT 'evaluator' AS trainer, CAST(e.document AS BIGINT) AS source, fv.error,
       e.document IN (SELECT source FROM fv_rows) AS has_rows FROM ev_in e LEFT JOIN fv ON fv.document = e.document
UNION ALL SELECT 'summarizer', CAST(a.id AS BIGINT), l.error, a.id IN (SELECT source FROM q_rows)
  FROM ar_in a LEFT JOIN fq_lost l ON l.source = a.id"""),
    ("outcome", """SELECT trainer, source, error,
       CASE WHEN error IS NOT NULL THEN 'failed' WHEN has_rows THEN 'rows' ELSE 'empty' END AS outcome FROM tried"""))


def _failing_stages(spark, sf_dir, training=None, revision=BASE_REVISION):
    return [("evaluator", pending_recipe_inputs(spark, sf_dir, "evaluator", revision, training), G.evaluator, "document"),
            ("summarizer", pending_article_inputs(spark, sf_dir, revision=revision, training=training), G.question_chat, "id")]


def _run_failing(spark, sf_dir):
    """(rows, attempts) of the evaluator and the summarizer over a model that fails for some prompts."""
    done = []
    rows = W.run_stages(_failing_stages(spark, sf_dir), BASE_REVISION, model=FLAKY, commit=lambda _, stage: done.append(stage.attempts))
    return rows, done[0].unionByName(done[1])


@register("stage_attempts", S.with_recursive(_FAILING) + """
SELECT trainer, 'base' AS revision, source, '0' AS run, outcome, error FROM outcome""")
def stage_attempts(spark, sf_dir):
    """What became of every input. A missing or invalid answer fails the input, also one that only steers the generator."""
    return _run_failing(spark, sf_dir)[1]


@register("failed_stage_rows", S.with_recursive(_FAILING) + """
SELECT conversation, position, content, role, trainer, revision, source FROM fv_rows
UNION ALL SELECT conversation, position, content, role, trainer, revision, source FROM q_rows
UNION ALL SELECT md5(concat_ws(chr(31), trainer, 'base', CAST(source AS VARCHAR), 'none')), 0, '', 'none', trainer, 'base', source
  FROM outcome WHERE outcome = 'empty'""")
def failed_stage_rows(spark, sf_dir):
    """The training rows of that run. Failed inputs have neither rows nor a sentinel, and no answer outside the
    options is in any row."""
    return _run_failing(spark, sf_dir)[0]


@register("pending_after_failures", S.with_recursive(_FAILING) + """
SELECT trainer, count(*) AS n_pending FROM outcome WHERE outcome = 'failed' GROUP BY trainer""")
def pending_after_failures(spark, sf_dir):
    """W6 after W7: once the run is committed, stage by stage, exactly the failed inputs are pending again."""
    store = BatchStore(spark, scratch_path(spark, "runs"), {"training": (TRAINING, ["revision", "trainer"]), "attempts": (W.ATTEMPTS, [])})
    W.run_stages(_failing_stages(spark, sf_dir), BASE_REVISION, model=FLAKY,
                 commit=lambda trainer, stage: store.write(f"{trainer}-0", {"training": stage.rows, "attempts": stage.attempts}))
    training = training_view(spark, sf_dir).unionByName(store.read("training"))
    counts = W.pending_counts(**{name: pending for name, pending, _, _ in _failing_stages(spark, sf_dir, training)})
    return counts.where("n_pending > 0")


@register("answer_rates", S.with_ctes(S.base_ctes(
    ("ev_in", S.pending_recipes_view("evaluator")), *S.failing_evaluator_ctes("ev_in"),
    ("ar_in", S.pending_articles_view()), *S.failing_article_ctes("ar_in"))) + " UNION ALL ".join(f"""
SELECT '{kind}' AS kind, count(*) AS n_asked, CAST(sum({kind}_tries) AS BIGINT) AS n_tries, count({kind}) AS n_valid
FROM {src} WHERE {kind}_asked HAVING count(*) > 0""" for kind, src in
    (("why", "fv"), ("gate", "fv"), ("critique", "fv"), ("article_class", "fa"), ("question_list", "fa"))))
def answer_rates(spark, sf_dir):
    """T18 inside the chain: per kind of question how many inputs were asked, in how many tries, and with what success."""
    evaluator = G.evaluator_rounds(pending_recipe_inputs(spark, sf_dir, "evaluator"), FLAKY)
    articles = G.article_rounds(pending_article_inputs(spark, sf_dir).select("id", "text"), FLAKY)
    return C.answer_rates(evaluator.select("asked").unionByName(articles.select("asked")))

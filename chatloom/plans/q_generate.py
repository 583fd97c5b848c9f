"""Pools, the three generators, completions, validation, batch planning."""
from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.chat import message
from chatloom.operators import complete as C
from chatloom.operators import generate as G
from chatloom.operators import prompts as P
from chatloom.operators.counted import COUNTS, Counted
from chatloom.operators.rotation import ROTATION, Rotation
from chatloom.plans import sql_gen as S
from chatloom.plans.q_select import pending_article_inputs, pending_recipe_inputs
from chatloom.plans.registry import register
from chatloom.session import scratch_path
from chatloom.sources.commits import BatchStore
from chatloom.sources.tables import load, recipe_view

_POOL = G.DEFAULT_POOLS


def _list_sql(items):
    return "[" + ", ".join(S.lit(x) for x in items) + "]"


@register("round_robin", S.with_ctes(S.base_ctes()) + f"""
SELECT id, {_list_sql(P.POOLS['ask_rating'])}[(row_number() OVER (ORDER BY id) - 1) % {len(P.POOLS['ask_rating'])} + 1]
         AS phrase
FROM recipe WHERE review_count >= 10 AND review_score IS NOT NULL""")
def round_robin(spark, sf_dir):
    """T3, rank mode: the eligible recipes take the pool's phrases in turn, in id order."""
    r = G.evaluator_eligible(recipe_view(spark, sf_dir)).select("id")
    return _POOL.assign(r, "ask_rating", "id", "phrase", mode="rank")


@register("round_robin_runs", S.with_ctes(S.base_ctes()) + f"""
SELECT id, {_list_sql(P.POOLS['ask_rating'])}[(row_number() OVER (ORDER BY id % 2, id) - 1) % {len(P.POOLS['ask_rating'])} + 1]
         AS phrase
FROM recipe""")
def round_robin_runs(spark, sf_dir):
    """T3 across runs: the recipes of even ids, then, in a second run, those of odd ids. The second run goes on where the
    first one stopped, and the first one is run again after it."""
    store = BatchStore(spark, scratch_path(spark, "turns"), {"phrase": ("id long, phrase string", []), "rotation": (ROTATION, [])})
    recipes = recipe_view(spark, sf_dir).select("id")
    for run in (0, 1, 0):
        turn = Rotation(store, run)
        rows = turn.assign(recipes.where(F.col("id") % 2 == run), _POOL, "ask_rating", "id", "phrase")
        store.write(run, {"phrase": rows, "rotation": turn.frame()})
    return store.read("phrase")


@register("round_robin_hash", S.with_ctes(S.base_ctes()) + f"""
SELECT id, {S.pick('ask_rating', 'id')} AS phrase FROM recipe""")
def round_robin_hash(spark, sf_dir):
    """T3, hash mode: no ordering at all."""
    return _POOL.assign(recipe_view(spark, sf_dir).select("id"), "ask_rating", "id", "phrase")


_EV = S.base_ctes(("ev_in", S.pending_recipes_view("evaluator")), *S.evaluator_ctes("ev_in"),
                  ("ev_msgs", S.evaluator_messages()))


def _ev_inputs(spark, sf_dir):
    return pending_recipe_inputs(spark, sf_dir, "evaluator")


@register("evaluator_conversations", S.with_ctes(_EV) + S.explode_sql("ev_msgs", "evaluator", "base", "document"))
def evaluator_conversations(spark, sf_dir):
    return G.evaluator(_ev_inputs(spark, sf_dir))


@register("critique_gate", S.with_ctes(_EV) + "SELECT document, bucket, gate, critique FROM ev3 WHERE bucket <> 'good'")
def critique_gate(spark, sf_dir):
    r = G.evaluator_rounds(_ev_inputs(spark, sf_dir))
    return r.where(F.col("bucket") != "good").select("document", "bucket", "gate", "critique")


_RC = S.base_ctes(("rc_in", S.pending_recipes_view("recipe")), *S.recipe_ctes("rc_in"),
                  ("rc_msgs", S.recipe_messages()))


def _rc_inputs(spark, sf_dir):
    return pending_recipe_inputs(spark, sf_dir, "recipe")


def _rc_rows(spark, sf_dir):
    return G.recipe_chat(_rc_inputs(spark, sf_dir))


@register("recipe_title_qa", S.with_ctes(_RC) + """
SELECT document, title_answer || variation[2] AS question FROM rc_done""")
def recipe_title_qa(spark, sf_dir):
    r = G.recipe_rounds(_rc_inputs(spark, sf_dir))
    return r.select("document", F.concat("title_answer", F.element_at("_variation", 2)).alias("question"))


def _pair_sql(user_pick_slot: str) -> str:
    """Rows of the recipe conversations that answer a given question slot (question, answer)."""
    return S.with_ctes(_RC + [("rows", S.explode_sql("rc_msgs", "recipe", "base", "document"))]) + f"""
SELECT q.source AS document, q.content AS question, a.content AS answer
FROM rows q JOIN rows a ON a.conversation = q.conversation AND a.position = q.position + 1
WHERE q.role = 'user' AND q.content = {S.pick(user_pick_slot, 'q.source')}"""


def _pair(spark, sf_dir, slot: str):
    return G.question_answers(G.recipe_messages(_rc_inputs(spark, sf_dir)), _POOL.pick(slot, F.col("document")))


@register("recipe_nutrition_qa", _pair_sql("ask_nutrition"))
def recipe_nutrition_qa(spark, sf_dir):
    return _pair(spark, sf_dir, "ask_nutrition")


@register("recipe_cuisine_qa", _pair_sql("ask_cuisine"))
def recipe_cuisine_qa(spark, sf_dir):
    return _pair(spark, sf_dir, "ask_cuisine")


@register("recipe_category_qa", _pair_sql("ask_category"))
def recipe_category_qa(spark, sf_dir):
    return _pair(spark, sf_dir, "ask_category")


@register("recipe_time_qa", _pair_sql("ask_time"))
def recipe_time_qa(spark, sf_dir):
    return _pair(spark, sf_dir, "ask_time")


@register("recipe_secrets_qa", S.with_ctes(_RC) + """
SELECT document, CAST(len(secrets) AS INTEGER) AS n_secrets, array_to_string(secrets, chr(10)) AS secrets_text, summary
FROM rc_done""")
def recipe_secrets_qa(spark, sf_dir):
    r = G.recipe_rounds(_rc_inputs(spark, sf_dir))
    return r.select("document", F.size("secrets").alias("n_secrets"),
                    F.array_join("secrets", "\n").alias("secrets_text"), "summary")


@register("assign_positions", S.with_ctes(_RC) + S.explode_sql("rc_msgs", "recipe", "base", "document"))
def assign_positions(spark, sf_dir):
    """T13 (with T7-T12): the recipe conversations as training rows, positions dense from 0."""
    return _rc_rows(spark, sf_dir)


_AR = S.base_ctes(("ar_in", S.pending_articles_view()), *S.article_ctes("ar_in"),
                  ("q_lines", S.question_lines_sql("ar1", "id", "question_list")))


def _article_rounds(spark, sf_dir):
    return G.article_rounds(pending_article_inputs(spark, sf_dir).select("id", "text"))


@register("parse_questions", S.with_ctes(_AR) + "SELECT source, ordinal, question FROM q_lines")
def parse_questions(spark, sf_dir):
    r = _article_rounds(spark, sf_dir).where(F.col("question_list").isNotNull())
    return G.parse_questions(r.select(F.col("id").alias("source"), F.col("question_list").alias("answer")))


_ALL_LINES = """SELECT id AS source, n - 1 AS ordinal, ls[n] AS line
  FROM (SELECT id, ls, generate_subscripts(ls, 1) AS n
        FROM (SELECT id, CASE WHEN question_list = '' THEN CAST([] AS VARCHAR[])
                              ELSE string_split(regexp_replace(question_list, '\\n$', ''), chr(10)) END AS ls FROM ar1))"""


@register("question_line_counts", S.with_ctes([*_AR, ("all_lines", _ALL_LINES)]) + f"""
SELECT 'question_line' AS what,
       CASE WHEN regexp_matches(line, '{"|".join(P.BANNED_QUESTION_WORDS)}') THEN 'banned_word'
            WHEN regexp_matches(line, '^[0-9.-]* ') THEN 'kept' ELSE 'no_prefix' END AS reason, count(*) AS n
FROM all_lines GROUP BY ALL""")
def question_line_counts(spark, sf_dir):
    """The lines that were dropped, by reason, counted while the questions are written and committed with them."""
    r = _article_rounds(spark, sf_dir).where(F.col("question_list").isNotNull())
    judged = G.question_lines(r.select(F.col("id").alias("source"), F.col("question_list").alias("answer")))
    store = BatchStore(spark, scratch_path(spark, "lines"), {"question": ("source long, ordinal int, question string", []), "counts": (COUNTS, [])})
    lines = Counted("question_line", G.LINE_REASONS)
    store.write("run", {"question": lines.watch(judged).where("reason IS NULL"), "counts": lambda: lines.frame(spark)})
    return store.read("counts").where("n > 0")


@register("diverse_questions", S.with_recursive(S.diverse_ctes("embeddings", "label", "vec_id", "embedding", 6)) + """
SELECT CAST(grp AS BIGINT) AS label, CAST(ord AS BIGINT) AS vec_id FROM dv_kept""")
def diverse_questions(spark, sf_dir):
    """T15 over the given vectors, one group per label: keep the 6 most spread out."""
    e = load(spark, sf_dir, "embeddings")
    kept = G.diverse(e.select(F.col("label").cast("long").alias("label"), "vec_id", "embedding"),
                     "label", "vec_id", "embedding", keep=6)
    return kept.select(F.col("label").cast("long").alias("label"), F.col("vec_id").cast("long").alias("vec_id"))


@register("question_conversations", S.with_recursive(_AR + S.question_ctes("q_lines", "ar1")) + """
SELECT * FROM q_rows""")
def question_conversations(spark, sf_dir):
    return G.question_chat(pending_article_inputs(spark, sf_dir))


_CLASS_PARAMS = C.params_json(400, 0.0, P.ARTICLE_CLASSES)
_CLASS_PROMPT = (f"{S.SYS} || {S.msg('user', S.lit(P.ARTICLE_INTRO) + ' || text')} || "
                 f"{S.msg('user', S.lit(P.ARTICLE_CLASS))} || {S.ASSIST}")


@register("bulk_completions", S.with_ctes(S.base_ctes(("ar_in", S.pending_articles_view()))) + f"""
SELECT DISTINCT md5({_CLASS_PROMPT} || chr(31) || {S.lit(_CLASS_PARAMS)}) AS prompt_id,
       {S.model(_CLASS_PROMPT, P.ARTICLE_CLASSES)} AS text
FROM ar_in""")
def bulk_completions(spark, sf_dir):
    """The distinct prompts of one round with their parameters, answered once each."""
    art = pending_article_inputs(spark, sf_dir)
    msgs = F.array(message("system", F.lit(P.SYSTEM)),
                   message("user", F.concat(F.lit(P.ARTICLE_INTRO), F.col("text"))),
                   message("user", F.lit(P.ARTICLE_CLASS)))
    prompts = C.prompts_table(art, msgs, options=P.ARTICLE_CLASSES)
    return prompts.select("prompt_id", C.stand_in(F.col("prompt"), options=P.ARTICLE_CLASSES).alias("text"))


@register("validate_answers", S.with_ctes(S.base_ctes(("ar_in", S.pending_articles_view()))) + f"""
SELECT id, answer, lower({S.strip_sql('answer')}) IN ('anecdotes', 'story', 'knowledge') AS valid
FROM (SELECT id, {S.model(_CLASS_PROMPT)} AS answer FROM ar_in
      UNION ALL SELECT id, {S.model(_CLASS_PROMPT, P.ARTICLE_CLASSES)} FROM ar_in)""")
def validate_answers(spark, sf_dir):
    """Answers of the class prompt, asked free-form and constrained, checked against the options."""
    art = pending_article_inputs(spark, sf_dir)
    msgs = F.array(message("system", F.lit(P.SYSTEM)),
                   message("user", F.concat(F.lit(P.ARTICLE_INTRO), F.col("text"))),
                   message("user", F.lit(P.ARTICLE_CLASS)))
    free = C.STAND_IN.answer(art, msgs, "answer").select("id", "answer")
    constrained = C.STAND_IN.answer(art, msgs, "answer", options=P.ARTICLE_CLASSES).select("id", "answer")
    checked = C.validate(free.unionByName(constrained), P.ARTICLE_CLASSES, text="answer")
    return checked.select("id", "answer", "valid")


@register("length_batches")
def length_batches(spark, sf_dir):
    """Batch plan for the question-answer prompts of every pending article (rows-only check;
    the batch properties are asserted by the unit tests)."""
    art = pending_article_inputs(spark, sf_dir).select("id", "text")
    msgs = F.array(message("system", F.lit(P.SYSTEM)),
                   message("user", F.concat(F.lit(P.ARTICLE_INTRO), F.col("text"))),
                   message("user", F.lit(P.ARTICLE_CLASS)))
    prompts = C.prompts_table(art, msgs, options=P.ARTICLE_CLASSES)
    sized = prompts.withColumn("n_tokens", F.size(F.split("prompt", r"\s+")))
    return C.plan_batches(sized, context=16384, max_tokens=400)

"""F1-F8, F11, F12 (text columns) and the recipe eligibility filters T1, T2, T6."""
from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions import text as TX
from chatloom.functions.chat import chatml, message
from chatloom.operators import generate as G
from chatloom.plans.registry import register
from chatloom.plans.sql_views import (card_sql, lines_sql, natural_list_sql, numbered_sql, strip_sql,
                                      with_views)
from chatloom.sources.tables import page_view, recipe_view, training_view


def natural_duration_sql(x: str) -> str:
    s = f"({x} % 86400)"
    dt = f"CAST(floor({x} / 86400) AS BIGINT)"
    y = f"CAST(floor({dt} / 365) AS BIGINT)"
    d = f"({dt} % 365)"
    m = f"CAST(floor({d} / 30.5) AS BIGINT)"
    return f"""(CASE WHEN {x} IS NULL THEN NULL
  WHEN {y} = 0 AND {d} < 1 THEN (CASE WHEN {s} = 0 THEN 'a moment' WHEN {s} = 1 THEN 'a second'
      WHEN {s} < 60 THEN CAST({s} AS VARCHAR) || ' seconds' WHEN {s} < 120 THEN 'a minute'
      WHEN {s} < 3600 THEN CAST(CAST(floor({s} / 60) AS BIGINT) AS VARCHAR) || ' minutes'
      WHEN {s} < 7200 THEN 'an hour' ELSE CAST(CAST(floor({s} / 3600) AS BIGINT) AS VARCHAR) || ' hours' END)
  WHEN {y} = 0 THEN (CASE WHEN {d} = 1 THEN 'a day' WHEN {m} = 0 THEN CAST({d} AS VARCHAR) || ' days'
      WHEN {m} = 1 THEN 'a month' ELSE CAST({m} AS VARCHAR) || ' months' END)
  WHEN {y} = 1 THEN (CASE WHEN {m} = 0 AND {d} = 0 THEN 'a year'
      WHEN {m} = 0 THEN '1 year, ' || CAST({d} AS VARCHAR) || ' days'
      WHEN {m} = 1 THEN '1 year, 1 month' ELSE '1 year, ' || CAST({m} AS VARCHAR) || ' months' END)
  ELSE CAST({y} AS VARCHAR) || ' years' END)"""


_R = with_views("recipe")


@register("fmt_ingredients", _R + f"SELECT id, {lines_sql('ingredients')} AS text FROM recipe")
def fmt_ingredients(spark, sf_dir):
    return recipe_view(spark, sf_dir).select("id", TX.lines("ingredients").alias("text"))


@register("fmt_directions", _R + f"SELECT id, {numbered_sql('directions')} AS text FROM recipe")
def fmt_directions(spark, sf_dir):
    return recipe_view(spark, sf_dir).select("id", TX.numbered("directions").alias("text"))


@register("fmt_nutrition", _R + """
SELECT id, array_to_string(list_transform(nutrition, lambda e: e.k || ': ' || e.v), chr(10)) AS text FROM recipe""")
def fmt_nutrition(spark, sf_dir):
    return recipe_view(spark, sf_dir).select("id", TX.key_values("nutrition").alias("text"))


@register("fmt_reviews", _R + f"SELECT id, {lines_sql('reviews')} AS text FROM recipe")
def fmt_reviews(spark, sf_dir):
    return recipe_view(spark, sf_dir).select("id", TX.lines("reviews").alias("text"))


@register("recipe_card", _R + f"SELECT id, {card_sql('unique_title', 'ingredients', 'directions')} AS card FROM recipe")
def recipe_card(spark, sf_dir):
    return recipe_view(spark, sf_dir).select(
        "id", TX.recipe_card("unique_title", "ingredients", "directions").alias("card"))


@register("natural_list", _R + f"""
SELECT id, {natural_list_sql('cuisine')} AS cuisine_text, {natural_list_sql('category')} AS category_text
FROM recipe""")
def natural_list(spark, sf_dir):
    return recipe_view(spark, sf_dir).select("id", TX.natural_list("cuisine").alias("cuisine_text"),
                                             TX.natural_list("category").alias("category_text"))


@register("natural_duration", _R + f"""
SELECT id, {natural_duration_sql('prep_time')} AS prep_text, {natural_duration_sql('total_time')} AS total_text
FROM recipe""")
def natural_duration(spark, sf_dir):
    return recipe_view(spark, sf_dir).select("id", TX.natural_duration("prep_time").alias("prep_text"),
                                             TX.natural_duration("total_time").alias("total_text"))


# Caller input with a self-written default: a two-value answer template.
FILL_TEMPLATE = "  Rated {}/5 by our readers: {} "


@register("fill_template", _R + f"""
SELECT id, {strip_sql("'  Rated ' || CAST(review_score AS VARCHAR) || '/5 by our readers: ' || unique_title || ' '")}
       AS text FROM recipe""")
def fill_template(spark, sf_dir):
    return recipe_view(spark, sf_dir).select(
        "id", TX.fill(F.lit(FILL_TEMPLATE), F.col("review_score"), F.col("unique_title")).alias("text"))


_PAD, _EOS = "<unk>", "</s>"
_PROMPT_SQL = ("'<|im_start|>' || role || chr(10) || content || '<|im_end|>' || chr(10) || "
               "'<|im_start|>assistant' || chr(10)")


@register("clean_completion", with_views("training") + f"""
SELECT conversation, position,
       {strip_sql("substr(regexp_replace(regexp_replace(raw, '^(?:<unk>)*', ''), '(?:</s>)*$', ''), length(prompt) + 1)")}
         AS cleaned
FROM (SELECT conversation, position, prompt, '<unk><unk>' || prompt || ' ' || content || chr(10) || '</s></s>' AS raw
      FROM (SELECT *, {_PROMPT_SQL} AS prompt FROM training))""")
def clean_completion(spark, sf_dir):
    t = training_view(spark, sf_dir)
    prompt = chatml(F.array(message(F.col("role"), F.col("content"))), generation=True)
    raw = F.concat(F.lit(_PAD * 2), prompt, F.lit(" "), F.col("content"), F.lit("\n"), F.lit(_EOS * 2))
    return t.select("conversation", "position",
                    TX.clean_completion(raw, prompt, pad=_PAD, eos=_EOS).alias("cleaned"))


@register("revision_label", with_views("page") + """
SELECT page_id, string_split(slug, '_')[-1] AS label_underscore,
       array_to_string(string_split(slug, '.')[1:greatest(len(string_split(slug, '.')) - 2, 0)], '') AS label_dotted
FROM page""")
def revision_label(spark, sf_dir):
    p = page_view(spark, sf_dir)
    return p.select("page_id", TX.revision_label("url", "underscore").alias("label_underscore"),
                    TX.revision_label("url", "dotted").alias("label_dotted"))


@register("evaluator_eligible", _R + """
SELECT id, review_count, review_score FROM recipe WHERE review_count >= 10 AND review_score IS NOT NULL""")
def evaluator_eligible(spark, sf_dir):
    return G.evaluator_eligible(recipe_view(spark, sf_dir)).select("id", "review_count", "review_score")


@register("score_bucket", _R + """
SELECT id, CASE WHEN review_score >= 4.4 THEN 'good' WHEN review_score < 3.7 THEN 'bad' ELSE 'maybe' END AS bucket
FROM recipe WHERE review_count >= 10 AND review_score IS NOT NULL""")
def score_bucket(spark, sf_dir):
    r = G.evaluator_eligible(recipe_view(spark, sf_dir))
    return r.select("id", G.score_bucket("review_score").alias("bucket"))


@register("recipe_eligible", _R + "SELECT id, review_score FROM recipe WHERE review_score >= 4.0")
def recipe_eligible(spark, sf_dir):
    return G.recipe_eligible(recipe_view(spark, sf_dir)).select("id", "review_score")

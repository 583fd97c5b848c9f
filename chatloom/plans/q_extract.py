"""Extraction round trip.

The given pages carry no JSON-LD, so recipe pages are written from the recipe view (HTML with a
JSON-LD block, by string concatenation: the same text in Spark and in SQL), then parsed by the
extraction job. The SQL side states what each page must yield, straight from the recipe view.
Page variety comes from value rules on the part key: missing script, broken JSON, missing
headline / author, a non-numeric rating, a bad duration, empty text, non-recipe types.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.html import article_text
from chatloom.functions.text import key_values, lines
from chatloom.operators import extract as D
from chatloom.plans.registry import register
from chatloom.plans.sql_views import VIEWS
from chatloom.session import default_parallelism, scratch_path
from chatloom.sources.tables import load, recipe_view
from chatloom.streaming import ingest as I

SPEC = D.PageSpec()
PARA3 = "Enjoy & share."


# ---- the page writer, in Spark ---------------------------------------------------------------
def _esc(c: Column) -> Column:
    for a, b in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _iso(s: Column) -> Column:
    d = F.floor(s / 86400)
    rest = s - d * 86400
    return F.concat(F.lit("P"), F.when(d > 0, F.concat(d.cast("string"), F.lit("D"))).otherwise(F.lit("")),
                    F.lit("T"), F.floor(rest / 3600).cast("string"), F.lit("H"),
                    F.floor(F.pmod(rest, F.lit(3600)) / 60).cast("string"), F.lit("M"),
                    F.pmod(rest, F.lit(60)).cast("string"), F.lit("S"))


def _jarr(arr: Column, fn) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(arr, fn), ", "), F.lit("]"))


def recipe_pages(spark, sf_dir):
    r = recipe_view(spark, sf_dir)
    k = F.col("id")
    title_raw = F.concat(F.col("unique_title"), F.lit(" & Co"))
    headline = F.when(k % 19 == 0, F.concat(_esc(title_raw), F.lit('"x'))).otherwise(_esc(title_raw))
    type_json = F.when(k % 13 == 0, F.lit('"Recipe"')).when(k % 11 == 0, F.lit('["Article"]')).otherwise(
        F.lit('["Recipe"]'))
    q = lambda x: F.concat(F.lit('"'), _esc(x), F.lit('"'))
    prep = F.when(k % 23 == 0, F.lit('"soon"')).when(F.col("prep_time").isNotNull(),
                                                     F.concat(F.lit('"'), _iso(F.col("prep_time")), F.lit('"')))
    total = F.when(F.col("total_time").isNotNull(), F.concat(F.lit('"'), _iso(F.col("total_time")), F.lit('"')))
    js = F.concat(
        F.lit('[{"@type": '), type_json,
        F.when(k % 17 == 0, F.lit("")).otherwise(F.concat(F.lit(', "headline": "'), headline, F.lit('"'))),
        F.when(k % 37 == 0, F.lit(', "author": []')).otherwise(
            F.concat(F.lit(', "author": [{"name": "Kitchen '), (k % 10).cast("string"), F.lit('"}]'))),
        F.lit(', "aggregateRating": {"ratingValue": '),
        F.when(k % 41 == 0, F.lit('"n/a"')).otherwise(F.col("review_score").cast("string")),
        F.lit(', "ratingCount": '), F.col("review_count").cast("string"), F.lit("}"),
        F.lit(', "review": '), _jarr(F.col("reviews"), lambda x: F.concat(F.lit('{"reviewBody": '), q(x), F.lit("}"))),
        F.lit(', "recipeIngredient": '), _jarr(F.col("ingredients"), q),
        F.lit(', "recipeInstructions": '),
        _jarr(F.col("directions"), lambda x: F.concat(F.lit('{"@type": "HowToStep", "text": '), q(x), F.lit("}"))),
        F.lit(', "nutrition": {"@type": "NutritionInformation"'),
        F.array_join(F.transform(F.map_entries("nutrition"),
                                 lambda e: F.concat(F.lit(', "'), e["key"], F.lit('": '), q(e["value"]))), ""),
        F.lit("}"),
        F.lit(', "recipeCategory": '), _jarr(F.col("category"), q),
        F.lit(', "recipeCuisine": '), _jarr(F.col("cuisine"), q),
        F.when(prep.isNotNull(), F.concat(F.lit(', "prepTime": '), prep)).otherwise(F.lit("")),
        F.when(total.isNotNull(), F.concat(F.lit(', "totalTime": '), total)).otherwise(F.lit("")),
        F.lit(', "recipeYield": '), q(F.col("recipe_yield")), F.lit("}]"))
    body = F.when(k % 29 == 0, F.lit('<p class="comp"> </p>')).otherwise(F.concat(
        F.lit('<p class="comp">'), _esc(F.array_join("ingredients", ", ")), F.lit('</p><p class="comp">'),
        _esc(F.array_join("directions", " ")), F.lit(' <a href="/tips">tips</a> '), _esc(F.lit(PARA3)),
        F.lit("</p>")))
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), _esc(title_raw), F.lit("</title>"),
        F.when(k % 2 == 0, F.concat(F.lit('<meta name="description" content="'),
                                    _esc(F.concat(F.lit("Serves "), F.col("recipe_yield"))), F.lit('">')))
         .otherwise(F.lit("")),
        F.when(k % 31 == 0, F.lit("")).otherwise(F.concat(
            F.lit(f'<script type="application/ld+json" id="{SPEC.script_id}">'), js, F.lit("</script>"))),
        F.lit('</head><body><nav><a class="card" href="/recipes/next">next</a></nav><article><h1>'), _esc(title_raw),
        F.lit('</h1><div class="text-passage">'), body,
        F.lit('<p class="note">Advertisement</p></div></article></body></html>'))
    pages = r.select(F.concat(F.lit("https://kitchen.example/r/"), k.cast("string")).alias("source"),
                     html.alias("html"), js.alias("json"))
    # a stored crawl is many files; spread the written pages the same way so the Python parsing
    # step runs on every core instead of the single partition AQE would coalesce them into
    return pages.repartition(default_parallelism(spark), "source")


# ---- the same page writer and the expected results, in SQL -----------------------------------
def _esc_sql(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


def _iso_sql(s: str) -> str:
    d = f"CAST(floor({s} / 86400) AS BIGINT)"
    rest = f"({s} - {d} * 86400)"
    return (f"('P' || CASE WHEN {d} > 0 THEN CAST({d} AS VARCHAR) || 'D' ELSE '' END || 'T' || "
            f"CAST(CAST(floor({rest} / 3600) AS BIGINT) AS VARCHAR) || 'H' || "
            f"CAST(CAST(floor(({rest} % 3600) / 60) AS BIGINT) AS VARCHAR) || 'M' || CAST({rest} % 60 AS VARCHAR) || 'S')")


def _jarr_sql(arr: str, body: str) -> str:
    return f"('[' || array_to_string(list_transform({arr}, lambda x: {body}), ', ') || ']')"


_Q = f"""'"' || {_esc_sql('x')} || '"'"""
_TITLE_RAW = "(unique_title || ' & Co')"
_JSON_SQL = f"""'[{{"@type": ' || CASE WHEN id % 13 = 0 THEN '"Recipe"' WHEN id % 11 = 0 THEN '["Article"]' ELSE '["Recipe"]' END
 || CASE WHEN id % 17 = 0 THEN '' ELSE ', "headline": "' || CASE WHEN id % 19 = 0 THEN {_esc_sql(_TITLE_RAW)} || '"x'
                                                                   ELSE {_esc_sql(_TITLE_RAW)} END || '"' END
 || CASE WHEN id % 37 = 0 THEN ', "author": []' ELSE ', "author": [{{"name": "Kitchen ' || CAST(id % 10 AS VARCHAR) || '"}}]' END
 || ', "aggregateRating": {{"ratingValue": ' || CASE WHEN id % 41 = 0 THEN '"n/a"' ELSE CAST(review_score AS VARCHAR) END
 || ', "ratingCount": ' || CAST(review_count AS VARCHAR) || '}}'
 || ', "review": ' || {_jarr_sql('reviews', "'{\"reviewBody\": ' || " + _Q + " || '}'")}
 || ', "recipeIngredient": ' || {_jarr_sql('ingredients', _Q)}
 || ', "recipeInstructions": ' || {_jarr_sql('directions', "'{\"@type\": \"HowToStep\", \"text\": ' || " + _Q + " || '}'")}
 || ', "nutrition": {{"@type": "NutritionInformation"'
 || array_to_string(list_transform(nutrition, lambda e: ', "' || e.k || '": "' || {_esc_sql('e.v')} || '"'), '') || '}}'
 || ', "recipeCategory": ' || {_jarr_sql('category', _Q)}
 || ', "recipeCuisine": ' || {_jarr_sql('cuisine', _Q)}
 || CASE WHEN id % 23 = 0 THEN ', "prepTime": "soon"' WHEN prep_time IS NOT NULL
         THEN ', "prepTime": "' || {_iso_sql('prep_time')} || '"' ELSE '' END
 || CASE WHEN total_time IS NOT NULL THEN ', "totalTime": "' || {_iso_sql('total_time')} || '"' ELSE '' END
 || ', "recipeYield": "' || {_esc_sql('recipe_yield')} || '"}}]'"""

_REASON = """CASE WHEN id % 31 = 0 THEN 'no_script' WHEN id % 19 = 0 AND id % 17 <> 0 THEN 'json' WHEN id % 17 = 0 THEN 'missing_headline'
  WHEN id % 37 = 0 THEN 'missing_author' WHEN is_recipe AND id % 41 = 0 THEN 'bad_number'
  WHEN is_recipe AND id % 23 = 0 THEN 'bad_duration' WHEN id % 29 = 0 THEN 'empty_text' END"""
_EXPECTED = f"""WITH recipe AS ({VIEWS['recipe']}),
pg AS (SELECT *, 'https://kitchen.example/r/' || CAST(id AS VARCHAR) AS source,
              NOT (id % 13 = 0 OR id % 11 = 0) AS is_recipe, {_JSON_SQL} AS json FROM recipe),
ex AS (SELECT *, {_REASON} AS reason, unique_title || ' & Co' AS doc_title FROM pg),
good AS (SELECT *, CAST(('0x' || substr(md5(doc_title), 1, 15)) AS BIGINT) AS doc_key FROM ex WHERE reason IS NULL)
"""
_TEXT_SQL = (f"CASE WHEN id % 29 = 0 THEN '' ELSE array_to_string(ingredients, ', ') || array_to_string(directions, ' ')"
             f" || '  ' || '{PARA3}' END")


def _parsed(spark, sf_dir):
    return D.parse_pages(recipe_pages(spark, sf_dir), SPEC)


def _extracted(spark, sf_dir):
    return D.extract_pages(recipe_pages(spark, sf_dir), SPEC)


@register("jsonld_block", _EXPECTED + "SELECT source, md5(CASE WHEN id % 31 = 0 THEN '' ELSE json END) AS block_md5 FROM pg")
def jsonld_block(spark, sf_dir):
    p = recipe_pages(spark, sf_dir)
    return p.select("source", F.md5(D.jsonld_block(F.col("html"), SPEC.script_id)).alias("block_md5"))


@register("jsonld_parse", _EXPECTED + f"""SELECT source, CASE WHEN id % 31 = 0 OR id % 19 = 0 OR id % 17 = 0 THEN NULL
  ELSE {_esc_sql(_TITLE_RAW)} END AS headline_raw FROM pg""")
def jsonld_parse(spark, sf_dir):
    p = recipe_pages(spark, sf_dir)
    meta = D.jsonld_parse(D.jsonld_block(F.col("html"), SPEC.script_id))
    return p.select("source", meta["headline"].alias("headline_raw"))


@register("article_text", _EXPECTED + f"SELECT source, {_TEXT_SQL} AS text FROM pg")
def article_text_q(spark, sf_dir):
    return _parsed(spark, sf_dir).select("source", "text")


@register("unescape_text", _EXPECTED + """SELECT source, CASE WHEN id % 31 = 0 OR id % 19 = 0 OR id % 17 = 0 THEN NULL
  ELSE doc_title END AS title FROM ex""")
def unescape_text(spark, sf_dir):
    return _parsed(spark, sf_dir).select("source", "title")


@register("meta_description", _EXPECTED + """SELECT source, CASE WHEN id % 2 = 0 THEN 'Serves ' || recipe_yield END
  AS subtitle FROM pg""")
def meta_description(spark, sf_dir):
    return _parsed(spark, sf_dir).select("source", "subtitle")


@register("quarantine", _EXPECTED + "SELECT source, reason FROM ex WHERE reason IS NOT NULL")
def quarantine(spark, sf_dir):
    return _extracted(spark, sf_dir).quarantine


@register("quarantine_counts", _EXPECTED + """SELECT 'page' AS what, reason, count(*) AS n FROM ex WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'document', 'kept', count(*) FROM good""")
def quarantine_counts(spark, sf_dir):
    """What an ingested batch left out, by reason, counted while it was written and committed with it."""
    store = I.open_store(spark, scratch_path(spark, "ingested"))
    I.ingest_batch(store, recipe_pages(spark, sf_dir), 0, SPEC)
    return store.read("counts")


@register("classify_page", _EXPECTED + """SELECT source, is_recipe FROM pg WHERE NOT (id % 31 = 0 OR (id % 19 = 0 AND id % 17 <> 0))""")
def classify_page(spark, sf_dir):
    return _parsed(spark, sf_dir).where(F.col("meta").isNotNull()).select("source", "is_recipe")


@register("recipe_fields", _EXPECTED + """SELECT doc_key AS document, review_score, review_count,
  array_to_string(ingredients, chr(10)) AS ingredients, array_to_string(directions, chr(10)) AS directions,
  array_to_string(reviews, chr(10)) AS reviews, array_to_string(category, chr(10)) AS category,
  array_to_string(cuisine, chr(10)) AS cuisine, recipe_yield FROM good WHERE is_recipe""")
def recipe_fields(spark, sf_dir):
    r = _extracted(spark, sf_dir).recipe
    return r.select("document", "review_score", "review_count", *[lines(c).alias(c) for c in
                    ["ingredients", "directions", "reviews", "category", "cuisine"]], "recipe_yield")


@register("durations", _EXPECTED + """SELECT doc_key AS document, CAST(prep_time AS VARCHAR) AS prep_time,
  CAST(total_time AS VARCHAR) AS total_time FROM good WHERE is_recipe""")
def durations(spark, sf_dir):
    r = _extracted(spark, sf_dir).recipe
    return r.select("document", F.col("prep_time").cast("string").alias("prep_time"),
                    F.col("total_time").cast("string").alias("total_time"))


@register("nutrition_map", _EXPECTED + """SELECT doc_key AS document,
  array_to_string(list_transform(nutrition, lambda e: e.k || ': ' || e.v), chr(10)) AS nutrition FROM good
  WHERE is_recipe""")
def nutrition_map(spark, sf_dir):
    return _extracted(spark, sf_dir).recipe.select("document", key_values("nutrition").alias("nutrition"))


@register("split_tables", _EXPECTED + f"""SELECT doc_key AS id, doc_title AS title, 'Kitchen ' || CAST(id % 10 AS VARCHAR) AS author,
  source, CASE WHEN id % 2 = 0 THEN 'Serves ' || recipe_yield END AS subtitle, {_TEXT_SQL} AS text,
  is_recipe AS has_recipe FROM good""")
def split_tables(spark, sf_dir):
    # both tables come from the same parsed rows and share the key: one pass, no join back
    good = _extracted(spark, sf_dir).good
    return good.select("id", "title", "author", "source", "subtitle", "text", F.col("is_recipe").alias("has_recipe"))


@register("quarantine_pages", "SELECT 'page/' || CAST(page_id AS VARCHAR) AS source, 'no_script' AS reason FROM pages")
def quarantine_pages(spark, sf_dir):
    """D6 on the given crawl: none of its pages has the JSON-LD block."""
    p = load(spark, sf_dir, "pages").select(F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("source"),
                                            "html")
    return D.extract_pages(p, SPEC).quarantine


@register("page_article_text")
def page_article_text(spark, sf_dir):
    """D3 on the given crawl with selector ``article p`` (rows-only; unit tests hold hand cases)."""
    p = load(spark, sf_dir, "pages")
    return p.select("page_id", article_text(F.col("html"), "article p").alias("text"))

"""Stored pages -> Document and Recipe rows, plus a quarantine with a reason per page.

One narrow pass: regex for the JSON-LD block and the meta description, ``from_json`` with a
fixed schema (raw control characters allowed, as a lenient JSON reader does), two Arrow UDFs for
article text and entity decoding. The parsed frame feeds the three outputs.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.attributes import attribute
from chatloom.functions.html import article_text, unescape, unescape_all, unescape_map
from chatloom.functions.text import iso_seconds, iso_valid, py_strip

META_SCHEMA = (
    "array<struct<`@type`: array<string>, headline: string, author: array<struct<name: string>>, "
    "aggregateRating: struct<ratingValue: string, ratingCount: string>, review: array<struct<reviewBody: string>>, "
    "recipeIngredient: array<string>, recipeInstructions: array<struct<text: string>>, "
    "nutrition: map<string, string>, recipeCategory: array<string>, recipeCuisine: array<string>, "
    "prepTime: string, totalTime: string, recipeYield: string>>")


@dataclass
class PageSpec:
    script_id: str = "recipe-meta"
    selector: str = "article .text-passage p.comp"
    description: str = "description"
    wrap_days: bool = False


@dataclass
class Extracted:
    parsed: DataFrame
    good: DataFrame
    document: DataFrame
    recipe: DataFrame
    quarantine: DataFrame


def script_tag(script_id: str) -> str:
    own = re.escape(script_id)
    return rf"""(?is)<script\b[^>]*(?<=[\s"'/])id\s*=\s*(?:"{own}"|'{own}'|{own}(?=[\s>/]))[^>]*>"""


def jsonld_block(html: Column, script_id: str) -> Column:
    """Inner text of ``<script id=...>`` (empty when absent)."""
    return F.regexp_extract(html, f"{script_tag(script_id)}(.*?)</script>", 1)


def has_block(html: Column, script_id: str) -> Column:
    return html.rlike(script_tag(script_id))


def jsonld_parse(block: Column) -> Column:
    """First element of the JSON array; raw newlines inside strings are accepted."""
    return F.try_element_at(F.from_json(block, META_SCHEMA, {"allowUnquotedControlChars": "true",
                                                             "mode": "PERMISSIVE"}), F.lit(1))


def meta_description(html: Column, name: str = "description") -> Column:
    """``content`` of ``<meta name=...>`` (attributes in any order), null when absent."""
    tags = F.regexp_extract_all(html, F.lit(r"""(?is)(<meta\s(?:[^>"']|"[^"]*"|'[^']*')*+>)"""), 1)
    return attribute(F.get(F.filter(tags, lambda t: attribute(t, "name") == name), F.lit(0)), "content")


def doc_key(title: Column) -> Column:
    """Deterministic document id from the natural key (the title): 60 bits of md5."""
    return F.conv(F.substring(F.md5(title), 1, 15), 16, 10).cast("long")


#: why ``parse_pages`` rejects a page
PAGE_REASONS = ["no_script", "json", "missing_headline", "missing_author", "bad_number", "bad_duration", "empty_text"]


def parse_pages(pages: DataFrame, spec: PageSpec = PageSpec()) -> DataFrame:
    html = F.col("html")
    # The parsed JSON goes through a generator (one element, outer): its output is computed once
    # per row. As a plain column, every field read below would re-run the regex and the parse.
    parsed = F.from_json(jsonld_block(html, spec.script_id), META_SCHEMA,
                         {"allowUnquotedControlChars": "true", "mode": "PERMISSIVE"})
    p = (pages.select("source", "html", has_block(html, spec.script_id).alias("has_block"),
                      F.posexplode_outer(F.slice(parsed, 1, 1)).alias("_pos", "meta"))
         .select("source", "has_block", "meta",
                 meta_description(html, spec.description).alias("subtitle_raw"),
                 article_text(html, spec.selector).alias("text_raw")))
    m = F.col("meta")
    is_recipe = F.coalesce(F.try_element_at(m["@type"], F.lit(1)) == "Recipe", F.lit(False))
    rating_raw = m["aggregateRating"]["ratingValue"]
    count_raw = m["aggregateRating"]["ratingCount"]
    prep, total = m["prepTime"], m["totalTime"]
    bad_number = ((rating_raw.isNotNull() & F.expr("try_cast(meta.aggregateRating.ratingValue AS double)").isNull())
                  | (count_raw.isNotNull() & F.expr("try_cast(meta.aggregateRating.ratingCount AS bigint)").isNull()))
    bad_duration = (prep.isNotNull() & ~iso_valid(prep)) | (total.isNotNull() & ~iso_valid(total))
    text = py_strip(unescape(F.col("text_raw")))
    reason = (F.when(~F.col("has_block"), "no_script")
              .when(m.isNull(), "json")
              .when(m["headline"].isNull(), "missing_headline")
              .when(F.try_element_at(m["author"], F.lit(1))["name"].isNull(), "missing_author")
              .when(is_recipe & bad_number, "bad_number")
              .when(is_recipe & bad_duration, "bad_duration")
              .when(F.coalesce(text, F.lit("")) == "", "empty_text"))
    return p.select(
        "source", "meta", reason.alias("reason"), is_recipe.alias("is_recipe"),
        unescape(m["headline"]).alias("title"),
        text.alias("text"),
        unescape(F.try_element_at(m["author"], F.lit(1))["name"]).alias("author"),
        unescape(F.col("subtitle_raw")).alias("subtitle"),
    )


def recipe_columns(meta: Column, wrap_days: bool = False) -> list[Column]:
    """Optional fields with their defaults ([] / {} / 0 / null)."""
    empty = F.array().cast("array<string>")
    return [
        F.coalesce(unescape_all(meta["recipeIngredient"]), empty).alias("ingredients"),
        F.coalesce(unescape_all(F.transform(meta["recipeInstructions"], lambda x: x["text"])), empty)
         .alias("directions"),
        F.coalesce(unescape_map(F.map_filter(meta["nutrition"], lambda k, v: k != "@type")),
                   F.create_map().cast("map<string,string>")).alias("nutrition"),
        F.expr("try_cast(meta.aggregateRating.ratingValue AS double)").alias("review_score"),
        F.coalesce(F.expr("try_cast(meta.aggregateRating.ratingCount AS bigint)"), F.lit(0).cast("long"))
         .alias("review_count"),
        F.coalesce(unescape_all(F.transform(meta["review"], lambda x: x["reviewBody"])), empty).alias("reviews"),
        F.coalesce(unescape_all(meta["recipeCategory"]), empty).alias("category"),
        F.coalesce(unescape_all(meta["recipeCuisine"]), empty).alias("cuisine"),
        iso_seconds(meta["prepTime"], wrap_days).alias("prep_time"),
        iso_seconds(meta["totalTime"], wrap_days).alias("total_time"),
        unescape(meta["recipeYield"]).alias("recipe_yield"),
    ]


def extract_pages(pages: DataFrame, spec: PageSpec = PageSpec()) -> Extracted:
    """Split parsed pages into documents, recipes (same key) and a quarantine."""
    return split_parsed(parse_pages(pages, spec), spec)


def split_parsed(parsed: DataFrame, spec: PageSpec = PageSpec()) -> Extracted:
    """The outputs of pages that ``parse_pages`` has read."""
    good = parsed.where(F.col("reason").isNull()).withColumn("id", doc_key(F.col("title")))
    document = good.select("id", "title", "text", "author", "source", "subtitle")
    recipe = good.where("is_recipe").select(F.col("id").alias("document"), *recipe_columns(F.col("meta"),
                                                                                          spec.wrap_days))
    recipe = recipe.withColumn("id", F.col("document"))
    quarantine = parsed.where(F.col("reason").isNotNull()).select("source", "reason")
    return Extracted(parsed, good, document, recipe, quarantine)

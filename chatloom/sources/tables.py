"""Loading the given tables, and the views that put them in the shape of the data model.

The data model has four tables: pages, documents, recipes and training messages (see
``chatloom.schemas``). The driver's tables stand in for them:

* ``documents``  -> Document (title = first line of the text)
* ``part`` + ``lineitem`` -> Recipe (one recipe per part; counts aggregated from line items)
* ``conversations`` + ``labels`` -> Training (one stored message per turn, plus "nothing to
  say" sentinel rows for documents labelled toxic)
* ``pages``      -> Page

Every view is a plain projection, or an aggregate followed by an equi-join; nothing collects a
group into one row.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import recipe_card

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed values of the stand-in stored tables.
TRAINERS = ["evaluator", "summarizer", "recipe"]
BASE_REVISION = "base"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def page_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page: (page_id, url, slug, html, source)."""
    p = load(spark, sf_dir, "pages")
    return p.select("page_id", "url",
                    F.element_at(F.split("url", "/", -1), -1).alias("slug"),
                    "html",
                    F.concat(F.lit("page/"), F.col("page_id").cast("string")).alias("source"))


def document_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document: id, title, text, author, source, subtitle (+ lang)."""
    d = load(spark, sf_dir, "documents")
    first = F.substring_index("text", "\n", 1)
    return d.select(
        F.col("doc_id").alias("id"),
        F.when(first == "", F.concat(F.col("source"), F.lit("-"), F.col("doc_id").cast("string")))
         .otherwise(first).alias("title"),
        "text",
        F.col("source").alias("author"),
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("source"),
        F.lit(None).cast("string").alias("subtitle"),
        "lang",
    )


def recipe_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recipe, one per part. ``review_count`` and the nutrition quantity are aggregated from the
    part's line items (partial aggregation, then one equi-join); list fields come from the part
    row itself, so no group is ever collected into an array."""
    part = load(spark, sf_dir, "part")
    li = (load(spark, sf_dir, "lineitem")
          .groupBy("l_partkey")
          .agg(F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("review_count"),
               F.sum(F.floor("l_quantity").cast("long")).alias("qty")))
    p = part.join(li, part.p_partkey == li.l_partkey, "left")
    k = F.col("p_partkey")
    words = F.split(F.concat_ws(" ", "p_name", F.lower("p_type")), " ")
    ingredients = F.transform(words, lambda w, i: F.concat((F.col("p_size") + i).cast("string"), F.lit(" g of "), w))
    return p.select(
        k.alias("id"),
        k.alias("document"),
        F.col("p_name").alias("title"),
        F.concat(F.col("p_name"), F.lit(" #"), k.cast("string")).alias("unique_title"),
        (F.col("p_size").cast("double") / 10.0).alias("review_score"),
        F.coalesce(F.col("review_count"), F.lit(0)).cast("long").alias("review_count"),
        ingredients.alias("ingredients"),
        F.array(F.concat(F.lit("Mix the "), F.col("p_name"), F.lit(".")),
                F.concat(F.lit("Cook for "), F.col("p_size").cast("string"), F.lit(" minutes.")),
                F.lit("Serve.")).alias("directions"),
        F.when(k % 6 == 0, F.create_map().cast("map<string,string>"))
         .otherwise(F.create_map(F.lit("energy"),
                                 F.concat(F.coalesce(F.col("qty"), F.lit(0)).cast("string"), F.lit(" kcal"))))
         .alias("nutrition"),
        F.array(F.concat(F.lit("Nice "), F.lower("p_type"), F.lit(" dish.")),
                F.concat(F.lit("Made it with "), F.col("p_brand"), F.lit("."))).alias("reviews"),
        F.when(k % 3 == 0, F.array().cast("array<string>"))
         .when(k % 3 == 1, F.array("p_type"))
         .otherwise(F.array("p_type", "p_brand")).alias("category"),
        F.when(k % 4 == 0, F.array().cast("array<string>"))
         .when(k % 4 == 1, F.array("p_brand"))
         .otherwise(F.array(F.col("p_brand"), F.col("p_type"), F.lit("Home"))).alias("cuisine"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(k * 97 % 9000).cast("long").alias("prep_time"),
        F.when(k % 7 == 0, F.lit(None)).otherwise(k * 131 % 90000).cast("long").alias("total_time"),
        F.concat(F.col("p_size").cast("string"), F.lit(" servings")).alias("recipe_yield"),
    )


def recipe_document_view(recipes: DataFrame) -> DataFrame:
    """The Document row behind each recipe (its text is the recipe card)."""
    return recipes.select(
        F.col("document").alias("id"),
        F.col("unique_title").alias("title"),
        recipe_card("unique_title", "ingredients", "directions").alias("text"),
        F.lit("kitchen").alias("author"),
        F.concat(F.lit("part/"), F.col("document").cast("string")).alias("source"),
        F.lit(None).cast("string").alias("subtitle"),
    )


def training_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training: stored messages. Each conversation is attributed to one of three generators by
    its id, all under revision ``base``; labelled-toxic documents carry a sentinel row."""
    c = load(spark, sf_dir, "conversations")
    trainer = F.element_at(F.array(*[F.lit(t) for t in TRAINERS]), (F.pmod("conv_id", F.lit(3)) + 1).cast("int"))
    msgs = c.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("conversation"),
        F.col("turn").cast("int").alias("position"),
        F.col("text").alias("content"),
        F.col("role"),
        trainer.alias("trainer"),
        F.lit(BASE_REVISION).alias("revision"),
        F.col("conv_id").alias("source"),
    )
    lab = load(spark, sf_dir, "labels").where(F.col("toxic") == 1)
    sentinels = lab.select(
        F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("conversation"),
        F.lit(0).alias("position"),
        F.lit("").alias("content"),
        F.lit("none").alias("role"),
        F.lit("summarizer").alias("trainer"),
        F.lit(BASE_REVISION).alias("revision"),
        F.col("doc_id").alias("source"),
    )
    return msgs.unionByName(sentinels)


def recipe_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are recipes (labels.quality = 1): the Recipe.document keys for articles."""
    return load(spark, sf_dir, "labels").where(F.col("quality") == 1).select(F.col("doc_id").alias("document"))

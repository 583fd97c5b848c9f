"""S1 incremental + S8: pick up new page files as they land and extract them, once each.

``availableNow`` processes everything new since the last run and stops, so a scheduled job
resumes where it left off (the stream checkpoint remembers which files were seen). Each micro
batch is one commit of a ``BatchStore``: its documents, recipes, quarantine and title index become visible
together, and a batch that is retried after a failure replaces its own output in all of them.

A title is stored once: of a batch's pages with one title the first source counts; the others, and pages whose
title an earlier batch stored, go to the quarantine. The stored titles are an index in buckets, of which a
batch reads those of its own titles.

How many documents a batch stored, and how many pages it left out for each reason, is counted while they are written
and committed with them (``counts``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.operators.counted import COUNTS, Counted
from chatloom.operators.extract import PAGE_REASONS, PageSpec, parse_pages, split_parsed
from chatloom.schemas import DOCUMENT, RECIPE
from chatloom.session import cut_lineage
from chatloom.sources.commits import BatchStore
from chatloom.sources.store import assert_no_orphans, split_empty
from chatloom.sources.titles import INDEX, first_titles, index_rows

QUARANTINE = "source string, reason string"
#: why a page goes to the quarantine: before it is parsed, by the parser, or by its title
REASONS = ["empty", *PAGE_REASONS, "duplicate_title"]


def page_stream(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    return (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern)
            .load(path)
            .select(F.col("value").alias("html"), F.col("_metadata.file_path").alias("source")))


def open_store(spark: SparkSession, path: str) -> BatchStore:
    """The tables that ``ingest_pages`` writes, as their readers see them."""
    return BatchStore(spark, path, {"document": (DOCUMENT, []), "recipe": (RECIPE, []), "quarantine": (QUARANTINE, []),
                                    "title": (INDEX, ["bucket"]), "counts": (COUNTS, [])})


def ingest_batch(store: BatchStore, pages: DataFrame, batch_id: int | str, spec: PageSpec = PageSpec()) -> None:
    """Pages (html, source) -> one commit of all tables. Sources tell the pages of a batch apart."""
    pages, empty = split_empty(pages)
    parsed = cut_lineage(parse_pages(pages, spec))      # read by several outputs, parsed once
    good = parsed.where("reason IS NULL").select("title", "source")
    first = first_titles(good, store.read("title", without=[batch_id]), ["source"]).select("source", F.lit(True).alias("_first"))
    late = F.when(F.col("reason").isNull() & F.col("_first").isNull(), "duplicate_title").otherwise(F.col("reason"))
    parsed = cut_lineage(parsed.join(first, "source", "left").withColumn("reason", late).drop("_first"))
    ex = split_parsed(parsed, spec)
    assert_no_orphans(ex.recipe, ex.document, "document", "id")
    quarantine = ex.quarantine.unionByName(empty.select("source", F.lit("empty").alias("reason")))
    stored, left = Counted("document", [], F.lit(None).cast("string")), Counted("page", REASONS)
    store.write(batch_id, {"document": stored.watch(ex.document), "recipe": ex.recipe, "quarantine": left.watch(quarantine),
                           "title": index_rows(ex.document),
                           "counts": lambda: stored.frame(store.spark).unionByName(left.frame(store.spark)).where("n > 0")})


def ingest_pages(spark: SparkSession, src: str, out: str, checkpoint: str, spec: PageSpec = PageSpec()):
    """Run one ``availableNow`` pass: documents, recipes, quarantine and title index under ``out``."""
    store = open_store(spark, out)
    q = (page_stream(spark, src).writeStream.foreachBatch(lambda batch, batch_id: ingest_batch(store, batch, batch_id, spec))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q

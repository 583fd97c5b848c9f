"""S1-S9 over the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import generate as G
from chatloom.operators import select as W
from chatloom.plans import sql_gen as S
from chatloom.plans.q_select import pending_recipe_inputs
from chatloom.plans.registry import register
from chatloom.plans.sql_views import with_views
from chatloom.schemas import TRAINING
from chatloom.session import cut_lineage, scratch_path
from chatloom.sources import store as ST
from chatloom.sources import titles as TT
from chatloom.sources.commits import BatchStore
from chatloom.sources.tables import document_view, load, page_view, recipe_view, training_view


@register("scan_pages", with_views("page") + """
SELECT page_id, url, slug, source, CAST(strlen(html) AS BIGINT) AS n_bytes FROM page""")
def scan_pages(spark, sf_dir):
    p = page_view(spark, sf_dir)
    return p.select("page_id", "url", "slug", "source", F.octet_length("html").cast("long").alias("n_bytes"))


@register("empty_pages", """
SELECT page_id, CASE WHEN html IS NULL OR length(html) = 0 THEN 'empty' ELSE 'ok' END AS status FROM pages""")
def empty_pages(spark, sf_dir):
    p = load(spark, sf_dir, "pages")
    kept, empty = ST.split_empty(p)
    return (kept.select("page_id", F.lit("ok").alias("status"))
            .unionByName(empty.select("page_id", F.lit("empty").alias("status"))))


@register("new_pages", with_views("page") + """
SELECT page_id, url FROM page WHERE source NOT IN (SELECT 'page/' || CAST(doc_id AS VARCHAR) FROM labels)""")
def new_pages(spark, sf_dir):
    """S3: the index log is ``labels`` (one row per page already indexed)."""
    indexed = load(spark, sf_dir, "labels").select(F.concat(F.lit("page/"), F.col("doc_id").cast("string")).alias("source"))
    return ST.new_pages(page_view(spark, sf_dir), indexed).select("page_id", "url")


@register("dedupe_title", with_views("document") + """
SELECT arg_min(id, source) AS id, title FROM document
WHERE title NOT IN (SELECT d.title FROM document d JOIN labels l ON l.doc_id = d.id)
GROUP BY title""")
def dedupe_title(spark, sf_dir):
    """First document per title by source, minus titles already stored (labelled documents)."""
    docs = document_view(spark, sf_dir)
    stored = docs.join(load(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")), "id")
    firsts = ST.first_by(docs.select("id", "title", "source"), "title", ["source"])
    return ST.not_stored(firsts, stored, "title").select("id", "title")


@register("orphans", with_views("recipe", "document", "training") + """
SELECT 'recipe.document' AS relation, document AS child_key FROM recipe
  WHERE document NOT IN (SELECT id FROM document)
UNION ALL
SELECT 'training.source', source FROM training WHERE source NOT IN (SELECT id FROM document)""")
def orphans(spark, sf_dir):
    docs = document_view(spark, sf_dir)
    r = ST.orphans(recipe_view(spark, sf_dir), docs, "document", "id")
    t = ST.orphans(training_view(spark, sf_dir), docs, "source", "id")
    return (r.select(F.lit("recipe.document").alias("relation"), F.col("document").alias("child_key"))
            .unionByName(t.select(F.lit("training.source").alias("relation"), F.col("source").alias("child_key"))))


@register("insert_rows", with_views("document") + """
SELECT id AS doc_id, CAST(('0x' || substr(md5(title), 1, 15)) AS BIGINT) AS id, title FROM document""")
def insert_rows(spark, sf_dir):
    """Deterministic keys from the natural key (title): copies of one title share a key."""
    docs = document_view(spark, sf_dir).select(F.col("id").alias("doc_id"), "title")
    return ST.with_key(docs, "title").select("doc_id", "id", "title")


@register("select_rows", with_views("document") + """
SELECT id, title FROM document WHERE lang = 'en' AND strlen(text) > 1000""")
def select_rows(spark, sf_dir):
    """A parametrised select over a DataFrame."""
    return ST.select(spark, "SELECT id, title FROM {docs} WHERE lang = :lang AND octet_length(text) > :n",
                     args={"lang": "en", "n": 1000}, docs=document_view(spark, sf_dir))


_EV_COUNT = S.with_ctes(S.base_ctes(("ev_in", S.pending_recipes_view("evaluator")), *S.evaluator_ctes("ev_in"),
                                    ("ev_msgs", S.evaluator_messages()),
                                    ("ev_rows", S.explode_sql("ev_msgs", "evaluator", "base", "document"))))


@register("commit_batch", _EV_COUNT + """
SELECT trainer, count(*) AS n_rows, count(DISTINCT conversation) AS n_conversations FROM ev_rows GROUP BY trainer""")
def commit_batch(spark, sf_dir):
    """The same batch written twice (a retried task or run) is stored once."""
    rows = G.evaluator(pending_recipe_inputs(spark, sf_dir, "evaluator"))
    path = scratch_path(spark, "batches")
    ST.commit_batch(rows, path, 7, partition_by=["trainer"])
    ST.commit_batch(rows, path, 7, partition_by=["trainer"])
    stored = spark.read.parquet(path)
    return stored.groupBy("trainer").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.countDistinct("conversation").alias("n_conversations"))


@register("table_layout", with_views("training") + """
SELECT conversation, position, content, role, source FROM training WHERE revision = 'base' AND trainer = 'evaluator'""")
def table_layout(spark, sf_dir):
    """Write the training table in its layout, read one (revision, trainer) back (partition-pruned)."""
    path = scratch_path(spark, "training")
    ST.write_training(training_view(spark, sf_dir), path, mode="overwrite")
    back = ST.read_training(spark, path, revision="base", trainer="evaluator")
    return back.select("conversation", "position", "content", "role", "source")


_BATCHES = """
WITH docs AS (SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE substr(split_part(text, chr(10), 1), 1, 200) END AS title,
                     doc_id % 3 AS batch, 'd/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS source FROM documents),
first AS (SELECT title, min(concat(batch, ' ', source)) AS pick FROM docs WHERE title IS NOT NULL GROUP BY title)
"""


def _titled(spark, sf_dir):
    """Documents in three batches; the title is the first line of the text."""
    line = F.substring(F.element_at(F.split("text", "\n"), 1), 1, 200)
    return load(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("id"), line.alias("title"), (F.col("doc_id") % 3).alias("batch"),
        F.concat(F.lit("d/"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("source"))


def _title_store(spark):
    return BatchStore(spark, scratch_path(spark, "titles"), {"document": ("id long, title string, source string", []), "title": (TT.INDEX, ["bucket"])})


def _store_titles(store, docs, batch):
    fresh = cut_lineage(TT.first_titles(docs.where(F.col("batch") == batch), store.read("title", without=[batch]), ["source"]))
    store.write(batch, {"document": fresh, "title": TT.index_rows(fresh)})


@register("unique_titles", _BATCHES + """
SELECT doc_id AS id, title, source FROM docs JOIN first USING (title) WHERE pick = concat(batch, ' ', source)""")
def unique_titles(spark, sf_dir):
    """S4 against a growing store: three batches, each against the index of those before; the second comes twice."""
    store, docs = _title_store(spark), _titled(spark, sf_dir)
    for batch in (0, 1, 1, 2):
        _store_titles(store, docs, batch)
    return store.read("document")


@register("commit_tables", _EV_COUNT + """
SELECT 'training' AS tab, count(*) AS n_rows FROM ev_rows
UNION ALL SELECT 'attempts', count(*) FROM ev_in""")
def commit_tables(spark, sf_dir):
    """Two tables, one commit. An attempt that dies between them shows nothing; a retry replaces what its batch wrote before."""
    pending = pending_recipe_inputs(spark, sf_dir, "evaluator")
    stage = W.settle_stage(pending, G.evaluator(pending), "evaluator", "base", "document")
    store = BatchStore(spark, scratch_path(spark, "commits"), {"training": (TRAINING, ["revision", "trainer"]), "attempts": (W.ATTEMPTS, ["trainer"])})
    rows = stage.rows.where("role <> 'none'")
    store.stage({"training": rows})                                        # no marker: a crash before the second table
    other = stage.attempts.withColumn("trainer", F.lit("other"))
    store.write("run-1", {"training": rows, "attempts": stage.attempts.unionByName(other)})
    store.write("run-1", {"training": rows, "attempts": stage.attempts})   # a retry with fewer partitions
    count = lambda name: store.read(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("tab"), "n_rows")
    return count("training").unionByName(count("attempts"))

"""Which inputs still need work for a (generator, revision), and running the stages.

Done-ness is an anti-join against the stored training rows of that generator and revision
(the filter on the training side is applied before the join, so partition pruning on
(revision, trainer) reaches the scan when the table is stored partitioned).
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.schemas import TRAINING_COLUMNS, md5_key
from chatloom.session import cut_lineage
from chatloom.sources.done_index import DoneIndex


def done_sources(training: DataFrame, trainer: str, revision: str, as_col: str) -> DataFrame:
    return (training.where((F.col("trainer") == trainer) & (F.col("revision") == revision))
            .select(F.col("source").alias(as_col)))


def not_done(inputs: DataFrame, training: DataFrame | DoneIndex, trainer: str, revision: str, key: str) -> DataFrame:
    """Inputs without a training row of (trainer, revision), by the rows themselves or by the bucketed index of a store."""
    if isinstance(training, DoneIndex):
        return training.pending(inputs, revision, trainer, key)
    return inputs.join(done_sources(training, trainer, revision, key), key, "left_anti")


def pending_recipes(recipes: DataFrame, documents: DataFrame, training: DataFrame | DoneIndex, trainer: str,
                    revision: str) -> DataFrame:
    """Recipes joined with their document, without any training row of (trainer, revision).
    The recipe id comes out as ``reid``; document columns keep their names."""
    docs = documents.select(F.col("id").alias("document"), "title", "text", "author",
                            F.col("source").alias("doc_source"), "subtitle")
    r = recipes.drop("title", "unique_title").withColumnRenamed("id", "reid")
    return not_done(r.join(docs, "document"), training, trainer, revision, "document")


def pending_articles(documents: DataFrame, recipe_documents: DataFrame, training: DataFrame | DoneIndex, trainer: str,
                     revision: str, min_bytes: int | None = 8000) -> DataFrame:
    """Documents that are not recipes, not done, and longer than ``min_bytes`` UTF-8 bytes."""
    d = documents
    if min_bytes is not None:
        d = d.where(F.octet_length("text") > min_bytes)
    articles = d.join(recipe_documents.select(F.col("document").alias("id")), "id", "left_anti")
    return not_done(articles, training, trainer, revision, "id")


def pending_counts(**pending: DataFrame) -> DataFrame:
    """One row per generator with the number of pending inputs."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_pending")).select(F.lit(name).alias("trainer"), "n_pending")
             for name, df in pending.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quick_sample(df: DataFrame, n: int = 50, seed: int = 0, key: str | None = None) -> DataFrame:
    """``n`` pending inputs at random. With ``key`` the choice is reproducible (order by a
    seeded hash of the key); either way Spark plans a top-k (TakeOrderedAndProject), not a sort."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))) if key else F.rand(seed)
    return df.orderBy(order).limit(n)


def sentinels(inputs: DataFrame, outputs: DataFrame, failed: DataFrame | None, trainer: str, revision: str,
              key: str = "source") -> DataFrame:
    """A ``none`` row for each input that succeeded and produced nothing. Failed inputs get
    no row, so the next run picks them up again."""
    ids = inputs.select(F.col(key).alias("source"))
    empty = ids.join(outputs.select("source"), "source", "left_anti")
    if failed is not None:
        empty = empty.join(failed.select(F.col(key).alias("source")), "source", "left_anti")
    return sentinel_rows(empty, trainer, revision)


def sentinel_rows(ids: DataFrame, trainer: str, revision: str) -> DataFrame:
    """The ``none`` row of each ``source``."""
    return ids.select(md5_key(F.lit(trainer), F.lit(revision), F.col("source"), F.lit("none")).alias("conversation"),
                      F.lit(0).alias("position"), F.lit("").alias("content"), F.lit("none").alias("role"),
                      F.lit(trainer).alias("trainer"), F.lit(revision).alias("revision"),
                      F.col("source").cast("long").alias("source")).select(*TRAINING_COLUMNS)


#: one row per input that a run tried: outcome is ``rows``, ``empty`` (a sentinel) or ``failed``
ATTEMPTS = "trainer string, revision string, source long, run string, outcome string, error string"


@dataclass(frozen=True)
class Stage:
    """What one run of a generator leaves: training rows (sentinels included) and its attempts."""
    rows: DataFrame
    attempts: DataFrame


def settle_stage(inputs: DataFrame, produced: DataFrame, trainer: str, revision: str, key: str, run: str = "0",
                 failed: DataFrame | None = None) -> Stage:
    """Splits the inputs into those with rows, those without any (they get a sentinel) and failed ones.

    An input fails whole: if any of its rows has an ``error`` (a column that generators add with
    ``errors=True``) or no content (an unanswered message), or if ``failed`` names it, none of its rows is
    kept and it gets no sentinel, so it stays pending. Its first error (in text order) goes to the attempts.

    The generator's rows are written once (reliable checkpoint): rows, sentinels and attempts read them, so
    the model rounds never run twice."""
    produced = cut_lineage(produced)
    error = F.col("error") if "error" in produced.columns else F.lit(None).cast("string")
    lost = (produced.select("source", F.coalesce(error, F.when(F.col("content").isNull(), "no_answer")).alias("error"))
            .where(F.col("error").isNotNull()))
    if failed is not None:
        lost = lost.unionByName(failed.select(F.col(key).cast("long").alias("source"), F.lit("failed").alias("error")))
    lost = cut_lineage(lost.groupBy("source").agg(F.min("error").alias("error")))
    # an input that failed may have whole conversations too: all or nothing
    whole = produced.where("content IS NOT NULL").join(lost, "source", "left_anti").select(*TRAINING_COLUMNS)
    found = whole.select("source").distinct().withColumn("_rows", F.lit(True))
    judged = cut_lineage(inputs.select(F.col(key).cast("long").alias("source")).distinct().join(found, "source", "left").join(lost, "source", "left"))
    outcome = F.when(F.col("error").isNotNull(), "failed").when(F.col("_rows"), "rows").otherwise("empty")
    attempts = judged.select(F.lit(trainer).alias("trainer"), F.lit(revision).alias("revision"), "source", F.lit(run).alias("run"),
                             outcome.alias("outcome"), "error")
    return Stage(whole.unionByName(sentinel_rows(judged.where("error IS NULL AND _rows IS NULL"), trainer, revision)), attempts)


def stage_output(inputs: DataFrame, produced: DataFrame, trainer: str, revision: str, key: str,
                 failed: DataFrame | None = None) -> DataFrame:
    """Generator rows plus the sentinels of the inputs that produced nothing (see ``settle_stage``)."""
    return settle_stage(inputs, produced, trainer, revision, key, failed=failed).rows


def failures(attempts: DataFrame, trainer: str, revision: str) -> DataFrame:
    """(source, n_failed, last_error) of the inputs that have failed in any run of a generator and revision."""
    own = attempts.where((F.col("trainer") == trainer) & (F.col("revision") == revision) & (F.col("outcome") == "failed"))
    return own.groupBy("source").agg(F.count(F.lit(1)).alias("n_failed"), F.max_by("error", "run").alias("last_error"))


def within_attempts(pending: DataFrame, attempts: DataFrame, trainer: str, revision: str, key: str, most: int) -> DataFrame:
    """Pending inputs that have failed fewer than ``most`` times: the others wait for someone to look at them."""
    spent = failures(attempts, trainer, revision).where(F.col("n_failed") >= most).select(F.col("source").alias(key))
    return pending.join(spent, key, "left_anti")


def run_stages(stages: list[tuple[str, DataFrame, Callable, str]], revision: str, model=None, run: str = "0",
               commit: Callable[[str, Stage], None] | None = None) -> DataFrame:
    """Run generators in order, each over its own pending set; union their outputs.

    ``stages`` holds (trainer, pending inputs, generator function, input key column); ``model`` is passed to the
    generators if given. ``commit(trainer, stage)`` is called as soon as a stage is done, before the next
    one starts, so what a later stage loses is not lost for an earlier one. A failing input neither
    stops its stage nor leaves rows or a sentinel (see ``settle_stage``).
    """
    out = None
    for trainer, pending, gen, key in stages:
        how = {"trainer": trainer, "revision": revision} | ({} if model is None else {"model": model, "errors": True})
        stage = settle_stage(pending, gen(pending, **how), trainer, revision, key, run)
        if commit is not None:
            commit(trainer, stage)
        out = stage.rows if out is None else out.unionByName(stage.rows)
    return out


def stage_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("trainer").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("conversation").alias("n_conversations"),
        F.count(F.when(F.col("role") == "none", 1)).alias("n_sentinels"))


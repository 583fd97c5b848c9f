"""Counts taken while the rest is written, against counts of what was written and left out."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatloom.operators import generate as G
from chatloom.operators.counted import COUNTS, Counted
from chatloom.session import scratch_path
from chatloom.sources.commits import BatchStore
from chatloom.streaming.ingest import ingest_batch, open_store

ANSWERS = [(1, "1. What is it?\n2. Who is her cook?\nno number\n- Why?"), (2, ""), (3, None), (4, "\n\n3 Is it hot?")]


def counts(store):
    return {(r["what"], r["reason"]): r["n"] for r in store.read("counts").collect()}


def judged(spark):
    return G.question_lines(spark.createDataFrame(ANSWERS, "source long, answer string"), banned=["her"])


def test_kept_lines_are_the_parsed_questions(spark):
    answers = spark.createDataFrame(ANSWERS, "source long, answer string")
    kept = judged(spark).where("reason IS NULL").drop("reason")
    assert kept.columns == ["source", "ordinal", "question"]
    assert kept.exceptAll(G.parse_questions(answers, banned=["her"])).isEmpty() and kept.count() == 3
    with pytest.raises(Exception, match="unnumbered question line: no number"):
        G.parse_questions(answers, banned=["her"], strict=True).collect()


def test_counts_of_one_write(spark):
    store = BatchStore(spark, scratch_path(spark, "counted"), {"question": ("source long, ordinal int, question string", []), "counts": (COUNTS, [])})
    for attempt in (judged(spark), judged(spark).where("source = 1"), judged(spark)):      # the batch is written three times
        lines = Counted("line", G.LINE_REASONS)
        store.write(0, {"question": lines.watch(attempt).where("reason IS NULL"), "counts": lambda: lines.frame(spark)})
    want = Counter(r["reason"] or "kept" for r in judged(spark).collect())
    assert counts(store) == {("line", k): want.get(k, 0) for k in ("banned_word", "no_prefix", "other", "kept")}
    assert want["kept"] == store.read("question").count() and want["banned_word"] == 1


def test_an_empty_frame_and_an_unnamed_reason(spark):
    store = BatchStore(spark, scratch_path(spark, "counted"), {"t": ("id long", []), "counts": (COUNTS, [])})
    none = Counted("row", ["odd"], F.lit(None).cast("string"))
    store.write("none", {"t": none.watch(spark.range(0)), "counts": lambda: none.frame(spark)})
    assert counts(store) == {("row", "odd"): 0, ("row", "other"): 0, ("row", "kept"): 0}
    some = Counted("row", ["odd"], F.when(F.col("id") % 2 == 1, "odd").when(F.col("id") == 4, "four"))
    store.write("none", {"t": some.watch(spark.range(7)).where("id < 6"), "counts": lambda: some.frame(spark)})
    assert counts(store) == {("row", "odd"): 3, ("row", "other"): 1, ("row", "kept"): 3}


def test_ingest_counts_what_it_leaves_out(spark):
    store = open_store(spark, scratch_path(spark, "ingest"))
    ingest_batch(store, spark.createDataFrame([("", "a"), (None, "b"), ("<p>none</p>", "c")], "html string, source string"), 0)
    assert counts(store) == {("page", "empty"): 2, ("page", "no_script"): 1}
    left = Counter(r["reason"] for r in store.read("quarantine").collect())
    assert left == {"empty": 2, "no_script": 1}

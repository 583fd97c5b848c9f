"""Batches of several tables, the bucketed title index, and ingest through both."""
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from chatloom.sources import titles as TT
from chatloom.sources.commits import BatchStore
from chatloom.streaming import ingest

TABLES = {"a": ("k string, v long", ["k"]), "b": ("v long", [])}


@pytest.fixture
def store(spark, tmp_path):
    return BatchStore(spark, str(tmp_path / "store"), TABLES)


def frame(spark, keys, n=3):
    return spark.range(n).crossJoin(spark.createDataFrame([(k,) for k in keys], "k string")).select("k", F.col("id").alias("v"))


def seen(store):
    return sorted((r.k, r.v) for r in store.read("a").collect()), sorted(r.v for r in store.read("b").collect())


def test_a_crash_between_two_tables_shows_nothing(spark, store, monkeypatch):
    assert seen(store) == ([], [])
    store.write(0, {"a": frame(spark, "x", 1), "b": spark.range(1).toDF("v")})
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("v"))
    with pytest.raises(Exception, match="lost"):
        store.write(1, {"a": frame(spark, "y"), "b": broken})              # table a is written, table b fails
    assert seen(store) == ([("x", 0)], [0])
    monkeypatch.setattr(store, "_publish", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        store.write(1, {"a": frame(spark, "y"), "b": spark.range(2).toDF("v")})
    assert seen(store) == ([("x", 0)], [0])
    monkeypatch.undo()
    store.write(1, {"a": frame(spark, "y", 1), "b": spark.range(2).toDF("v")})
    assert seen(store) == ([("x", 0), ("y", 0)], [0, 0, 1])


def test_a_retry_with_fewer_partitions_leaves_nothing(spark, store):
    store.write("run", {"a": frame(spark, "xyz"), "b": spark.range(9).toDF("v")})
    store.write("run", {"a": frame(spark, "x", 1)})
    assert seen(store) == ([("x", 0)], [])
    assert len(store.unused()) == 2 and store.vacuum(3600) == 0 and store.vacuum(0) == 2 and store.unused() == []
    assert seen(store) == ([("x", 0)], [])


def test_compaction_and_reading_without_a_batch(spark, store):
    for batch in range(12):                                                # 10 sorts before 2 as text
        store.write(batch, {"a": frame(spark, "xy", 1), "b": spark.range(1).select((F.col("id") + batch).alias("v"))})
    store.write(3, {"b": spark.range(1).select(F.lit(33).cast("long").alias("v"))})
    want = seen(store)
    assert len(want[0]) == 22 and 33 in want[1] and 3 not in want[1] and 10 in want[1]
    assert 10 not in {r.v for r in store.read("b", without=[10]).collect()}
    store.compact("merged")
    assert list(store.commits()) == ["merged"] and seen(store) == want
    store.write(12, {"b": spark.range(1).toDF("v")})
    assert len(seen(store)[1]) == len(want[1]) + 1
    # what a compaction replaced may be written again
    with pytest.raises(ValueError):
        store.write("no/slash", {})
    with pytest.raises(ValueError, match="unknown"):
        store.write(1, {"c": spark.range(1)})


def test_partition_filters_prune_and_types_are_those_of_the_schema(spark, store):
    store.write(0, {"a": frame(spark, ["1", "2", "03"])})
    df = store.read("a").where("k = '03'")
    assert df.schema["k"].dataType.simpleString() == "string" and df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert "= 03" in found, plan


def titles(spark, rows):
    return spark.createDataFrame(rows, "id long, title string, source string")


def test_titles_of_two_batches(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "t"), {"doc": ("id long, title string, source string", []), "title": (TT.INDEX, ["bucket"])})

    def add(batch, rows):
        fresh = TT.first_titles(titles(spark, rows), store.read("title", without=[batch]), ["source"]).cache()
        store.write(batch, {"doc": fresh, "title": TT.index_rows(fresh)})
        return sorted((r.title, r.source) for r in fresh.collect())

    first = [(1, "A", "s2"), (2, "A", "s1"), (3, "B", "s9"), (4, None, "s3"), (5, "", "s4"), (6, "", "s5")]
    assert add(0, first) == [("", "s4"), ("A", "s1"), ("B", "s9")]
    assert add(1, [(7, "A", "s0"), (8, "C", "s0"), (9, "a", "s7")]) == [("C", "s0"), ("a", "s7")]
    assert add(1, [(7, "A", "s0"), (8, "C", "s0"), (9, "a", "s7")]) == [("C", "s0"), ("a", "s7")]      # a retry meets its own titles
    assert add(2, []) == []
    assert store.read("doc").count() == 5
    hot = [(i, "A", f"z{i}") for i in range(50)] + [(99, "D" * 5000, f"y{i}") for i in range(50)]
    assert add(3, hot) == [("D" * 5000, "y0")]


def test_the_index_is_read_in_part(spark, tmp_path):
    store = BatchStore(spark, str(tmp_path / "t"), {"title": (TT.INDEX, ["bucket"])})
    many = spark.range(500).select("id", F.concat(F.lit("t"), F.col("id")).alias("title"), F.lit("s").alias("source"))
    store.write(0, {"title": TT.index_rows(many)})
    index = store.read("title")
    own = [r.b for r in many.where("id < 3").select(TT.bucket_of(TT.title_key(F.col("title"))).alias("b")).collect()]
    part = TT.bucket_part(index, own)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1], plan
    files = {f for r in part.select(F.input_file_name().alias("f")).distinct().collect() for f in [r.f]}
    assert {int(re.search(r"bucket=(\d+)", f)[1]) for f in files} == set(own) and 0 < part.count() < index.count()
    fresh = TT.first_titles(many.where("id < 3").unionByName(titles(spark, [(900, "new", "s")])), index, ["source"])
    assert [r.title for r in fresh.collect()] == ["new"]
    whole = fresh._jdf.queryExecution().executedPlan().toString()
    assert any("bucket" in f for f in re.findall(r"PartitionFilters: \[([^\]]*)\]", whole))


PAGE = ('<script id="recipe-meta">[{{"@type": ["Recipe"], "headline": "{0}", "author": [{{"name": "A"}}]}}]</script>'
        '<article><div class="text-passage"><p class="comp">{1}</p></div></article>')


def test_an_ingest_that_dies_is_done_again_whole(spark, monkeypatch):
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("pages-", "out-", "ck-"))
    for name, title in (("a", "Same"), ("b", "Same"), ("c", "Other"), ("d", "")):
        with open(os.path.join(src, f"{name}.html"), "w") as f:
            f.write(PAGE.format(title, name))
    store = ingest.open_store(spark, out)
    real = BatchStore.write

    def dies(self, batch, frames, replaces=()):
        self.stage({"document": frames["document"]})
        raise OSError("between two tables")

    monkeypatch.setattr(BatchStore, "write", dies)
    with pytest.raises(Exception, match="between two tables"):
        ingest.ingest_pages(spark, src, out, ck)
    assert all(store.read(t).count() == 0 for t in store.tables)
    monkeypatch.setattr(BatchStore, "write", real)
    ingest.ingest_pages(spark, src, out, ck)
    assert sorted(r.title for r in store.read("document").collect()) == ["", "Other", "Same"]
    assert store.read("recipe").count() == store.read("title").count() == 3
    assert [(os.path.basename(r.source), r.reason) for r in store.read("quarantine").collect()] == [("b.html", "duplicate_title")]


def test_an_orphan_batch_is_refused(spark, tmp_path, monkeypatch):
    store = ingest.open_store(spark, str(tmp_path / "o"))
    pages = spark.createDataFrame([(PAGE.format("T", "x"), "s1")], "html string, source string")
    real = ingest.split_parsed

    def orphaned(parsed, spec):
        ex = real(parsed, spec)
        return type(ex)(ex.parsed, ex.good, ex.document.limit(0), ex.recipe, ex.quarantine)

    monkeypatch.setattr(ingest, "split_parsed", orphaned)
    with pytest.raises(ValueError, match="missing id"):
        ingest.ingest_batch(store, pages, 0)
    assert store.read("recipe").count() == 0 and store.commits() == {}

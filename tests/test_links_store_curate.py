import os
import random
import re
import tempfile

from pyspark.sql import functions as F

from chatloom.operators import curate as B
from chatloom.operators import links as L
from chatloom.plans.q_links import co_purchase_edges
from chatloom.sources import store as ST
from chatloom.sources.tables import training_view

from conftest import SF, rows


def test_class_token_and_external(spark):
    html = ('<a class="card" href="https://s.example/a">1</a><a class="big card" href="https://s.example/b">2</a>'
            '<a class="cardigan" href="https://s.example/c">3</a><a class="card" href="https://other.example/d">4</a>')
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    links = L.extract_links(df, css_class="card")
    assert [r["href"] for r in rows(links.orderBy("ordinal"))] == [
        "https://s.example/a", "https://s.example/b", "https://other.example/d"]
    single = spark.createDataFrame([(2, "<a href='/x' class='card'>q</a><A HREF=\"/y\">r</A>")], "page_id long, html string")
    assert [r["href"] for r in rows(L.extract_links(single).orderBy("ordinal"))] == ["/x", "/y"]
    assert [r["href"] for r in rows(L.extract_links(single, css_class="card"))] == ["/x"]
    flagged = L.internal_links(links.withColumnRenamed("href", "url"), F.lit("https://s.example"))
    assert {r["host"] for r in rows(flagged.where("NOT internal"))} == {"other.example"}


def test_search_stop_rule(spark):
    res = spark.createDataFrame([("t", 0, 3), ("t", 24, 1), ("t", 48, 0), ("t", 72, 0)],
                                "term string, offset long, links long")
    lit = sorted(r["offset"] for r in L.until_exhausted(res, min_links=2).collect())
    intended = sorted(r["offset"] for r in L.until_exhausted(res, min_links=1).collect())
    assert lit == [0, 24] and intended == [0, 24, 48]


def test_reachable_matches_bfs(spark):
    edges = co_purchase_edges(spark, SF)
    e = [(r["src"], r["dst"]) for r in edges.collect()]
    seed = min(s for s, _ in e)
    seen, frontier, depth = {seed: 0}, {seed}, 0
    while frontier:
        depth += 1
        nxt = {d for s, d in e if s in frontier} - set(seen)
        for n in nxt:
            seen[n] = depth
        frontier = nxt
    got = {r["node"]: r["depth"] for r in L.reachable(edges, spark.createDataFrame([(seed,)], "node long"),
                                                      checkpoint_every=2).collect()}
    assert got == seen


def test_first_by_and_commit_batch(spark):
    df = spark.createDataFrame([("t", "b", 2), ("t", "a", 1), ("u", "c", 3)], "title string, source string, id long")
    got = {r["title"]: r["id"] for r in ST.first_by(df, "title", ["source"]).collect()}
    assert got == {"t": 1, "u": 3}
    path = tempfile.mkdtemp(prefix="batch-")
    ST.commit_batch(df, path, 1)
    ST.commit_batch(df, path, 1)
    ST.commit_batch(df.limit(1), path, 2)
    assert spark.read.parquet(path).count() == 4


def test_training_layout_prunes_partitions(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="layout-"), "training")
    ST.write_training(training_view(spark, SF), path, mode="overwrite")
    back = ST.read_training(spark, path, revision="base", trainer="evaluator")
    plan = back._jdf.queryExecution().executedPlan().toString()
    pruned = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert re.search(r"\(revision#\d+ = base\)", pruned) and re.search(r"\(trainer#\d+ = ", pruned), plan      # Spark cuts long lists short
    assert back.count() == training_view(spark, SF).where("trainer = 'evaluator'").count()


def test_near_duplicates_against_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away into the green hills at dawn"
    texts = [base, base + " today", base.replace("lazy", "sleepy"),
             "completely different words make up this other sentence about baking bread at home slowly",
             base, "tiny"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["keep_id"] for r in B.near_duplicates(df, threshold=0.7, n=3).collect()}

    def sh(t, n=3):
        w = t.lower().split()
        return {" ".join(w[i:i + n]) for i in range(max(len(w) - n, 0) + 1)}
    for i, t in enumerate(texts):
        k = got[i]
        if k != i:
            a, b = sh(t), sh(texts[k])
            assert len(a & b) / len(a | b) >= 0.7 and k < i
    assert got[4] == 0 and got[1] == 0 and got[3] == 3 and got[5] == 5


def test_near_duplicates_leave_no_like_pair_of_a_drift_chain(spark):
    # each like the next (0.886), the ends unlike: in one component of band hits, few are like its least id
    chain = [f"w{i}" for i in range(70)]
    texts = []
    for step in range(12):
        texts.append(" ".join(chain))
        chain = chain[4:] + [f"s{step}x{i}" for i in range(4)]
    texts += ["other words " + " ".join(f"z{i}" for i in range(40))] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[0])], "id long, text string")
    docs = df.where("id IS NOT NULL")
    keep = {r["id"]: r["keep_id"] for r in B.near_duplicates(df).where("id IS NOT NULL").collect()}
    sets = {r["id"]: set(r["s"]) for r in B.shingles(docs).groupBy("id").agg(F.collect_set("shingle").alias("s")).collect()}
    buckets = {r["id"]: {tuple(b) for b in r["s"]} for r in B.minhash_bands(B.shingles(docs)).groupBy("id").agg(
        F.collect_set(F.struct("band", "bucket")).alias("s")).collect()}

    def like(a, b):
        return len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8 and bool(buckets[a] & buckets[b])

    kept = sorted(i for i, k in keep.items() if i == k)
    assert not [(a, b) for a in kept for b in kept if a < b and like(a, b)]
    reach = {i: {i} for i in keep}                       # what like pairs connect
    for _ in keep:
        reach = {i: r | {b for a in r for b in keep if like(a, b)} for i, r in reach.items()}
    assert all(keep[i] in reach[i] and keep[i] <= i for i in keep)
    assert keep[13] == keep[14] == 12 and 1 < len(kept) < 12


def test_stream_ingest_once(spark):
    from chatloom.streaming.ingest import ingest_pages, open_store
    src = tempfile.mkdtemp(prefix="pages-")
    meta = '[{"@type": ["Article"], "headline": "H%d", "author": [{"name": "A"}]}]'
    for i in range(3):
        with open(os.path.join(src, f"p{i}.html"), "w") as f:
            f.write(f'<script id="recipe-meta">{meta % i}</script><article><div class="text-passage">'
                    f'<p class="comp">text {i}</p></div></article>')
    out = tempfile.mkdtemp(prefix="out-")
    ck = tempfile.mkdtemp(prefix="ck-")
    ingest_pages(spark, src, out, ck)
    ingest_pages(spark, src, out, ck)  # nothing new: no duplicates
    assert open_store(spark, out).read("document").count() == 3


def test_ingest_stores_a_title_once(spark):
    from chatloom.streaming.ingest import ingest_pages, open_store
    src, out, ck = (tempfile.mkdtemp(prefix=p) for p in ("pages-", "out-", "ck-"))

    def page(name, title):
        with open(os.path.join(src, name), "w") as f:
            f.write(f'<script id="recipe-meta">[{{"@type": ["Article"], "headline": "{title}", "author": [{{"name": "A"}}]}}]'
                    f'</script><article><div class="text-passage"><p class="comp">{name}</p></div></article>')

    for i in range(3):
        page(f"a{i}.html", "Same")
    ingest_pages(spark, src, out, ck)
    page("b.html", "Same")
    page("c.html", "Other")
    ingest_pages(spark, src, out, ck)
    docs = sorted((r.title, os.path.basename(r.source)) for r in open_store(spark, out).read("document").collect())
    assert docs == [("Other", "c.html"), ("Same", "a0.html")]
    left = sorted((os.path.basename(r.source), r.reason) for r in open_store(spark, out).read("quarantine").collect())
    assert left == [(n, "duplicate_title") for n in ("a1.html", "a2.html", "b.html")]


def test_near_duplicates_awkward_rows(spark):
    schema = "id long, text string"
    assert B.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    words = " ".join(f"w{i}" for i in range(30))
    rows_ = [(1, None), (2, ""), (3, " ?! "), (4, "Two words"), (5, "two, words"), (6, words), (6, words + " more"), (7, words), (None, words)]
    got = sorted(((r["id"], r["keep_id"]) for r in B.near_duplicates(spark.createDataFrame(rows_, schema)).collect()), key=str)
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (6, 6), (7, 6), (None, None)]


def test_minhash_is_the_stated_arithmetic(spark):
    import zlib
    sh = spark.createDataFrame([(1, "a b c d e"), (1, "b c d e ü"), (2, "x")], "id long, shingle string")
    got = {(r["id"], r["band"]): r["bucket"] for r in B.minhash_bands(sh, bands=2, rows=2).collect()}
    for i, grams in ((1, ["a b c d e", "b c d e ü"]), (2, ["x"])):
        h = [min((a * zlib.crc32(g.encode()) + b) % B.PRIME for g in grams) for a, b in map(B.seeded, range(4))]
        want = spark.range(1).select(*[F.xxhash64(F.lit(h[2 * j]).cast("long"), F.lit(h[2 * j + 1]).cast("long")) for j in range(2)]).first()
        assert [got[(i, j)] for j in range(2)] == list(want)


def test_sets_are_read_for_pairs_that_may_be_alike_only(spark, monkeypatch):
    # all share half of their words in one run: many meet in buckets, none is like another but for two copies
    shared = " ".join(f"w{i}" for i in range(80))
    texts = [shared + " " + " ".join(f"d{i}x{j}" for j in range(60)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts + [texts[3] + " more", texts[9]])), "id long, text string")
    asked, real = [], B.alike

    def counted(sets, pairs, threshold, key):
        asked.append((sets.count(), pairs.count()))
        return real(sets, pairs, threshold, key)

    monkeypatch.setattr(B, "alike", counted)
    tables = {t.name for t in spark.catalog.listTables()}
    keep = {r["id"]: r["keep_id"] for r in B.near_duplicates(df).collect()}
    assert {i: k for i, k in keep.items() if i != k} == {60: 3, 61: 9}
    assert sum(n for n, _ in asked) <= 4 and sum(n for _, n in asked) == 2, asked
    assert {t.name for t in spark.catalog.listTables()} == tables


def test_bitmaps_rule_out_no_like_pair(spark):
    rng = random.Random(8)
    sets = []
    for size in (1, 2, 5, 40, 700, 6000):
        base = [rng.getrandbits(63) - 2 ** 62 for _ in range(size)]
        for lost in (0, 0.05, 0.11, 0.2, 0.5, 1):
            gone = int(size * lost)
            sets.append(base[gone:] + [rng.getrandbits(62) for _ in range(gone)])
    df = spark.createDataFrame(list(enumerate(sets)), "id long, set array<long>")
    pairs = [(i, j) for i in range(len(sets)) for j in range(i)]
    some = spark.createDataFrame(pairs, "id long, other long")
    like = {(i, j) for i, j in pairs if len(set(sets[i]) & set(sets[j])) / len(set(sets[i]) | set(sets[j])) >= 0.8}
    left = {tuple(r) for r in B.may_be_alike(B.bitmaps(df), some, 0.8).collect()}
    assert like <= left and {tuple(r) for r in B.alike(df, some, 0.8).collect()} == like
    small = {(i, j) for i, j in left if max(len(sets[i]), len(sets[j])) < B.CELLS}           # larger sets fill the cells
    assert len(like) > 10 and len(small - like) <= 2

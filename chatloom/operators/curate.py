"""Near-duplicate removal, recipe search conversations, corpus profile.

Near duplicates verify the members of a bucket against its leaders, the least ids in it. Members that
are like a leader are attached to it and take no further part; among those that are like none, the next
leaders are elected, twice as many each round, until no bucket has two members left. So of two
documents that share a bucket and are both kept, one was a leader and the other was verified not to
be like it. Components are taken over the verified edges only.

Before sets are compared, a pair is held against bitmaps of a fixed size, which bound its similarity from above. Sets
are read for the pairs that pass, in place: they are dealt out by document once and not moved in every round.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.session import cut_lineage, write_bucketed, write_once


def normalize(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"(?U)[^\w]+", " "))


def exact_duplicates(docs: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """Exact copies after normalisation: each document -> the smallest id with the same text."""
    # (id, hash) is tiny next to the texts: write it once so both branches below reuse it
    # instead of normalising every text twice
    h = cut_lineage(docs.select(key, F.md5(normalize(F.col(text))).alias("_h")))
    keep = h.groupBy("_h").agg(F.min(key).alias("keep_id"))
    return h.join(keep, "_h").select(key, "keep_id")


def _grams(n: int) -> Column:
    """Every window of ``n`` words of a normalised text ``_t``, found by one regex; a text shorter than
    ``n`` words is one."""
    window = r"(?<!\S)(?=(" + " ".join([r"\S+"] * n) + r"))"
    return (F.when(F.size(F.split("_t", " ")) < n, F.array("_t"))
            .otherwise(F.regexp_extract_all("_t", F.lit(window), 1)))


def shingles(docs: DataFrame, key: str = "id", text: str = "text", n: int = 5, distinct: bool = True) -> DataFrame:
    """Word n-grams per document (every word of the whole text); ``distinct`` makes them a set."""
    norm = docs.select(key, normalize(F.col(text)).alias("_t"))
    grams = norm.select(key, F.explode(_grams(n)).alias("shingle")).where(F.col("shingle") != "")
    return grams.distinct() if distinct else grams


def shingle_sets(docs: DataFrame, key: str = "id", text: str = "text", n: int = 5) -> DataFrame:
    """(key, set): the 64-bit hashes of a document's shingles, as one row expression. Of the rows of one
    key the one with the greatest set counts."""
    norm = docs.select(key, normalize(F.col(text)).alias("_t")).where("_t <> ''")
    sets = norm.select(key, F.array_distinct(F.transform(_grams(n), lambda s: F.xxhash64(s))).alias("set"))
    return sets.groupBy(key).agg(F.max("set").alias("set"))


#: the seeded hashes are (a x + b) mod p of a shingle's crc32, which plain SQL can compute as well
PRIME = 2_147_483_647


def seeded(i: int) -> tuple[int, int]:
    """(a, b) of the i-th hash."""
    digest = hashlib.md5(f"minhash {i}".encode()).hexdigest()
    return int(digest[:7], 16) * 2 + 1, int(digest[8:15], 16)


def minhash_bands(sh: DataFrame, key: str = "id", bands: int = 8, rows: int = 4) -> DataFrame:
    """(doc, band, bucket): ``bands * rows`` seeded hashes, minimum per doc, grouped in bands."""
    k = bands * rows
    # each shingle is hashed once; the k seeded values come from that number
    base = sh.select(key, F.crc32("shingle").alias("_x"))
    sig = base.groupBy(key).agg(*[F.min((F.col("_x") * a + b) % PRIME).alias(f"h{i}") for i, (a, b) in enumerate(map(seeded, range(k)))])
    parts = [F.struct(F.lit(b).alias("band"),
                      F.xxhash64(*[F.col(f"h{b * rows + r}") for r in range(rows)]).alias("bucket"))
             for b in range(bands)]
    return sig.select(key, F.explode(F.array(*parts)).alias("_b")).select(key, "_b.band", "_b.bucket")


def components(edges: DataFrame, key: str = "id") -> DataFrame:
    """(key, label) for the documents of the edges (key, other): the least id reachable; stops when
    no label changes."""
    back = edges.select(F.col("other").alias(key), F.col(key).alias("other"))
    both = cut_lineage(edges.select(key, "other").unionByName(back).distinct())
    labels = both.select(key).distinct().withColumn("label", F.col(key))
    while True:
        near = both.join(labels.withColumnRenamed(key, "other"), "other").groupBy(key).agg(F.min("label").alias("near"))
        # one row per document: materialise every round so the convergence test and the next
        # round read it instead of recomputing the round
        new = cut_lineage(labels.join(near, key).select(key, F.col("label").alias("old"), F.least("label", "near").alias("label")))
        if new.where("label <> old").isEmpty():
            return new.select(key, "label")
        labels = new.select(key, "label")


def alike(sets: DataFrame, pairs: DataFrame, threshold: float, key: str = "id") -> DataFrame:
    """The (key, other) pairs whose sets (arrays of ``shingle_sets``) have a Jaccard similarity of at least ``threshold``."""
    a = sets.select(key, F.col("set").alias("_a"))
    b = sets.select(F.col(key).alias("other"), F.col("set").alias("_b"))
    least, most = F.least(F.size("_a"), F.size("_b")), F.greatest(F.size("_a"), F.size("_b"))
    met = pairs.join(a, key).join(b, "other").where(least >= threshold * most)      # sizes alone rule a pair out
    shared = met.select(key, "other", F.size(F.array_intersect("_a", "_b")).alias("_i"), (F.size("_a") + F.size("_b")).alias("_n"))
    return shared.where(F.col("_i") / (F.col("_n") - F.col("_i")) >= threshold).select(key, "other")


#: cells of a document's bitmap
CELLS = 2048


def bitmaps(sets: DataFrame, key: str = "id") -> DataFrame:
    """(key, n, bits): the size of a set, and which cells (the low bits of a shingle's hash) it has shingles in."""
    kind = sets.schema[key].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                column = batch.column("set")
                sizes = column.value_lengths().to_numpy()
                cells = np.zeros((batch.num_rows, CELLS), bool)
                cells[np.repeat(np.arange(batch.num_rows), sizes), column.flatten().to_numpy() & (CELLS - 1)] = True
                bits = np.packbits(cells, axis=1).view(np.int64)
                ends = pa.array(np.arange(0, bits.size + 1, CELLS // 64, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(ends, pa.array(bits.ravel()))],
                                                 [key, "n", "bits"])

    return sets.select(key, "set").mapInArrow(run, f"`{key}` {kind}, n int, bits array<long>")


def may_be_alike(maps: DataFrame, pairs: DataFrame, threshold: float, key: str = "id") -> DataFrame:
    """The (key, other) pairs that their bitmaps leave in question: a cell that only one of them has shingles in holds
    at least one shingle that the other lacks."""
    a = maps.select(key, F.col("n").alias("_na"), F.col("bits").alias("_a"))
    b = maps.select(F.col(key).alias("other"), F.col("n").alias("_nb"), F.col("bits").alias("_b"))

    def lacking(x, y):
        alone = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(alone, F.lit(0), lambda total, n: total + n)

    met = pairs.join(a, key).join(b, "other").where(F.least("_na", "_nb") >= threshold * F.greatest("_na", "_nb"))
    most = met.select(key, "other", (F.col("_na") + F.col("_nb")).alias("_n"),
                      F.least(F.col("_na") - lacking("_a", "_b"), F.col("_nb") - lacking("_b", "_a")).alias("_i"))
    return most.where(F.col("_i") / (F.col("_n") - F.col("_i")) >= threshold).select(key, "other")


def near_duplicates(docs: DataFrame, key: str = "id", text: str = "text", threshold: float = 0.8,
                    n: int = 5, bands: int = 8, rows: int = 4) -> DataFrame:
    """B1: each document -> ``keep_id``: the smallest id that verified edges (shingle Jaccard of at least
    ``threshold`` with a leader of a shared LSH bucket) lead to; itself without any."""
    spark = docs.sparkSession
    # a minimum ignores repeats, so the signatures need no distinct (no shuffle of all shingles)
    bands_ = minhash_bands(shingles(docs.where(F.col(key).isNotNull()), key, text, n, distinct=False), key, bands, rows)
    # docs x bands rows, read twice: materialise once in the shared folder
    bands_ = write_once(bands_, "bands")
    shared = bands_.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    left = write_once(bands_.join(shared, ["band", "bucket"]), "left")
    if left.isEmpty():
        return docs.select(key, F.col(key).alias("keep_id"))
    # shingle sets only for documents in a candidate pair, written once for all rounds
    involved = left.select(key).distinct()
    table = write_bucketed(shingle_sets(docs.join(involved, key, "left_semi"), key, text, n), "sets", key)
    sets = spark.table(table)
    maps = write_once(bitmaps(sets, key), "bitmaps")
    edges, leaders = None, 1
    while not left.isEmpty():
        # the first leader is an aggregate: whole groups of copies are left then
        first = left.groupBy("band", "bucket").agg(F.min(key).alias(key))
        chosen = first if leaders == 1 else top_k(left, ["band", "bucket"], [F.col(key)], leaders, salt_key=key)
        chosen = write_once(chosen.select("band", "bucket", F.col(key).alias("other")), "leaders")
        pairs = left.join(chosen, ["band", "bucket"]).where(F.col("other") < F.col(key)).select(key, "other").distinct()
        close = write_once(may_be_alike(maps, pairs, threshold, key), "close")
        asked = close.select(key).unionByName(close.select(F.col("other").alias(key))).distinct()
        own = write_once(sets.join(asked, key, "left_semi"), "asked-sets")
        found = write_once(alike(own, close, threshold, key), "alike")
        edges = found if edges is None else edges.unionByName(found)
        rest = (left.join(chosen.withColumnRenamed("other", key), ["band", "bucket", key], "left_anti")
                .join(found.select(key).distinct(), key, "left_anti"))
        # a bucket's last member has met all leaders
        more = rest.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
        left = write_once(rest.join(more, ["band", "bucket"]), "left")
        leaders *= 2
    spark.sql(f"DROP TABLE {table}")
    labels = components(edges, key)
    return (docs.select(key).join(labels, key, "left")
            .select(key, F.coalesce("label", key).alias("keep_id")))


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, salt_buckets: int = 16,
          salt_key: str = "id") -> DataFrame:
    """Top ``k`` rows per group in two steps (per group+salt, then per group), so one huge group
    is ranked by many tasks and the final step sees at most ``salt_buckets * k`` rows."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_key)), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    pre = salted.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return pre.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)


def recipe_search(recipes: DataFrame, k: int = 3, min_score: float = 4.0) -> DataFrame:
    """B2: for each (category, ingredient), recipes of that category holding the ingredient, ordered
    by the ingredient's share of the recipe's ingredient lines, then score; top ``k`` each."""
    r = recipes.where(F.col("review_score") >= min_score)
    items = r.select("id", "unique_title", "review_score", F.size("ingredients").alias("n_ing"),
                     F.explode("category").alias("category"), "ingredients")
    names = items.select("*", F.explode(F.array_distinct(F.transform(
        "ingredients", lambda x: F.regexp_extract(x, r" of (.*)$", 1)))).alias("ingredient"))
    share = names.withColumn("share", F.size(F.filter("ingredients", lambda x: F.regexp_extract(
        x, r" of (.*)$", 1) == F.col("ingredient"))) / F.col("n_ing"))
    best = top_k(share, ["category", "ingredient"],
                 [F.col("share").desc(), F.col("review_score").desc(), F.col("id")], k)
    return best.select("category", "ingredient", "rank", "id", "unique_title", "share", "review_score")


def recipe_search_chat(best: DataFrame) -> DataFrame:
    """B2 messages: one question per (category, ingredient) and the proposed recipes (k per group)."""
    g = best.groupBy("category", "ingredient").agg(
        F.array_sort(F.collect_list(F.struct("rank", "unique_title"))).alias("_l"))
    return g.select("category", "ingredient",
                    F.concat(F.lit("Find "), F.lower("category"), F.lit(" recipes, ingredient "),
                             F.col("ingredient"), F.lit(".")).alias("question"),
                    F.concat(F.lit("Found:\n"),
                             F.array_join(F.transform("_l", lambda x: F.concat(F.lit("- "), x["unique_title"])),
                                          "\n")).alias("answer"))


def corpus_profile(docs: DataFrame, thresholds: list[int] = (500, 8000), by: str = "source",
                   text: str = "text") -> DataFrame:
    """Document sizes in bytes per group: min, average, max, and counts above each threshold."""
    b = F.octet_length(text)
    aggs = [F.count(F.lit(1)).alias("n_docs"), F.min(b).alias("min_bytes"),
            F.round(F.avg(b), 3).alias("avg_bytes"), F.max(b).alias("max_bytes")]
    aggs += [F.count(F.when(b > t, 1)).alias(f"over_{t}") for t in thresholds]
    return docs.groupBy(by).agg(*aggs)

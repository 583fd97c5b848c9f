"""B1, embedding variant: look-alikes by cosine, and the rows that survive under a new revision.

1. Vectors are scaled to length one; equal ones are collapsed to their least id.
2. Each takes part in ``bands`` tables of buckets. A bucket's number is put together from hashes: which of
   ``DIRECTIONS`` random directions, seeded so that every task draws the same ones, the vector lies nearest to, and on
   which side. There are as many hashes as keep a bucket of unlike ones small however many there are; ``bands`` follows
   from the threshold and the wanted recall.
3. The members of a bucket meet with their vectors in one task, which compares all of them exactly and puts out one
   link per member at most: no pair is joined with its vectors. A bucket of over ``MANY`` members is dealt out in
   blocks, and every two blocks meet in a task of their own.
4. A bucket of over ``HUGE`` members is first thinned by leaders, the least ids: those that are like one are attached and
   take no further part in this bucket; among the rest the next leaders are elected, twice as many each round, until at
   most ``HUGE`` are left, which meet as in 3. A group of copies costs one pair each.
5. Components are taken over the verified pairs; every id goes to the least one.
"""
from __future__ import annotations

import itertools
import math
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.operators.curate import components, top_k
from chatloom.session import cut_lineage, scratch_path

#: vectors that share a bucket by chance, on average, at most
CROWD = 64
#: members of a bucket that one task compares at once, and those that meet in blocks of half as many
MANY = 8 * CROWD
HUGE = 8 * MANY
#: random directions of a hash, and the bits of its value (direction and side)
DIRECTIONS, BITS = 64, 7
#: bits of a bucket's number, at most
MAX_ROWS = 42


@lru_cache
def agreement(threshold: float) -> float:
    """The chance that two vectors of this cosine agree in a hash, as a power per bit of it. Along a random
    direction such vectors are normal variates of this correlation, so the chance is counted over drawn ones, less three
    standard errors."""
    if threshold >= 1:
        return 1.0
    rng, draws, same = np.random.default_rng(7), 100_000, 0
    for _ in range(20):
        a = rng.normal(size=(draws // 20, DIRECTIONS))
        b = threshold * a + math.sqrt(1 - max(-1.0, threshold) ** 2) * rng.normal(size=a.shape)
        same += int((hashes(a) == hashes(b)).sum())
    p = same / draws
    return max(p - 3 * math.sqrt(p * (1 - p) / draws), 1e-9) ** (1 / BITS)


def hashes(along: np.ndarray) -> np.ndarray:
    """The hash of each row of components along the directions."""
    best = np.abs(along).argmax(axis=-1)
    return 2 * best + (np.take_along_axis(along, best[..., None], -1)[..., 0] > 0)


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows): numbers of ``rows`` bits (whole hashes) for buckets of at most CROWD unlike vectors on average, and as
    many bands as a pair at the threshold needs to share one of them with probability ``recall``."""
    rows = min(MAX_ROWS, BITS * max(1, math.ceil(math.log2(max(2, n) / CROWD) / BITS)))
    hit = agreement(threshold) ** rows
    return (1 if hit >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log1p(-hit)))), rows


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unit_vectors(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the vectors that have a direction: not null, all components finite, not all zero."""
    v = F.col(vector)
    whole = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = vectors.where(F.col(key).isNotNull() & v.isNotNull() & whole).select(F.col(key).alias("id"), v.cast("array<double>").alias("v"))
    kind = usable.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column("v")
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            # the largest component first: squares of large ones overflow otherwise
            top = np.array([np.abs(flat[a:z]).max(initial=0) for a, z in zip(ends[:-1], ends[1:])])
            flat = flat / np.repeat(np.where(top > 0, top, 1), np.diff(ends))
            size = np.sqrt(np.add.reduceat(np.append(flat * flat, 0.0), ends[:-1])) if len(flat) else top
            keep = top > 0
            flat = flat / np.repeat(np.where(keep, size, 1), np.diff(ends))
            out = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("id"), out], ["id", "v"]).filter(pa.array(keep))

    return usable.mapInArrow(run, f"id {kind}, v array<double>")


def buckets(units: DataFrame, bands: int, rows: int, seed: int) -> DataFrame:
    """(id, band, bucket) per vector and band. The directions depend on seed, band and dimension alone."""
    kind = units.schema["id"].dataType.simpleString()

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        weights = np.int64(1) << np.arange(0, rows, BITS, dtype=np.int64)
        for batch in batches:
            column = batch.column("v")
            sizes = column.value_lengths().to_numpy()
            for d in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == d))
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, d]).normal(size=(bands, rows // BITS * DIRECTIONS, d))
                x = own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                numbers = [(hashes((x @ p.T).reshape(len(x), -1, DIRECTIONS)) * weights).sum(axis=1) for p in planes[d]]
                bucket = np.stack(numbers, axis=1) * 8191 + d                         # lengths never meet
                ids = own.column("id").take(pa.array(np.repeat(np.arange(len(x)), bands)))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(np.arange(bands, dtype=np.int32), len(x))), pa.array(bucket.ravel())],
                                                 ["id", "band", "bucket"])

    return units.mapInArrow(run, f"id {kind}, band int, bucket long")


def alike(pairs: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """The pairs (id, other) whose exact cosine reaches the threshold."""
    both = (pairs.join(units, "id").withColumnRenamed("v", "a")
            .join(units.select(F.col("id").alias("other"), F.col("v").alias("b")), "other").select("id", "other", "a", "b"))
    kind = pairs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("a", "b"))
            ends = np.concatenate(([0], np.cumsum(batch.column("a").value_lengths().to_numpy())))
            cosine = np.add.reduceat(np.append(a * b, 0.0), ends[:-1]) if batch.num_rows else np.zeros(0)
            yield batch.select(["id", "other"]).filter(pa.array(cosine >= threshold))

    return both.mapInArrow(run, f"id {kind}, other {kind}")


def meetings(members: DataFrame) -> DataFrame:
    """(id, band, bucket, part): the members (id, band, bucket, n) of a bucket of up to MANY meet in one part of it; those of a
    larger one are dealt out in blocks, and there is a part for every two of them."""
    blocks = F.when(F.col("n") <= MANY, 1).otherwise(F.ceil(F.col("n") / (MANY // 2))).cast("int")
    own = members.select("id", "band", "bucket", blocks.alias("blocks"))
    own = own.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != F.col("block"))
    part = F.transform(met, lambda x: F.least(x, "block").cast("long") * F.col("blocks") + F.greatest(x, "block"))
    return own.select("id", "band", "bucket", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(part)).alias("part"))


def within(members: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """(id, other): ``other`` is the least id that links of at least the threshold lead to in a part of a bucket."""
    kind = units.schema["id"].dataType.simpleString()
    part = ["band", "bucket", "part"]
    dealt = meetings(members).join(units, "id").select("id", *part, "v").repartition(*part).sortWithinPartitions(*part, "id")

    def run(batches):
        rest = None                                     # the last part of a batch may go on in the next one
        for batch in itertools.chain(batches, [None]):
            parts = [x for x in (rest, batch) if x is not None and x.num_rows]
            if not parts:
                continue
            table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            new = np.any([np.diff(table.column(c).to_numpy()) != 0 for c in part], axis=0)
            starts = np.flatnonzero(np.concatenate(([True], new)))
            ends = np.append(starts[1:], table.num_rows)
            if batch is not None:
                rest, starts, ends = table.slice(starts[-1]), starts[:-1], ends[:-1]
            column = table.column("v")
            flat, at = column.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
            ids, others = [], []
            for a, z in zip(starts.tolist(), ends.tolist()):
                if z - a > 1:
                    x = flat[at[a]:at[z]].reshape(z - a, -1)
                    least = _least(x @ x.T >= threshold)
                    linked = np.flatnonzero(least < np.arange(z - a))
                    ids.append(a + linked)
                    others.append(a + least[linked])
            if ids:
                yield pa.RecordBatch.from_arrays([table.column("id").take(pa.array(np.concatenate(x))) for x in (ids, others)], ["id", "other"])

    return dealt.mapInArrow(run, f"id {kind}, other {kind}")


def _least(near: np.ndarray) -> np.ndarray:
    """The least index that a matrix of links leads to, of every index."""
    least = np.arange(len(near))
    if np.count_nonzero(near) <= len(near):             # a vector is like itself
        return least
    while True:
        new = np.minimum(least, np.where(near, least, len(near)).min(axis=1))
        if (new == least).all():
            return least
        least = new


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, recall: float = 0.95,
                 seed: int = 11) -> DataFrame:
    """(key, keep_id) per row: the least id that verified pairs (cosine of at least ``threshold``, up to 1e-9)
    lead to, itself without any. Two vectors at the threshold share a bucket with probability ``recall``, closer ones more often.

    Null vectors, those with null or non-finite components and zero vectors are like nothing. A null key has no
    keep_id. Of rows with one key, the least vector counts.
    """
    units = stored(unit_vectors(vectors, key, vector), "units")
    one = units.groupBy("id").agg(F.min("v").alias("v"))
    # equal directions: one stands for all, so that a vector of very many rows is one row from here on
    same = stored(one.select("id", "v", F.md5(F.array_join(F.transform("v", lambda x: x.cast("string")), ",")).alias("h")), "directions")
    first = same.groupBy("h").agg(F.min("id").alias("other"))
    copies = cut_lineage(same.select("id", "h").join(first, "h").where("id <> other").select("id", "other"))
    distinct = stored(same.select("id", "v").join(copies.select("id"), "id", "left_anti"), "distinct-directions")
    bands, rows = plan(distinct.count(), threshold, recall)
    placed = stored(buckets(distinct, bands, rows, seed), "buckets")

    def crowded(rows_: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The rows of buckets that have two members or more, with how many: those that meet, and those of huge buckets."""
        n = rows_.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        sized = cut_lineage(rows_.join(n, ["band", "bucket"]))
        return sized.where(F.col("n") <= HUGE), sized.where(F.col("n") > HUGE).drop("n")

    some, left = crowded(placed)
    meet, edges, leaders = [some], copies, 1
    while not left.isEmpty():
        chosen = left.groupBy("band", "bucket").agg(F.min("id").alias("id")) if leaders == 1 else top_k(left, ["band", "bucket"], [F.col("id")], leaders)
        chosen = cut_lineage(chosen.select("band", "bucket", F.col("id").alias("other")))
        met = cut_lineage(left.join(chosen, ["band", "bucket"]).where("other < id").select("band", "bucket", "id", "other"))
        found = cut_lineage(alike(met.select("id", "other").distinct(), distinct, threshold - 1e-9))
        edges = edges.unionByName(found)
        # whoever is like a leader of a bucket is attached there; in other buckets it still meets others
        attached = met.join(found, ["id", "other"]).select("band", "bucket", "id").distinct()
        gone = chosen.select("band", "bucket", F.col("other").alias("id")).unionByName(attached)
        rest = left.join(gone, ["band", "bucket", "id"], "left_anti")
        some, left = crowded(rest)
        meet.append(some)
        leaders *= 2
    edges = edges.unionByName(within(reduce(DataFrame.unionByName, meet), distinct, threshold - 1e-9))
    labels = components(edges)
    return (vectors.select(F.col(key).alias("id")).join(labels, "id", "left")
            .select(F.col("id").alias(key), F.coalesce("label", "id").alias("keep_id")))


def survivors(training: DataFrame, kept: DataFrame, revision: str, new_revision: str, key: str = "conversation") -> DataFrame:
    """The training rows of ``revision`` whose conversation stands for itself, under ``new_revision``: the
    original rows stay as they are. ``kept`` is (key, keep_id); conversations that it does not name survive."""
    own = training.where(F.col("revision") == revision)
    lost = kept.where(F.col(key) != F.col("keep_id")).select(key).distinct()
    return own.join(lost, key, "left_anti").withColumn("revision", F.lit(new_revision)).select(*training.columns)


def embed_conversations(training: DataFrame, embed, revision: str) -> DataFrame:
    """(conversation, embedding): ``embed`` (Column -> Column) of each conversation's first user message."""
    asked = training.where((F.col("revision") == revision) & (F.col("role") == "user"))
    first = asked.groupBy("conversation").agg(F.min_by("content", "position").alias("question"))
    return first.select("conversation", embed(F.col("question")).alias("embedding"))


def deduplicate_training(training: DataFrame, embed, revision: str, new_revision: str, threshold: float = 0.9) -> DataFrame:
    """Look-alike conversations of a revision go; what is left comes out under a new one."""
    kept = near_vectors(embed_conversations(training, embed, revision), "conversation", "embedding", threshold)
    return survivors(training, kept, revision, new_revision)


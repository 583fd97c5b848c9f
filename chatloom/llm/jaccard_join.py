"""N-gram Jaccard join by vertical partitioning.

A document's set holds the 64-bit hashes of its distinct word n-grams; the global order is that of
the hashes, and fragments are ranges of it. Two sets with Jaccard t or more miss at most
``n - ceil(t n)`` n-grams of each other, so inside any fragment that holds more of a set than that,
they must meet.

1. Fragment 0, the lowest range of the order, is wide enough to hold ``p = n - ceil(t n) + 1`` n-grams
   of every set of a size class (checked; widened if it is not). Document frequencies of its n-grams
   are counted over all distinct sets. A set posts its p rarest n-grams of the fragment; an n-gram
   of frequency 1 meets nobody, so most sets post nothing at all.
2. Sets that post one n-gram form a bucket. Every member is paired with the bucket's first one; pairs
   are verified: the fragments of both sets are joined, each fragment's overlap is counted
   separately and the counts are summed per pair. Verified pairs are contracted to components.
   Before, the full sets of the documents that post anything are fetched, and those that do not share
   t of their n-grams with any others are dropped.
3. What is left are bucket members of different components. Buckets with one first set are taken together, so
   that two sets meet there once. All members except those of the largest component are paired with the members of
   other components if they share a bucket and if their overlaps with the first set, known from step 2, leave
   room for a link; those pairs are verified. So no link between components is lost, and a bucket
   of thousands of near copies never becomes all its pairs.

Equal sets are collapsed before step 1. The result is one row per document.
"""
from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import if_few, map_batches, release, stored
from chatloom.llm.words import distinct, hashed, signed, window_hashes
from chatloom.session import cut_lineage

NGRAM = 5
PERCENT = 80
FRAGMENTS = 4
#: ids of copies and of documents in a pair are sent to all tasks up to so many rows, else joined by a shuffle
MAX_BROADCAST_ROWS = 500_000
#: bits of the map of shared n-grams that is sent to all tasks (32 MB). It only spares work: with more
#: n-grams than slots it rules out less, and the join that follows is exact
MAX_SLOTS = 1 << 28
#: stands for a missing id: such rows are never the first
LAST = (1 << 63) - 1
LEVEL_BITS = 6


def level_of(n: int) -> int:
    """Size class: sizes 2^k .. 2^(k+1) - 1."""
    return max(0, int(n).bit_length() - 1)


@lru_cache(maxsize=None)
def fragment_end(level: int, sigmas: float, percent: int) -> int:
    """End of fragment 0 (of 2^64) for a size class: the share that a prefix needs plus ``sigmas``
    standard deviations at the class's smallest size (partners from the class below included)."""
    miss = 1 - percent / 100
    least = max(1.0, (1 << level) * percent / 100)
    share = miss + 1 / least + sigmas * math.sqrt(miss * (1 - miss) / least)
    return min((1 << 64) - 1, int(share * (1 << 64)))


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def gram_sets(texts: list[str | None], ngram: int):
    """Each text's sorted distinct n-gram hashes; a text of fewer words is one n-gram."""
    for ids in hashed(texts, lower=True):
        yield distinct(window_hashes(ids, min(ngram, len(ids)))) if len(ids) else np.zeros(0, np.uint64)


def set_name(grams: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(grams.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def summaries(docs: DataFrame, ngram: int, percent: int, sigmas: float) -> DataFrame:
    """(id, raw, n, node, b, level, fits, grams): the text's digest, set size, the halves of the set name, fragment 0, whether it is wide enough."""
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("id", "n", "node", "b", "level", "fits", "grams")} | {"raw": batch["raw"]}
            for doc, grams in zip(batch["id"], gram_sets(batch["text"], ngram)):
                n = len(grams)
                a, b = set_name(grams)
                level = level_of(n)
                head = grams[:np.searchsorted(grams, np.uint64(fragment_end(level, sigmas, percent)), "right")]
                need = prefix_size(n, percent) if n else 0
                fits = len(head) >= need
                # a set close to the next class also meets that class, in its narrower fragment
                if n >= percent * (1 << (level + 1)) / 100:
                    fits &= int(np.searchsorted(grams, np.uint64(fragment_end(level + 1, sigmas, percent)), "right")) >= need
                out["id"].append(doc)
                out["n"].append(n)
                out["node"].append(a)
                out["b"].append(b)
                out["level"].append(level)
                out["fits"].append(bool(fits))
                out["grams"].append(signed(head))
            yield out

    return map_batches(docs, "id long, raw binary, n long, node long, b long, level int, fits boolean, grams array<long>", run)


def fragment_keys(rows: DataFrame, percent: int, sigmas: float, seen: np.ndarray | None = None) -> DataFrame:
    """(key, node, level, n, held): the n-grams of fragment 0 at each level a set takes part in; ``held``
    is the number of the set's n-grams there. The key is the n-gram with the level in its low bits.

    With ``seen`` (a bit per slot of keys that two sets have) keys without a bit are left out, and so
    are sets of which too few are left to reach their p rarest: bits can only be set too often.
    """
    arrow = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("level", pa.int32()), ("n", pa.int64()), ("held", pa.int64())])
    mask = np.int64(-(1 << LEVEL_BITS))

    def run(batches):
        for batch in batches:
            grams = batch.column("grams")
            flat, cuts = grams.values.to_numpy(), grams.offsets.to_numpy()
            out = [[np.zeros(0, np.int64)] for _ in range(5)]
            for i, (node, n, level) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("node", "n", "level")))):
                own = flat[cuts[i]:cuts[i + 1]]
                near_next = n * 100 >= percent * (1 << (level + 1))
                for at in (level, level + 1) if near_next else (level,):
                    if at > level:
                        own = own[:np.searchsorted(own.view(np.uint64), np.uint64(fragment_end(at, sigmas, percent)), "right")]
                    keys, held = (own & mask) | at, len(own)
                    if seen is not None:
                        keys = keys[has_bit(seen, keys)]
                        if prefix_size(n, percent) <= held - len(keys):
                            continue
                    for column, value in zip(out, (keys, *(np.full(len(keys), v) for v in (node, at, n, held)))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), type=f.type) for c, f in zip(out, arrow)], schema=arrow)

    return rows.select("node", "n", "level", "grams").mapInArrow(run, "key long, node long, level int, n long, held long")


def slots_of(keys: np.ndarray, slots: int) -> np.ndarray:
    """A slot per key, from the high bits of a product that mixes all its bits."""
    with np.errstate(over="ignore"):
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - slots.bit_length())


def has_bit(seen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = slots_of(keys, len(seen) * 8)
    return (seen[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def key_bits(shared: DataFrame, per_key: int = 16) -> np.ndarray:
    """A bit map of the slots of the shared keys: ``per_key`` slots a key, at most MAX_SLOTS. Tasks merge their
    keys to one map per block of slots before anything moves, so its size bounds all that does."""
    slots = min(MAX_SLOTS, max(1 << 16, 1 << (per_key * shared.count()).bit_length()))
    block = 1 << 15

    def run(batches):
        maps: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = np.unique(slots_of(batch.column("key").to_numpy(), slots).astype(np.int64))
            parts = slot // block
            for p in np.unique(parts).tolist():
                bits = np.zeros(block, np.uint8)
                bits[slot[parts == p] % block] = 1
                packed = np.packbits(bits, bitorder="little")
                maps[p] = maps[p] | packed if p in maps else packed
        yield {"part": list(maps), "bits": [m.tobytes() for m in maps.values()]}

    def task(batches):
        for out in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(out["part"], pa.int64()), pa.array(out["bits"], pa.binary())], ["part", "bits"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in pdf["bits"]])
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "bits": [whole.tobytes()]})

    schema = "part long, bits binary"
    merged = shared.select("key").mapInArrow(task, schema).groupBy("part").applyInPandas(merge, schema).toArrow()
    seen = np.zeros(slots // 8, np.uint8)
    for part, bits in zip(merged["part"].to_pylist(), merged["bits"].to_pylist()):
        seen[part * block // 8:(part + 1) * block // 8] = np.frombuffer(bits, np.uint8)
    return seen


def prefix(n: Column, percent: int) -> Column:
    return n - F.ceil(n * percent / 100.0) + 1


def posted(sets: DataFrame, percent: int, sigmas: float) -> DataFrame:
    """(key, node, n): the p rarest n-grams of each set's fragment, without those no other set has."""
    shared = stored(fragment_keys(sets, percent, sigmas).groupBy("key").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "shared-keys")
    release(sets.sparkSession)
    met = fragment_keys(sets, percent, sigmas, key_bits(shared)).join(shared, "key")
    # n-grams of frequency 1 are the rarest: they use up part of the p. Repeated rows: a set of n-grams
    per_set = met.groupBy("node", "level", "n", "held").agg(F.collect_set(F.struct("df", "key")).alias("met"))
    left = prefix(F.col("n"), percent) - (F.col("held") - F.size("met"))
    chosen = per_set.withColumn("left", left.cast("int")).where("left > 0")
    return chosen.select("node", "n", F.explode(F.slice(F.sort_array("met"), F.lit(1), F.col("left"))).alias("m")).select(
        F.col("m.key").alias("key"), "node", "n")


def can_link(nx: Column, ax: Column, ny: Column, ay: Column, percent: int) -> Column:
    """Whether two sets of these sizes and numbers of shared n-grams can reach the threshold: the overlap
    is at most the smaller number, and must be t / (1 + t) of both sizes together."""
    return F.least(ax, ay) * (100 + percent) >= (nx + ny) * percent


def can_link_around(percent: int) -> Column:
    """The same with the overlaps ``ox``, ``oy`` of both with a third set: inside that set they share at most the
    smaller overlap, outside it at most the smaller number of what else each shares with others. Unknown
    overlaps rule nothing out."""
    most = F.least("ox", "oy") + F.least(F.col("ax") - F.col("ox"), F.col("ay") - F.col("oy"))
    known = F.col("ox").isNotNull() & F.col("oy").isNotNull()
    return ~known | (most * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent)


def fragment_rows(docs: DataFrame, nodes: DataFrame, ngram: int) -> DataFrame:
    """(node, n, parts), one row per set that is in a bucket, cut into FRAGMENTS ranges: only one text of
    each is fetched, by its id and digest, so rows without an id do not meet each other's sets."""
    def run(batches):
        for batch in batches:
            out = {k: [] for k in ("node", "n", "again", "parts")}
            for node, again, grams in zip(batch["node"], batch["again"], gram_sets(batch["text"], ngram)):
                if set_name(grams)[0] != node:
                    continue                          # another text under the same id
                part = (grams >> np.uint64(64 - FRAGMENTS.bit_length() + 1)).astype(np.int64)
                cuts = np.searchsorted(part, np.arange(FRAGMENTS + 1))
                out["node"].append(node)
                out["n"].append(len(grams))
                out["again"].append(again)
                out["parts"].append([signed(grams[cuts[f]:cuts[f + 1]]) for f in range(FRAGMENTS)])
            yield out

    texts = docs.join(if_few(nodes, MAX_BROADCAST_ROWS), ["own", "raw"]).select("node", "again", "text")
    found = stored(map_batches(texts, "node long, n long, again boolean, parts array<array<long>>", run), "fragments")
    return found.where("NOT again").unionByName(found.where("again").dropDuplicates(["node"])).drop("again")


def enough_shared(sets: DataFrame, percent: int) -> DataFrame:
    """The sets that share ``percent`` of their n-grams with any of the others, with the number they
    share (``alive``, at least); a set in a verified pair shares as many with one of them. Unlike texts
    around a common passage end here."""
    shared = (sets.select(F.explode(F.flatten("parts")).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("df"))
              .where("df > 1").select("key"))
    seen = key_bits(stored(shared, "shared-grams"), per_key=64)

    def run(batches):
        for batch in batches:
            parts = batch.column("parts").flatten()
            flat = parts.values.to_numpy()
            cuts = parts.offsets.to_numpy()
            held = np.concatenate(([0], np.cumsum(has_bit(seen, flat))))
            alive = (held[cuts[FRAGMENTS::FRAGMENTS]] - held[cuts[:-1:FRAGMENTS]])[:batch.num_rows]
            out = batch.append_column("alive", pa.array(alive.astype(np.int64)))
            yield out.filter(pa.array(alive * 100 >= batch.column("n").to_numpy() * percent))

    return sets.mapInArrow(run, "node long, n long, parts array<array<long>>, alive long")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(x, y, nx, ny, overlap) of the pairs: the overlap of each fragment counted by itself, summed per
    pair. ``pairs`` is materialised; repeated pairs (of repeated rows) are merged."""
    left = sets.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("parts").alias("px"))
    right = sets.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("parts").alias("py"))
    # a few pairs go to the sets; only sets in a pair move
    met = left.join(if_few(pairs, MAX_BROADCAST_ROWS), "x")
    second = right.join(if_few(cut_lineage(pairs.select("y").distinct()), MAX_BROADCAST_ROWS), "y", "left_semi")
    both = met.join(second, "y")
    counts = F.zip_with("px", "py", lambda a, b: F.size(F.array_intersect(a, b)))
    overlap = F.aggregate(counts, F.lit(0), lambda total, c: total + c).cast("long")
    return both.select("x", "y", "nx", "ny", overlap.alias("overlap")).distinct()


def reaching(judged: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose Jaccard reaches the threshold."""
    return judged.where(F.col("overlap") * 100 >= (F.col("nx") + F.col("ny") - F.col("overlap")) * percent).select("x", "y")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of the edges, the label being the component's least node. Each
    round takes the least label around and then the label's own label, until nothing changes."""
    both = cut_lineage(edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = cut_lineage(both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("node"), F.least("x", "m").alias("label")))
    while True:
        around = both.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("near"))
        nearer = labels.join(around.withColumnRenamed("x", "node"), "node").select("node", "label", F.least("label", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        new = cut_lineage(nearer.join(jump, "to").select("node", F.least("to", "further").alias("new"), "label"))
        if new.where("new <> label").isEmpty():
            return labels
        labels = new.select("node", F.col("new").alias("label"))


def links(buckets: DataFrame, fragments: DataFrame, percent: int) -> DataFrame:
    """Verified edges that connect the same documents as all links do (steps 2 and 3)."""
    # the set with the fewest n-grams of its own is more often the original of its copies than any other
    first = buckets.groupBy("key").agg(F.min(F.struct((F.col("n") - F.col("alive")).alias("alone"), "own", "node", "n", "alive")).alias("first"))
    # what one set posted in the buckets of one first set: those buckets hold much the same members
    members = stored(buckets.join(first, "key").groupBy("first", "node", "n", "alive").agg(F.collect_set("key").alias("keys"))
                     .select(F.col("first.node").alias("c"), F.col("first.n").alias("nc"), F.col("first.alive").alias("ac"), "node", "n", "alive", "keys"),
                     "members")
    star = cut_lineage(members.where((F.col("node") != F.col("c")) & can_link(F.col("n"), F.col("alive"), F.col("nc"), F.col("ac"), percent))
                       .select(F.col("node").alias("x"), F.col("c").alias("y")))
    judged = cut_lineage(overlaps(star, fragments))
    edges = cut_lineage(reaching(judged, percent))
    labels = components(edges)
    held = judged.select(F.col("x").alias("node"), F.col("y").alias("c"), "overlap")
    common = F.when(F.col("node") == F.col("c"), F.col("n")).otherwise(F.col("overlap"))
    placed = stored(members.join(held, ["node", "c"], "left").join(labels, "node", "left")
                    .select("c", "node", "n", "alive", "keys", common.alias("common"), F.coalesce("label", "node").alias("label")), "placed")
    sizes = placed.groupBy("c", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = (sizes.groupBy("c").agg(F.max_by("label", F.struct("size", "label")).alias("most"), F.count(F.lit(1)).alias("parts"))
               .where("parts > 1").drop("parts"))
    mixed = placed.join(largest, "c")
    fields = {"node": "", "n": "n", "alive": "a", "common": "o", "keys": "k", "label": "l"}
    some = mixed.where("label <> most").select("c", *[F.col(f).alias(p + "x") for f, p in fields.items()])
    other = mixed.select("c", "most", *[F.col(f).alias(p + "y") for f, p in fields.items()])
    # two members outside the largest component meet once; a failed star pair is not tried again
    cross = (some.join(other, "c").where((F.col("lx") != F.col("ly")) & ((F.col("ly") == F.col("most")) | (F.col("x") > F.col("y")))
                                         & can_link(F.col("nx"), F.col("ax"), F.col("ny"), F.col("ay"), percent)
                                         & can_link_around(percent) & F.arrays_overlap("kx", "ky"))
             .select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
             .join(star.unionByName(star.select(F.col("x").alias("y"), F.col("y").alias("x"))), ["x", "y"], "left_anti"))
    cross = cut_lineage(cross)
    release(buckets.sparkSession)
    return edges.unionByName(reaching(overlaps(cross, fragments), percent))


def judged_rows(docs: DataFrame, key: str, text: str, ngram: int, percent: int) -> DataFrame:
    """(id, own, raw, n, group, half, component) per row: ``own`` is the id, LAST for none; (``group``, ``half``)
    names the row's component, whatever ids its rows have; ``component`` is the least ``own`` in it."""
    source = docs.select(F.col(key).cast("long").alias("id"), F.unhex(F.md5(text)).alias("raw"), F.col(text).alias("text"))
    sigmas = 6.0
    while True:
        rows = stored(summaries(source, ngram, percent, sigmas), "sets")
        if rows.where("NOT fits").isEmpty():
            break
        sigmas *= 2                                    # some set's hashes lie unusually high: widen the fragment
    # a set is a node, known by its name; its first document stands for equal ones
    rows = rows.withColumn("own", F.coalesce("id", F.lit(LAST)))
    full = rows.where("n > 0")
    firsts = cut_lineage(full.groupBy("node", "b").agg(F.min("own").alias("first")))
    copies = cut_lineage(full.select("own", "node", "b").join(firsts, ["node", "b"]).where("own > first").select("own", "node").distinct())
    sets = full.join(if_few(copies, MAX_BROADCAST_ROWS), ["own", "node"], "left_anti")
    chosen = posted(sets, percent, sigmas).join(firsts.select("node", F.col("first").alias("own")), "node")
    met = stored(chosen, "postings")
    release(docs.sparkSession)
    posting = cut_lineage(met.select("own", "node").distinct())
    nodes = cut_lineage(full.select("own", "node", "raw").join(if_few(posting, MAX_BROADCAST_ROWS), ["own", "node"])
                        .groupBy("own", "node").agg(F.min("raw").alias("raw"), (F.count(F.lit(1)) > 1).alias("again")))
    texts = source.where(F.col("text").isNotNull()).select(F.coalesce("id", F.lit(LAST)).alias("own"), "raw", "text")
    known = fragment_rows(texts, nodes, ngram)
    known = stored(enough_shared(known, percent), "fragments-in-pairs")
    release(docs.sparkSession)
    met = met.join(if_few(cut_lineage(known.groupBy("node").agg(F.max("alive").alias("alive"))), MAX_BROADCAST_ROWS), "node")
    # an n-gram that only one set posted links nothing
    shared = met.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    buckets = stored(met.join(shared, "key"), "buckets")
    release(docs.sparkSession)
    labels = components(links(buckets, known, percent))
    least = firsts.join(labels, "node").groupBy("label").agg(F.min("first").alias("component"))
    found = labels.join(least, "label").select("node", "label", "component")
    placed = rows.select("id", "n", "own", "raw", "node", "b").join(firsts, ["node", "b"], "left").join(found, "node", "left")
    return placed.select("id", "own", "raw", "n", F.coalesce("label", "node").alias("group"),
                         F.when(F.col("label").isNull(), F.col("b")).otherwise(0).alias("half"),
                         F.coalesce("component", "first", "own").alias("component"))


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """One row per input row: key, n_shingles, component_id (least key reachable by links).

    Null and empty texts have an empty set and link with nothing (their own key is their component).
    Equal sets are linked. Rows that share a key are judged by their own texts. Rows without a key
    link like others; their component is null if no linked row has a key. Keys are numbers (or their decimal
    digits); any other key fails the cast.
    """
    kind = docs.schema[key].dataType
    placed = judged_rows(docs, key, text, ngram, percent)
    return placed.select(F.col("id").cast(kind).alias(key), F.col("n").alias("n_shingles"),
                         F.when(F.col("component") < LAST, F.col("component")).cast(kind).alias("component_id"))


def keep_one(docs: DataFrame, columns: list[str], key: str = "doc_id", text: str = "text", ngram: int = NGRAM,
             percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one with the least key (of different texts under that
    key, the one with the least digest). Rows are judged by key and text, so an unlike text under a key that
    is also another row's stays. Of repeated rows (equal key and text) the least one by ``columns`` stays;
    repeated rows without a set are one as well. Rows without a key stay, and do not stand for others that have one.
    """
    rows = stored(judged_rows(docs, key, text, ngram, percent).where("id IS NOT NULL").select("own", "raw", "n", "group", "half"), "judged")
    same = F.coalesce("raw", F.lit(b"")).alias("raw")     # a null text has no digest
    best = (rows.where("n > 0").groupBy("group", "half").agg(F.min(F.struct("own", "raw")).alias("best")).select("best.own", "best.raw"))
    gone = cut_lineage(rows.where("n > 0").select("own", "raw").distinct().join(best, ["own", "raw"], "left_anti"))
    again = cut_lineage(rows.select("own", same).groupBy("own", "raw").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("own", "raw"))
    digest = F.coalesce(F.unhex(F.md5(text)), F.lit(b""))
    source = docs.select(*columns, F.col(key).cast("long").alias("_own"), digest.alias("_raw"))
    named = lambda df: if_few(df.select(F.col("own").alias("_own"), F.col("raw").alias("_raw")), MAX_BROADCAST_ROWS)
    left = source.join(named(gone), ["_own", "_raw"], "left_anti")
    repeated = named(again)
    once = left.join(repeated, ["_own", "_raw"], "left_anti").select(*columns)
    least = (left.join(repeated, ["_own", "_raw"], "left_semi").groupBy("_own", "_raw")
             .agg(F.min(F.struct(*columns)).alias("_r")).select(*[F.col(f"_r.{c}").alias(c) for c in columns]))
    return once.unionByName(least)

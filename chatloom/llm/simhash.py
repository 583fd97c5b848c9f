"""SimHash near-duplicates by tiled exact comparison.

1. A text's fingerprint holds, per bit, what more than half of its shingle hashes hold. Equal fingerprints
   are collapsed; the rest works on distinct ones, eight bytes each.
2. Fingerprints fall into tiles by the population counts of their parts (PARTS consecutive runs of bits). Two
   fingerprints differ in at least as many bits as the counts of their parts do, so a pair of
   tiles whose counts differ by more than the radius, summed over the parts, is skipped. The other
   pairs of existing tiles are the unit of work. The number of parts is the least that keeps every
   tile within ``MOST`` fingerprints (or the finest), counted, not assumed.
3. In a task, a pair of tiles too large to compare at once is cut again in the same way: one part
   after the other is halved and sub-tiles out of reach of each other are skipped. What is left is compared in
   full by numpy exclusive-or and bit counts.
4. A task reports what it found as a star per connected group, not as pairs, so a group of thousands of near
   copies makes at most a row per fingerprint and tile pair. Components over the stars are those
   over all links.
"""
from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import if_few, stored
from chatloom.llm.jaccard_join import components
from chatloom.session import cut_lineage

NGRAM = 3
RADIUS = 2
BITS = 64
#: numbers of parts to choose from; also what one tile should hold at most
PARTS = (2, 4, 8, 16)
MOST = 1_000_000
#: pairs of fingerprints that are compared at once
CELLS = 1_000_000
MAX_BROADCAST_ROWS = 200_000
#: shingles whose bits are counted at once
CHUNK = 1 << 16


def fingerprint(body: bytes | None, ngram: int) -> int:
    """As an unsigned number. A text of fewer words is one shingle, a text without words is zero."""
    words = (body or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(ngram, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    n = len(starts)
    bits = np.zeros(BITS, np.int64)
    ends = ends[size - 1:].tolist()
    for at in range(0, n, CHUNK):
        hashes = [digest(joined[a:z], 42) for a, z in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])]
        flags = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        bits += flags.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, ngram: int) -> DataFrame:
    """(id, fp) per row of (id, text)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [fingerprint(b, ngram) for b in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])

    return docs.mapInArrow(run, f"id {kind}, fp long")


def tile_of(fp: Column, parts: int, radius: int) -> Column:
    """The population counts of the parts in one number, with room for a neighbour's at either end."""
    width = BITS // parts
    base = width + 1 + 2 * radius
    mask = (1 << width) - 1
    counts = [F.bit_count(F.shiftrightunsigned(fp, i * width).bitwiseAND(F.lit(mask).cast("long"))).cast("long") for i in range(parts)]
    total = F.lit(0).cast("long")
    for count in reversed(counts):
        total = total * base + count
    return total


def offsets(parts: int, radius: int) -> list[int]:
    """What lies between the numbers of two tiles within the radius, as non-negative numbers."""
    base = BITS // parts + 1 + 2 * radius
    found = {(0, 0)}                                      # (offset, sum of differences)
    for i in range(parts):
        found = {(o + d * base ** i, r + abs(d)) for (o, r), d in product(found, range(-radius, radius + 1)) if r + abs(d) <= radius}
    return sorted(o for o, _ in found if o >= 0)


def reach(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least node that each of ``n`` nodes is connected with by the edges (x, y)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Edges between the fingerprints of tile ``a`` and those of ``b`` (None: inside ``a``) that connect what
    all pairs within the radius connect. Nodes are places in ``a`` followed by ``b``."""
    whole = a if b is None else np.concatenate([a, b])
    found = []

    def compare(i: np.ndarray, j: np.ndarray, own: bool):
        step = max(1, cells // max(1, len(j)))
        for at in range(0, len(i), step):
            rows = i[at:at + step]
            x, y = np.nonzero(np.bitwise_count(whole[rows][:, None] ^ whole[j][None, :]) <= radius)
            if own:
                x, y = x[rows[x] < j[y]], y[rows[x] < j[y]]
            if len(x):                                  # a star per group instead of its pairs
                nodes, place = np.unique(np.concatenate([rows[x], j[y]]), return_inverse=True)
                to = reach(len(nodes), place[:len(x)], place[len(x):])
                moved = np.flatnonzero(to != np.arange(len(nodes)))
                found.append((nodes[moved], nodes[to[moved]]))

    def counts(nodes, low, width):
        return np.bitwise_count((whole[nodes] >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def groups(nodes, by):
        order = np.argsort(by, kind="stable")
        values, first = np.unique(by[order], return_index=True)
        return list(zip(values.tolist(), np.split(nodes[order], first[1:])))

    def cut(i, j, own, spare, parts):
        """``parts``: runs (low, width) still to be halved; ``spare``: what the radius leaves for them all.
        All fingerprints of a side have equal counts in each run."""
        if len(i) * len(j) <= cells or not parts:
            compare(i, j, own)
            return
        (low, width), *rest = parts
        half = width // 2
        if half:
            rest = [*rest, (low, half), (low + half, width - half)]
        left, right = groups(i, counts(i, low, half)), groups(j, counts(j, low, half))
        total_i, total_j = counts(i[:1], low, width)[0], counts(j[:1], low, width)[0]
        before = abs(int(total_i - total_j))
        for p, sub_i in left:
            for q, sub_j in right:
                if own and q < p:
                    continue
                after = abs(p - q) + abs(int(total_i - p) - int(total_j - q))
                if spare + before - after >= 0:
                    cut(sub_i, sub_j, own and p == q, spare + before - after, rest)

    # to begin with, the whole counts of both sides are compared: tiles hold fingerprints of any
    i, j, own = np.arange(len(a)), np.arange(len(a)) if b is None else np.arange(len(a), len(whole)), b is None
    if len(i) * len(j) <= cells:
        compare(i, j, own)
    else:
        left, right = groups(i, counts(i, 0, BITS)), groups(j, counts(j, 0, BITS))
        for p, sub_i in left:
            for q, sub_j in right:
                if abs(p - q) <= radius and not (own and q < p):
                    cut(sub_i, sub_j, own and p == q, radius - abs(p - q), [(0, BITS)])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x, y = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    nodes, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    to = reach(len(nodes), place[:len(x)], place[len(x):])
    moved = np.flatnonzero(to != np.arange(len(nodes)))
    return nodes[moved], nodes[to[moved]]


def links(prints: DataFrame, radius: int, most: int = MOST, parts: tuple[int, ...] = PARTS) -> DataFrame:
    """(x, y): edges that connect the same fingerprints as all pairs within the radius. ``prints``
    holds distinct fingerprints ``fp`` and is materialised."""
    fitting = [p for p in parts if (BITS // p + 1 + 2 * radius) ** p < 1 << 62]
    for n in fitting:
        tiled = prints.select("fp", tile_of(F.col("fp"), n, radius).alias("tile"))
        tiles = cut_lineage(tiled.groupBy("tile").agg(F.count(F.lit(1)).alias("n")))
        if tiles.where(F.col("n") > most).isEmpty():
            break
    near = F.explode(F.array(*[F.lit(o).cast("long") for o in offsets(n, radius)]))
    pairs = (tiles.select(F.col("tile").alias("s"), near.alias("o")).select("s", (F.col("s") + F.col("o")).alias("t"))
             .join(tiles.select(F.col("tile").alias("t")), "t"))
    pairs = if_few(cut_lineage(pairs.select("s", "t")), MAX_BROADCAST_ROWS)
    left = tiled.join(pairs, tiled["tile"] == pairs["s"]).select("s", "t", F.lit(False).alias("second"), "fp")
    right = tiled.join(pairs.where("s <> t"), tiled["tile"] == F.col("t")).select("s", "t", F.lit(True).alias("second"), "fp")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        prints = pdf["fp"].to_numpy().view(np.uint64)
        second = pdf["second"].to_numpy()
        a, b = prints[~second], prints[second]
        x, y = tile_links(a, b if pdf["s"].iloc[0] != pdf["t"].iloc[0] else None, radius)
        whole = np.concatenate([a, b]).view(np.int64)
        return pd.DataFrame({"x": whole[x], "y": whole[y]})

    return left.unionByName(right).groupBy("s", "t").applyInPandas(run, "x long, y long")


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", ngram: int = NGRAM, radius: int = RADIUS) -> DataFrame:
    """One row per input row: key, fingerprint (16 hex digits), component_id (least key reachable by
    fingerprints that differ in ``radius`` bits or fewer).

    Null and empty texts and texts without words have the fingerprint zero, which links like any other.
    Rows that share a key are rows of their own. Rows without a key link like others; their component is
    null if no linked row has a key.
    """
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = stored(fingerprints(source, ngram), "fingerprints")
    firsts = stored(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    labels = components(cut_lineage(links(firsts.select("fp"), radius)))
    linked = firsts.join(labels.withColumnRenamed("node", "fp"), "fp")
    least = linked.groupBy("label").agg(F.min("first").alias("least"))
    # only what is linked with another one moves twice
    found = labels.join(least, "label").select(F.col("node").alias("fp"), "least")
    # written, so that the join below has a plain exchange on both sides and a fingerprint of many rows can be split
    places = stored(firsts.join(found, "fp", "left").select("fp", F.coalesce("least", "first").alias("component")), "components")
    return rows.join(places, "fp").select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                          F.col("component").alias("component_id"))

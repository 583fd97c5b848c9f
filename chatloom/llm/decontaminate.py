"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become word sequences (letters and digits, case folded). A document
and an item that share a run of ``min_match`` words (a seed) are compared: the longest common run of
unmarked words is found by Karp-Rabin hashes (binary search over its length), all runs of that
length are marked without overlap, and so on until no run of ``min_match`` words is left. The marked
share of the item is its coverage; a reordered item is still covered tile by tile.

The benchmark is the stated query set. It is taken in blocks of bounded size, each sent to all tasks,
so documents never move.
"""
from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import map_batches
from chatloom.llm.words import window_hashes

MIN_MATCH = 5
COVERAGE = 0.7
#: items and characters per block: what one pass over the documents carries
BLOCK = 20_000
BLOCK_CHARS = 32_000_000

TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").casefold())


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted, non-empty ``known``."""
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values


def free_windows(marked: np.ndarray, size: int) -> np.ndarray:
    """Whether each window of ``size`` holds no marked word."""
    total = np.concatenate(([0], np.cumsum(marked)))
    return total[size:] == total[:-size]


def common_windows(a, b, mark_a, mark_b, size: int) -> list[tuple[int, int]]:
    """Pairs (start in a, start in b) of equal unmarked windows, verified word by word."""
    ha, hb = window_hashes(a, size), window_hashes(b, size)
    if not len(ha) or not len(hb):
        return []
    ia, ib = np.flatnonzero(free_windows(mark_a, size)), np.flatnonzero(free_windows(mark_b, size))
    ib = ib[np.isin(hb[ib], ha[ia])]
    if not len(ib):
        return []
    places = defaultdict(list)
    for i in ia.tolist():
        places[int(ha[i])].append(i)
    return [(i, j) for j in ib.tolist() for i in places.get(int(hb[j]), ()) if np.array_equal(a[i:i + size], b[j:j + size])]


def tile(a: np.ndarray, b: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of ``a`` in ``b``: (start in a, start in b, length), longest first."""
    mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    tiles = []
    longest = min(len(a), len(b))
    while longest >= min_match:
        # a common run of s words implies one of s - 1, so its greatest length is found by bisection
        low, high = min_match - 1, longest
        while low < high:
            mid = (low + high + 1) // 2
            if common_windows(a, b, mark_a, mark_b, mid):
                low = mid
            else:
                high = mid - 1
        longest = low
        if longest < min_match:
            break
        for i, j in sorted(common_windows(a, b, mark_a, mark_b, longest)):
            if not mark_a[i:i + longest].any() and not mark_b[j:j + longest].any():
                mark_a[i:i + longest] = 1
                mark_b[j:j + longest] = 1
                tiles.append((i, j, longest))
    return tiles


class Items:
    """One block of benchmark items with its seed index."""

    def __init__(self, rows: list[tuple], min_match: int, coverage: float):
        self.min_match, self.coverage = min_match, coverage
        self.words: dict[str, int] = {}
        self.items = []
        self.seeds = defaultdict(list)
        self.short = defaultdict(list)
        for key, text in rows:
            own = tokens(text)
            if not own:
                continue
            if len(own) < min_match:
                self.short[tuple(own)].append(key)
                continue
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in own], np.uint64)
            hashes = window_hashes(ids, min_match)
            for h in set(hashes.tolist()):
                self.seeds[h].append(len(self.items))
            self.items.append((key, ids, hashes))
        self.known = np.array(sorted(self.seeds), np.uint64)

    def hits(self, text: str | None):
        """(item id, coverage, tiles, longest tile) of the items whose coverage is reached."""
        get = self.words.get
        words, size = tokens(text), self.min_match
        # an item below the length of a seed says too little: only a document that is the item is a leak
        found = [(key, 1.0, 1, len(words)) for key in self.short.get(tuple(words), ())] if len(words) < size else []
        ids = np.array([get(w, 0) for w in words], np.uint64)
        own = window_hashes(ids, size)
        candidates = set()
        if len(self.known):
            for h in set(own[among(own, self.known)].tolist()):
                candidates.update(self.seeds[h])
        for c in sorted(candidates):
            key, item, hashes = self.items[c]
            # words under shared seeds bound the coverage from above
            shared = np.flatnonzero(np.isin(hashes, own))
            under = np.zeros(len(item) + 1, np.int64)
            np.add.at(under, shared, 1)
            np.add.at(under, shared + size, -1)
            if np.count_nonzero(np.cumsum(under)) < self.coverage * len(item):
                continue
            # words outside the benchmark (0) match nothing in an item, so only runs of known words count
            tiles = tile(item, ids, size)
            covered = sum(n for _, _, n in tiles) / len(item)
            if covered >= self.coverage:
                found.append((key, covered, len(tiles), max(n for _, _, n in tiles)))
        return found


def blocks(benchmark: DataFrame, key: str, text: str, block: int):
    """Benchmark rows in lists of about ``block`` rows and BLOCK_CHARS characters: split by hash, so every row is in one list."""
    rows = benchmark.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    n, chars = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    parts = max(1, -(-n // block), -(-chars // BLOCK_CHARS))
    for p in range(parts):
        own = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(parts)) == p)
        yield [(r["k"], r["t"]) for r in own.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
               item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """One row per document and benchmark item that it covers to ``coverage`` or more: key, item key,
    coverage, n_tiles, longest. Documents without such an item have no row.

    Null and empty documents and items match nothing. Repeated rows on either side give a row each.
    An item shorter than ``min_match`` words is covered only by a document of the same words and no others.
    """
    kind, item_kind = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, coverage double, n_tiles long, longest long"
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    out = None
    for rows in blocks(benchmark, item_key, item_text, block):
        def run(batches, rows=rows):
            items = Items(rows, min_match, coverage)
            for b in batches:
                got = [(d, *hit) for d, t in zip(b["id"], b["text"]) for hit in items.hits(t)]
                if got:
                    yield dict(zip(["id", "item", "coverage", "n_tiles", "longest"], zip(*got)))

        part = map_batches(source, schema, run)
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("id").alias(key), F.col("item").alias(item_key), "coverage", "n_tiles", "longest")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
               min_match: int = MIN_MATCH, coverage: float = COVERAGE, block: int = BLOCK) -> DataFrame:
    """``docs``, same columns, without the rows that cover a benchmark item. Rows are filtered where
    they are: nothing is joined or shuffled."""
    import pyarrow as pa

    for rows in blocks(benchmark, item_key, item_text, block):
        def run(batches, rows=rows):
            items = Items(rows, min_match, coverage)
            for b in batches:
                yield b.filter(pa.array([not items.hits(t) for t in b.column(text).to_pylist()]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

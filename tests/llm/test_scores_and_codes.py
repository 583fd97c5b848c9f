"""Importance resampling, SimHash components and vector codes against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chatloom.llm import importance_resample, simhash, vector_codes
from tests.llm.brute import lower, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


# ------------------------------------------------------------------ importance resampling

def grams(text, n_max):
    w = TERM.findall(lower(text or ""))
    return [" ".join(w[i:i + n]) for n in range(1, n_max + 1) for i in range(len(w) - n + 1)]


def brute_resample(rows, target, n_max=1, buckets=10_000, min_words=20, percent=10, seed="2024"):
    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, grams(text, n_max)))
    for text in target:
        t.update(map(bucket, grams(text, n_max)))
    whole_s, whole_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for doc, text in rows:
        own = [math.floor(1000 * math.log((t[b] + 1) * whole_s / ((s[b] + 1) * whole_t))) for b in map(bucket, grams(text, n_max))]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        n_words = len(grams(text, 1))
        out.append([doc, n_words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[1]))
    for i, r in enumerate(fit[:percent * len(fit) // 100]):
        r[5] = i + 1
    return out


def same(df, expected):
    assert Counter(map(tuple, df.collect())) == Counter(map(tuple, expected))


TARGET = ["w1 w2 w3 the same passage", "again and again w5 w6\nw7", None, "", "W1 w1 é"]


@pytest.mark.parametrize("ngram,percent", [(1, 10), (1, 100), (2, 30), (3, 0)])
def test_resample_equals_brute_force(spark, docs, texts, ngram, percent):
    target = spark.createDataFrame([(i, t) for i, t in enumerate(TARGET)], "item_id long, text string")
    got = importance_resample.resample(docs, target, ngram=ngram, percent=percent)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    same(got, brute_resample(texts, TARGET, ngram, percent=percent))


def test_runs_over_line_breaks_are_counted_once(spark):
    texts = ["a b\nc\n\nd e", "a b\nc\n\nd e", "x\ny", "\n", None, "c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = importance_resample.bucket_counts(df, "text", 3, 997)
    expected = Counter(zlib.crc32(g.encode()) % 997 for t in texts for g in grams(t, 3))
    assert {b: n for b, n in enumerate(got.tolist()) if n} == dict(expected)


def test_resample_ties_and_hot_keys(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text)] * 40 + [(None, text)] * 30 + [(i, text + f" x{i}") for i in range(20, 60)]
    got = importance_resample.resample(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                                       spark.createDataFrame([], "text string"), percent=60)
    same(got, brute_resample(rows, [], percent=60))
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 67))


def test_resample_awkward_tables(spark, no_docs):
    assert importance_resample.resample(no_docs, no_docs).collect() == []
    clash = spark.createDataFrame([(1, "a b", 5, 6, 7, 8, "z")], "doc_id long, text string, rank int, score int, times int, bucket int, id string")
    got = importance_resample.resample(clash, clash, min_words=1, percent=100).collect()
    assert [(r["doc_id"], r["n_features"], r["rank"]) for r in got] == [(1, 2, 1)]


# ------------------------------------------------------------------ simhash

def brute_print(text, n=3):
    w = words(lower(text or ""))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), seed=42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(prints, radius):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash_equals_brute_force(docs, texts):
    prints = [brute_print(t) for _, t in texts]
    for radius in (2, 9):
        groups = reachable(prints, radius)
        least = {}
        for g, (doc, _) in zip(groups, texts):
            if doc is not None:
                least[g] = min(least.get(g, doc), doc)
        got = simhash.simhash_components(docs, radius=radius)
        same(got, [(doc, f"{p:016x}", least.get(g)) for (doc, _), p, g in zip(texts, prints, groups)])


def test_simhash_empty_and_clashing(spark, no_docs):
    assert simhash.simhash_components(no_docs).collect() == []
    clash = spark.createDataFrame([(3, None, 1, "a"), (2, " \n", 1, "b"), (None, "one", 1, "c")], "doc_id long, text string, fp int, tile string")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.simhash_components(clash).collect()}
    assert got == {(3, 2), (2, 2), (None, None)}


def clustered(rng, n, centres=6):
    """Random fingerprints, and chains of ones that differ in a bit or two."""
    out = {rng.getrandbits(64) for _ in range(n)}
    for _ in range(centres):
        at = rng.getrandbits(64)
        for _ in range(n // centres):
            at ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                at ^= 1 << rng.randrange(64)
            out.add(at)
            if rng.random() < 0.1:
                at ^= rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)
    return sorted(out | {0, (1 << 64) - 1, 1, 6})


def connected(n, edges, radius, prints):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, y in edges:
        parent[find(x)] = find(y)
    groups, expected = [find(i) for i in range(n)], reachable(prints, radius)
    assert len(set(groups)) == len(set(expected)) == len(set(zip(groups, expected)))


@pytest.mark.parametrize("cells", [1, 50, 3000, 10_000_000])
def test_tiles_cut_at_any_size_lose_no_link(cells):
    rng = random.Random(cells)
    prints = clustered(rng, 300)
    a = np.array(prints, np.uint64)
    x, y = simhash.tile_links(a, None, 2, cells)
    connected(len(a), zip(x.tolist(), y.tolist()), 2, prints)
    assert len(x) < len(a)
    # two tiles: only links between them
    left, right = a[::2], a[1::2]
    x, y = simhash.tile_links(left, right, 3, cells)
    both = np.concatenate([left, right]).tolist()
    expected = {(i, j + len(left)) for i, p in enumerate(left.tolist()) for j, q in enumerate(right.tolist()) if (p ^ q).bit_count() <= 3}
    got, want = Counter(), Counter()
    for e, c in ((zip(x.tolist(), y.tolist()), got), (expected, want)):
        parent = list(range(len(both)))
        for i, j in e:
            while parent[i] != i:
                i = parent[i]
            while parent[j] != j:
                j = parent[j]
            parent[max(i, j)] = min(i, j)
        for i in range(len(both)):
            k = i
            while parent[k] != k:
                k = parent[k]
            c[i] = k
    assert got == want


@pytest.mark.parametrize("most", [10_000, 40, 3, 1])
def test_tile_pairs_at_any_number_of_parts(spark, most):
    prints = clustered(random.Random(9), 400)
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long").repartition(3).cache()
    edges = [(r["x"] & (1 << 64) - 1, r["y"] & (1 << 64) - 1) for r in simhash.links(df, 2, most).collect()]
    place = {p: i for i, p in enumerate(prints)}
    connected(len(prints), [(place[x], place[y]) for x, y in edges], 2, prints)


def test_a_large_group_of_near_copies_makes_no_pairs():
    rng = random.Random(2)
    base = rng.getrandbits(64)
    group = sorted({base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)})
    x, _ = simhash.tile_links(np.array(group, np.uint64), None, 2)
    assert len(x) == len(group) - 1


# ------------------------------------------------------------------ vector codes

def brute_codes(rows, parts, entries, rounds):
    kept = []
    for key, vector, label in rows:
        if vector and len(vector) % parts == 0 and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [max(-(1 << 20), min(1 << 20, math.floor(256 * x))) for x in vector], label))
    firsts = {}
    for key, v, _ in kept:
        if key is not None:
            firsts[key] = min(firsts.get(key, v), v)
    if not firsts:
        return []
    dims = len(firsts[min(firsts)])
    kept = [r for r in kept if len(r[1]) == dims]
    w = dims // parts
    cut = lambda v: [v[p * w:(p + 1) * w] for p in range(parts)]
    start = [cut(firsts[k]) for k in sorted(firsts)[:entries] if len(firsts[k]) == dims]
    books = [[s[p] for s in start] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min(range(len(books[p])), key=lambda k: (far(x, books[p][k]), k)) for p, x in enumerate(cut(v))] for _, v, _ in kept]

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), c in zip(kept, codes) if c[p] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    codes = assign()
    errors = [sum(far(x, books[p][k]) for p, (x, k) in enumerate(zip(cut(v), c))) for (_, v, _), c in zip(kept, codes)]
    per = Counter()
    for (_, _, label), e in zip(kept, errors):
        per[label] += e
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [(key, bytes(c).hex(), e, per[label], sha) for (key, _, label), c, e in zip(kept, codes, errors)]


SCHEMA = "vec_id long, embedding array<float>, label int"


def vector_rows(seed, n, dims, centres=5):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(centres)]
    rows = [(i * 7 % (n * 2), [float(np.float32(m + rng.gauss(0, 0.05))) for m in rng.choice(middle)], rng.choice([1, 2, 3, None])) for i in range(n)]
    rows += [rows[0], rows[0], (rows[1][0], [0.0] * dims, 1), (None, [0.5] * dims, 2), (None, None, None), (-5, None, 1),
             (-4, [float("nan")] * dims, 1), (-3, [float("inf")] * dims, 1), (-2, [None] + [0.1] * (dims - 1), 1), (n * 9, [], 1),
             (n * 9 + 1, [0.25] * (dims * 2), 1), (n * 9 + 2, [0.25] * (dims + 1), 1), (n * 9 + 3, [1e30, -1e30] + [0.0] * (dims - 2), 1)]
    rows += [(n * 10 + i, [0.125] * dims, 4) for i in range(n // 2)]          # a hot vector
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,dims,parts,entries,rounds", [(300, 8, 2, 16, 4), (200, 12, 3, 40, 2), (30, 8, 4, 64, 3), (60, 4, 4, 5, 6), (40, 6, 1, 1, 2)])
def test_codes_equal_brute_force(spark, n, dims, parts, entries, rounds):
    rows = vector_rows(n, n, dims)
    got = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), parts=parts, entries=entries, rounds=rounds)
    same(got, brute_codes(rows, parts, entries, rounds))


def test_bounds_settle_like_the_full_comparison():
    rng = np.random.default_rng(4)
    for entries, b in ((32, 4), (32, 1), (9, 8), (2, 1), (1, 1)):
        x = rng.integers(-40, 40, (400, 3))
        book = rng.integers(-40, 40, (entries, 3))
        near, bounds = vector_codes.closest(x, book, b)
        for step in range(5):
            new = book + rng.integers(-6, 7, book.shape) * (rng.random(entries) < 0.5)[:, None]
            if step == 3:
                new[-1] = new[0]                                           # a tie with a lower index
            near, bounds, need = vector_codes.settle(x, near, bounds, new, vector_codes.movement(book, new))
            squares = ((x[:, None] - new[None]) ** 2).sum(2)
            assert (near[:, 0] == squares.argmin(1)).all()
            # what the bounds promise
            own = np.sqrt(np.take_along_axis(squares, near, 1)) * vector_codes.UNIT
            assert (own[:, 0] <= bounds[:, 0]).all() and (own[:, 1:] >= bounds[:, 1:-1]).all()
            others = squares.astype(float)
            np.put_along_axis(others, near, np.inf, 1)
            assert (np.sqrt(others.min(1)) * vector_codes.UNIT >= np.minimum(bounds[:, -1], vector_codes.FAR)).all() or entries <= near.shape[1]
            assert need.min() >= 1 and need.max() <= near.shape[1] + 1
            if near.shape[1] > 2:
                near, bounds = (a[:, 0] for a in vector_codes.shorten(near[:, None], bounds[:, None], near.shape[1] - 1))
            book = new


def test_lists_get_shorter_and_spare_comparisons(spark):
    """After a small movement most parts keep their entry unseen."""
    rng = np.random.default_rng(1)
    book = rng.integers(-200, 200, (64, 4))
    x = book[rng.integers(0, 64, 5000)] + rng.integers(-8, 9, (5000, 4))
    near, bounds = vector_codes.closest(x, book, 8)
    new = book + rng.integers(-1, 2, book.shape)
    _, _, need = vector_codes.settle(x, near, bounds, new, vector_codes.movement(book, new))
    assert (need == 1).mean() > 0.9


def test_codes_of_awkward_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    got = vector_codes.compress(empty)
    assert got.collect() == [] and got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    clash = spark.createDataFrame([(1, [0.5] * 16, 3, 4, "x", 5)], "vec_id long, embedding array<double>, label int, error int, code string, id int")
    assert [(r["vec_id"], r["code"], r["error"]) for r in vector_codes.compress(clash).collect()] == [(1, "00" * 16, 0)]
    with pytest.raises(ValueError, match="256"):
        vector_codes.compress(clash, entries=300)


def test_codes_do_not_depend_on_the_layout(spark):
    df = spark.createDataFrame(vector_rows(3, 200, 8), SCHEMA)
    results = [Counter(map(tuple, vector_codes.compress(df.repartition(n), parts=2, entries=16).collect())) for n in (1, 7)]
    assert results[0] == results[1]
    assert df.where(F.col("vec_id").isNull()).count() == 2

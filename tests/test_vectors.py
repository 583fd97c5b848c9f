"""Look-alike vectors against brute force, and the rows that survive."""
import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from chatloom.operators import vectors as V

SCHEMA = "vec_id long, embedding array<float>"


def clouds(seed, n, dims=24, spread=0.045):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        centre = rng.normal(size=dims)
        centre /= np.linalg.norm(centre)
        for _ in range(int(rng.integers(1, 7))):
            rows.append((len(rows) * 3, (centre + rng.normal(scale=spread, size=dims)).astype(np.float32).tolist()))
    return rows


def cosines(rows):
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    return x @ x.T


def test_recall_and_precision_against_brute_force(spark):
    rows = clouds(1, 150)
    cos, place = cosines(rows), {k: i for i, (k, _) in enumerate(rows)}
    kept = {r.vec_id: r.keep_id for r in V.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert set(kept) == set(place) and all(kept[k] <= k for k in kept)
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if cos[i, j] >= 0.9]
    groups = [kept[k] for k, _ in rows]
    found = sum(groups[i] == groups[j] for i, j in pairs)
    assert len(pairs) > 100 and found / len(pairs) >= 0.9
    # no group holds anything that pairs of its members do not connect
    parent = list(range(len(rows)))
    for i, j in pairs:
        a, b = i, j
        while parent[a] != a:
            a = parent[a]
        while parent[b] != b:
            b = parent[b]
        parent[a] = b
    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    assert all(root(i) == root(place[groups[i]]) for i in range(len(rows)))
    # of those kept, few are alike
    left = [i for i, (k, _) in enumerate(rows) if kept[k] == k]
    assert sum(cos[i, j] >= 0.9 for i in left for j in left if j < i) <= 0.1 * len(pairs)


def test_the_plan_follows_size_and_threshold():
    for n, t, recall in ((100, 0.9, 0.95), (10 ** 6, 0.9, 0.95), (10 ** 10, 0.95, 0.9)):
        bands, rows = V.plan(n, t, recall)
        hit = V.agreement(t) ** rows
        assert 1 - (1 - hit) ** bands >= recall and n / 2 ** rows <= V.CROWD
    assert V.plan(10, 1.0, 0.9)[0] == 1


def test_hot_and_awkward_vectors(spark):
    rng = random.Random(3)
    one = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(100 + i, one) for i in range(200)] + [(500 + i, [x * 2 for x in one]) for i in range(50)]
    rows += [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(40)]
    rows += [(7, one), (None, one), (60, None), (61, [float("nan")] * 8), (62, [0.0] * 8), (63, [None] + [1.0] * 7), (64, []), (65, one[:4]),
             (66, [x * 1e30 for x in one]), (67, [math.inf] + one[1:])]
    got = Counter((r.vec_id, r.keep_id) for r in V.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), threshold=0.999).collect())
    assert sum(got.values()) == len(rows)
    unit = lambda v: [x / math.sqrt(sum(y * y for y in v)) for x in v]
    least = 7 if unit(one) < unit(next(v for k, v in rows if k == 7)) else 66
    assert all(got[100 + i, least] == 1 for i in range(200)) and all(got[500 + i, least] == 1 for i in range(50)) and got[66, least] == 1 and got[7, 7] == 2
    assert got[None, None] == 1 and all(got[k, k] == 1 for k in (60, 61, 62, 63, 64, 65, 67))
    assert V.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, [1.0], 2, "x"), (2, [2.0], 2, "y")], "vec_id long, embedding array<double>, id int, v string")
    assert sorted(map(tuple, V.near_vectors(clash).collect())) == [(1, 1), (2, 1)]


def test_a_group_of_copies_costs_one_pair_each(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = rng.normal(size=32)
    rows = [(i, (base + rng.normal(scale=0.01, size=32)).tolist()) for i in range(400)]
    met = []
    real = V.alike

    def counted(pairs, units, threshold):
        met.append(pairs.count())
        return real(pairs, units, threshold)

    monkeypatch.setattr(V, "alike", counted)
    kept = V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.keep_id for r in kept} == {0}
    assert sum(met) < 10 * len(rows)


def test_survivors_come_out_under_a_new_revision(spark):
    rows = [(c, p, f"q{q}" if p == 0 else "a", "user" if p == 0 else "assistant", "t", "base", i)
            for i, (c, q) in enumerate([("c1", 1), ("c2", 2), ("c3", 1), ("c4", 3)]) for p in range(2)]
    rows += [("c9", 0, "", "none", "t", "base", 9), ("d1", 0, "q1", "user", "t", "old", 1)]
    training = spark.createDataFrame(rows, "conversation string, position int, content string, role string, trainer string, revision string, source long")
    embed = lambda q: F.when(q == "q1", F.array(F.lit(1.0), F.lit(0.0))).when(q == "q2", F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.lit(-1.0), F.lit(0.5)))
    out = V.deduplicate_training(training, embed, "base", "unique").collect()
    assert {r.revision for r in out} == {"unique"} and len(out) == 7
    assert {r.conversation for r in out} == {"c1", "c2", "c4", "c9"}


def test_members_of_a_bucket_meet_without_joined_pairs(spark, monkeypatch):
    rows = clouds(5, 250)
    asked = []
    monkeypatch.setattr(V, "alike", lambda pairs, units, threshold: asked.append(pairs.count()))
    V.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(asked) == 0                              # pairs that were joined with both vectors, most of them unlike
    rows = rows[:300]
    members = spark.createDataFrame([(i, 0, 0, len(rows)) for i, _ in rows], "id long, band int, bucket long, n long")
    for most in (8, 64, 1000):
        monkeypatch.setattr(V, "MANY", most)
        met = V.meetings(members).groupBy("part").agg(F.collect_list("id").alias("ids")).collect()
        pairs = {(a, b) for r in met for a in r.ids for b in r.ids if a < b}
        assert len(pairs) == len(rows) * (len(rows) - 1) // 2 and sum(len(r.ids) for r in met) <= len(rows) * max(1, 2 * len(rows) / most)


def test_huge_buckets_are_thinned_and_met_in_blocks_with_the_same_links(spark, monkeypatch):
    rows = clouds(6, 60) + [(10_000 + i, [1.0] * 23 + [i / 500]) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = Counter(map(tuple, V.near_vectors(df).collect()))
    asked, real = [], V.alike

    def counted(pairs, units, threshold):
        asked.append(pairs.count())
        return real(pairs, units, threshold)

    monkeypatch.setattr(V, "alike", counted)
    monkeypatch.setattr(V, "MANY", 8)
    monkeypatch.setattr(V, "HUGE", 40)
    assert Counter(map(tuple, V.near_vectors(df).collect())) == want
    assert 0 < sum(asked) < 20 * len(rows) and want[10_119, 10_000] == 1


def test_an_index_leads_to_the_least_one_linked():
    near = np.eye(6, dtype=bool)
    for a, b in ((0, 5), (5, 3), (1, 4)):
        near[a, b] = near[b, a] = True
    assert V._least(near).tolist() == [0, 1, 2, 0, 1, 0] and V._least(np.eye(3, dtype=bool)).tolist() == [0, 1, 2]

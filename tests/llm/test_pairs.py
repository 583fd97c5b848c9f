"""Substring dedup and the Jaccard join against brute force."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from chatloom.llm import jaccard_join, substring_dedup
from chatloom.llm.fm_index import BitRank, FMIndex
from chatloom.llm import words as words_module
from chatloom.llm.words import hashed, sliding, window_hashes
from tests.llm.brute import components, shingles, substring, words
from tests.llm.conftest import prose

SORT = lambda rows: sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_window_hashes_and_sliding():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 4, 300).astype(np.uint64)
    for size in (1, 2, 3, 5, 8, 50):
        h = window_hashes(ids, size)
        for i in range(0, len(h), 7):
            for j in range(0, len(h), 5):
                assert (h[i] == h[j]) == bool((ids[i:i + size] == ids[j:j + size]).all())
        want = [min(ids[i:i + size]) for i in range(len(ids) - size + 1)]
        assert sliding(np.minimum, ids, size).tolist() == want
    assert len(window_hashes(ids[:3], 5)) == 0 == len(sliding(np.minimum, ids[:3], 5))


def test_hashed_words(monkeypatch, texts):
    own = [t for _, t in texts] + ["x" * 47 + " " + "x" * 48 + " " + "x" * 49 + " " + "y" * 40000, "A a \u00c9 \u00e9", "\x00 \x00\x00", " lead", "trail "]
    known = {}
    for chunk in (1, 500, 1 << 20):
        monkeypatch.setattr(words_module, "CHUNK", chunk)
        for lower in (False, True):
            got = list(hashed(own, lower))
            assert len(got) == len(own)
            for text, ids in zip(own, got):
                body = (text or "").encode()
                split = (body.lower() if lower else body).split()
                assert len(split) == len(ids)
                for w, h in zip(split, ids.tolist()):
                    assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known) > 1000


def test_bit_rank():
    bits = np.random.default_rng(1).integers(0, 2, 1000).astype(np.uint8)
    ranks = BitRank(bits)
    assert ranks.ones(np.arange(1001)).tolist() == [int(bits[:i].sum()) for i in range(1001)]


@pytest.mark.parametrize("alphabet,least", [(2, 3), (3, 4), (12, 3)])
def test_fm_index_intervals(alphabet, least):
    rng = random.Random(alphabet)
    seqs = [np.array([rng.randrange(1, alphabet + 1) for _ in range(rng.randint(1, 14))]) for _ in range(40)]
    owner = np.array([rng.randrange(12) for _ in seqs], np.int32)
    order = np.argsort(owner, kind="stable")
    seqs, owner = [seqs[i] for i in order], owner[order]
    found = FMIndex(seqs, owner, alphabet + 1).earlier_matches(seqs, owner, least)
    for s, o, f in zip(seqs, owner, found):
        starts = {i for i in range(len(s) - least + 1) for t, p in zip(seqs, owner) if p < o
                  for j in range(len(t) - least + 1) if (s[i:i + least] == t[j:j + least]).all()}
        want = {i + d for i in starts for d in range(least)}
        assert {w for a, z in f for w in range(a, z)} == want


@pytest.mark.parametrize("window", [50, 8, 12])
def test_substring_dedup_equals_brute_force(docs, texts, window):
    got = substring_dedup.dedup_substrings(docs.withColumnRenamed("n_chars", "n_words"), window=window).collect()
    assert SORT(map(tuple, got)) == SORT(substring(texts, window))


def test_drop_repeats_cuts_words_out_of_the_texts(docs, texts):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    got = substring_dedup.drop_repeats(docs, columns, size="n_chars").collect()
    want = SORT((d, s) for (d, n, gone, s) in substring(texts) if not (n and gone == n))
    import hashlib
    assert SORT((r.doc_id, hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest()) for r in got) == want
    originals = {t for _, t in texts}
    for r in got:
        assert r.text in originals or r.n_chars == len(r.text)
    assert substring_dedup.cut_words(" a  b\tc\n", np.array([False, True, False])) == " a  c\n"


SEARCH_SHARD = substring_dedup.search_shard


def bounded_search(window):
    def run(pdf):
        assert len(pdf) <= 30, len(pdf)
        return SEARCH_SHARD(window)(pdf)
    return run


def test_no_shard_holds_more_than_its_bound(spark, docs, texts, monkeypatch):
    # a phrase of the least hash, each time between other words: one seed in ever new passages
    monkeypatch.setattr(substring_dedup, "search_shard", bounded_search)
    monkeypatch.setattr(substring_dedup, "MOST", 30, raising=False)
    monkeypatch.setattr(substring_dedup, "SHARD", 10)
    rng = random.Random(3)
    say = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    phrase = min((say(8) for _ in range(2000)), key=lambda p: int(window_hashes(next(hashed([" ".join(p)])), 8)[0]))
    rows = [(i, " ".join(say(60) + phrase + say(60))) for i in range(60)]
    rows += [(100 + i, " ".join(say(5) + t.split()[20 + i:90 + i] + say(5))) for i, (_, t) in enumerate(rows[:20])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert SORT(map(tuple, substring_dedup.dedup_substrings(frame).collect())) == SORT(substring(rows))
    monkeypatch.setattr(substring_dedup, "MOST", 0, raising=False)     # every passage by its windows
    got = substring_dedup.dedup_substrings(docs.withColumnRenamed("n_chars", "n_words"), window=12).collect()
    assert SORT(map(tuple, got)) == SORT(substring(texts, 12))


def rows_of_one_id(seed=9):
    """Rows without an id, and rows of one id, that share passages, are near copies or repeat."""
    rng = random.Random(seed)
    say = lambda n: " ".join(f"u{rng.randrange(10**6)}" for _ in range(n))
    passage, base = say(60), say(100)
    rows = [(1, say(5) + " " + passage), (2, base + " end")]
    for doc in (None, 7):
        rows += [(doc, say(10) + " " + passage + " " + say(8)) for _ in range(40)]
        rows += [(doc, base + " " + say(3)) for _ in range(40)]
        rows += [(doc, passage + " " + base)] * 40
    return rows


def test_rows_of_one_id_meet_no_texts_but_their_own(spark, monkeypatch):
    rows = rows_of_one_id()
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    counts = {}

    def counted(module, name):
        real = getattr(module, name)

        def run(df, *args):
            counts[name] = max(counts.get(name, 0), df.count())
            return real(df, *args)
        monkeypatch.setattr(module, name, run)

    counted(substring_dedup, "passages")
    counted(substring_dedup, "map_batches")     # whatever Python is handed: rows with their texts
    counted(jaccard_join, "enough_shared")
    assert SORT(map(tuple, substring_dedup.dedup_substrings(frame).collect())) == SORT(substring(rows))
    kept = substring_dedup.drop_repeats(frame, ["doc_id", "text"])
    import hashlib
    got = SORT((r.doc_id, hashlib.sha256(" ".join(words(r.text)).encode()).hexdigest()) for r in kept.collect())
    assert got == SORT((d, s) for d, n, gone, s in substring(rows) if gone < n)
    counted(jaccard_join, "map_batches")
    assert SORT(map(tuple, jaccard_join.jaccard_components(frame).collect())) == SORT(components(rows))
    distinct = len(set(rows))
    assert counts["passages"] <= distinct and counts["enough_shared"] <= distinct
    assert counts["map_batches"] <= len(rows)


def test_texts_of_the_same_words_keep_their_own_white_space(spark):
    rng = random.Random(10)
    passage, tail = ([f"v{rng.randrange(10**6)}" for _ in range(n)] for n in (60, 3))
    rows = [(1, " ".join(passage)), (2, " ".join(passage + tail)), (2, "\n".join(passage) + "\n" + "\t".join(tail))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in substring_dedup.drop_repeats(frame, ["doc_id", "text"]).collect()]
    assert SORT(got) == SORT([rows[0], (2, " ".join(tail)), (2, "\t".join(tail))])


def test_substring_dedup_empty(no_docs):
    assert substring_dedup.dedup_substrings(no_docs).count() == 0


def test_jaccard_components_equal_brute_force(docs, texts):
    got = jaccard_join.jaccard_components(docs.withColumnRenamed("source", "component_id")).collect()
    assert SORT(map(tuple, got)) == SORT(components(texts))


def test_jaccard_random_small_sets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 12)))) for i in range(150)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert SORT(map(tuple, got)) == SORT(components(rows))


def test_jaccard_large_group_of_near_copies(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(200), rng.choice([0, 1, 2, 3, 5, 9])):
            w[at] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    # a passage that makes up more than half of unlike documents
    rows += [(1000 + i, " ".join(base[:60] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))])) for i in range(60)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert SORT(map(tuple, got)) == SORT(components(rows))


def test_jaccard_links_outside_the_first_sets_reach(spark):
    # members too far from the original that link only with each other: by shared changes, or by shared losses
    rng = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(base[:at] + [f"e{i}"] + base[at + 1:])) for i, at in enumerate(rng.sample(range(150), 30))]
    for g in range(6):
        changed = list(base)
        for at in rng.sample(range(150), 8):
            changed[at] = f"g{g}"
        rows += [(100 + 10 * g + i, " ".join(changed[:at] + [f"f{g}{i}"] + changed[at + 1:])) for i, at in enumerate(rng.sample(range(150), 3))]
        cut = base[:20 * g] + base[20 * g + rng.randint(28, 40):]
        rows += [(200 + 10 * g + i, " ".join(cut[i:len(cut) - i])) for i in range(4)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = components(rows)
    assert SORT(map(tuple, got)) == SORT(want)
    assert 5 < len({c for _, _, c in want}) < 40


def test_jaccard_widens_a_fragment_that_is_too_narrow(spark, monkeypatch):
    # with no spare standard deviations some sets do not fit, so the loop must widen
    rng = random.Random(7)
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randint(20, 40)))) for i in range(40)]
    rows += [(100 + i, t + " tail") for i, t in rows[:20]]
    real, seen = jaccard_join.summaries, []

    def narrow(docs, ngram, percent, sigmas):
        seen.append(sigmas)
        return real(docs, ngram, percent, sigmas - 6.0)

    monkeypatch.setattr(jaccard_join, "summaries", narrow)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    jaccard_join.jaccard_components(frame)
    assert len(seen) > 1


def kept_rows(rows):
    """Brute force of keep_one over (doc_id, text): by rows, whatever rows share an id."""
    sets = [shingles(t) for _, t in rows]
    groups = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                old, new = groups[i], groups[j]
                groups = [new if g == old else g for g in groups]
    digest = lambda t: hashlib.md5(t.encode()).digest() if t is not None else b""
    best = {}
    for (d, t), g, s in zip(rows, groups, sets):
        if s and d is not None:
            best[g] = min(best.get(g, (1 << 63, b"")), (d, digest(t)))
    out = Counter()
    for (d, t), g, s in zip(rows, groups, sets):
        if d is None:
            out[d, t] += 1
        elif not s or best[g] == (d, digest(t)):
            out[d, t] = 1
    return out


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_keep_one(docs, texts, no_docs):
    kept = jaccard_join.keep_one(docs, COLUMNS).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == kept_rows(texts)
    comp = components(texts)
    assert {r.doc_id for r in kept if r.doc_id is not None} == {c for d, _, c in comp if d is not None}
    assert sum(r.doc_id is None for r in kept) == sum(d is None for d, _ in texts)
    assert jaccard_join.keep_one(no_docs, COLUMNS).count() == 0


def test_keep_one_judges_texts_that_share_an_id(spark):
    rng = random.Random(5)
    a, b, c, d = (prose(rng, 60, 5000) for _ in range(4))
    rows = [(3, a), (7, a + " z"), (7, b), (11, c), (11, d), (12, c + " y"), (11, c + " x"), (13, None), (13, ""), (13, None), (7, b)]
    hot = prose(rng, 80, 5000)                            # a third of all rows under one id, unlike and alike
    rows += [(20, prose(rng, 40, 5000)) for _ in range(6)] + [(20, hot + f" v{i}") for i in range(6)] + [(2, hot)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, t, "en" if n % 2 else None, "s", n) for n, (i, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = jaccard_join.keep_one(df, COLUMNS).collect()
    got = Counter((r.doc_id, r.text) for r in kept)
    assert got == kept_rows(rows)
    assert got[7, b] == 1 and (7, a + " z") not in got and got[3, a] == 1 and got[11, d] == 1
    assert sum(n for (i, t), n in got.items() if i == 11 and t != d) == 1 and sum(n for (i, _), n in got.items() if i == 20) == 6

"""Toxicity, packing, HTML extraction, decontamination."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chatloom.llm import decontaminate, html_blocks, html_extract, packing, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


# ------------------------------------------------------------------ toxicity

def toxic_tables(spark, n=900):
    rng = random.Random(3)
    stems = ["blargo", "zwitti", "krauneb"]
    docs, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('abcdefgh')}{rng.randrange(300)}".replace("1", "i").replace("0", "o") for _ in range(rng.randint(5, 60))]
        words = ["".join(chr(97 + (ord(c) * 7) % 26) for c in w) for w in words]
        bad = rng.random() < 0.25
        if bad:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(stems) + rng.choice(["", "en", "ique", "as"]))
        docs.append((i, " ".join(words), "x", "s", 1.0))
        if rng.random() < 0.8:
            labels.append((i, 0, int(bad)))
    docs += [(n, None, None, None, 0.5), (n + 1, "", "x", "s", 0.5), (n + 2, "!" * 5000, "x", "s", 0.5), (n + 3, "a " * 40000, "x", "s", 0.5), docs[0],
             (None, "blargoen", "x", "s", 0.1)]
    labels += [(None, 1, 1), (5, None, None), labels[0]]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score double").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_held_out(spark):
    docs, labels = toxic_tables(spark)
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 80
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    pos = [r.score for r in held if truth[r.doc_id]]
    neg = [r.score for r in held if not truth[r.doc_id]]
    assert np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg]) > 0.97


def test_toxicity_held_out_labels_teach_nothing(spark):
    docs, labels = toxic_tables(spark, 300)
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda rows: sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 9)) for r in rows)
    assert key(toxicity.score_toxicity(docs, labels).collect()) == key(toxicity.score_toxicity(docs, flipped).collect())


def test_toxicity_without_labels_or_rows(spark):
    docs, labels = toxic_tables(spark, 20)
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.features("", toxicity.Lexicon()) == [0.0] * len(toxicity.FEATURES)
    assert len(toxicity.features("You 1d10t IDIOT!!", toxicity.Lexicon())) == len(toxicity.FEATURES)


def test_training_sample_is_bounded(spark):
    from pyspark.sql import functions as F
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).cast("int").alias("toxic"))
    got = toxicity.training_labels(labels, "doc_id", "toxic", F.lit(True), limit=300)
    assert 200 <= got.count() <= 300


# ------------------------------------------------------------------ packing

@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list("<|endoftext|> \n'st1"))), max_size=80))
def test_byte_bpe_equals_the_tokenizers_file(text):
    assert packing.byte_bpe(RANKS)(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def check_packing(got, texts, length):
    seqs, docs = {}, {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
        docs.setdefault(r.doc_id, []).append(r)
    for rows in seqs.values():
        rows.sort(key=lambda r: r.offset)
        at = 0
        for r in rows:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length
    want = {}
    for doc, text in texts:
        want.setdefault(doc, []).append([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0])
    assert set(want) == set(docs)
    for doc, all_ids in want.items():
        pieces = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in docs[doc])
        if len(all_ids) > 1:
            assert sum(p[1] for p in pieces) == sum(map(len, all_ids))
            continue
        at = 0
        for start, n, crc, total in pieces:
            assert start == at and total == len(all_ids[0])
            assert crc == zlib.crc32(np.array(all_ids[0][start:start + n], "<u4").tobytes())
            at += n
        assert at == len(all_ids[0])
    return sum(r.length for r in got) / (length * len(seqs))


@pytest.mark.parametrize("length,parts", [(1024, 3), (64, 1), (100, 7)])
def test_packing_round_trip(spark, docs, texts, length, parts):
    source = docs.withColumnRenamed("n_chars", "length").repartition(parts)
    got = packing.pack_documents(source, packing.byte_bpe, (RANKS,), length=length).collect()
    full = check_packing(got, texts, length)
    assert full > 0.9


def test_packing_keeps_ids_on_request(spark, docs):
    got = packing.pack_documents(docs, packing.byte_bpe, (RANKS,), with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in got)


def test_packing_empty(no_docs):
    assert packing.pack_documents(no_docs, packing.byte_bpe, (RANKS,)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=80), st.integers(1, 5), st.integers(0, 9))
def test_windows_are_bounded(sizes, limit, gap):
    w = packing.Windows(32, limit, gap)
    out = {}
    for doc, n in enumerate(sizes):
        for window, pieces in w.place(lambda a, z, doc=doc: (doc, a, z - a), 0, n):
            out[window] = pieces
            assert sum(p[2] for p in pieces) >= 32 - gap
        assert len(w.open) <= limit and set(w.pieces) == {i for _, i in w.open}
    out |= w.pieces
    assert all(sum(p[2] for p in pieces) <= 32 for pieces in out.values())
    for doc, n in enumerate(sizes):
        own = sorted(p for pieces in out.values() for p in pieces if p[0] == doc)
        assert [p[1] for p in own] == [sum(q[2] for q in own[:i]) for i in range(len(own))] and sum(p[2] for p in own) == n


# ------------------------------------------------------------------ HTML

def test_blocks_of_malformed_pages():
    b = html_blocks.blocks
    assert b(None) == b("") == b("<p></p><!-- x") == b("<script>a<b</script") == []
    assert [x.text for x in b("a<b>c</b> d<br>e&amp;f&nbsp;g &lt;p&gt;")] == ["ac d e&f g <p>"]
    assert [x.text for x in b("<title>t</title><p>one<p>two<div>three</p>four")] == ["one", "two", "three", "four"]
    assert [x.text for x in b("<p>x < y > z & w</p><p class='a\"b>c'>q</p>")] == ["x < y > z & w", "q"]
    assert [x.text for x in b("<ul><li>a<li>b</ul>c<a href=x>d</a")] == ["a", "b", "cd"]
    assert [x.text for x in b("<STYLE>p{}</STYLE><P>k</P><textarea>no</textarea><svg><text>no</text></svg>")] == ["k"]
    assert b("<div class='Side-Bar x' id=\"m\" role=nav><p>t</p></div>")[0].path == (("div", "side", "bar", "x", "m", "nav"), ("p",))
    assert b('<p "unclosed>text</p>') is not None
    link = b("<li><a href='/x'>all</a></li><p>half <a>half</a></p>")
    assert link[0].linked == 1.0 and 0.4 < link[1].linked < 0.5


ARTICLE = "<!DOCTYPE html><html><head><title>T</title></head><body><nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>" \
          "<div class=\"ad\">Buy {0} now.</div><article><h1>{1}</h1><p>{2}</p><p>{3} &amp; {4}</p></article><footer>&copy; site {0}</footer></body></html>"


def pages(n, seed=2):
    rng = random.Random(seed)
    say = lambda k: " ".join(f"w{rng.randrange(500)}" for _ in range(k)).capitalize() + "."
    made = []
    for i in range(n):
        title, one, two, three = say(5), say(rng.randint(1, 80)), say(rng.randint(2, 40)), say(4)
        made.append((i, f"http://h/{i}", ARTICLE.format(say(3), title, one, two, three), f"{title}\n{one}\n{two} & {three}"))
    return made


def test_extraction_of_whole_pages(spark):
    made = pages(150)
    rows = [(i, u, h, "clash") for i, u, h, _ in made] + [(900, "u", None, ""), (901, None, "", ""), (None, "u", made[0][2], ""), made[1][:3] + ("",)]
    got = html_extract.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    want = {i: t for i, _, _, t in made} | {900: "", 901: "", None: made[0][3]}
    assert all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_extraction_generalises_to_other_templates():
    model = html_extract.train([h for _, _, h, _ in pages(200)])
    rng = random.Random(9)
    wrong = total = 0
    for _, _, h, _ in pages(120, seed=5):
        own = html_blocks.blocks(h)
        made, labels = html_extract.variant(own, [html_extract.is_main(b.path) for b in own], rng)
        got = model.label([html_extract.vectors(made)])[0]
        wrong += sum(bool(a) != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong / total < 0.03


def test_lstm_gradients():
    rng = np.random.default_rng(0)
    model = html_extract.BiLSTM()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, mask, y = html_extract.pad([(rng.normal(0, 1, (4, html_extract.FEATURES)), np.array([0, 1, 1, 0.])), (rng.normal(0, 1, (2, html_extract.FEATURES)), np.array([1, 0.]))])

    def loss():
        z = model.logits(x, mask)[0]
        return float((mask * (np.logaddexp(0, z) - y * z)).sum() / mask.sum())

    grad = model.gradients(x, mask, y)
    for name in model.p:
        flat = model.p[name].reshape(-1)
        at = int(np.abs(grad[name]).argmax())
        step = 1e-3
        flat[at] += step
        up = loss()
        flat[at] -= 2 * step
        down = loss()
        flat[at] += step
        assert abs((up - down) / (2 * step) - grad[name].reshape(-1)[at]) < 2e-3, name


def test_extraction_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_extract.extract_main_text(empty).count() == 0


# ------------------------------------------------------------------ decontamination

def greedy_tiles(a, b, least):
    """Greedy string tiling by looking at every pair of places."""
    used_a, used_b, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                if n > best[0]:
                    best = (n, -i, -j)
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return total
        used_a.update(range(i, i + n))
        used_b.update(range(j, j + n))
        total += n


def test_short_items_drop_no_documents(spark):
    docs = spark.createDataFrame([(1, "yes we can do it"), (2, "no yes"), (3, "YES!"), (4, "42 is the answer"), (5, "one two three four five"),
                                  (6, "zero one two three four five six")], "doc_id long, text string")
    items = spark.createDataFrame([(0, "yes"), (1, "42"), (2, "one two three four"), (3, "one two three four five")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in decontaminate.find_leaks(docs, items).collect()) == [(3, 0, 1.0), (5, 3, 1.0), (6, 3, 1.0)]
    assert sorted(r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()) == [1, 2, 4]


def test_coverage_equals_brute_force(spark):
    """Greedy tiling done plainly: the longest common runs first, those of a length in order of their places."""
    rng = random.Random(31)
    say = lambda k: [rng.choice("abcdefgh") for _ in range(k)]
    items = {i: say(rng.randint(5, 14)) for i in range(8)}
    docs = {d: say(rng.randint(0, 60)) for d in range(25)}
    docs |= {100 + i: say(3) + w[6:] + say(2) + w[:6] for i, w in items.items()}

    def plain(a, b, least):
        used_a, used_b, tiles = set(), set(), []
        while True:
            runs = []
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                        n += 1
                    runs.append((n, i, j))
            longest = max((n for n, _, _ in runs), default=0)
            if longest < least:
                return tiles
            for n, i, j in sorted(runs):
                if n == longest and not used_a.intersection(range(i, i + n)) and not used_b.intersection(range(j, j + n)):
                    used_a.update(range(i, i + n))
                    used_b.update(range(j, j + n))
                    tiles.append(n)

    want = set()
    for d, text in docs.items():
        for k, item in items.items():
            tiles = plain(item, text, 5)
            if sum(tiles) >= 0.7 * len(item):
                want.add((d, k, round(sum(tiles) / len(item), 9), len(tiles), max(tiles)))
    got = decontaminate.find_leaks(spark.createDataFrame([(d, " ".join(t)) for d, t in docs.items()], "doc_id long, text string"),
                                   spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()], "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, round(r.coverage, 9), r.n_tiles, r.longest) for r in got} == want and len(want) >= 5


def test_tiling_equals_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        a = [rng.randrange(1, 6) for _ in range(rng.randint(3, 25))]
        b = [rng.randrange(0, 6) for _ in range(rng.randint(3, 40))]
        for least in (2, 3):
            tiles = decontaminate.tile(np.array(a, np.uint64), np.array(b, np.uint64), least)
            assert all(a[i:i + n] == b[j:j + n] for i, j, n in tiles)
            assert len({i + d for i, _, n in tiles for d in range(n)}) == sum(n for *_, n in tiles)
            assert abs(sum(n for *_, n in tiles) - greedy_tiles(a, b, least)) <= least * 2


def test_leaks(spark):
    rng = random.Random(8)
    say = lambda k: [f"w{rng.randrange(4000)}" for _ in range(k)]
    items = [(i, say(rng.randint(15, 50))) for i in range(30)]
    bench = [(i, " ".join(w), "x") for i, w in items] + [(100, None, "x"), (101, "", "x"), (102, "...", "x"), (103, "tiny item here", "x"), (0, " ".join(items[0][1]), "x")]
    docs, want = [], set()

    def doc(words, *leaks):
        docs.append((len(docs), words if isinstance(words, str) or words is None else " ".join(words), "clash"))
        want.update((len(docs) - 1, i) for i in leaks)

    for _ in range(40):
        doc(say(rng.randint(5, 200)))
    doc(say(30) + items[3][1] + say(9), 3)
    doc(", ".join(items[4][1]).upper() + "!", 4)
    reordered = items[5][1][8:] + say(20) + items[5][1][:8]
    doc(reordered, 5)
    doc(items[6][1] + items[7][1], 6, 7)
    doc(items[8][1][:len(items[8][1]) // 2])                       # half of an item is no leak
    doc([w for i, w in enumerate(items[9][1]) if i % 4])           # no run of five words is left
    doc("a tiny item here")                                        # a short item is only matched whole
    doc("Tiny, ITEM here!", 103)
    doc(say(5000) + items[10][1] + say(5000), 10)
    doc(items[0][1], 0)
    doc(None)
    doc("")
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string").repartition(3)
    benchmark = spark.createDataFrame(bench, "item_id long, text string, coverage string")
    for block in (decontaminate.BLOCK, 7):
        got = decontaminate.find_leaks(frame, benchmark, block=block).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
        assert sum(r.item_id == 0 for r in got) == 2               # the repeated item
        kept = decontaminate.drop_leaks(frame, benchmark, block=block)
        assert kept.columns == frame.columns
        assert {r.doc_id for r in kept.collect()} == set(range(len(docs))) - {d for d, _ in want}
    assert decontaminate.find_leaks(frame.limit(0), benchmark).count() == 0
    assert decontaminate.find_leaks(frame, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_leaks(frame, benchmark.limit(0)).count() == len(docs)


def test_long_pages_are_labelled_like_short_ones(spark):
    """The size of pages is no switch: a long comment in each changes no text."""
    rows = [(i, u, h, t) for i, u, h, t in pages(30)]
    long = [(i, u, h + "<!-- " + "x" * 50_001 + " -->", t) for i, u, h, t in rows]
    schema = "page_id long, url string, html string, text string"
    texts = [sorted((r.page_id, r.text) for r in html_extract.extract_main_text(spark.createDataFrame(x, schema)).collect()) for x in (rows, long)]
    assert texts[0] == texts[1] and all(t for _, t in texts[0])


def test_training_sample_is_bounded_and_whole(spark):
    rows = [(i, f"<p>page {i} " + "word " * (10 + i % 7)) for i in range(400)] + [(1000 + i, "<p>hot page") for i in range(300)] + [(2000, None), (2001, "")]
    df = spark.createDataFrame(rows, "page_id long, html string").repartition(5)
    texts = {h for _, h in rows if h}
    got = html_extract.sample_pages(df, "html", 20, 100_000)
    assert len(got) == len(set(got)) == 20 and set(got) <= texts
    assert got == html_extract.sample_pages(df.repartition(2), "html", 20, 100_000)
    small = html_extract.sample_pages(df, "html", 20, 200)
    assert 1 <= len(small) < 20 and sum(map(len, small)) <= 200
    assert len(html_extract.sample_pages(df, "html", 20, 3)) == 1                    # none fits: one page all the same
    assert html_extract.sample_pages(df.where("page_id >= 1000"), "html", 20, 1000) == ["<p>hot page"]
    assert html_extract.sample_pages(df.limit(0), "html", 20, 1000) == []


def test_nothing_to_learn_from_falls_back_to_structure(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "sample_pages", lambda *a: [])
    html = "<nav><a href=x>menu</a></nav><article><p>the text</p></article><footer>foot</footer>"
    got = html_extract.extract_main_text(spark.createDataFrame([(1, "u", html), (2, "u", "<!-- -->")], "page_id long, url string, html string"))
    assert sorted((r.page_id, r.text) for r in got.collect()) == [(1, "the text"), (2, "")]

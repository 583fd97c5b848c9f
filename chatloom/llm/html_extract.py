"""HTML extraction by a recurrent block labeller.

A page is a sequence of leaf blocks. Each block becomes a vector of its hashed tag path, the mean of
its hashed word vectors and a few measures; a numpy bidirectional LSTM reads the whole sequence both
ways and labels every block main text or not, so each label depends on the whole page.

The model is trained per run on a bounded sample of the table's own pages. Their labels come from
structure (inside an article or main element, outside of navigation, notices, comments, ...); copies
of each page with neutral or renamed containers and with inserted boilerplate (menus, sidebars,
forms, comments) teach the network to label by context when the structure says less.
"""
from __future__ import annotations

import random
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import map_batches
from chatloom.llm.html_blocks import Block, blocks

#: at most so many pages train the model, the first in hash order
MAX_TRAIN_PAGES = 240
#: the training pages have so many characters in all, at most; a page is taken whole or not. Bounds what reaches the driver
MAX_TRAIN_CHARS = 4_000_000
#: pages that are looked at per page that trains: the others' hashes are out of the running before anything moves
LOOK = 8
PATH, LEAF, WORDS, BUCKETS, HIDDEN = 48, 24, 24, 4096, 16

MAIN = frozenset("article main".split())
MAIN_NAMES = frozenset("article main content post entry story".split())
OTHER_TAGS = frozenset("nav header footer aside form menu button dialog".split())
OTHER_NAMES = frozenset("""nav menu navbar navigation breadcrumb breadcrumbs sidebar footer header masthead ad ads advert advertisement
sponsored promo banner cookie consent notice alert comment comments reply replies disqus share social related recommended login
signup subscribe newsletter copyright search toolbar pagination tags widget""".split())


def is_main(path: tuple) -> bool:
    """The label that the structure gives: inside a main container and not inside anything else."""
    inside = False
    for tag, *names in path:
        if tag in MAIN or MAIN_NAMES.intersection(names) and not OTHER_NAMES.intersection(names):
            inside = True
        elif OTHER_NAMES.intersection(names) or tag in OTHER_TAGS and not (tag == "header" and inside):
            return False
    return inside


@lru_cache(maxsize=1)
def word_table() -> np.ndarray:
    return np.random.default_rng(5).normal(0, 1, (BUCKETS, WORDS)).astype(np.float32)


@lru_cache(maxsize=50_000)
def path_vector(path: tuple) -> np.ndarray:
    v = np.zeros(PATH + LEAF, np.float32)
    for e in path:
        for i, name in enumerate(e):
            v[zlib.crc32(f"{i > 0}{name}".encode()) % PATH] = 1.0
    for name in path[-1] if path else ():
        v[PATH + zlib.crc32(name.encode()) % LEAF] = 1.0
    return v


def vectors(page: list[Block]) -> np.ndarray:
    """(blocks, features) of one page, over whole texts."""
    n = len(page)
    words, ends, measures = [], [], []
    for i, b in enumerate(page):
        own = b.text.lower().split(" ")
        words.extend([zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in own])
        ends.append(len(words))
        size = len(b.text)
        measures.append((np.log1p(size) / 6, np.log1p(len(own)) / 4, b.linked, b.text[-1] in ".!?…", "." in b.text,
                         min(1.0, b.text.count(",") / len(own)), len(b.path) / 8, i / n, (n - i) / n, b.text[0].isupper()))
    starts = [0, *ends[:-1]]
    sums = np.add.reduceat(word_table()[words], starts, axis=0)
    mean = sums / np.diff([*starts, len(words)])[:, None]
    return np.concatenate([np.stack([path_vector(b.path) for b in page]), mean, np.array(measures, np.float32)], axis=1, dtype=np.float32)


FEATURES = PATH + LEAF + WORDS + 10


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class BiLSTM:
    """Two LSTMs (forward, backward) and a linear output over both states and the input."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        def init(*shape):
            return (rng.normal(0, 1, shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1.0
            self.p |= {f"{d}x": init(FEATURES, 4 * HIDDEN), f"{d}h": init(HIDDEN, 4 * HIDDEN), f"{d}0": bias}
        self.p |= {"out": init(2 * HIDDEN, 1), "skip": init(FEATURES, 1) * 0.1, "c": np.zeros(1, np.float32)}

    def scan(self, d: str, x: np.ndarray, mask: np.ndarray, learn: bool = True):
        """x (T, B, F), mask (T, B): states (T, B, H) and, to ``learn``, what the backward pass needs."""
        steps, batch, _ = x.shape
        gates_x = x @ self.p[d + "x"] + self.p[d + "0"]
        h = c = np.zeros((batch, HIDDEN), np.float32)
        states, memory = np.zeros((steps, batch, HIDDEN), np.float32), []
        for t in (range(steps) if d == "f" else range(steps - 1, -1, -1)):
            g = gates_x[t] + h @ self.p[d + "h"]
            i, f, o = sigmoid(g[:, :HIDDEN]), sigmoid(g[:, HIDDEN:2 * HIDDEN]), sigmoid(g[:, 2 * HIDDEN:3 * HIDDEN])
            u = np.tanh(g[:, 3 * HIDDEN:])
            new = f * c + i * u
            tanh = np.tanh(new)
            m = mask[t][:, None]
            if learn:
                memory.append((t, h, c, i, f, o, u, tanh, m))
            # past its end (before its start) a sequence keeps its state
            h, c = m * (o * tanh) + (1 - m) * h, m * new + (1 - m) * c
            states[t] = h
        return states, memory

    def logits(self, x, mask, learn=True):
        hf, mf = self.scan("f", x, mask, learn)
        hb, mb = self.scan("b", x, mask, learn)
        both = np.concatenate([hf, hb], axis=2)
        return (both @ self.p["out"] + x @ self.p["skip"] + self.p["c"])[:, :, 0], both, mf, mb

    def gradients(self, x, mask, y):
        z, both, mf, mb = self.logits(x, mask)
        dz = ((sigmoid(z) - y) * mask / mask.sum())[:, :, None].astype(np.float32)
        flat = lambda a: a.reshape(-1, a.shape[-1])
        grad = {"out": flat(both).T @ flat(dz), "skip": flat(x).T @ flat(dz), "c": dz.sum((0, 1))}
        d_both = dz @ self.p["out"].T
        for d, memory, d_states in (("f", mf, d_both[:, :, :HIDDEN]), ("b", mb, d_both[:, :, HIDDEN:])):
            wh = self.p[d + "h"]
            dg_all = np.zeros((*mask.shape, 4 * HIDDEN), np.float32)
            gh = np.zeros_like(wh)
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, h0, c0, i, f, o, u, tanh, m in reversed(memory):
                dh = dh + d_states[t]
                own, dcell = dh * m, dc * m
                do = own * tanh
                dcell = dcell + own * o * (1 - tanh ** 2)
                dg = np.concatenate([dcell * u * i * (1 - i), dcell * c0 * f * (1 - f), do * o * (1 - o), dcell * i * (1 - u ** 2)], axis=1)
                dg_all[t] = dg
                gh += h0.T @ dg
                dh = dg @ wh.T + dh * (1 - m)
                dc = dcell * f + dc * (1 - m)
            grad |= {d + "x": flat(x).T @ flat(dg_all), d + "h": gh, d + "0": dg_all.sum((0, 1))}
        return grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 15, batch: int = 16, rate: float = 0.01, seed: int = 4):
        """Adam on pages of similar length."""
        rng = np.random.default_rng(seed)
        pages = sorted(pages, key=lambda p: len(p[1]))
        groups = [pad(pages[i:i + batch]) for i in range(0, len(pages), batch)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        step = 0
        for _ in range(epochs):
            for g in rng.permutation(len(groups)):
                step += 1
                for k, gradient in self.gradients(*groups[g]).items():
                    gradient = np.clip(gradient, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * gradient
                    v[k] = 0.99 * v[k] + 0.01 * gradient ** 2
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)
        return self

    def label(self, pages: list[np.ndarray], cells: int = 20_000) -> list[np.ndarray]:
        """Main-text flags of each page's blocks; pages of similar length share a padded batch."""
        out: list = [None] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: -len(pages[i]))
        while order:
            size = max(1, cells // max(1, len(pages[order[0]])))
            own, order = order[:size], order[size:]
            x, mask, _ = pad([(pages[i], None) for i in own])
            z = self.logits(x, mask, learn=False)[0]
            for k, i in enumerate(own):
                out[i] = z[:len(pages[i]), k] > 0
        return out


def pad(pages):
    steps = max(len(x) for x, _ in pages)
    x = np.zeros((steps, len(pages), FEATURES), np.float32)
    mask, y = np.zeros((steps, len(pages)), np.float32), np.zeros((steps, len(pages)), np.float32)
    for k, (own, label) in enumerate(pages):
        x[:len(own), k] = own
        mask[:len(own), k] = 1
        if label is not None:
            y[:len(own), k] = label
    return x, mask, y


MAIN_BOXES = [(("article",),), (("main",),), (("div", "content"),), (("div", "post", "body"),), (("section",),), (("div",),),
              (("main",), ("article",)), (("div", "wrapper"), ("article", "post")), (("div", "entry", "content"),)]
BOILERPLATE = {
    "top": [(("header",),), (("header", "site", "header"),), (("div", "header"),), (("nav",), ("ul",), ("li",)), (("div", "menu"), ("ul",), ("li",)),
            (("div", "cookie", "notice"),), (("div", "notice"),), (("div", "alert"),), (("div", "breadcrumb"),)],
    "any": [(("div", "ad"),), (("aside",),), (("div", "banner"),), (("div", "promo"),), (("div", "sponsored"),), (("form",),),
            (("form",), ("div",)), (("div", "newsletter"),), (("div", "share"),)],
    "end": [(("aside", "sidebar"), ("ul",), ("li",)), (("div", "sidebar"), ("p",)), (("section", "comments"), ("div", "comment"), ("p",)),
            (("div", "comments"), ("p",)), (("ol", "comment", "list"), ("li", "comment"), ("p",)), (("div", "related"), ("ul",), ("li",)), (("footer",),),
            (("footer",), ("p",)), (("div", "footer"),), (("div", "copyright"),)],
}


def variant(page: list[Block], labels: list[bool], rng: random.Random) -> tuple[list[Block], list[bool]]:
    """A copy of a labelled page in another template: renamed containers, added boilerplate."""
    words = " ".join(b.text for b in page).split(" ")

    def filler(path) -> Block:
        short = path[-1][0] == "li"
        own = [rng.choice(words) for _ in range(rng.randint(1, 3) if short else rng.randint(3, 40))]
        return Block(path, " ".join(own), 1.0 if short else rng.choice([0.0, 0.0, 0.3]))

    def run(kind) -> list[Block]:
        found = []
        for _ in range(rng.randint(0, 2)):
            path = rng.choice(BOILERPLATE[kind])
            found += [filler(root + path) for _ in range(rng.randint(2, 6) if path[-1][0] == "li" else rng.randint(1, 3))]
        return found

    root = (("html",), ("body",))
    box = root + rng.choice(MAIN_BOXES)
    top, main, end = [], [], []
    seen = False
    for b, y in zip(page, labels):
        leaf = b.path[-1] if b.path else ("div",)
        if y:
            seen = True
            main.append((Block(box + ((leaf,) if leaf[0] in {"p", "h1", "h2", "h3", "li", "blockquote", "pre"} else ()), b.text, b.linked), True))
            if rng.random() < 0.08:
                main.append((filler(box + rng.choice(BOILERPLATE["any"])), False))
        else:
            group = BOILERPLATE["end" if seen else "top"]
            path = b.path if rng.random() < 0.4 else root + rng.choice(group)
            (end if seen else top).append(Block(path, b.text, b.linked))
    if main and rng.random() < 0.4:                      # comments inside the article's container
        main += [(filler(box + rng.choice(BOILERPLATE["end"][2:5])), False) for _ in range(rng.randint(1, 4))]
    top, end = run("top") + top + run("any"), run("any") + end + run("end")
    rows = [(b, False) for b in top] + main + [(b, False) for b in end]
    return [b for b, _ in rows], [y for _, y in rows]


def train(pages: list[str], copies: int = 3, seed: int = 8) -> BiLSTM | None:
    """None if no page has a block to learn from."""
    rng = random.Random(seed)
    data = []
    for page in pages:
        own = blocks(page)
        if not own:
            continue
        labels = [is_main(b.path) for b in own]
        for made, y in [(own, labels), *(variant(own, labels, rng) for _ in range(copies if any(labels) else 0))]:
            if made:
                x = vectors(made)
                # words alone decide little: hide or shuffle them in part of the training pages
                if rng.random() < 0.5:
                    own = x[:, PATH + LEAF:PATH + LEAF + WORDS]
                    own[:] = 0.0 if rng.random() < 0.5 else own[rng.sample(range(len(own)), len(own))] * rng.choice([0.5, 1.0, 3.0])
                data.append((x, np.array(y, np.float32)))
    return BiLSTM().fit(data) if data else None


def sample_pages(pages: DataFrame, html: str, most: int, chars: int) -> list[str]:
    """At most ``most`` different pages of ``chars`` characters in all: in hash order those that still fit, or the
    shortest one looked at if none fits. Pages are thinned by their hash first and only the hashes and sizes
    of ``most`` of them come to the driver before the chosen texts do."""
    full = pages.where(F.length(html) > 0).select(F.xxhash64(html).alias("h"), F.length(html).alias("n"), F.col(html).alias("html"))
    total, scale = full.count(), 1 << 30
    share = min(scale, LOOK * most * scale // max(1, total) + 1)
    looked = []
    while total and not looked:                           # many copies of few pages: none may have a low hash
        thin = full.where(F.pmod("h", F.lit(scale)) < share)
        looked = thin.groupBy("h").agg(F.max("n").alias("n")).orderBy("h").limit(most).collect()
        if share == scale:
            break
        share = min(scale, share * 64)
    chosen, size = [], 0
    for row in looked:
        if size + row["n"] <= chars:
            chosen.append(row["h"])
            size += row["n"]
    if looked and not chosen:
        chosen = [min(looked, key=lambda r: (r["n"], r["h"]))["h"]]
    if not chosen:
        return []
    texts = full.where(F.col("h").isin(chosen)).groupBy("h").agg(F.min("html").alias("html"))
    return sorted(r["html"] for r in texts.select("html").collect())


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                      max_train_pages: int = MAX_TRAIN_PAGES, max_train_chars: int = MAX_TRAIN_CHARS) -> DataFrame:
    """One row per page: key, url, text (main blocks joined by a line break), n_chars (its code points).

    Null and empty pages have an empty text. Repeated pages get equal texts. The sample is taken by
    the hash of the page, so it does not depend on the layout of the table. If no sampled page has a block to
    learn from, blocks are labelled by the structure that would have labelled the training pages.
    """
    model = train(sample_pages(pages, html, max_train_pages, max_train_chars))
    weights = model.p if model else None
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        model = BiLSTM()
        model.p = weights or model.p
        for b in batches:
            for at in range(0, len(b["id"]), 512):
                parsed = [blocks(p) for p in b["html"][at:at + 512]]
                full = [p for p in parsed if p]
                flags = iter(model.label([vectors(p) for p in full]) if weights else [[is_main(x.path) for x in p] for p in full])
                texts = ["\n".join(x.text for x, keep in zip(p, next(flags)) if keep) if p else "" for p in parsed]
                yield {"id": b["id"][at:at + 512], "url": b["url"][at:at + 512], "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return map_batches(rows, f"id {kind}, url string, text string, n_chars long", run).select(F.col("id").alias(key), "url", "text", "n_chars")

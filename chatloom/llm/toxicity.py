"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

1. A bounded, hash-ordered sample of labelled training rows gives a lexicon: words and word stems
   (prefixes) that are far likelier in toxic texts than their base rate explains.
2. Every text is turned into dense features once: lexicon densities, hits close to a second-person
   word, capitals, punctuation, obfuscation. Only these narrow rows are kept for what follows.
3. Spark ML's gradient-boosted trees learn from the training rows, an isotonic regression on a
   separate fold of them maps their output to probabilities, and both score all documents.

Labels, language, source and id are no inputs of a score.
"""
from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import map_batches
from chatloom.session import cut_lineage

#: at most so many labelled rows train the lexicon and the trees (hash order, so any bound is a fair sample)
MAX_TRAIN_ROWS = 20_000
#: at most so many learned terms, the strongest first: the size of the model, not of the data
MAX_TERMS = 4_000
PREFIXES = (4, 5, 6)
FOLDS = 5

# common English insults and second-person words, a starting lexicon
INSULTS = frozenset("""idiot idiots moron stupid dumb fool loser losers scum trash garbage pathetic worthless
disgusting clown ugly filthy vermin imbecile retard jerk creep hate shut kill""".split())
SECOND_PERSON = frozenset("you your yours yourself ya u tu te toi ton vous votre du dich dir dein ihr euch tú ti usted vosotros".split())
LEET = str.maketrans("013457@$!*", "oieastasii")

LETTERS = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
MIXED = re.compile(r"[^\W\d_]+[0-9@$!*]+[^\W\d_]+")
SPACED = re.compile(r"(?<!\w)(?:\w[ .\-_]){3,}\w(?!\w)")
RUNS = re.compile(r"([^\W\d_])\1{3,}")

FEATURES = ["insults", "words", "stems", "hits_log", "distinct", "strongest", "weight", "near_you", "capital_words",
            "capitals", "exclaims", "questions", "symbols", "mixed", "mixed_hits", "spaced", "runs", "words_log", "word_length"]


@dataclass
class Lexicon:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)


def terms(text: str) -> set[str]:
    """Distinct words (as ``=word``) and stems of a text."""
    own = set(LETTERS.findall(text.lower()))
    out = {"=" + w for w in own}
    for n in PREFIXES:
        out.update(w[:n] for w in own if len(w) > n)
    return out


def features(text: str, lexicon: Lexicon) -> list[float]:
    raw = LETTERS.findall(text)
    n = len(raw)
    if n == 0:
        return [0.0] * len(FEATURES)
    per = 100.0 / n
    words = [w.lower() for w in raw]
    counts = Counter(words)
    insults = word_hits = stem_hits = weight = strongest = 0.0
    hit: set[str] = set()
    known = lexicon.words
    stems = lexicon.stems
    for w, c in counts.items():
        best = 0.0
        if w in INSULTS:
            insults += c
            hit.add(w)
        if w in known:
            word_hits += c
            best = known[w]
        for k in PREFIXES:
            s = w[:k]
            if s in stems and len(w) > k:
                best = max(best, stems[s])
                stem_hits += c
                break
        if best:
            hit.add(w)
            weight += best * c
            strongest = max(strongest, best)
    near = 0
    if hit:
        you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
        at = set()
        for i in you:
            at.update(range(i - 3, i + 4))
        near = sum(1 for i in at if 0 <= i < n and words[i] in hit)
    mixed = MIXED.findall(text)
    mixed_hits = 0
    for m in mixed:
        plain = m.lower().translate(LEET)
        mixed_hits += plain in INSULTS or plain in known or any(plain[:k] in stems for k in PREFIXES)
    total = sum(counts[w] for w in hit)
    symbols = sum(text.count(c) for c in "#$%&*@|<>")
    return [insults * per, word_hits * per, stem_hits * per, math.log1p(total), float(len(hit)), strongest, weight / n,
            near * per, sum(1 for w in raw if len(w) > 1 and w.isupper()) / n,
            len(CAPITALS.findall(text)) / max(1, len(text)), text.count("!") / n, text.count("?") / n, symbols / n,
            len(mixed) * per, mixed_hits * per, len(SPACED.findall(text)) * per, len(RUNS.findall(text)) * per,
            math.log1p(n), sum(map(len, raw)) / n]


def fold(key: Column) -> Column:
    return F.crc32(key.cast("string")) % FOLDS


def training_labels(labels: DataFrame, key: str, label: str, usable: Column, limit: int = MAX_TRAIN_ROWS) -> DataFrame:
    """(key, y) of at most ``limit`` labelled rows, the first in hash order. Several labels of one
    document: it is toxic if any says so; null keys and labels are left out."""
    rows = (labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & usable)
            .groupBy(key).agg(F.max(label).cast("double").alias("y")))
    n = rows.count()
    spot = F.xxhash64(key)
    if n > limit:
        # thin out by hash before the exact cut, so the cut itself sees about ``limit`` rows at any size
        rows = rows.where(F.pmod(spot, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * limit / n)))
        rows = rows.orderBy(F.pmod(spot, F.lit(1 << 30)), key).limit(limit)
    return rows


def learn_lexicon(texts: DataFrame, n: int, n_toxic: int, max_terms: int = MAX_TERMS) -> Lexicon:
    """Terms whose share of toxic texts is far above the base rate. ``texts`` has (text, y)."""
    if n_toxic == 0 or n_toxic == n:
        return Lexicon()

    def count(batches):
        toxic: Counter = Counter()
        clean: Counter = Counter()
        for b in batches:
            for text, y in zip(b["text"], b["y"]):
                (toxic if y else clean).update(terms(text or ""))
        # the sums of this partition; a term without a toxic text here may have some elsewhere
        names = list(toxic.keys() | clean.keys())
        for i in range(0, len(names), 50_000):
            part = names[i:i + 50_000]
            yield {"term": part, "a": [toxic[t] for t in part], "b": [clean[t] for t in part]}

    base = n_toxic / n
    a, b = F.col("a"), F.col("b")
    share = a / (a + b)
    # n * KL(share || base): how surprising the share is
    rest = F.when(b > 0, b * F.log((1 - share) / (1 - base))).otherwise(F.lit(0.0))
    surprise = a * F.log(share / base) + rest
    found = (map_batches(texts, "term string, a long, b long", count).groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
             .where((a >= 4) & (share > max(0.6, 2 * base)) & (surprise > 9))
             .select("term", surprise.alias("surprise"), (F.log(a + 0.5) - F.log(b + 0.5)).alias("weight"))
             .orderBy(F.desc("surprise"), "term").limit(max_terms).collect())
    return Lexicon({r["term"][1:]: r["weight"] for r in found if r["term"].startswith("=")},
                   {r["term"]: r["weight"] for r in found if not r["term"].startswith("=")})


def feature_rows(docs: DataFrame, lexicon: Lexicon, key: str, text: str) -> DataFrame:
    def run(batches):
        for b in batches:
            yield {"id": b["id"], "x": [features(t or "", lexicon) for t in b["text"]]}

    kind = docs.schema[key].dataType.simpleString()
    return map_batches(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), f"id {kind}, x array<double>", run)


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                   max_train_rows: int = MAX_TRAIN_ROWS, trees: int = 20, depth: int = 4) -> DataFrame:
    """One row per document: key, ``held_out`` (crc32 of the key as text is a multiple of 5), ``score``
    in 0..1 and ``predicted``. Rows held out train nothing.

    Null and empty texts have zero features and are scored like any other. Without training rows
    of both classes every score is their smoothed toxic share. Repeated rows score alike.
    """
    held = fold(F.col(key)) == 0
    y = cut_lineage(training_labels(labels, key, label, ~held, max_train_rows))
    size = y.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("toxic")).first()
    out = [F.col("id").alias(key), (fold(F.col("id")) == 0).alias("held_out")]
    flat = F.lit((size["toxic"] + 0.5) / (size["n"] + 1.0))
    if size["toxic"] in (0.0, float(size["n"])):
        return docs.select(F.col(key).alias("id")).select(*out, flat.alias("score"), (flat >= 0.5).cast("int").alias("predicted"))
    # y has at most max_train_rows narrow rows: the documents need no shuffle to find theirs
    bounded = F.broadcast(y)
    lexicon = learn_lexicon(docs.select(F.col(key), F.col(text).alias("text")).join(bounded, key).select("text", "y"),
                            size["n"], int(size["toxic"]))
    rows = cut_lineage(feature_rows(docs, lexicon, key, text)).withColumn("features", array_to_vector("x"))
    # a bounded training set: a few partitions, so each boosting step is a few short tasks
    train = rows.join(F.broadcast(y.withColumnRenamed(key, "id")), "id").select("id", "features", "y").coalesce(6).cache()
    if train.select("y").distinct().count() < 2:       # labels of documents that are not there
        train.unpersist()
        return docs.select(F.col(key).alias("id")).select(*out, flat.alias("score"), (flat >= 0.5).cast("int").alias("predicted"))
    calibration = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(4)) == 0
    fit, rest = train.where(~calibration), train.where(calibration)
    if fit.select("y").distinct().count() < 2 or rest.select("y").distinct().count() < 2:
        fit = rest = train
    model = GBTClassifier(featuresCol="features", labelCol="y", maxIter=trees, maxDepth=depth, stepSize=0.3,
                          minInstancesPerNode=3, seed=11, cacheNodeIds=False).fit(fit)
    margin = vector_to_array(F.col("probability"))[1]
    curve = IsotonicRegression(featuresCol="p", labelCol="y", predictionCol="calibrated").fit(
        model.transform(rest).select(margin.alias("p"), "y"))
    scored = curve.transform(model.transform(rows).select("id", margin.alias("p")))
    train.unpersist()
    # isotonic steps are flat; a hundredth of the trees' own probability orders documents on one step
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.99 * F.col("calibrated") + 0.01 * F.col("p")))
    return scored.select(*out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))

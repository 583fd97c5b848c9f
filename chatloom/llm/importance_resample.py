"""Target-distribution importance resampling with segment deduplication.

Documents are drawn with the odds of their hashed n-gram features under a target corpus against the
corpus itself (a bag-of-buckets ratio), perturbed by Gumbel noise so that the k highest scores are a
sample without replacement.

1. Corpus counts. Separator newlines cut the texts into lines, equal lines are collapsed with their
   number of occurrences, the features inside a distinct line are hashed once and multiplied by it. Runs
   that reach over a line break are not inside any line: they are counted per text and added (there
   are none for runs of one word).
2. The gain of each bucket is a fixed-size array (``buckets`` numbers), whatever the corpus.
3. Every text is scored by one narrow pass; nothing of it is shuffled.
4. A histogram of the integer scores (a bounded number of values) gives the score at which the draw
   ends; only documents at or above it are ordered, by a distributed rank.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import stored
from chatloom.operators.ranking import global_rank

NGRAM = 1
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
#: texts are taken together until they make so many bytes
CHUNK = 1 << 20

# word bytes stay (A-Z in lower case), all others become spaces; bytes from 0x80 on belong to words
FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(body: bytes | None) -> list[bytes]:
    return body.translate(FOLD).split() if body else []


def runs(words: list[bytes], size: int) -> list[bytes]:
    """All runs of ``size`` words, joined by one space."""
    return words if size == 1 else [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)]


def features(words: list[bytes], ngram: int) -> list[bytes]:
    return words if ngram == 1 else [g for n in range(1, ngram + 1) for g in runs(words, n)]


def crossing(body: bytes | None, ngram: int) -> list[bytes]:
    """The runs of a text that reach over a line break."""
    lines = [words_of(line) for line in (body or b"").split(b"\n")]
    words = [w for line in lines for w in line]
    at = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
    return [g for n in range(2, ngram + 1) for i, g in enumerate(runs(words, n)) if at[i] != at[i + n - 1]]


def hashed(grams: list[bytes], buckets: int) -> np.ndarray:
    return (np.fromiter(map(zlib.crc32, grams), np.uint32, len(grams)) % np.uint32(buckets)).astype(np.int64)


def chunks(batch: pa.RecordBatch, column: str):
    """(first row, bytes of the rows' texts) in pieces of about CHUNK bytes."""
    held, first, size = [], 0, 0
    for i, body in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
        held.append(body)
        size += len(body or b"")
        if size >= CHUNK:
            yield first, held
            held, first, size = [], i + 1, 0
    if held:
        yield first, held


def add_up(df: DataFrame, of_text, buckets: int) -> DataFrame:
    """(bucket, n): the features of ``df``'s texts times their ``times``, one array of counts per task."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            times = batch.column("times").to_numpy()
            for first, bodies in chunks(batch, "text"):
                found = [of_text(b) for b in bodies]
                where = hashed([g for own in found for g in own], buckets)
                np.add.at(total, where, np.repeat(times[first:first + len(bodies)], [len(own) for own in found]))
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    return df.select("text", F.col("times").cast("long")).mapInArrow(run, "bucket long, n long")


def bucket_counts(texts: DataFrame, text: str, ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences per bucket of all features of a column of texts (null: none)."""
    bodies = texts.select(F.col(text).alias("text")).where(F.length("text") > 0)
    lines = bodies.select(F.explode(F.split("text", "\n", -1)).alias("text")).where(F.length("text") > 0)
    distinct = lines.groupBy("text").agg(F.count(F.lit(1)).alias("times"))
    parts = add_up(distinct, lambda body: features(words_of(body), ngram), buckets)
    if ngram > 1:
        across = bodies.where(F.instr("text", "\n") > 0).select("text", F.lit(1).alias("times"))
        parts = parts.unionByName(add_up(across, lambda body: crossing(body, ngram), buckets))
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():     # at most one row per bucket
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log odds of each bucket, add-one smoothed, rounded down."""
    size = len(source)
    whole_s, whole_t = float(source.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log((t + 1.0) * whole_s / ((s + 1.0) * whole_t)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, ngram: int) -> DataFrame:
    """(id, n_words, n_features, weight) per row: the mean gain of its features, rounded down."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            words, sizes, totals = [], [], []
            for _, bodies in chunks(batch, "text"):
                own = [words_of(b) for b in bodies]
                found = own if ngram == 1 else [features(w, ngram) for w in own]
                upto = np.concatenate(([0], np.cumsum(gains[hashed([g for f in found for g in f], len(gains))])))
                ends = np.concatenate(([0], np.cumsum([len(f) for f in found])))
                words += [len(w) for w in own]
                sizes += [len(f) for f in found]
                totals += np.diff(upto[ends]).tolist()
            size, total = np.array(sizes, np.int64), np.array(totals, np.int64)
            weight = np.where(size > 0, total // np.maximum(size, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.int64()), pa.array(size), pa.array(weight)],
                                             ["id", "n_words", "n_features", "weight"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def noise(key: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, rounded down, from eight hex digits of a seeded digest of the key."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("long") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.ln(-F.ln(uniform))).cast("long")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text", ngram: int = NGRAM,
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """One row per input row: key, n_words, n_features, weight, score and ``rank`` (1 is the highest
    score) of the drawn ones, ``percent`` of the documents with ``min_words`` words or more.

    Null and empty texts have no features, weight 0 and are never drawn. Ties of a score go to the smaller
    key, missing keys last (their noise is that of an empty key); rows that share key and score are
    ordered by their feature counts and words, equal rows get ranks of their own. An empty target
    weighs like a flat one.
    """
    kind = docs.schema[key].dataType.simpleString()
    gains = bucket_gains(bucket_counts(docs, text, ngram, buckets), bucket_counts(target, target_text, ngram, buckets))
    weighed = weigh(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), gains, ngram)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")
    usable = F.col("n_words") >= min_words
    # scores are integers within a few ten thousand: the histogram does not grow with the corpus
    bars = sorted(((r["score"], r["n"]) for r in scored.where(usable).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    drawn = percent * sum(n for _, n in bars) // 100
    last, above = None, 0
    for score, n in bars:
        if above >= drawn:
            break
        last, above = score, above + n
    names = [F.col("id").cast(kind).alias(key), "n_words", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*names, F.lit(None).cast("long").alias("rank"))
    chosen = usable & (F.col("score") >= last)
    tied = scored.where(chosen).withColumn("_row", F.monotonically_increasing_id())
    ranked = global_rank(tied, [F.col("score").desc(), F.col("id").asc_nulls_last(), "n_features", "n_words", "_row"], "rank")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return (ranked.select(*names, rank.cast("long").alias("rank"))
            .unionByName(scored.where(~chosen).select(*names, F.lit(None).cast("long").alias("rank"))))

"""Substring deduplication: words covered by a window that an earlier document also has are removed.

An FM-index per shard finds the intervals. What a shard holds is routed, so that no document has to
be streamed past every index:

1. every window of ``window`` words has a seed, the least hash among its ``SEED``-word runs; equal
   windows have equal seeds. Per document only the distinct seeds are kept (about one per 21 words).
   Whole copies are settled by a digest of their words and take no further part.
2. seeds that two documents share (least id < greatest id, a pre-aggregated count) mark the documents
   that can have common windows; only their texts are fetched.
3. windows in a row with the same shared seed form a passage. Equal passages are collapsed with their
   least document id; passages of a seed go to one shard.
4. each shard builds a compressed FM-index over its distinct passages and streams them past it:
   backward search with the least owner of the suffix range gives the intervals of ``window`` words or
   more that occur in an earlier document. Later documents with an equal passage lose all of it.
5. a shard of more than ``MOST`` distinct passages (a seed that stands between ever different words)
   gets no index. Its passages are routed on by the digests of their windows: the least owner of each
   window is a pre-aggregated row, joined back to the passages. So no task holds more than ``MOST``.

A seed held by a third of all documents is one pre-aggregated row; an equal passage of theirs is
another. The join back to its holders is split by the adaptive skew rule.
"""
from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import if_few, map_batches, stored
from chatloom.llm.fm_index import FMIndex
from chatloom.llm.words import distinct, hashed, signed, sliding, split_words, window_hashes
from chatloom.session import cut_lineage

WINDOW = 50
SEED = 8
#: passages per shard, on average
SHARD = 3_000
#: passages that one index holds, at most
MOST = 10_000
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
#: full shards are sent to all tasks up to so many, else joined by a shuffle
MAX_BROADCAST_ROWS = 500_000
#: a null id counts as the greatest: such rows are never the earlier document
LAST = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def window_seeds(ids: np.ndarray, window: int) -> np.ndarray:
    """The seed of every window."""
    size = min(SEED, window)
    return sliding(np.minimum, window_hashes(ids, size), window - size + 1)


def digest(words: list[bytes]) -> "hashlib._Hash":
    return hashlib.sha256(b" ".join(words))


def text_key(sha: "hashlib._Hash") -> int:
    return int.from_bytes(sha.digest()[:8], "little", signed=True)


def summaries(docs: DataFrame, window: int) -> DataFrame:
    """(id, raw, key, sha, n_words, seeds) per row; ``key`` tells texts of one id apart, ``raw`` also
    those that only differ in their white space."""
    def run(batches):
        for b in batches:
            keys, shas, sizes, seeds = [], [], [], []
            for text, ids in zip(b["text"], hashed(b["text"])):
                words = split_words(text)
                sha = digest(words)
                keys.append(text_key(sha))
                shas.append(sha.hexdigest())
                sizes.append(len(words))
                own = window_seeds(ids, window) if len(words) >= window else np.zeros(0, np.uint64)
                seeds.append(signed(distinct(own)))
            yield {"id": b["id"], "raw": b["raw"], "key": keys, "sha": shas, "n_words": sizes, "seeds": seeds}

    return map_batches(docs, "id long, raw binary, key long, sha string, n_words long, seeds array<long>", run)


def passages(texts: DataFrame, window: int) -> DataFrame:
    """(id, key, seed, passage, name, starts, size) for the runs of windows under a shared seed. Long
    runs (periodic text) are cut into passages of bounded size; equal ones of a text share a row."""
    most = window - min(SEED, window) + 1

    def run(batches):
        for b in batches:
            out = {k: [] for k in ("id", "key", "seed", "passage", "name", "starts", "size")}
            for doc, key, text, seeds, ids in zip(b["id"], b["key"], b["text"], b["seeds"], hashed(b["text"])):
                words = split_words(text)
                if text_key(digest(words)) != key:
                    continue                        # another text under the same id
                own = window_seeds(ids, window).view(np.int64)
                shared = np.isin(own, np.array(seeds, np.int64))
                cuts = np.flatnonzero(np.diff(own)) + 1
                found: dict[tuple, list[int]] = {}
                for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)]):
                    if not shared[first]:
                        continue
                    for at in range(first, last, most):
                        till = min(at + most, last) - 1 + window
                        found.setdefault((int(own[first]), b" ".join(words[at:till])), []).append(at)
                for (seed, body), starts in found.items():
                    out["id"].append(doc)
                    out["key"].append(key)
                    out["seed"].append(seed)
                    out["passage"].append(body.decode("utf-8", "surrogatepass"))
                    out["name"].append(int.from_bytes(hashlib.sha256(body).digest()[:8], "little", signed=True))
                    out["starts"].append(starts)
                    out["size"].append(body.count(b" ") + 1)
            yield out

    return map_batches(texts, "id long, key long, seed long, passage string, name long, starts array<int>, size int", run)


def search_shard(window: int):
    """pandas (seed, passage, name, owner) of one shard -> intervals of each passage in earlier owners."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["owner", "seed", "name"], kind="stable")
        vocabulary: dict[str, int] = {}
        sequences = [np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in p.split(" ")], np.int64) for p in pdf["passage"]]
        owner = np.unique(pdf["owner"].to_numpy(), return_inverse=True)[1].astype(np.int32)
        index = FMIndex(sequences, owner, len(vocabulary) + 1)
        found = index.earlier_matches(sequences, owner, window)
        return pd.DataFrame({"seed": pdf["seed"], "name": pdf["name"], "owner": pdf["owner"],
                             "low": [[a for a, _ in f] for f in found], "high": [[z for _, z in f] for f in found]})
    return run


def search_windows(distinct: DataFrame, window: int) -> DataFrame:
    """The same as ``search_shard`` for any number of passages: every window is looked up by its digest."""
    def run(batches):
        for b in batches:
            out = {k: [] for k in ("seed", "name", "owner", "at", "window")}
            for seed, body, name, owner in zip(b["seed"], b["passage"], b["name"], b["owner"]):
                words = split_words(body)
                for at in range(len(words) - window + 1):
                    out["seed"].append(seed)
                    out["name"].append(name)
                    out["owner"].append(owner)
                    out["at"].append(at)
                    out["window"].append(digest(words[at:at + window]).digest()[:16])
            yield out

    windows = map_batches(distinct, "seed long, name long, owner long, at int, window binary", run)
    earliest = (windows.groupBy("window").agg(F.min("owner").alias("a"), F.max("owner").alias("z")).where("a < z")
                .select("window", F.col("a").alias("earliest")))
    # at most as many as a passage has windows
    found = (windows.join(earliest, "window").where("earliest < owner").groupBy("seed", "name", "owner")
             .agg(F.sort_array(F.collect_set("at")).alias("low")))
    low = F.coalesce("low", F.array().cast("array<int>"))
    return (distinct.select("seed", "name", "owner").join(found, ["seed", "name", "owner"], "left")
            .select("seed", "name", "owner", low.alias("low"), F.transform(low, lambda at: at + F.lit(window)).alias("high")))


def search(held: DataFrame, window: int) -> DataFrame:
    """(seed, name, owner, low, high) per distinct passage: its least document and its intervals in earlier ones."""
    shards = max(1, -(-held.count() // SHARD))
    routed = held.select("id", "seed", "passage", "name", F.pmod(F.xxhash64("seed"), F.lit(shards)).alias("shard"))
    owners = lambda rows: rows.groupBy("shard", "seed", "passage", "name").agg(F.min("id").alias("owner"))
    indexed = lambda rows: owners(rows).groupBy("shard").applyInPandas(
        search_shard(window), "seed long, name long, owner long, low array<int>, high array<int>")
    full = cut_lineage(routed.select("shard", "seed", "name").distinct().groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
                       .where(F.col("n") > MOST).select("shard"))
    if full.isEmpty():
        return indexed(routed)
    full = if_few(full, MAX_BROADCAST_ROWS)
    return indexed(routed.join(full, "shard", "left_anti")).unionByName(
        search_windows(owners(routed.join(full, "shard", "left_semi")), window))


def covered(n: int, intervals: list[tuple[int, int]]) -> np.ndarray:
    """Flags of the words inside any interval."""
    change = np.zeros(n + 1, np.int64)
    for a, z in intervals:
        change[a] += 1
        change[z] -= 1
    return np.cumsum(change[:-1]) > 0


def cut_words(text: str, gone: np.ndarray) -> str:
    """The text without the flagged words; each takes the white space after it along."""
    body = text.encode("utf-8", "surrogatepass")
    spans = [m.span() for m in WORDS.finditer(body)]
    kept, at = [], 0
    ends = [s for s, _ in spans[1:]] + [len(body)]
    for (start, _), end, out in zip(spans, ends, gone.tolist()):
        if out:
            kept.append(body[at:start])
            at = end
    kept.append(body[at:])
    return b"".join(kept).decode("utf-8", "surrogatepass")


def runs(flags: np.ndarray) -> np.ndarray:
    """Begin and end of each run of flagged words, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))


def digest_of(text: str) -> Column:
    """Rows of one id are joined by it too, so that they never meet each other's texts."""
    return F.unhex(F.md5(text))


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW):
    """(summaries, changes): the rows of ``docs`` with their digests and ``first`` (least id with the
    same words), and one row per (id, key) of the first copies that lose words: n_removed,
    kept_sha256 and ``cuts`` (the runs of words that go)."""
    source = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("id"), digest_of(text).alias("raw"), F.col(text).alias("text"))
    rows = stored(summaries(source, window), "summaries")
    firsts = rows.groupBy("sha").agg(F.min("id").alias("first"))
    rows = stored(rows.join(firsts, "sha"), "firsts")
    own = rows.where("id = first").select("id", "key", "raw", F.explode("seeds").alias("seed"))
    shared = own.groupBy("seed").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").select("seed")
    # one of the texts with the same words; rows with that text repeat if a seed counts more than once
    wanted = (own.join(shared, "seed").groupBy("id", "key").agg(F.min("raw").alias("raw"), F.collect_set("seed").alias("seeds"), F.count(F.lit(1)).alias("n"))
              .select("id", "key", "raw", "seeds", (F.col("n") > F.size("seeds")).alias("again")))
    fetched = stored(source.where(F.col("text").isNotNull()).join(wanted, ["id", "raw"]).select("id", "key", "text", "seeds", "again"), "texts")
    texts = fetched.where("NOT again").unionByName(fetched.where("again").dropDuplicates(["id", "key"])).drop("again")
    held = stored(passages(texts, window), "passages")
    searched = search(held, window)
    # the first holder of a passage loses what the search found, later holders lose all of it
    spans = (held.select("id", "key", "seed", "name", "starts", "size").join(searched, ["seed", "name"])
             .select("id", "key", "starts", F.when(F.col("id") > F.col("owner"), F.array(F.lit(0))).otherwise(F.col("low")).alias("low"),
                     F.when(F.col("id") > F.col("owner"), F.array("size")).otherwise(F.col("high")).alias("high"))
             .where(F.size("low") > 0))
    # one document's spans: at most as many as it has words
    per_text = spans.groupBy("id", "key").agg(F.collect_list(F.struct("starts", "low", "high")).alias("spans"))

    def change(batches):
        for b in batches:
            out = {k: [] for k in ("id", "key", "n_removed", "kept_sha256", "cuts")}
            for doc, name, body, found in zip(b["id"], b["key"], b["text"], b["spans"]):
                words = split_words(body)
                if text_key(digest(words)) != name:
                    continue
                gone = covered(len(words), [(s + a, s + z) for f in found for s in f["starts"] for a, z in zip(f["low"], f["high"])])
                out["id"].append(doc)
                out["key"].append(name)
                out["n_removed"].append(int(gone.sum()))
                out["kept_sha256"].append(digest([w for w, g in zip(words, gone.tolist()) if not g]).hexdigest())
                out["cuts"].append(runs(gone).tolist())
            yield out

    changes = map_batches(texts.select("id", "key", "text").join(per_text, ["id", "key"]),
                          "id long, key long, n_removed long, kept_sha256 string, cuts array<int>", change)
    return rows, changes


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per input row: key, n_words, n_removed, kept_sha256 (of the kept words joined by spaces).

    Null and empty texts have no words. Repeated rows (same id) are not earlier than each other; of
    equal texts the least id keeps its words. A null id counts as the greatest. Texts shorter than a
    window keep everything.
    """
    rows, changes = find_repeats(docs, key, text, window)
    joined = rows.join(changes.drop("cuts"), ["id", "key"], "left")
    copy = (F.col("id") > F.col("first")) & (F.col("n_words") >= window)
    return joined.select(
        F.when(F.col("id") != LAST, F.col("id")).cast(docs.schema[key].dataType).alias(key), "n_words",
        F.when(copy, F.col("n_words")).when(F.col("id") == F.col("first"), F.coalesce("n_removed", F.lit(0)))
         .otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).when(F.col("id") == F.col("first"), F.coalesce("kept_sha256", "sha"))
         .otherwise(F.col("sha")).alias("kept_sha256"))


def drop_repeats(docs: DataFrame, columns: list[str], key: str = "doc_id", text: str = "text", window: int = WINDOW,
                 size: str | None = None) -> DataFrame:
    """``docs`` with the repeated words cut out of their texts (white space elsewhere stays as it was)
    and ``size`` (if named) set to the new number of code points. Documents that lose every word go."""
    rows, changes = find_repeats(docs, key, text, window)
    # only what changes travels, one row per id and text: null cuts for those that go
    copies = rows.where((F.col("id") > F.col("first")) & (F.col("n_words") >= window)).select("id", "raw", F.lit(None).cast("array<int>").alias("_cuts"))
    edited = (rows.where(F.col("id") == F.col("first")).select("id", "raw", "key", "n_words").join(changes.where("n_removed > 0"), ["id", "key"])
              .select("id", "raw", F.when(F.col("n_removed") < F.col("n_words"), F.col("cuts")).alias("_cuts")))
    edits = (copies.unionByName(edited).dropDuplicates(["id", "raw"])
             .select(F.col("id").alias("_id"), F.col("raw").alias("_raw"), "_cuts", F.lit(True).alias("_edit")))
    source = docs.select(*columns, F.coalesce(F.col(key).cast("long"), F.lit(LAST)).alias("_id"), digest_of(text).alias("_raw"))
    joined = source.join(edits, ["_id", "_raw"], "left")

    def apply(batches):
        for b in batches:
            keep = [not edit or cuts is not None for edit, cuts in zip(b["_edit"], b["_cuts"])]
            texts = []
            for body, cuts in zip(b[text], b["_cuts"]):
                if cuts is not None:
                    body = cut_words(body, covered(len(split_words(body)), list(zip(cuts[::2], cuts[1::2]))))
                texts.append(body)
            out = {c: [v for v, k in zip(b[c], keep) if k] for c in columns if c != text}
            out[text] = [t for t, k in zip(texts, keep) if k]
            if size:
                out[size] = [n if t is None else len(t) for n, t in zip(out[size], out[text])]
            yield out

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return map_batches(joined.select(*columns, "_edit", "_cuts"), schema, apply)

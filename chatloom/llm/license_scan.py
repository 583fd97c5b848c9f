"""Licence scan: positional rare-token index over licence templates.

A template is a short licence wording with a mandatory key phrase inside. Document frequencies of
the licence words are counted over all documents; every template posts its two rarest key-phrase
words with their positions. A file looks up its own occurrences of those words, turns each into the
place where the template would start, and intersects the places of the two postings. What is left is
verified against the whole key phrase, so every place is exact. The score of a place is the
IDF-weighted share of the template's words that stand at their relative positions.

The scan is a projection: no shuffle, one output row per input row, whatever the keys look like.
"""
from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import lower_ascii

LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    before: str      # words that usually precede the key phrase
    key: str         # the mandatory phrase
    after: str = ""
    base: bool = False

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def words(self) -> list[tuple[int, str]]:
        """All words with their position relative to the key phrase."""
        all_words = f"{self.before} {self.key} {self.after}".split()
        first = len(self.before.split())
        return [(i - first, w) for i, w in enumerate(all_words)]


TEMPLATES = [
    Template("mit", "released", "under the mit license", "", True),
    Template("apache-2", "licensed under the", "apache license version 2", "0", True),
    Template("cc-by-nc", "licensed under", "cc by nc", "4 0", True),
    Template("gpl-3", "licensed under the", "gnu general public license version 3"),
    Template("gpl-2", "licensed under the", "gnu general public license version 2"),
    Template("lgpl", "under the terms of the", "gnu lesser general public license"),
    Template("agpl", "under the terms of the", "gnu affero general public license"),
    Template("mpl-2", "subject to the terms of the", "mozilla public license v 2", "0"),
    Template("bsd", "", "redistribution and use in source and binary forms", "with or without modification"),
    Template("mit", "", "permission is hereby granted free of charge", "to any person obtaining a copy"),
    Template("isc", "", "permission to use copy modify and or distribute this software"),
    Template("unlicense", "this is", "free and unencumbered software released into the public domain"),
    Template("cc-by", "licensed under a", "creative commons attribution 4"),
    Template("cc-by-sa", "licensed under", "cc by sa", "4 0"),
    Template("cc0", "", "cc0 1 0 universal"),
]


def license_words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(LICENSE_WORD), 0)


def word_weights(docs: DataFrame, templates: list[Template], text: str = "text") -> dict[str, float]:
    """IDF of every template word, counted over all documents. The result has one number per
    template word: its size depends on the templates, not on the documents."""
    vocabulary = sorted({w for t in templates for _, w in t.words})
    lit = F.array(*[F.lit(w) for w in vocabulary])
    total = F.count(F.lit(1))
    # one pass: an array of 0/1 flags would be wide, so explode only the licence words a text has
    held = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(lit, license_words(F.col(text))))).alias("w"))
    counts = {r["w"]: r["n"] for r in held.groupBy("w").agg(total.alias("n")).collect()}
    n = counts.pop("", 0)
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1.0 for w in vocabulary}


def anchors(template: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The two rarest words of the key phrase (one if it has only one) with their first position."""
    words = template.key_words
    distinct = sorted(set(words), key=lambda w: (-idf[w], w))[:2]
    return [(w, words.index(w)) for w in distinct]


def template_places(t: Template, idf: dict[str, float], words: Column, hits: Column) -> Column:
    """Places (label, base, start of the key phrase, score) of one template in one file."""
    size = len(t.key_words)
    phrase = F.array(*[F.lit(x) for x in t.key_words])
    whole = sum(idf[x] for _, x in t.words)

    def posting(word: str, at: int) -> Column:
        return F.transform(F.filter(hits, lambda y: y["w"] == word), lambda y: y["i"] - F.lit(at))

    def score(start: Column) -> Column:
        total = F.lit(sum(idf[x] for x in t.key_words))
        for at, x in t.words:
            if not 0 <= at < size:
                # get() is null outside the array
                total = total + F.when(F.get(words, start + F.lit(at)) == x, F.lit(idf[x])).otherwise(F.lit(0.0))
        return F.least(F.lit(1.0), total / F.lit(whole))

    starts = None
    for word, at in anchors(t, idf):
        starts = posting(word, at) if starts is None else F.array_intersect(starts, posting(word, at))
    starts = F.filter(starts, lambda s: (s >= 0) & (F.slice(words, s + 1, size) == phrase))
    return F.transform(F.array_distinct(starts), lambda s: F.struct(
        F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), s.alias("start"), score(s).alias("score")))


def scan_licenses(docs: DataFrame, templates: list[Template] | None = None, key: str = "doc_id",
                  text: str = "text", idf: dict[str, float] | None = None) -> DataFrame:
    """One row per input row: key, n_words, ``places`` (array of label, base, start, score), n_base,
    first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words and no place (labels empty, positions null, score 0). A phrase
    that stands several times gives a place each time, also inside one very long text.
    """
    templates = TEMPLATES if templates is None else templates
    idf = word_weights(docs, templates, text) if idf is None else idf
    posted = sorted({w for t in templates for w, _ in anchors(t, idf)})
    low = lower_ascii(F.coalesce(F.col(text), F.lit("")))
    words = docs.select(F.col(key).alias("_key"), low.alias("_low")).select(
        "_key", F.regexp_extract_all("_low", F.lit(LICENSE_WORD), 0).alias("_words"),
        # a cheap test: files without any posted word skip the index
        F.col("_low").rlike("|".join(map(re.escape, posted))).alias("_any"))
    w = F.col("_words")
    no_hit = F.array().cast("array<struct<i:int,w:string>>")
    hits = F.when(F.col("_any"), F.filter(F.transform(w, lambda x, i: F.struct(i.alias("i"), x.alias("w"))),
                                          lambda h: h["w"].isin(posted))).otherwise(no_hit)
    hit_rows = words.select("_key", "_words", hits.alias("_hits"))
    h = F.col("_hits")
    place_type = "array<struct<label:string,base:boolean,start:int,score:double>>"
    found = [template_places(t, idf, w, h) for t in templates]
    places = F.when(F.size(h) > 0, F.concat(*found)).otherwise(F.array().cast(place_type))
    scanned = hit_rows.select("_key", F.size("_words").cast("long").alias("n_words"), places.alias("places"))
    p = F.col("places")
    base_starts = F.transform(F.filter(p, lambda x: x["base"]), lambda x: x["start"])
    labels = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    return scanned.select(
        F.col("_key").alias(key), "n_words", "places", F.size(base_starts).cast("long").alias("n_base"),
        F.array_min(base_starts).cast("long").alias("first_word"), F.array_max(base_starts).cast("long").alias("last_word"),
        labels(F.filter(p, lambda x: x["base"])).alias("base_labels"), labels(p).alias("labels"),
        F.coalesce(F.array_max(F.transform(p, lambda x: x["score"])), F.lit(0.0)).alias("score"))

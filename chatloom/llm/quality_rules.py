"""Quality rules: a ledger of failure bits.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per rule.
A policy is a versioned set of rules, i.e. a mask: applying it is ``bits & mask = 0``, and the effect
of leaving a rule out is a count over masks. Neither reads a text again.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import WORD, let, settled


@dataclass(frozen=True)
class Rule:
    name: str
    bit: int
    fails: Callable[[], Column]    # over the measurement columns
    base: bool = False


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


RULES = [
    Rule("few_words", 0, lambda: F.col("n_words") < 50, True),
    Rule("repeated_windows", 1, lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words"), True),
    Rule("symbols", 2, lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("repeated_lines", 3, lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("capitals", 4, lambda: 2 * F.col("n_capitals") > F.col("n_letters")),
    Rule("long_words", 5, lambda: F.col("word_chars") > 30 * F.col("n_words")),
    Rule("no_letters", 6, lambda: 2 * F.col("n_letters") < F.col("word_chars")),
]

POLICIES = [
    Policy("2026-01", ("few_words", "repeated_windows")),
    Policy("2026-02", ("few_words", "repeated_windows", "symbols", "repeated_lines", "capitals", "long_words", "no_letters")),
]

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_capitals"]


def mask(policy: Policy, rules: list[Rule] | None = None) -> int:
    bits = {r.name: r.bit for r in (rules or RULES)}
    return sum(1 << bits[name] for name in set(policy.rules))


def repeat_words(words: Column, windows: Column) -> Column:
    """Words covered by a 3-word window that occurs twice or more: sort (window, place) pairs, keep
    places whose window equals a neighbour's, count the distinct words under them."""
    def covered(s: Column) -> Column:
        n = F.size(s)
        twice = F.filter(F.sequence(F.lit(0), n - 1), lambda k: F.coalesce(F.get(s, k - 1)["w"] == F.get(s, k)["w"], F.lit(False))
                         | F.coalesce(F.get(s, k + 1)["w"] == F.get(s, k)["w"], F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda k: F.sequence(F.get(s, k)["i"], F.get(s, k)["i"] + 2)))))

    pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
    # most texts repeat no window; only the others sort
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(pairs, covered)).otherwise(F.lit(0))


def ledger(docs: DataFrame, rules: list[Rule] | None = None, key: str = "doc_id", text: str = "text",
           carry: list[str] = ()) -> DataFrame:
    """One row per input row: key, the measurements, ``bits`` (bit r set: rule r fails) and the
    columns named in ``carry``.

    A null or empty text measures 0 everywhere, so it fails ``few_words``. A window is compared by
    its 64-bit hash inside one document.
    """
    rules = rules or RULES
    kept = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None)
    words = docs.select(F.col(key).alias("_key"), kept.alias("_carry"), F.coalesce(F.col(text), F.lit("")).alias("_text")).select(
        "_key", "_carry", "_text", F.regexp_extract_all("_text", F.lit(WORD), 0).alias("_w"))
    w = F.col("_w")
    windows = F.when(F.size(w) > 2, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    parts = words.select("_key", "_carry", "_text", "_w", windows.alias("_g"), lines.alias("_lines"))
    count = lambda pattern: F.regexp_count("_text", F.lit(pattern)).cast("long")
    measured = settled(
        parts, ["_key", "_carry"], n_words=F.size("_w").cast("long"),
        word_chars=(F.length("_text") - F.regexp_count("_text", F.lit(r"[\x20\x09-\x0D]"))).cast("long"),
        n_symbols=count(r"[#*$%&|<>]"), n_lines=F.size("_lines").cast("long"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        n_repeat_words=repeat_words(F.col("_w"), F.col("_g")).cast("long"),
        n_letters=count(r"\p{L}"), n_capitals=count(r"\p{Lu}"))
    bits = F.lit(0).cast("long")
    for r in rules:
        bits = bits.bitwiseOR(F.when(r.fails(), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    carried = [F.col(f"_carry.{c}").alias(c) for c in carry if c != key]
    return measured.select(F.col("_key").alias(key), *carried, *MEASURES, bits.alias("bits"))


def apply_policy(entries: DataFrame, policy: Policy, rules: list[Rule] | None = None) -> DataFrame:
    """Adds ``policy``, ``base_failed`` and ``kept`` to ledger rows."""
    rules = rules or RULES
    base = sum(1 << r.bit for r in rules if r.base)
    return entries.select("*", F.lit(policy.version).alias("policy"),
                          (F.col("bits").bitwiseAND(F.lit(base)) != 0).alias("base_failed"),
                          (F.col("bits").bitwiseAND(F.lit(mask(policy, rules) | base)) == 0).alias("kept"))


def judge(docs: DataFrame, policy: Policy, rules: list[Rule] | None = None, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """The input's columns (none may bear a ledger name) with the ledger and the policy's verdict."""
    return apply_policy(ledger(docs, rules, key, text, carry=docs.columns), policy, rules)


def ablation(entries: DataFrame, policies: list[Policy] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """For every policy and each of its rules: documents the rule rejects, documents only it rejects
    (kept again without it) and documents kept with and without it.

    Ledger rows are first counted per bit pattern (at most 2^rules groups), then every
    (policy, rule) is a masked sum over the patterns.
    """
    rules = rules or RULES
    by_name = {r.name: r.bit for r in rules}
    patterns = entries.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    cases = F.array(*[F.struct(F.lit(p.version).alias("policy"), F.lit(name).alias("rule"),
                               F.lit(mask(p, rules)).cast("long").alias("policy_mask"),
                               F.lit(1 << by_name[name]).cast("long").alias("rule_mask"))
                      for p in (policies or POLICIES) for name in p.rules])
    pairs = patterns.select("bits", "n", F.inline(cases))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    failed, rest = F.col("bits").bitwiseAND(F.col("policy_mask")), F.col("policy_mask") - F.col("rule_mask")
    return pairs.groupBy("policy", "rule").agg(
        total(F.col("bits").bitwiseAND(F.col("rule_mask")) != 0)("n_failed"),
        total(failed == F.col("rule_mask"))("n_only"),
        total(failed == 0)("n_kept"),
        total(F.col("bits").bitwiseAND(rest) == 0)("n_kept_without"))

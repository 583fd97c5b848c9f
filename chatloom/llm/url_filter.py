"""URL filter: pattern rules indexed by their rarest literal token.

Every rule names the literal tokens (runs of a-z and 0-9) that any URL it matches must hold as whole
tokens. Token frequencies are counted over all URLs; each rule is indexed under its rarest token
only. A URL's tokens fetch the rules indexed under them, and only those rules run their regular
expression. Rules without a literal are indexed under the empty token, which every URL has.

Work is done once per distinct URL (a verdict depends on the URL alone), so a URL that fills a third
of the table is evaluated once and joined back.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import literal_rows, lower_ascii

#: rules are a caller's list, sent as literals; beyond this many, the index is joined by a shuffle
MAX_BROADCAST_RULES = 20_000


@dataclass(frozen=True)
class Rule:
    name: str              # shown in the result
    action: str            # "allow" or "block"
    regex: str
    literals: tuple[str, ...]
    on_address: bool       # the regex runs on host + path; otherwise on the lower-cased whole URL
    tier: int              # a higher tier wins; inside a tier the longest name wins


def address_rule(host: str, path: str, action: str) -> Rule:
    """A host with all its subdomains, and paths that start with ``path`` (which starts with /)."""
    regex = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(path)
    literals = tuple(re.findall("[a-z0-9]+", host.lower()))
    # the last token of a path prefix may go on in the URL unless the prefix ends with a separator
    literals += tuple(re.findall(r"[a-z0-9]+(?![a-z0-9]|$)", path.lower()))
    return Rule(host + path, action, regex, literals, True, 1)


def word_rule(name: str, words: str, action: str = "block") -> Rule:
    """Consecutive whole words anywhere in the URL."""
    tokens = words.split(" ")
    regex = r"(?:^|[^a-z0-9])" + "[^a-z0-9]+".join(map(re.escape, tokens)) + r"(?:[^a-z0-9]|$)"
    return Rule(name, action, regex, tuple(tokens), False, 0)


BASE_RULES = [
    address_rule("net", "/", "block"),
    address_rule("example.net", "/en/", "allow"),
    address_rule("example.com", "/de/", "block"),
    address_rule("org", "/fr/", "allow"),
]

METHOD_RULES = [
    word_rule("gambling:casino", "casino"),
    word_rule("gambling:free-bets", "free bets"),
    word_rule("gambling:poker", "poker online"),
    word_rule("pharma:cheap-pills", "cheap pills"),
    word_rule("pharma:buy-pills", "buy pills"),
    word_rule("ads:ads-track", "ads track"),
    word_rule("ads:adserver", "adserver"),
    word_rule("account:wp-login", "wp login php"),
    Rule("binary:exe", "block", r"\.exe(?:[?#]|$)", ("exe",), False, 0),
    Rule("binary:zip", "block", r"\.zip(?:[?#]|$)", ("zip",), False, 0),
    Rule("binary:jpg", "block", r"\.jpg(?:[?#]|$)", ("jpg",), False, 0),
    Rule("account:session", "block", r"[?&;]sessionid=", ("sessionid",), False, 0),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): both empty for a null URL or one without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_index(tokens: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """Each rule under its rarest literal: the one in the fewest URLs, ties to the smaller token."""
    literals = rules.select("rule_no", F.explode(F.when(F.size("literals") > 0, F.col("literals"))
                                                 .otherwise(F.array(F.lit("")))).alias("token"))
    wanted = literals.select("token").distinct()
    found = tokens.join(F.broadcast(wanted) if small else wanted, "token", "left_semi")
    seen = found.groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    rarest = (literals.join(F.broadcast(seen) if small else seen, "token", "left")
              .groupBy("rule_no").agg(F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("token")))
    return rarest.join(rules.drop("literals"), "rule_no")


def filter_urls(pages: DataFrame, rules: list[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: key, host, path, ``rule`` (the fitting address rule), ``verdict``
    (allow or block; the address rule's if one fits, else block if a pattern fits, else allow) and
    ``pattern`` (the fitting pattern).

    A null URL or one without ``://`` has empty host and path; patterns still see its text. Repeated
    rows stay, equal lengths go to the smaller name, an empty table gives an empty result.
    """
    small = len(rules) <= MAX_BROADCAST_RULES
    spark = pages.sparkSession
    table = literal_rows(spark, [
        {"rule_no": i, "name": r.name, "action": r.action, "regex": r.regex, "literals": list(r.literals),
         "on_address": r.on_address, "tier": r.tier} for i, r in enumerate(rules)],
        "rule_no int, name string, action string, regex string, literals array<string>, on_address boolean, tier int")
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"))
    host, path = split_url(F.col("_url"))
    urls = (rows.where(F.col("_url").isNotNull()).select("_url").distinct()
            .select("_url", F.concat(host, path).alias("_address"), lower_ascii(F.col("_url")).alias("_lower")))
    # the address holds every token an address rule can need, the URL those of the patterns
    tokens = F.array_distinct(F.concat(F.regexp_extract_all("_lower", F.lit("[a-z0-9]+"), 0), F.array(F.lit(""))))
    keyed = urls.select("*", F.explode(tokens).alias("token"))
    index = rule_index(keyed.select("token"), table, small)
    candidates = keyed.join(F.broadcast(index) if small else index, "token")
    fits = candidates.where(F.expr("CASE WHEN on_address THEN _address ELSE _lower END RLIKE regex"))
    # the longest name of each tier, ties to the rule listed first
    rank = F.struct(F.length("name"), -F.col("rule_no"))
    hit = F.struct("name", "action")
    best = fits.groupBy("_url").agg(
        F.max_by(F.when(F.col("tier") == 1, hit), F.when(F.col("tier") == 1, rank)).alias("_rule"),
        F.max_by(F.when(F.col("tier") == 0, hit), F.when(F.col("tier") == 0, rank)).alias("_pattern"))
    out = rows.join(best, "_url", "left")
    return out.select(
        F.col("_key").alias(key), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"),
        F.col("_rule.name").alias("rule"),
        F.coalesce("_rule.action", "_pattern.action", F.lit("allow")).alias("verdict"),
        F.col("_pattern.name").alias("pattern"))

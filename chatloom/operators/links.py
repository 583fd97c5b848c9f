"""The crawler's logic over a stored page corpus (no network).

Link extraction is a regex over the raw HTML (JVM-side); the class-token filter looks at each
anchor's own ``class`` attribute. Reachability is an iterative frontier join with a reliable
checkpoint every few rounds.
"""
from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.attributes import attribute, decode_entities
from chatloom.session import cut_lineage

# a tag up to its end; a > inside a quoted value is not the end
ANCHOR = r"""<a\s(?:[^>"']|"[^"]*"|'[^']*')*+>"""


def extract_links(pages: DataFrame, html: str = "html", key: str = "page_id",
                  css_class: str | None = None, carry: list[str] = ()) -> DataFrame:
    """G1: hrefs of the page's anchors (entities decoded), in page order; with ``css_class`` only
    anchors whose class list holds that exact token (``card`` matches ``big card`` but not
    ``cardigan``). ``carry`` names further page columns of the result."""
    tags = F.regexp_extract_all(F.col(html), F.lit(f"(?is)({ANCHOR})"), 1)
    staged = pages.select(F.col(key), *carry, F.posexplode(tags).alias("ordinal", "_tag"))
    if css_class:
        token = re.escape(css_class)
        staged = staged.where(attribute(F.col("_tag"), "class").rlike(rf"(?:^|\s){token}(?:\s|$)"))
    return (staged.withColumn("href", decode_entities(attribute(F.col("_tag"), "href")))
            .where(F.col("href").isNotNull()).select(key, *carry, "ordinal", "href"))


def origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def absolute(href: Column, page_url: Column) -> Column:
    """Root-relative links resolved against the page's origin; absolute ones kept."""
    return F.when(href.startswith("/") & ~href.startswith("//"), F.concat(origin(page_url), href)).otherwise(href)


def internal_links(links: DataFrame, base: Column, url: str = "url") -> DataFrame:
    """Flag each link internal (starts with ``base + '/'``) or external, with its host."""
    return (links.withColumn("internal", F.col(url).startswith(F.concat(base, F.lit("/"))))
            .withColumn("host", host(F.col(url))))


def slug(url: Column) -> Column:
    return F.element_at(F.split(url, "/", -1), -1)


def slug_dedupe(urls: DataFrame, known: DataFrame | None, url: str = "url",
                order: list[str] = ("page_id", "ordinal")) -> DataFrame:
    """One URL per slug (the first in ``order`` wins), minus slugs already stored."""
    firsts = (urls.withColumn("slug", slug(F.col(url)))
              .groupBy("slug").agg(F.min_by(F.col(url), F.struct(*order)).alias(url)))
    if known is not None:
        firsts = firsts.join(known.select("slug"), "slug", "left_anti")
    return firsts


def reachable(edges: DataFrame, seeds: DataFrame, checkpoint_every: int = 4) -> DataFrame:
    """Every node reachable from the seeds, with its BFS depth (seeds have depth 0). Rounds go on
    until no new node is found, however deep the graph is.

    Each round joins the frontier with the edges, keeps unseen destinations, and appends them.
    Every ``checkpoint_every`` rounds the visited set is checkpointed to the shared folder so the
    lineage (and a lost executor's recomputation) stays short.
    """
    # every round reads the edges: materialise them once in the shared folder
    e = cut_lineage(edges.select("src", "dst").distinct())
    seen = seeds.select(F.col("node")).distinct().withColumn("depth", F.lit(0))
    frontier = seen
    for depth in itertools.count(1):
        nxt = (frontier.join(e, frontier.node == e.src).select(F.col("dst").alias("node")).distinct()
               .join(seen.select("node"), "node", "left_anti")
               .withColumn("depth", F.lit(depth)))
        # the new frontier is read three times (emptiness test, visited set, next round)
        nxt = cut_lineage(nxt)
        if nxt.isEmpty():
            break
        seen = seen.unionByName(nxt)
        if depth % checkpoint_every == 0:
            seen = cut_lineage(seen)
        frontier = nxt
    return seen


def search_seeds(terms: DataFrame, step: int = 24, max_offset: Column | int = 0, term: str = "term") -> DataFrame:
    """G5 seeds: (term, offset) for offsets 0, step, 2*step ... up to ``max_offset``."""
    mx = F.lit(max_offset) if isinstance(max_offset, int) else max_offset
    return terms.select(F.col(term), F.explode(F.sequence(F.lit(0), mx, F.lit(step))).alias("offset"))


def until_exhausted(results: DataFrame, min_links: int = 2, term: str = "term") -> DataFrame:
    """G5 stop rule: per term, the result pages up to and including the first one with fewer
    than ``min_links`` links (2 reproduces the original off-by-one; 1 is the intended rule)."""
    stop = (results.groupBy(term)
            .agg(F.min(F.when(F.col("links") < min_links, F.col("offset"))).alias("_stop")))
    return (results.join(stop, term)
            .where(F.col("_stop").isNull() | (F.col("offset") <= F.col("_stop")))
            .drop("_stop"))


def fetch_ok(fetch_log: DataFrame, status: str = "status") -> tuple[DataFrame, DataFrame]:
    """Responses to keep (status 200) and a count of the rest by status (null is one of them)."""
    good = F.col(status).eqNullSafe(200)
    ok = fetch_log.where(good)
    errors = fetch_log.where(~good).groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    return ok, errors


def unseen_links(pages: DataFrame, known_urls: DataFrame, css_class: str | None = None) -> DataFrame:
    """Rescan every stored page for links and keep the URLs not stored yet."""
    links = extract_links(pages, css_class=css_class, carry=["url"])
    abs_ = links.select(absolute(F.col("href"), F.col("url")).alias("url")).distinct()
    return abs_.join(known_urls.select("url"), "url", "left_anti")

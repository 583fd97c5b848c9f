"""G1-G7 over the stored pages (and a co-purchase graph for reachability)."""
from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import links as L
from chatloom.plans.registry import register
from chatloom.plans.sql_views import with_views
from chatloom.sources.tables import load, page_view

_TAGS = """SELECT page_id, url, CAST(n - 1 AS INTEGER) AS ordinal, tags[n] AS tag
FROM (SELECT page_id, url, tags, generate_subscripts(tags, 1) AS n
      FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)(<a\\s[^>]*>)', 1) AS tags FROM pages))"""
_HREF = "regexp_extract(tag, '(?is)\\bhref\\s*=\\s*\"([^\"]*)\"', 1)"
for _name, _char in [("quot", '"'), ("copy", "\u00a9"), ("middot", "\u00b7"), ("amp", "&")]:
    _HREF = f"replace({_HREF}, '&{_name};', '{_char}')"
_LINKS = f"""SELECT page_id, url AS page_url, ordinal, {_HREF} AS href
FROM ({_TAGS}) WHERE regexp_matches(tag, '(?is)\\bhref\\s*=\\s*"([^"]*)"')"""
_ORIGIN = "regexp_extract(page_url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"
_ABS = f"""SELECT page_id, ordinal, CASE WHEN starts_with(href, '/') AND NOT starts_with(href, '//')
                                     THEN {_ORIGIN} || href ELSE href END AS url, {_ORIGIN} AS base
FROM links"""


def _links(spark, sf_dir):
    return L.extract_links(load(spark, sf_dir, "pages"))


def _absolute(spark, sf_dir):
    pages = load(spark, sf_dir, "pages").withColumnRenamed("url", "page_url")
    return (L.extract_links(pages, carry=["page_url"])
            .select("page_id", "ordinal", L.absolute(F.col("href"), F.col("page_url")).alias("url"),
                    L.origin(F.col("page_url")).alias("base")))


@register("extract_links", f"WITH links AS ({_LINKS}) SELECT page_id, ordinal, href FROM links")
def extract_links(spark, sf_dir):
    return _links(spark, sf_dir)


@register("internal_links", f"""WITH links AS ({_LINKS}), abs AS ({_ABS})
SELECT page_id, ordinal, url, starts_with(url, base || '/') AS internal,
       regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1) AS host FROM abs""")
def internal_links(spark, sf_dir):
    out = L.internal_links(_absolute(spark, sf_dir), F.col("base"))
    return out.select("page_id", "ordinal", "url", "internal", "host")


@register("slug_dedupe", f"""WITH links AS ({_LINKS}), abs AS ({_ABS}), page AS (
  SELECT string_split(url, '/')[-1] AS slug FROM pages)
SELECT slug, list(url ORDER BY page_id, ordinal)[1] AS url
FROM (SELECT string_split(url, '/')[-1] AS slug, url, page_id, ordinal FROM abs)
WHERE slug NOT IN (SELECT slug FROM page)
GROUP BY slug""")
def slug_dedupe(spark, sf_dir):
    known = page_view(spark, sf_dir).select("slug")
    return L.slug_dedupe(_absolute(spark, sf_dir), known).select("slug", "url")


_EDGES_SQL = """SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1"""


def co_purchase_edges(spark, sf_dir):
    """Part -> the part on the next line of the same order (a shuffle join on both keys, so a
    very large order is spread over tasks)."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    nxt = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    return li.join(nxt, ["l_orderkey", "l_linenumber"]).select(F.col("l_partkey").alias("src"), "dst")


@register("reachable_pages", f"""WITH RECURSIVE edges AS ({_EDGES_SQL}),
r(node) AS (SELECT min(l_partkey) FROM lineitem UNION SELECT e.dst FROM r JOIN edges e ON e.src = r.node)
SELECT node FROM r""")
def reachable_pages(spark, sf_dir):
    seeds = load(spark, sf_dir, "lineitem").agg(F.min("l_partkey").alias("node"))
    return L.reachable(co_purchase_edges(spark, sf_dir), seeds).select("node")


_PAGING_SQL = """WITH brands AS (SELECT p_brand AS term, count(*) AS n FROM part GROUP BY p_brand),
results AS (SELECT term, "offset", CAST(least(24, greatest(n - "offset", 0)) AS BIGINT) AS links
            FROM (SELECT term, n, unnest(range(0, (n // 24 + 1) * 24 + 1, 24)) AS "offset" FROM brands)),
stop AS (SELECT term, min("offset") FILTER (WHERE links < 2) AS s FROM results GROUP BY term)
SELECT r.term, CAST(r."offset" AS BIGINT) AS "offset", r.links
FROM results r JOIN stop USING (term) WHERE stop.s IS NULL OR r."offset" <= stop.s"""


@register("search_paging", _PAGING_SQL)
def search_paging(spark, sf_dir):
    brands = load(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    seeds = L.search_seeds(brands, 24, ((F.col("n") / 24).cast("long") + 1) * 24).join(brands, "term")
    results = seeds.select("term", F.col("offset").cast("long").alias("offset"),
                           F.least(F.lit(24), F.greatest(F.col("n") - F.col("offset"), F.lit(0))).cast("long")
                           .alias("links"))
    return L.until_exhausted(results, min_links=2).select("term", "offset", "links")


@register("fetch_ok", """SELECT status, count(*) AS n FROM (
  SELECT CASE WHEN contains(html, '</html>') THEN 200 ELSE 206 END AS status FROM pages) GROUP BY status""")
def fetch_ok(spark, sf_dir):
    log = load(spark, sf_dir, "pages").select(
        "url", F.when(F.col("html").contains("</html>"), 200).otherwise(206).alias("status"))
    ok, errors = L.fetch_ok(log)
    return (ok.agg(F.count(F.lit(1)).alias("n")).select(F.lit(200).alias("status"), "n").where(F.col("n") > 0)
            .unionByName(errors.select("status", "n")))


@register("rescan_corpus", f"""WITH links AS ({_LINKS}), abs AS ({_ABS})
SELECT DISTINCT url FROM abs WHERE url NOT IN (SELECT url FROM pages)""")
def rescan_corpus(spark, sf_dir):
    pages = load(spark, sf_dir, "pages")
    return L.unseen_links(pages, pages.select("url"))

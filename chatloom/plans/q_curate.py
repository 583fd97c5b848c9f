"""B1-B3."""
from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.operators import curate as B
from chatloom.operators import vectors as V
from chatloom.operators.generate import stand_in_embedding
from chatloom.plans import sql_gen as S
from chatloom.plans.registry import register
from chatloom.plans.sql_views import with_views
from chatloom.sources.tables import document_view, load, recipe_view, training_view

# what \w stands for in Unicode: letters, marks, digits, letter numbers, connectors, joiners
_NORM = r"trim(regexp_replace(lower(text), '[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}]+', ' ', 'g'))"


@register("exact_duplicates", f"""WITH h AS (SELECT doc_id AS id, md5({_NORM}) AS h FROM documents)
SELECT h.id, k.keep_id FROM h JOIN (SELECT h, min(id) AS keep_id FROM h GROUP BY h) k USING (h)""")
def exact_duplicates(spark, sf_dir):
    """B1, exact part: copies after normalisation map to the smallest id."""
    d = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return B.exact_duplicates(d)


def _near_sql(threshold: float = 0.8, bands: int = 8, rows: int = 4, rounds: int = 7) -> str:
    """near_duplicates in SQL: crc32 by table, seeded minima, buckets, then a CTE per round of leaders (``rounds``
    of them settle buckets of up to 2 ** rounds - 1 unlike documents; more would leave a row with a null keep_id)."""
    minima = ", ".join(f"min(({a} * x + {b}) % {B.PRIME}) AS h{i}" for i, (a, b) in enumerate(map(B.seeded, range(bands * rows))))
    buckets = " UNION ALL ".join(
        f"SELECT id, {j} AS band, concat_ws(',', {', '.join(f'h{j * rows + r}' for r in range(rows))}) AS bucket FROM sig" for j in range(bands))
    crowded = "QUALIFY count(*) OVER (PARTITION BY band, bucket) > 1"
    ctes = [f"norm AS (SELECT doc_id AS id, {_NORM} AS t FROM documents)",
            "words AS (SELECT id, string_split(t, ' ') AS w FROM norm WHERE t <> '')",
            "gram AS MATERIALIZED (SELECT DISTINCT id, s FROM (SELECT id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), "
            "lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM words))",
            "size AS (SELECT id, count(*) AS n FROM gram GROUP BY id)",
            "crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], "
            "lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t)",
            "bytes AS (SELECT s, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS b "
            "FROM (SELECT s, hex(encode(s)) AS h FROM gram GROUP BY s))",
            "hashed AS MATERIALIZED (SELECT s, xor(list_reduce(list_prepend(4294967295, b), lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), "
            "4294967295) AS x FROM bytes, crc)",
            f"sig AS MATERIALIZED (SELECT id, {minima} FROM gram JOIN hashed USING (s) GROUP BY id)",
            f"left0 AS MATERIALIZED (SELECT * FROM ({buckets}) {crowded})"]
    for i in range(rounds):
        ctes += [f"chosen{i} AS MATERIALIZED (SELECT * FROM left{i} QUALIFY row_number() OVER (PARTITION BY band, bucket ORDER BY id) <= {2 ** i})",
                 f"met{i} AS MATERIALIZED (SELECT DISTINCT l.id, c.id AS other FROM left{i} l JOIN chosen{i} c USING (band, bucket) WHERE c.id < l.id)",
                 f"both{i} AS (SELECT m.id, m.other, count(*) AS n FROM met{i} m JOIN gram a ON a.id = m.id JOIN gram b ON b.id = m.other AND b.s = a.s GROUP BY ALL)",
                 f"found{i} AS MATERIALIZED (SELECT p.id, p.other FROM both{i} p JOIN size a ON a.id = p.id JOIN size b ON b.id = p.other "
                 f"WHERE p.n / (a.n + b.n - p.n) >= {threshold})",
                 f"left{i + 1} AS MATERIALIZED (SELECT l.* FROM left{i} l ANTI JOIN chosen{i} c ON l.id = c.id AND l.band = c.band AND l.bucket = c.bucket "
                 f"WHERE l.id NOT IN (SELECT id FROM found{i}) {crowded})"]
    edges = " UNION ".join(f"SELECT id, other FROM found{i} UNION SELECT other, id FROM found{i}" for i in range(rounds))
    ctes += [f"edge AS MATERIALIZED ({edges})",
             "reach(id, other) AS (SELECT id, id FROM edge UNION SELECT reach.id, edge.other FROM reach JOIN edge ON edge.id = reach.other)",
             "label AS (SELECT id, min(other) AS label FROM reach GROUP BY id)"]
    return "WITH RECURSIVE " + ",\n".join(ctes) + f"""
SELECT d.doc_id AS id, CASE WHEN NOT EXISTS (SELECT 1 FROM left{rounds}) THEN coalesce(label, d.doc_id) END AS keep_id
FROM documents d LEFT JOIN label ON label.id = d.doc_id"""


@register("near_duplicates", _near_sql())
def near_duplicates(spark, sf_dir):
    """B1: near copies (shingle MinHash bands, verified Jaccard >= 0.8 with bucket leaders, components) -> keep_id."""
    d = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return B.near_duplicates(d)


RECIPE_SEARCH_SQL = with_views("recipe", extra=[("items", """
SELECT id, unique_title, review_score, len(ingredients) AS n_ing, ingredients, unnest(category) AS category
FROM recipe WHERE review_score >= 4.0"""), ("names", """
SELECT *, unnest(list_distinct(list_transform(ingredients, lambda x: regexp_extract(x, ' of (.*)$', 1)))) AS ingredient
FROM items"""), ("share", """
SELECT *, len(list_filter(ingredients, lambda x: regexp_extract(x, ' of (.*)$', 1) = ingredient)) / n_ing AS share
FROM names""")]) + """
SELECT category, ingredient, rank, id, unique_title, share, review_score FROM (
  SELECT *, row_number() OVER (PARTITION BY category, ingredient ORDER BY share DESC, review_score DESC, id) AS rank
  FROM share) WHERE rank <= 3"""


@register("recipe_search", RECIPE_SEARCH_SQL)
def recipe_search(spark, sf_dir):
    return B.recipe_search(recipe_view(spark, sf_dir), k=3, min_score=4.0).select(
        "category", "ingredient", F.col("rank").cast("long").alias("rank"), "id", "unique_title", "share",
        "review_score")


_SEARCH_SQL = RECIPE_SEARCH_SQL


@register("recipe_search_conversations", _SEARCH_SQL.replace(
    "SELECT category, ingredient, rank, id, unique_title, share, review_score FROM (",
    "SELECT category, ingredient, 'Find ' || lower(category) || ' recipes, ingredient ' || ingredient || '.'"
    " AS question, 'Found:' || chr(10) || string_agg('- ' || unique_title, chr(10) ORDER BY rank) AS answer"
    " FROM (").replace("WHERE rank <= 3", "WHERE rank <= 3 GROUP BY category, ingredient"))
def recipe_search_conversations(spark, sf_dir):
    """B2 messages: the question for a (category, ingredient) and the recipes proposed for it."""
    best = B.recipe_search(recipe_view(spark, sf_dir), k=3, min_score=4.0)
    return B.recipe_search_chat(best)


@register("corpus_profile", with_views("document") + """
SELECT author AS source, count(*) AS n_docs, min(strlen(text)) AS min_bytes, round(avg(strlen(text)), 3) AS avg_bytes,
       max(strlen(text)) AS max_bytes, count(*) FILTER (WHERE strlen(text) > 500) AS over_500,
       count(*) FILTER (WHERE strlen(text) > 8000) AS over_8000
FROM document GROUP BY author""")
def corpus_profile(spark, sf_dir):
    d = document_view(spark, sf_dir).select(F.col("author").alias("source"), "text")
    out = B.corpus_profile(d, [500, 8000], by="source")
    return out.select("source", "n_docs", F.col("min_bytes").cast("long").alias("min_bytes"), "avg_bytes",
                      F.col("max_bytes").cast("long").alias("max_bytes"), "over_500", "over_8000")


def _alike_sql(vectors: str, key: str, threshold: float) -> str:
    """CTEs: every pair of ``vectors`` (key, v) compared; ``kept`` names the least key that pairs lead to."""
    return f"""{vectors}, pair AS (
  SELECT a.{key} AS x, b.{key} AS y FROM vec a JOIN vec b ON a.{key} <> b.{key} WHERE list_cosine_similarity(a.v, b.v) >= {threshold} - 1e-9
), reach(x, y) AS (
  SELECT {key}, {key} FROM vec UNION SELECT reach.x, pair.y FROM reach JOIN pair ON pair.x = reach.y
), kept AS (
  SELECT x AS {key}, min(y) AS keep_id FROM reach GROUP BY x
)"""


@register("near_vectors", "WITH RECURSIVE " + _alike_sql(
    "vec AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)", "vec_id", 0.9) + " SELECT vec_id, keep_id FROM kept")
def near_vectors(spark, sf_dir):
    """B1, embedding variant: look-alikes by cosine of at least 0.9."""
    return V.near_vectors(load(spark, sf_dir, "embeddings"))


@register("unique_conversations", S.with_ctes(S.base_ctes()).replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ", " + _alike_sql(
    f"""asked AS (
  SELECT conversation, arg_min(content, position) AS question FROM training WHERE revision = 'base' AND role = 'user' GROUP BY conversation
), vec AS (SELECT conversation, {S.embedding_sql('question')} AS v FROM asked)""", "conversation", 0.99) + """
SELECT conversation, position, content, role, trainer, 'unique' AS revision, source FROM training
WHERE revision = 'base' AND conversation NOT IN (SELECT conversation FROM kept WHERE conversation <> keep_id)""")
def unique_conversations(spark, sf_dir):
    """B1 on training rows: conversations that ask alike (cosine of their first questions) go, the others come out under a new revision."""
    return V.deduplicate_training(training_view(spark, sf_dir), stand_in_embedding, "base", "unique", threshold=0.99)

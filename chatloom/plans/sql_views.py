"""The stand-in views of ``chatloom.sources.tables`` written in DuckDB SQL (for the oracles).

Each constant is one CTE body; ``with_views`` glues the ones a query needs in front of it.
"""
from __future__ import annotations

VIEWS = {
    "recipe": """
  SELECT p.p_partkey AS id, p.p_partkey AS document, p.p_name AS title,
         p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS unique_title,
         CAST(p.p_size AS DOUBLE) / 10.0 AS review_score,
         CAST(coalesce(li.review_count, 0) AS BIGINT) AS review_count,
         list_transform(string_split(p.p_name || ' ' || lower(p.p_type), ' '),
                        lambda w, i: CAST(p.p_size + i - 1 AS VARCHAR) || ' g of ' || w) AS ingredients,
         ['Mix the ' || p.p_name || '.', 'Cook for ' || CAST(p.p_size AS VARCHAR) || ' minutes.', 'Serve.']
           AS directions,
         CASE WHEN p.p_partkey % 6 = 0 THEN CAST([] AS STRUCT(k VARCHAR, v VARCHAR)[])
              ELSE [{'k': 'energy', 'v': CAST(coalesce(li.qty, 0) AS VARCHAR) || ' kcal'}] END AS nutrition,
         ['Nice ' || lower(p.p_type) || ' dish.', 'Made it with ' || p.p_brand || '.'] AS reviews,
         CASE p.p_partkey % 3 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [p.p_type]
              ELSE [p.p_type, p.p_brand] END AS category,
         CASE p.p_partkey % 4 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN [p.p_brand]
              ELSE [p.p_brand, p.p_type, 'Home'] END AS cuisine,
         CASE WHEN p.p_partkey % 5 = 0 THEN NULL ELSE CAST(p.p_partkey * 97 % 9000 AS BIGINT) END AS prep_time,
         CASE WHEN p.p_partkey % 7 = 0 THEN NULL ELSE CAST(p.p_partkey * 131 % 90000 AS BIGINT) END AS total_time,
         CAST(p.p_size AS VARCHAR) || ' servings' AS recipe_yield
  FROM part p LEFT JOIN (
    SELECT l_partkey, count(*) FILTER (WHERE l_returnflag = 'R') AS review_count,
           sum(CAST(floor(l_quantity) AS BIGINT)) AS qty
    FROM lineitem GROUP BY l_partkey) li ON p.p_partkey = li.l_partkey""",
    "document": """
  SELECT doc_id AS id,
         CASE WHEN split_part(text, chr(10), 1) = '' THEN source || '-' || CAST(doc_id AS VARCHAR)
              ELSE split_part(text, chr(10), 1) END AS title,
         text, source AS author, 'doc/' || CAST(doc_id AS VARCHAR) AS source,
         CAST(NULL AS VARCHAR) AS subtitle, lang
  FROM documents""",
    "training": """
  SELECT 'c' || CAST(conv_id AS VARCHAR) AS conversation, CAST(turn AS INTEGER) AS position, text AS content,
         role, ['evaluator', 'summarizer', 'recipe'][(conv_id % 3) + 1] AS trainer, 'base' AS revision,
         conv_id AS source
  FROM conversations
  UNION ALL
  SELECT 's' || CAST(doc_id AS VARCHAR), 0, '', 'none', 'summarizer', 'base', doc_id
  FROM labels WHERE toxic = 1""",
    "page": """
  SELECT page_id, url, string_split(url, '/')[-1] AS slug, html, 'page/' || CAST(page_id AS VARCHAR) AS source
  FROM pages""",
}


def lines_sql(x: str) -> str:
    return f"array_to_string({x}, chr(10))"


def numbered_sql(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda s, i: CAST(i AS VARCHAR) || '. ' || s), chr(10))"


def card_sql(title: str, ingredients: str, directions: str) -> str:
    return (f"({title} || chr(10) || '        ' || chr(10) || 'Ingredients:' || chr(10) || {lines_sql(ingredients)}"
            f" || chr(10) || chr(10) || 'Instructions:' || chr(10) || {numbered_sql(directions)} || chr(10))")


def natural_list_sql(x: str) -> str:
    return (f"(CASE WHEN len({x}) = 0 THEN NULL WHEN len({x}) = 1 THEN {x}[1] "
            f"ELSE array_to_string({x}[1:len({x}) - 1], ', ') || ' and ' || {x}[-1] END)")


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def chatml_sql(role: str, content: str) -> str:
    """One message in ChatML."""
    return f"('<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10))"


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in names]
    for name, body in extra or []:
        parts.append(f"{name} AS (\n{body}\n)")
    return "WITH " + ",\n".join(parts) + "\n"

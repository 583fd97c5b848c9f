"""DuckDB SQL for the generator oracles, built from the same prompt constants and pools.

Prompts are rendered by string concatenation (ChatML), the stand-in model is md5 arithmetic,
phrases are picked by the same hash, so the SQL and the Spark jobs must agree exactly.
"""
from __future__ import annotations

from chatloom.operators import prompts as P
from chatloom.operators.complete import HEX, RETRIES, STAND_IN_LEADS, reask
from chatloom.plans.sql_views import VIEWS, card_sql, lines_sql, natural_list_sql, strip_sql

ASSIST = "('<|im_start|>assistant' || chr(10))"


def lit(s: str) -> str:
    """A SQL string literal (newlines as chr(10))."""
    parts = s.split("\n")
    return "(" + " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts) + ")"


def msg(role: str, content: str) -> str:
    return f"('<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>' || chr(10))"


def struct(role: str, content: str) -> str:
    return f"{{'role': '{role}', 'content': {content}}}"


def digit(h: str, pos: str) -> str:
    return f"(strpos('{HEX}', substr({h}, {pos}, 1)) - 1)"


def model_from_hash(h: str, options: list[str] | None = None, max_tokens: int = 400) -> str:
    if options:
        opts = "[" + ", ".join(lit(o) for o in options) + "]"
        return f"{opts}[{digit(h, '1')} % {len(options)} + 1]"
    if max_tokens < 600:
        return f"('r' || substr({h}, 1, 8))"
    leads = "[" + ", ".join(lit(x) for x in STAND_IN_LEADS) + "]"
    d = digit(h, "k + 1")
    line = (f"CASE WHEN {d} = 0 THEN '' ELSE CAST(k AS VARCHAR) || '. ' END || {leads}[{d} % 4 + 1] || ' ' || "
            f"substr({h}, k + 2, 6) || '?'")
    return f"array_to_string(list_transform(range(1, {digit(h, '1')} + 2), lambda k: {line}), chr(10))"


def model(prompt: str, options: list[str] | None = None, max_tokens: int = 400) -> str:
    return model_from_hash(f"md5({prompt})", options, max_tokens)


def flaky(prompt: str, options: list[str] | None = None, max_tokens: int = 400) -> str:
    """The stand-in that fails, see ``complete.flaky_stand_in``."""
    h = f"md5({prompt})"
    answer = model(prompt, options, max_tokens)
    if options:
        answer = (f"CASE WHEN {digit(h, '31')} < 4 THEN 'perhaps ' || substr({h}, 1, 4) "
                  f"WHEN {digit(h, '30')} % 2 = 1 THEN ' ' || upper({answer}) || chr(10) ELSE {answer} END")
    return f"CASE WHEN {digit(h, '32')} <> 0 THEN {answer} END"


def asked_ctes(name: str, src: str, out: str, prompt: str, when: str, error: str, options: list[str] | None = None,
               max_tokens: int = 400, retries: int = RETRIES) -> list[tuple[str, str]]:
    """One question of ``complete.ask`` to the failing stand-in: ``src`` with ``out``, ``out``_tries, ``out``_asked
    and ``out``_error (``error`` so far or what went wrong here)."""
    ok = f"({error}) IS NULL AND coalesce({when}, false)"
    ctes = [(f"{name}_0", f"SELECT *, {ok} AS {out}_asked, {prompt} AS {out}_chat FROM {src}"),
            (f"{name}_a0", f"SELECT *, CASE WHEN {out}_asked THEN {flaky(f'({out}_chat || {ASSIST})', options, max_tokens)} END AS {out}_r0, 1 AS {out}_t0 "
                           f"FROM {name}_0")]
    last = 0
    if options:
        among = ", ".join(lit(o) for o in options)
        bad = lambda c: f"coalesce(lower({strip_sql(c)}) NOT IN ({among}), false)"
        for k in range(1, retries + 1):
            p = k - 1
            chat = f"{out}_chat" if p == 0 else f"{out}_c{p}"
            ctes.append((f"{name}_b{k}", f"SELECT *, {bad(f'{out}_r{p}')} AS {out}_bad{k}, {chat} || {msg('assistant', f'{out}_r{p}')} || "
                                         f"{msg('user', lit(reask(options)))} AS {out}_c{k} FROM {name}_a{p}"))
            ctes.append((f"{name}_a{k}", f"SELECT *, CASE WHEN {out}_bad{k} THEN {flaky(f'({out}_c{k} || {ASSIST})', options, max_tokens)} ELSE {out}_r{p} END "
                                         f"AS {out}_r{k}, {out}_t{p} + CASE WHEN {out}_bad{k} THEN 1 ELSE 0 END AS {out}_t{k} FROM {name}_b{k}"))
            last = k
        value, wrong = f"lower({strip_sql(f'{out}_r{last}')})", bad(f"{out}_r{last}")
    else:
        value, wrong = f"{out}_r{last}", "false"
    ctes.append((name, f"""SELECT *, CASE WHEN NOT {wrong} THEN {value} END AS {out}, {out}_t{last} AS {out}_tries,
       coalesce({error}, CASE WHEN {out}_asked AND {out}_r{last} IS NULL THEN 'no_answer:{out}' END,
                CASE WHEN {out}_asked AND {wrong} THEN 'invalid:{out}' END) AS {out}_error FROM {name}_a{last}"""))
    return ctes


def pick(slot: str, key: str) -> str:
    items = P.POOLS[slot]
    if isinstance(items[0], (list, tuple)):
        arr = "[" + ", ".join("[" + ", ".join(lit(x) for x in it) + "]" for it in items) + "]"
    else:
        arr = "[" + ", ".join(lit(x) for x in items) + "]"
    idx = f"CAST(('0x' || substr(md5('{slot}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) % {len(items)} + 1"
    return f"{arr}[{idx}]"


def fmt_lit(template: str, *values: str) -> str:
    parts = template.split("{}")
    out = [lit(parts[0])]
    for i, v in enumerate(values, start=1):
        if i < len(parts):
            out.append(f"{v} || {lit(parts[i])}")
    return "(" + " || ".join(out) + ")"


def fmt_expr(template: str, *values: str) -> str:
    parts = f"string_split({template}, '{{}}')"
    out = [f"{parts}[1]"]
    for i, v in enumerate(values, start=1):
        out.append(f"CASE WHEN len({parts}) > {i} THEN {v} || {parts}[{i + 1}] ELSE '' END")
    return "(" + " || ".join(out) + ")"


def natural_duration(x: str) -> str:
    from chatloom.plans.q_text import natural_duration_sql
    return natural_duration_sql(x)


SYS = msg("system", lit(P.SYSTEM))


def explode_sql(src: str, trainer: str, revision: str, source: str, conv: str | None = None) -> str:
    conv = conv or f"md5(concat_ws(chr(31), '{trainer}', '{revision}', CAST({source} AS VARCHAR)))"
    return f"""SELECT {conv} AS conversation, CAST(pos - 1 AS INTEGER) AS position, messages[pos].content AS content,
       messages[pos].role AS role, '{trainer}' AS trainer, '{revision}' AS revision, CAST({source} AS BIGINT) AS source
FROM (SELECT *, generate_subscripts(messages, 1) AS pos FROM {src})"""


# ---- pending sets ----------------------------------------------------------------------------
def rdoc_view() -> str:
    return f"""SELECT document AS id, unique_title AS title, {card_sql('unique_title', 'ingredients', 'directions')} AS text,
       'kitchen' AS author, 'part/' || CAST(document AS VARCHAR) AS source, CAST(NULL AS VARCHAR) AS subtitle
FROM recipe"""


def pending_recipes_view(trainer: str, revision: str = "base") -> str:
    return f"""SELECT r.id AS reid, r.document, d.title, d.text, d.author, d.source AS doc_source, d.subtitle,
       r.ingredients, r.directions, r.nutrition, r.review_score, r.review_count, r.reviews, r.category, r.cuisine,
       r.prep_time, r.total_time, r.recipe_yield
FROM recipe r JOIN rdoc d ON r.document = d.id
WHERE NOT EXISTS (SELECT 1 FROM training t WHERE t.source = r.document AND t.trainer = '{trainer}'
                  AND t.revision = '{revision}')"""


def pending_articles_view(trainer: str = "summarizer", revision: str = "base", min_bytes: int = 8000) -> str:
    return f"""SELECT * FROM document d
WHERE strlen(d.text) > {min_bytes}
  AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.quality = 1 AND l.doc_id = d.id)
  AND NOT EXISTS (SELECT 1 FROM training t WHERE t.source = d.id AND t.trainer = '{trainer}'
                  AND t.revision = '{revision}')"""


def base_ctes(*extra: tuple[str, str]) -> list[tuple[str, str]]:
    return [("recipe", VIEWS["recipe"]), ("document", VIEWS["document"]), ("training", VIEWS["training"]),
            ("rdoc", rdoc_view()), *extra]


def with_ctes(ctes: list[tuple[str, str]]) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in ctes) + "\n"


# ---- evaluator -------------------------------------------------------------------------------
def evaluator_ctes(src: str = "ev_in") -> list[tuple[str, str]]:
    score = "CAST(review_score AS VARCHAR)"
    gate_q = msg("user", lit(P.EVAL_GATE))
    return [
        ("ev0", f"""SELECT document, title, review_score,
       CASE WHEN review_score >= 4.4 THEN 'good' WHEN review_score < 3.7 THEN 'bad' ELSE 'maybe' END AS bucket,
       {lit(P.EVAL_INTRO)} || {card_sql('title', 'ingredients', 'directions')} AS intro_c,
       {lit(P.EVAL_REVIEWS)} || {lines_sql('reviews')} AS rev_c
FROM {src} WHERE review_count >= 10 AND review_score IS NOT NULL"""),
        ("ev1", f"SELECT *, {SYS} || {msg('user', 'intro_c')} || {msg('user', 'rev_c')} AS pre FROM ev0"),
        ("ev2", f"""SELECT *, {model(f"pre || {msg('user', fmt_lit(P.EVAL_WHY, score))} || {ASSIST}")} AS why,
       CASE WHEN bucket <> 'good' THEN {model(f"pre || {gate_q} || {ASSIST}", P.YES_NO)} END AS gate
FROM ev1"""),
        ("ev3", f"""SELECT *, CASE WHEN gate = 'yes' THEN
         {model(f"pre || {gate_q} || {msg('assistant', 'gate')} || {msg('user', lit(P.EVAL_CRITIQUE))} || {ASSIST}")}
       END AS critique FROM ev2"""),
    ]


def failing_evaluator_ctes(src: str = "ev_in") -> list[tuple[str, str]]:
    """The evaluator's rounds with the failing stand-in; ``fv`` has bucket, why, gate, critique and ``error``."""
    score = "CAST(review_score AS VARCHAR)"
    gate_q = msg("user", lit(P.EVAL_GATE))
    ctes = evaluator_ctes(src)[:2]
    ctes += asked_ctes("fv1", "ev1", "why", f"pre || {msg('user', fmt_lit(P.EVAL_WHY, score))}", "true", "CAST(NULL AS VARCHAR)")
    ctes += asked_ctes("fv2", "fv1", "gate", f"pre || {gate_q}", "bucket <> 'good'", "why_error", P.YES_NO)
    ctes += asked_ctes("fv3", "fv2", "critique", f"pre || {gate_q} || {msg('assistant', 'gate')} || {msg('user', lit(P.EVAL_CRITIQUE))}",
                       "gate = 'yes'", "gate_error")
    return [*ctes, ("fv", "SELECT *, critique_error AS error FROM fv3")]


def evaluator_messages(src: str = "ev3") -> str:
    score = "CAST(review_score AS VARCHAR)"
    template = (f"CASE WHEN bucket = 'good' THEN {pick('rating_high', 'document')} WHEN bucket = 'bad' THEN "
                f"{pick('rating_low', 'document')} ELSE {pick('rating_mid', 'document')} END")
    has = "coalesce(critique <> '', false)"
    return f"""SELECT document, list_filter([
  {struct('user', 'intro_c')},
  {struct('user', pick('ask_rating', 'document'))},
  {struct('assistant', strip_sql(fmt_expr(template, score, 'why')))},
  CASE WHEN {has} THEN {struct('user', pick('ask_changes', 'document'))} END,
  CASE WHEN {has} THEN {struct('assistant', 'critique')} END], lambda m: m IS NOT NULL) AS messages
FROM {src}"""


# ---- recipe chat -----------------------------------------------------------------------------
def recipe_ctes(src: str = "rc_in", extra: int = 3) -> list[tuple[str, str]]:
    judge = msg("user", lit(P.SECRET_JUDGE))
    more = msg("user", lit(P.SECRET_MORE))
    ctes = [
        ("rc0", f"""SELECT *, {pick('request', 'document')} AS variation,
       {msg('user', lit(P.RECIPE_INTRO) + ' || text')} AS article_m FROM {src} WHERE review_score >= 4.0"""),
        ("rc1", f"SELECT *, {msg('user', fmt_lit(P.RECIPE_TITLE, 'title', 'variation[1]'))} AS title_m FROM rc0"),
        ("rc2", f"SELECT *, {model(f'{SYS} || article_m || title_m || {ASSIST}', max_tokens=20)} AS title_answer FROM rc1"),
        ("rc3", f"""SELECT *, {SYS} || article_m || title_m || {msg('assistant', 'title_answer')} ||
       {msg('user', lit(P.SECRET_FIRST))} AS c1 FROM rc2"""),
        ("rc4", f"SELECT *, {model(f'c1 || {ASSIST}')} AS a1 FROM rc3"),
        ("rc5", f"SELECT *, c1 || {msg('assistant', 'a1')} || {judge} AS c1j FROM rc4"),
        ("rc6", f"""SELECT *, {model(f'c1j || {ASSIST}', P.YES_NO)} AS j1 FROM rc5"""),
        ("rc7", f"""SELECT *, coalesce(j1 = 'no', false) AS alive1,
       CASE WHEN j1 = 'no' THEN [a1] ELSE CAST([] AS VARCHAR[]) END AS secrets1 FROM rc6"""),
    ]
    prev = "rc7"
    for k in range(2, extra + 2):
        p = k - 1
        ctes += [
            (f"rs{k}a", f"""SELECT *, CASE WHEN alive{p} THEN c{p}j || {msg('assistant', f'j{p}')} || {more} END AS c{k}
FROM {prev}"""),
            (f"rs{k}b", f"""SELECT *, CASE WHEN alive{p} THEN {model(f'c{k} || {ASSIST}')} END AS a{k} FROM rs{k}a"""),
            (f"rs{k}c", f"""SELECT *, coalesce(alive{p} AND NOT starts_with(lower(a{k}), 'no'), false) AS go{k} FROM rs{k}b"""),
            (f"rs{k}d", f"""SELECT *, CASE WHEN go{k} THEN c{k} || {msg('assistant', f'a{k}')} || {judge} END AS c{k}j
FROM rs{k}c"""),
            (f"rs{k}e", f"""SELECT *, CASE WHEN go{k} THEN {model(f'c{k}j || {ASSIST}', P.YES_NO)} END AS j{k} FROM rs{k}d"""),
            (f"rs{k}f", f"""SELECT *, coalesce(go{k} AND j{k} <> 'yes', false) AS alive{k},
       CASE WHEN coalesce(go{k} AND j{k} <> 'yes', false) THEN list_append(secrets{p}, a{k}) ELSE secrets{p} END
         AS secrets{k} FROM rs{k}e"""),
        ]
        prev = f"rs{k}f"
    last = extra + 1
    ctes.append(("rc_done", f"""SELECT *, secrets{last} AS secrets,
       CASE WHEN len(secrets{last}) > 0 THEN
         {model(f"{SYS} || {msg('user', lit(P.SECRET_SUMMARY) + f' || array_to_string(secrets{last}, chr(10))')} || {ASSIST}")}
       END AS summary FROM {prev}"""))
    return ctes


def recipe_messages(src: str = "rc_done") -> str:
    k = "document"
    nd = natural_duration
    p_ok, t_ok = "coalesce(prep_time <> 0, false)", "coalesce(total_time <> 0, false)"
    t_ans = (f"CASE WHEN {p_ok} AND {t_ok} THEN {fmt_expr(pick('tell_both_times', k), nd('prep_time'), nd('total_time'))}"
             f" WHEN {p_ok} THEN {fmt_expr(pick('tell_preparation', k), nd('prep_time'))}"
             f" WHEN {t_ok} THEN {fmt_expr(pick('tell_total', k), nd('total_time'))} END")
    nut = "array_to_string(list_transform(nutrition, lambda e: e.k || ': ' || e.v), chr(10))"
    return f"""SELECT document, list_filter([
  {struct('user', 'title_answer || variation[2]')},
  {struct('assistant', card_sql('title', 'ingredients', 'directions'))},
  CASE WHEN len(nutrition) > 0 THEN {struct('user', pick('ask_nutrition', k))} END,
  CASE WHEN len(nutrition) > 0 THEN {struct('assistant', nut)} END,
  CASE WHEN len(cuisine) > 0 THEN {struct('user', pick('ask_cuisine', k))} END,
  CASE WHEN len(cuisine) > 0 THEN {struct('assistant', pick('tell_cuisine', k) + ' || ' + natural_list_sql('cuisine'))} END,
  CASE WHEN len(category) > 0 THEN {struct('user', pick('ask_category', k))} END,
  CASE WHEN len(category) > 0 THEN
    {struct('assistant', pick('tell_category', k) + ' || ' + natural_list_sql('category') + " || '.'")} END,
  CASE WHEN ({t_ans}) IS NOT NULL THEN {struct('user', pick('ask_time', k))} END,
  CASE WHEN ({t_ans}) IS NOT NULL THEN {struct('assistant', t_ans)} END,
  CASE WHEN len(secrets) > 0 THEN {struct('user', pick('ask_tips', k))} END,
  CASE WHEN len(secrets) > 0 THEN {struct('assistant', 'summary')} END], lambda m: m IS NOT NULL) AS messages
FROM {src}"""


# ---- article questions -----------------------------------------------------------------------
def article_ctes(src: str = "ar_in") -> list[tuple[str, str]]:
    art = msg("user", lit(P.ARTICLE_INTRO) + " || text")
    return [
        ("ar0", f"""SELECT id, text, {model(f"{SYS} || {art} || {msg('user', lit(P.ARTICLE_CLASS))} || {ASSIST}",
                                           P.ARTICLE_CLASSES)} AS article_class FROM {src}"""),
        ("ar1", f"""SELECT *, CASE WHEN article_class NOT IN ('anecdotes', 'story') THEN
         {model(f"{SYS} || {art} || {msg('user', lit(P.ARTICLE_QUESTIONS))} || {ASSIST}", max_tokens=600)}
       END AS question_list FROM ar0"""),
    ]


def failing_article_ctes(src: str = "ar_in") -> list[tuple[str, str]]:
    """The article rounds with the failing stand-in; ``fa`` has question_list and ``error``."""
    art = msg("user", lit(P.ARTICLE_INTRO) + " || text")
    return [("fa0", f"SELECT id, text FROM {src}"),
            *asked_ctes("fa1", "fa0", "article_class", f"{SYS} || {art} || {msg('user', lit(P.ARTICLE_CLASS))}", "true",
                        "CAST(NULL AS VARCHAR)", P.ARTICLE_CLASSES),
            *asked_ctes("fa2", "fa1", "question_list", f"{SYS} || {art} || {msg('user', lit(P.ARTICLE_QUESTIONS))}",
                        "article_class NOT IN ('anecdotes', 'story')", "article_class_error", max_tokens=600),
            ("fa", "SELECT *, question_list_error AS error FROM fa2")]


def question_lines_sql(src: str, key: str, text: str) -> str:
    """T14 in SQL: lines (Python splitlines on \\n; the answers hold no other breaks), banned
    substrings, list prefix."""
    banned = "|".join(P.BANNED_QUESTION_WORDS)
    return f"""SELECT {key} AS source, CAST(n - 1 AS INTEGER) AS ordinal,
       regexp_extract(line, '^[0-9.-]* (.*)', 1) AS question
FROM (SELECT {key}, n, ls[n] AS line
      FROM (SELECT {key}, ls, generate_subscripts(ls, 1) AS n
            FROM (SELECT {key}, CASE WHEN {text} = '' THEN CAST([] AS VARCHAR[])
                                     ELSE string_split(regexp_replace({text}, '\\n$', ''), chr(10)) END AS ls
                  FROM {src})))
WHERE NOT regexp_matches(line, '{banned}') AND regexp_matches(line, '^[0-9.-]* ')"""


def embedding_sql(text: str, dims: int = 8) -> str:
    raw = f"list_transform(range(1, {dims + 1}), lambda i: CAST({digit(f'md5({text})', 'i')} AS DOUBLE) - 7.5)"
    return f"list_transform({raw}, lambda x: x / sqrt(list_sum(list_transform({raw}, lambda y: y * y))))"


def diverse_ctes(src: str, group: str, ordinal: str, vec: str, keep: int = 6, prefix: str = "dv") -> list[tuple[str, str]]:
    """T15 as a recursive CTE: the state per group is (dropped ordinals, running sum, count)."""
    return [
        (f"{prefix}_items", f"SELECT {group} AS grp, {ordinal} AS ord, {vec} AS vec FROM {src}"),
        (f"{prefix}_sum", f"""SELECT grp, list(s ORDER BY i) AS s, max(n) AS n
FROM (SELECT grp, i, sum(vec[i]) AS s, count(*) AS n
      FROM (SELECT grp, vec, generate_subscripts(vec, 1) AS i FROM {prefix}_items) GROUP BY grp, i)
GROUP BY grp"""),
        (f"{prefix}_state", f"""SELECT grp, CAST([] AS INTEGER[]) AS removed, s, n FROM {prefix}_sum
UNION ALL
SELECT grp, list_append(removed, ord), list_transform(s, lambda a, i: a - vec[i]), n - 1
FROM (SELECT d.grp, d.removed, d.s, d.n, q.ord, q.vec,
             row_number() OVER (PARTITION BY d.grp ORDER BY list_dot_product(q.vec, d.s) DESC, q.ord DESC) AS rk
      FROM {prefix}_state d JOIN {prefix}_items q ON q.grp = d.grp AND NOT list_contains(d.removed, q.ord)
      WHERE d.n > {keep})
WHERE rk = 1"""),
        (f"{prefix}_final", f"SELECT grp, arg_max(removed, len(removed)) AS removed FROM {prefix}_state GROUP BY grp"),
        (f"{prefix}_kept", f"""SELECT q.grp, q.ord FROM {prefix}_items q JOIN {prefix}_final f ON q.grp = f.grp
WHERE NOT list_contains(f.removed, q.ord)"""),
    ]


def question_ctes(lines: str = "q_lines", articles: str = "ar1") -> list[tuple[str, str]]:
    art = msg("user", lit(P.ARTICLE_INTRO) + " || a.text")
    ask = msg("user", fmt_lit(P.ARTICLE_ANSWER, "q.question"))
    return [
        ("q_vec", f"SELECT source, ordinal, {embedding_sql('question')} AS vec FROM {lines}"),
        *diverse_ctes("q_vec", "source", "ordinal", "vec", 6, "qd"),
        ("q_ans", f"""SELECT q.source, q.ordinal, q.question,
       {model(f"{SYS} || {art} || {ask} || {ASSIST}", max_tokens=2000)} AS reply
FROM {lines} q JOIN qd_kept k ON q.source = k.grp AND q.ordinal = k.ord JOIN {articles} a ON a.id = q.source"""),
        ("q_msgs", f"""SELECT source, ordinal, [{struct('user', 'question')}, {struct('assistant', 'reply')}] AS messages
FROM q_ans"""),
        ("q_rows", explode_sql("q_msgs", "summarizer", "base", "source",
                               conv="md5(concat_ws(chr(31), 'summarizer', 'base', CAST(source AS VARCHAR), "
                                    "CAST(ordinal AS VARCHAR)))")),
    ]


def failing_question_ctes(lines: str = "q_lines", articles: str = "fa") -> list[tuple[str, str]]:
    """Replies of the failing stand-in: ``fq`` has a row per kept question, ``fq_rows`` the rows of the articles without any error."""
    base = question_ctes(lines, articles)
    art = msg("user", lit(P.ARTICLE_INTRO) + " || text")
    question = msg("user", fmt_lit(P.ARTICLE_ANSWER, "question"))
    at = next(i for i, (n, _) in enumerate(base) if n == "q_ans")
    return [*base[:at],
            ("fq0", f"""SELECT q.source, q.ordinal, q.question, a.text
FROM {lines} q JOIN qd_kept k ON q.source = k.grp AND q.ordinal = k.ord JOIN {articles} a ON a.id = q.source"""),
            *asked_ctes("fq", "fq0", "reply", f"{SYS} || {art} || {question}", "true", "CAST(NULL AS VARCHAR)", max_tokens=2000),
            ("fq_lost", f"""SELECT source, min(error) AS error FROM (
  SELECT source, reply_error AS error FROM fq UNION ALL SELECT id, error FROM {articles}) WHERE error IS NOT NULL GROUP BY source"""),
            ("q_ans", "SELECT * FROM fq WHERE source NOT IN (SELECT source FROM fq_lost)"), *base[at + 1:]]


def with_recursive(ctes: list[tuple[str, str]]) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS (\n{b}\n)" for n, b in ctes) + "\n"

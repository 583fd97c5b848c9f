"""Conversation generators over pending inputs.

A generator is ``(inputs, model, pools) -> DataFrame[training]``. Each model round is one
``model.answer`` call that adds a column; optional turns are ``when`` structs filtered out of a
message array, and positions come from ``posexplode`` (T13). Inputs never meet each other:
every generator is narrow per input row, except the question step, which explodes an
answer into lines and regroups them per article (a handful of lines per group).
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.chat import message
from chatloom.functions.text import (fill, fmt, key_values, lines, natural_duration, natural_list, recipe_card,
                                     splitlines)
from chatloom.operators import prompts as P
from chatloom.operators.complete import STAND_IN, Model, ask
from chatloom.operators.pools import Pools
from chatloom.schemas import TRAINING_COLUMNS, md5_key
from chatloom.session import cut_lineage

DEFAULT_POOLS = Pools(P.POOLS)


# ---------------------------------------------------------------------------------------------
# eligibility
# ---------------------------------------------------------------------------------------------
def evaluator_eligible(recipes: DataFrame, min_reviews: int = 10) -> DataFrame:
    """At least ``min_reviews`` reviews and a score (a null score is not eligible)."""
    return recipes.where((F.col("review_count") >= min_reviews) & F.col("review_score").isNotNull())


def score_bucket(score, good: float = 4.4, bad: float = 3.7) -> Column:
    """>= good -> good, < bad -> bad, else maybe."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= good, "good").when(s < bad, "bad").otherwise("maybe")


def recipe_eligible(recipes: DataFrame, min_score: float = 4.0) -> DataFrame:
    """A score of at least ``min_score``."""
    return recipes.where(F.col("review_score").isNotNull() & (F.col("review_score") >= min_score))


# ---------------------------------------------------------------------------------------------
# Message arrays -> training rows
# ---------------------------------------------------------------------------------------------
def explode_messages(df: DataFrame, trainer: str, revision: str, source: str = "source",
                     messages: str = "messages", conversation: Column | None = None, errors: bool = False) -> DataFrame:
    """One row per message, position dense from 0 in array order; one conversation per row of
    ``df`` (id = md5 of trainer, revision, source[, extra key]).

    A row of ``df`` with an ``error`` has no messages. With ``errors`` the result has that column too, and such
    a row comes out once, with its source and error alone."""
    conv = conversation if conversation is not None else md5_key(F.lit(trainer), F.lit(revision), F.col(source))
    if "error" in df.columns:
        df = df.withColumn(messages, F.when(F.col("error").isNull(), F.col(messages)))
    if errors:
        error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
        staged = (df.select(conv.alias("conversation"), F.col(source).cast("long").alias("source"), error.alias("error"),
                            F.posexplode_outer(messages).alias("position", "m"))
                  .where(F.col("m").isNotNull() | F.col("error").isNotNull()))
        found = F.col("error").isNull()
        return staged.select(F.when(found, F.col("conversation")).alias("conversation"), F.col("position").cast("int").alias("position"),
                             F.col("m.content").alias("content"), F.col("m.role").alias("role"), F.lit(trainer).alias("trainer"),
                             F.lit(revision).alias("revision"), "source", "error")
    # posexplode_outer: an inner explode makes Spark infer a "size(messages) > 0" filter and push
    # it below the generator, inlining every model round into one huge predicate.
    staged = (df.select(conv.alias("conversation"), F.col(source).cast("long").alias("source"),
                        F.posexplode_outer(messages).alias("position", "m"))
              .where(F.col("m").isNotNull()))
    return staged.select("conversation", F.col("position").cast("int").alias("position"),
                         F.col("m.content").alias("content"), F.col("m.role").alias("role"),
                         F.lit(trainer).alias("trainer"), F.lit(revision).alias("revision"),
                         "source").select(*TRAINING_COLUMNS)


def _present(arr: Column) -> Column:
    return F.filter(arr, lambda m: m.isNotNull())


def _sys() -> Column:
    return message("system", F.lit(P.SYSTEM))


# ---------------------------------------------------------------------------------------------
# T4, T5: evaluator
# ---------------------------------------------------------------------------------------------
def evaluator_rounds(inputs: DataFrame, model: Model = STAND_IN) -> DataFrame:
    """The evaluator's model rounds: reason for the score; for scores under "good", whether the
    reviews agree on improvements (yes/no); a critique when they do (T5)."""
    r = evaluator_eligible(inputs)
    score = F.col("review_score").cast("string")
    intro = message("user", F.concat(F.lit(P.EVAL_INTRO), recipe_card("title", "ingredients", "directions")))
    reviews = message("user", F.concat(F.lit(P.EVAL_REVIEWS), lines("reviews")))
    base = [_sys(), intro, reviews]
    r = r.withColumn("bucket", score_bucket("review_score")).withColumn("_intro", intro)
    r = ask(model, r, F.array(*base, message("user", fmt(F.lit(P.EVAL_WHY), score))), "why")
    gate_q = message("user", F.lit(P.EVAL_GATE))
    r = ask(model, r, F.array(*base, gate_q), "gate", options=P.YES_NO, when=F.col("bucket") != "good")
    crit = F.array(*base, gate_q, message("assistant", F.col("gate")), message("user", F.lit(P.EVAL_CRITIQUE)))
    return ask(model, r, crit, "critique", when=F.col("gate") == "yes")


def evaluator(inputs: DataFrame, model: Model = STAND_IN, pools: Pools = DEFAULT_POOLS,
              trainer: str = "evaluator", revision: str = "base", errors: bool = False) -> DataFrame:
    """T4: intro with the recipe card; the rating question and the scored answer; and, when the
    score is not good and a critique was written, the improvement question and the critique."""
    r = evaluator_rounds(inputs, model)
    key = F.col("document")
    score = F.col("review_score").cast("string")
    template = (F.when(F.col("bucket") == "good", pools.pick("rating_high", key))
                .when(F.col("bucket") == "bad", pools.pick("rating_low", key))
                .otherwise(pools.pick("rating_mid", key)))
    has_crit = F.coalesce(F.col("critique") != "", F.lit(False))
    msgs = _present(F.array(
        F.col("_intro"),
        message("user", pools.pick("ask_rating", key)),
        message("assistant", fill(template, score, F.col("why"))),
        F.when(has_crit, message("user", pools.pick("ask_changes", key))),
        F.when(has_crit, message("assistant", F.col("critique"))),
    ))
    return explode_messages(r.withColumn("messages", msgs), trainer, revision, "document", errors=errors)


# ---------------------------------------------------------------------------------------------
# Recipe chat
# ---------------------------------------------------------------------------------------------
def secrets_rounds(r: DataFrame, model: Model, base: list[Column], extra: int = 3) -> DataFrame:
    """Ask for the recipe's secret, then "anything else?" up to ``extra`` times.

    The first answer counts only if judged not common knowledge; each later answer stops the
    chain if it starts with "no" (any case) or is judged common. Adds ``secrets`` (kept answers
    in order, at most 1 + extra).
    """
    yes_no = P.YES_NO
    r = r.withColumn("_c", F.array(*base, message("user", F.lit(P.SECRET_FIRST))))
    r = ask(model, r, F.col("_c"), "_a", kind="secret")
    r = r.withColumn("_c", F.concat("_c", F.array(message("assistant", F.col("_a")),
                                                   message("user", F.lit(P.SECRET_JUDGE)))))
    r = ask(model, r, F.col("_c"), "_j", options=yes_no, kind="secret_judge")
    # cheap boolean steps share one projection with the column they guard (fewer plan analyses)
    first = F.coalesce(F.col("_j") == "no", F.lit(False))
    r = r.withColumns({"_alive": first,
                       "secrets": F.when(first, F.array("_a")).otherwise(F.array().cast("array<string>"))})
    for _ in range(extra):
        r = r.withColumn("_c", F.when(F.col("_alive"), F.concat("_c", F.array(
            message("assistant", F.col("_j")), message("user", F.lit(P.SECRET_MORE))))))
        r = ask(model, r, F.col("_c"), "_a", when=F.col("_alive"), kind="secret")
        go = F.col("_alive") & ~F.lower(F.col("_a")).startswith("no")
        r = r.withColumns({"_go": go, "_c": F.when(go, F.concat("_c", F.array(
            message("assistant", F.col("_a")), message("user", F.lit(P.SECRET_JUDGE)))))})
        r = ask(model, r, F.col("_c"), "_j", options=yes_no, when=F.col("_go"), kind="secret_judge")
        keep = F.coalesce(F.col("_go") & (F.col("_j") != "yes"), F.lit(False))
        r = r.withColumns({"_alive": keep,
                           "secrets": F.when(keep, F.concat("secrets", F.array("_a"))).otherwise(F.col("secrets"))})
    return r.drop("_c", "_a", "_j", "_alive", "_go")


def recipe_rounds(inputs: DataFrame, model: Model = STAND_IN, pools: Pools = DEFAULT_POOLS) -> DataFrame:
    r = recipe_eligible(inputs)
    key = F.col("document")
    article = message("user", F.concat(F.lit(P.RECIPE_INTRO), F.col("text")))
    variation = pools.pick("request", key)
    title_prompt = message("user", fmt(F.lit(P.RECIPE_TITLE), F.col("title"), F.element_at(variation, 1)))
    r = r.withColumn("_variation", variation)
    r = ask(model, r, F.array(_sys(), article, title_prompt), "title_answer", max_tokens=20)
    r = secrets_rounds(r, model, [_sys(), article, title_prompt, message("assistant", F.col("title_answer"))])
    summary = F.array(_sys(), message("user", F.concat(F.lit(P.SECRET_SUMMARY), F.array_join("secrets", "\n"))))
    return ask(model, r, summary, "summary", when=F.size("secrets") > 0)


def time_answer(pools: Pools, key: Column, prep: Column, total: Column) -> Column:
    """Both times, prep only or total only; a zero time counts as missing."""
    p_ok = F.coalesce(prep != 0, F.lit(False))
    t_ok = F.coalesce(total != 0, F.lit(False))
    p_txt, t_txt = natural_duration(prep), natural_duration(total)
    return (F.when(p_ok & t_ok, fmt(pools.pick("tell_both_times", key), p_txt, t_txt))
            .when(p_ok, fmt(pools.pick("tell_preparation", key), p_txt))
            .when(t_ok, fmt(pools.pick("tell_total", key), t_txt)))


def recipe_messages(inputs: DataFrame, model: Model = STAND_IN, pools: Pools = DEFAULT_POOLS) -> DataFrame:
    """T7-T12 in one message array per recipe: title request -> card; nutrition; cuisine;
    category; time; and last the summarized secrets."""
    r = recipe_rounds(inputs, model, pools)
    key = F.col("document")
    has_n = F.size("nutrition") > 0
    has_cu = F.size("cuisine") > 0
    has_ca = F.size("category") > 0
    t_ans = time_answer(pools, key, F.col("prep_time"), F.col("total_time"))
    has_t = t_ans.isNotNull()
    has_s = F.size("secrets") > 0
    msgs = _present(F.array(
        message("user", F.concat(F.col("title_answer"), F.element_at("_variation", 2))),
        message("assistant", recipe_card("title", "ingredients", "directions")),
        F.when(has_n, message("user", pools.pick("ask_nutrition", key))),
        F.when(has_n, message("assistant", key_values("nutrition"))),
        F.when(has_cu, message("user", pools.pick("ask_cuisine", key))),
        F.when(has_cu, message("assistant", F.concat(pools.pick("tell_cuisine", key), natural_list("cuisine")))),
        F.when(has_ca, message("user", pools.pick("ask_category", key))),
        F.when(has_ca, message("assistant", F.concat(pools.pick("tell_category", key),
                                                     natural_list("category"), F.lit(".")))),
        F.when(has_t, message("user", pools.pick("ask_time", key))),
        F.when(has_t, message("assistant", t_ans)),
        F.when(has_s, message("user", pools.pick("ask_tips", key))),
        F.when(has_s, message("assistant", F.col("summary"))),
    ))
    return r.withColumn("messages", msgs)


def recipe_chat(inputs: DataFrame, model: Model = STAND_IN, pools: Pools = DEFAULT_POOLS,
                trainer: str = "recipe", revision: str = "base", errors: bool = False) -> DataFrame:
    """T7-T12 as training rows, one conversation per recipe."""
    return explode_messages(recipe_messages(inputs, model, pools), trainer, revision, "document", errors=errors)


def question_answers(chats: DataFrame, question: Column, source: str = "document", messages: str = "messages") -> DataFrame:
    """(source, question, answer): the user message that is ``question`` and the message after it, out of the
    message array itself, so the chat is evaluated once."""
    asked = chats.select(source, messages, question.alias("_question"), F.posexplode_outer(messages).alias("_at", "_m"))
    return (asked.where((F.col("_m.role") == "user") & (F.col("_m.content") == F.col("_question")))
            .select(source, F.col("_question").alias("question"), F.get(messages, F.col("_at") + 1)["content"].alias("answer")))


# ---------------------------------------------------------------------------------------------
# Article questions
# ---------------------------------------------------------------------------------------------
QUESTION_LINE = r"^[\d.-]* (.*)"


def parse_questions(answers: DataFrame, text: str = "answer", key: str = "source",
                    whole_words: bool = False, strict: bool = False,
                    banned: list[str] = P.BANNED_QUESTION_WORDS) -> DataFrame:
    """Split an answer into lines, drop lines holding a banned word, strip the list prefix.

    By default a banned word matches as a substring ("other" holds "her"); ``whole_words``
    matches words only. A kept line without a list prefix is dropped (``strict`` fails instead).
    Output: key, ordinal (the line's 0-based number in the answer), question.
    """
    judged = question_lines(answers, text, key, whole_words, banned)
    kept = judged.where(F.col("reason").isNull() | (F.col("reason") == "no_prefix") if strict else F.col("reason").isNull())
    if strict:
        kept = kept.withColumn("question", F.when(F.col("reason").isNull(), F.col("question"))
                               .otherwise(F.raise_error(F.concat(F.lit("unnumbered question line: "), F.col("question")))))
    return kept.drop("reason")


#: why ``question_lines`` leaves a line out
LINE_REASONS = ["banned_word", "no_prefix"]


def question_lines(answers: DataFrame, text: str = "answer", key: str = "source", whole_words: bool = False,
                   banned: list[str] = P.BANNED_QUESTION_WORDS) -> DataFrame:
    """T14 with every line: key, ordinal, question (a line that is left out stays as it is) and ``reason``, null for a
    line that is kept. The rows without a reason are ``parse_questions``; ``counted.Counted`` counts the others."""
    words = "|".join(banned)
    pattern = rf"\b(?:{words})\b" if whole_words else f"(?:{words})"
    lines_ = answers.select(F.col(key), F.posexplode(splitlines(F.col(text))).alias("_n", "_line"))
    reason = F.when(F.col("_line").rlike(pattern), "banned_word").when(~F.col("_line").rlike(r"(?s)^[\d.-]* "), "no_prefix")
    judged = lines_.select(F.col(key), F.col("_n").cast("int").alias("ordinal"), "_line", reason.alias("reason"))
    return judged.select(key, "ordinal", F.when(F.col("reason").isNull(), F.regexp_extract("_line", r"(?s)^[\d.-]* (.*)", 1))
                         .otherwise(F.col("_line")).alias("question"), "reason")


def _diverse_group(keep: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ordinal", kind="stable").reset_index(drop=True)
        if len(pdf) <= keep:
            return pdf[["grp", "ordinal"]]
        e = np.vstack(pdf["vec"].to_numpy()).astype(np.float64)
        alive = np.ones(len(pdf), dtype=bool)
        s = e.sum(axis=0)
        n = len(pdf)
        while n > keep:
            score = e @ s
            score[~alive] = -np.inf
            # the closest to the mean; among equal scores the later one
            best = np.flatnonzero(score == score.max())[-1]
            alive[best] = False
            s = s - e[best]
            n -= 1
        return pdf.loc[alive, ["grp", "ordinal"]]
    return run


def _diverse_rounds(items: DataFrame, keep: int, checkpoint_every: int = 4) -> DataFrame:
    """Exact greedy for groups too large for one task: every round scores all alive items of every
    still-too-large group against its running sum in parallel, drops each group's best
    (max_by aggregate, ties -> later ordinal) and subtracts it from the sum. Returns dropped
    (grp, ordinal) pairs."""
    dims = items.select("grp", F.posexplode("vec").alias("i", "x"))
    sums = (dims.groupBy("grp", "i").agg(F.sum("x").alias("x"))
            .groupBy("grp").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("_s")))  # d per group
    counts = items.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    state = cut_lineage(sums.join(counts, "grp").select("grp", F.transform("_s", lambda e: e["x"]).alias("s"), "n"))
    dropped = None
    rnd = 0
    while True:
        active = state.where(F.col("n") > keep).select("grp", "s")
        if active.isEmpty():
            break
        rnd += 1
        alive = items.join(active, "grp")
        if dropped is not None:
            alive = alive.join(dropped, ["grp", "ordinal"], "left_anti")
        scored = alive.withColumn("score", F.aggregate(F.zip_with("vec", "s", lambda a, b: a * b), F.lit(0.0),
                                                       lambda acc, x: acc + x))
        pick = scored.groupBy("grp").agg(F.max_by(F.struct("ordinal", "vec"), F.struct("score", "ordinal")).alias("p"))
        step = pick.select("grp", F.col("p.ordinal").alias("ordinal"))
        dropped = step if dropped is None else dropped.unionByName(step)
        state = (state.join(pick, "grp", "left")
                 .select("grp", F.when(F.col("p").isNull(), F.col("s"))
                         .otherwise(F.zip_with("s", "p.vec", lambda a, b: a - b)).alias("s"),
                         (F.col("n") - F.when(F.col("p").isNull(), 0).otherwise(1)).alias("n")))
        state = cut_lineage(state)  # small: one row per large group
        if rnd % checkpoint_every == 0:
            dropped = cut_lineage(dropped)
    return dropped


def diverse(df: DataFrame, group: str, ordinal: str, vector: str, keep: int = 6,
            max_local: int = 20_000) -> DataFrame:
    """While a group has more than ``keep`` items, drop the one whose (unit) vector is closest
    to the group's mean; ties drop the later item.

    With unit vectors the cosine to the mean orders like the dot product with the running sum,
    so each drop is one matrix-vector product and a subtraction. Groups of at most ``max_local``
    items (a question list is a handful) run with ``applyInPandas`` on (group, ordinal, vector)
    only; larger groups take the exact distributed rounds above, so no group is ever collected
    into a single task. Returns the kept (group, ordinal) pairs.
    """
    staged = df.select(F.col(group).alias("grp"), F.col(ordinal).cast("int").alias("ordinal"),
                       F.col(vector).cast("array<double>").alias("vec"))
    sizes = staged.groupBy("grp").agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_n") > max_local).select("grp")
    small = staged.join(sizes.where(F.col("_n") <= max_local).select("grp"), "grp", "left_semi")
    kept = small.groupBy("grp").applyInPandas(_diverse_group(keep), "grp long, ordinal int")
    if not large.isEmpty():
        big = staged.join(large, "grp", "left_semi")
        dropped = _diverse_rounds(big, keep)
        kept = kept.unionByName(big.select("grp", "ordinal").join(dropped, ["grp", "ordinal"], "left_anti"))
    return kept.select(F.col("grp").alias(group), F.col("ordinal").alias(ordinal))


def stand_in_embedding(text: Column, dims: int = 8) -> Column:
    """Deterministic unit vector from md5(text): hex digits centred on zero, then normalised."""
    h = F.md5(text)
    raw = F.transform(F.sequence(F.lit(1), F.lit(dims)),
                      lambda i: (F.instr(F.lit("0123456789abcdef"), h.substr(i, F.lit(1))) - 1).cast("double") - 7.5)
    norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(raw, lambda x: x / norm)


def article_rounds(inputs: DataFrame, model: Model = STAND_IN) -> DataFrame:
    """Class of the article, then (for knowledge articles) the question list."""
    article = message("user", F.concat(F.lit(P.ARTICLE_INTRO), F.col("text")))
    r = ask(model, inputs, F.array(_sys(), article, message("user", F.lit(P.ARTICLE_CLASS))), "article_class",
                     options=P.ARTICLE_CLASSES)
    return ask(model, r, F.array(_sys(), article, message("user", F.lit(P.ARTICLE_QUESTIONS))), "question_list",
                        max_tokens=600, when=~F.col("article_class").isin("anecdotes", "story"))


def question_chat(inputs: DataFrame, model: Model = STAND_IN, embed=stand_in_embedding, keep: int = 6,
                  trainer: str = "summarizer", revision: str = "base", whole_words: bool = False, errors: bool = False) -> DataFrame:
    """Each kept question and its answer is its own two-message conversation. With ``errors``, an
    article without a usable class or question list, and one of whose questions has no answer, comes out as an error."""
    rounds = article_rounds(inputs.select("id", "text"), model)
    if not model.total:
        # two outputs read the rounds: what they need of them is written once, without the text
        rounds = cut_lineage(rounds.select("id", "question_list", "error"))
    r = rounds.where(F.col("question_list").isNotNull())
    # the questions are read twice, below and for their diversity: asked for once
    q = cut_lineage(parse_questions(r.select(F.col("id").alias("source"), F.col("question_list").alias("answer")),
                                    whole_words=whole_words))
    if embed is not None:
        vec = q.withColumn("vec", embed(F.col("question")))
        kept = diverse(vec, "source", "ordinal", "vec", keep)
        q = q.join(kept, ["source", "ordinal"], "left_semi")
    qa = q.join(inputs.select(F.col("id").alias("source"), "text"), "source")
    article = message("user", F.concat(F.lit(P.ARTICLE_INTRO), F.col("text")))
    prompt = message("user", fmt(F.lit(P.ARTICLE_ANSWER), F.col("question")))
    qa = ask(model, qa, F.array(_sys(), article, prompt), "reply", max_tokens=2000)
    msgs = F.array(message("user", F.col("question")), message("assistant", F.col("reply")))
    conv = md5_key(F.lit(trainer), F.lit(revision), F.col("source"), F.col("ordinal"))
    rows = explode_messages(qa.withColumn("messages", msgs), trainer, revision, "source", conversation=conv, errors=errors)
    if not errors or model.total:
        return rows
    none = {c: F.lit(None).cast(k).alias(c) for c, k in rows.dtypes}
    lost = rounds.where(F.col("error").isNotNull()).select(
        *[{"trainer": F.lit(trainer).alias(c), "revision": F.lit(revision).alias(c), "source": F.col("id").cast("long").alias(c),
           "error": F.col("error")}.get(c, none[c]) for c in rows.columns])
    return rows.unionByName(lost)

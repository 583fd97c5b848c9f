"""Asking a model for many prompts at once, checking constrained answers, planning batches.

A model answers a message list (system + context chain + prompt). Three kinds are pluggable:

* ``ExpressionModel``: a Spark expression over the rendered prompt (stays on the JVM; used for
  the deterministic stand-in model, so every generator has an exact SQL oracle);
* ``BatchModel``: a Python function over a pandas Series of prompts, run with ``mapInPandas``
  on the *distinct* prompts only, then joined back by prompt id; the answers are written to
  the checkpoint folder so a lost executor never asks the model twice;
* ``TableModel``: an existing completions table ``(prompt_id, text)`` (offline inference).

The prompt id is ``md5(rendered prompt, parameters)``: a rerun asks nothing new.
"""
from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatloom.functions.chat import chatml, message
from chatloom.functions.text import py_strip
from chatloom.session import cut_lineage

HEX = "0123456789abcdef"
DEFAULTS = {"max_tokens": 400, "temperature": 0.0}


def params_json(max_tokens: int, temperature: float, options: list[str] | None) -> str:
    return json.dumps({"max_tokens": max_tokens, "temperature": temperature, "options": options},
                      sort_keys=True)


def prompt_id(prompt: Column, params: str) -> Column:
    return F.md5(F.concat(prompt, F.lit("\u001f" + params)))


class Model:
    template: Callable[[Column], Column] = staticmethod(lambda m: chatml(m, generation=True))
    #: answers every prompt, and with one of the options where there are any: ``ask`` need not look
    total = False

    def answer(self, df: DataFrame, messages: Column, out: str, options: list[str] | None = None,
               max_tokens: int = DEFAULTS["max_tokens"], temperature: float = DEFAULTS["temperature"],
               when: Column | None = None) -> DataFrame:
        raise NotImplementedError


class ExpressionModel(Model):
    def __init__(self, fn: Callable[..., Column], total: bool = True):
        self.fn = fn
        self.total = total

    def answer(self, df, messages, out, options=None, max_tokens=DEFAULTS["max_tokens"],
               temperature=DEFAULTS["temperature"], when=None):
        ans = self.fn(self.template(messages), options=options, max_tokens=max_tokens)
        return df.withColumn(out, ans if when is None else F.when(when, ans))


def hex_digit(h: Column, pos) -> Column:
    """Value 0-15 of the hex digit at 1-based ``pos`` (an int or a Column)."""
    p = pos if isinstance(pos, Column) else F.lit(pos)
    return F.instr(F.lit(HEX), h.substr(p, F.lit(1))) - 1


# Fixed values of the stand-in model's multi-line answers.
STAND_IN_LEADS = ["How do I cook", "Why does this", "What is", "When should her"]


def stand_in(prompt: Column, options: list[str] | None = None, max_tokens: int = 400) -> Column:
    """Deterministic stand-in model (also written in SQL by the oracles).

    * options: the option at (first hex digit of md5(prompt)) mod len(options);
    * budget under 600 tokens: ``'r' + md5(prompt)[:8]``;
    * budget of 600 or more: 1-16 numbered lines ``k. <lead> <6 hex>?`` (a line whose hex digit
      is 0 has no number, like a sloppy list).
    """
    h = F.md5(prompt)
    if options:
        return F.element_at(F.array(*[F.lit(o) for o in options]),
                            (F.pmod(hex_digit(h, 1), F.lit(len(options))) + 1).cast("int"))
    if max_tokens < 600:
        return F.concat(F.lit("r"), F.substring(h, 1, 8))
    leads = F.array(*[F.lit(x) for x in STAND_IN_LEADS])
    n = hex_digit(h, 1) + 1

    def line(k):
        d = hex_digit(h, k + 1)
        prefix = F.when(d == 0, F.lit("")).otherwise(F.concat(k.cast("string"), F.lit(". ")))
        return F.concat(prefix, F.element_at(leads, (F.pmod(d, F.lit(4)) + 1).cast("int")), F.lit(" "),
                        h.substr(k + 2, F.lit(6)), F.lit("?"))
    return F.array_join(F.transform(F.sequence(F.lit(1), n.cast("int")), line), "\n")


STAND_IN = ExpressionModel(stand_in)


def flaky_stand_in(prompt: Column, options: list[str] | None = None, max_tokens: int = 400) -> Column:
    """A stand-in that fails like a real model, by digits of md5(prompt) (also written in SQL by the oracles):
    no answer at all if the last digit is 0; of constrained answers, a text outside the options if the last but
    one is below 4, and the option in upper case between blanks if the one before is odd."""
    h = F.md5(prompt)
    answer = stand_in(prompt, options, max_tokens)
    if options:
        answer = (F.when(hex_digit(h, 31) < 4, F.concat(F.lit("perhaps "), F.substring(h, 1, 4)))
                  .when(hex_digit(h, 30) % 2 == 1, F.concat(F.lit(" "), F.upper(answer), F.lit("\n"))).otherwise(answer))
    return F.when(hex_digit(h, 32) != 0, answer)


FLAKY = ExpressionModel(flaky_stand_in, total=False)

# ---------------------------------------------------------------------------------------------
# Answers that may fail
# ---------------------------------------------------------------------------------------------
#: how often an answer outside the options is asked for again
RETRIES = 2


def reask(options: list[str]) -> str:
    return "Answer with one of these words only: " + ", ".join(options) + "."


def ask(model: Model, df: DataFrame, messages: Column, out: str, options: list[str] | None = None,
        max_tokens: int = DEFAULTS["max_tokens"], temperature: float = DEFAULTS["temperature"], when: Column | None = None,
        retries: int = RETRIES, kind: str | None = None) -> DataFrame:
    """``model.answer`` whose failures stay with the input.

    An input without an answer, or whose answer is none of ``options`` after ``retries`` further rounds, gets an
    ``error`` (``no_answer:<kind>`` or ``invalid:<kind>``, the kind being ``out`` unless given; the first one stays)
    and is not asked anything more. Answers among ``options`` come out trimmed and in lower case. A round asks again only the inputs
    whose answer was invalid, with that answer and the list of options added to the conversation.
    ``asked`` collects (kind, tries, valid) of every question that an input was asked.
    """
    if model.total:
        return model.answer(df, messages, out, options=options, max_tokens=max_tokens, temperature=temperature, when=when)
    kwargs = {"options": options, "max_tokens": max_tokens, "temperature": temperature}
    kind = kind or out
    if "error" not in df.columns:
        df = df.withColumns({"error": F.lit(None).cast("string"),
                             "asked": F.array().cast("array<struct<kind:string,tries:int,valid:boolean>>")})
    go = F.col("error").isNull()
    df = df.withColumn("_ask", go if when is None else go & F.coalesce(when, F.lit(False)))
    df = df.withColumns({"_chat": F.when(F.col("_ask"), messages), "_tries": F.lit(1)})
    df = model.answer(df, F.col("_chat"), out, when=F.col("_ask"), **kwargs)
    valid = F.lit(True)
    if options:
        def chosen(name):
            return F.lower(py_strip(F.col(name)))

        def wrong(name):
            return F.col("_ask") & F.col(name).isNotNull() & ~chosen(name).isin(*options)

        for _ in range(retries):
            df = df.withColumn("_bad", wrong(out))
            df = df.withColumn("_chat", F.when(F.col("_bad"), F.concat("_chat", F.array(
                message("assistant", F.col(out)), message("user", F.lit(reask(options)))))))
            df = model.answer(df, F.col("_chat"), "_again", when=F.col("_bad"), **kwargs)
            df = df.withColumns({out: F.when(F.col("_bad"), F.col("_again")).otherwise(F.col(out)),
                                 "_tries": F.col("_tries") + F.col("_bad").cast("int")}).drop("_again")
        df = df.withColumns({"_bad": wrong(out), out: chosen(out)})
        valid = ~F.col("_bad")
    none = F.when(F.col("_ask") & F.col(out).isNull(), f"no_answer:{kind}")
    invalid = F.when(F.col("_ask") & ~valid, f"invalid:{kind}")
    entry = F.struct(F.lit(kind).alias("kind"), F.col("_tries").alias("tries"), (F.col(out).isNotNull() & valid).alias("valid"))
    df = df.withColumns({"error": F.coalesce("error", none, invalid),
                         "asked": F.when(F.col("_ask"), F.concat("asked", F.array(entry))).otherwise(F.col("asked"))})
    if options:
        df = df.withColumn(out, F.when(~F.col("_bad"), F.col(out)))
    return df.drop("_ask", "_chat", "_tries", "_bad")


def answer_rates(asked: DataFrame) -> DataFrame:
    """(kind, n_asked, n_tries, n_valid): how often each question was asked and ended with a usable answer."""
    # outer: an inner explode makes Spark infer a filter and push it below, inlining every round into one predicate
    each = asked.select(F.explode_outer("asked").alias("a")).select("a.kind", "a.tries", "a.valid").where("kind IS NOT NULL")
    return each.groupBy("kind").agg(F.count(F.lit(1)).alias("n_asked"), F.sum(F.col("tries").cast("long")).alias("n_tries"),
                                    F.count(F.when(F.col("valid"), 1)).alias("n_valid"))


def with_answers(staged: DataFrame, answers: DataFrame, out: str) -> DataFrame:
    """Joins ``answers(_pid, _answer)``. Rows that were not asked have no ``_pid``: a hash of the row stands
    in as their join key, so that they spread over all tasks instead of meeting in one."""
    fields = [F.col(c) for c, kind in staged.dtypes if "map<" not in kind]
    key = F.coalesce("_pid", F.concat(F.lit("-"), F.xxhash64(*fields).cast("string")))
    return (staged.withColumn("_pid", key).join(answers, "_pid", "left")
            .withColumn(out, F.col("_answer")).drop("_prompt", "_pid", "_answer"))


class BatchModel(Model):
    """``fn(prompts: pd.Series, params: dict) -> pd.Series`` called once per Arrow batch. A missing
    answer stays null: the stage runner then treats the input as failed."""

    def __init__(self, fn: Callable[[pd.Series, dict], pd.Series], cache_answers: bool = True):
        self.fn = fn
        self.cache_answers = cache_answers

    def answer(self, df, messages, out, options=None, max_tokens=DEFAULTS["max_tokens"],
               temperature=DEFAULTS["temperature"], when=None):
        params = params_json(max_tokens, temperature, options)
        pdict = json.loads(params)
        fn = self.fn
        ask = when if when is not None else F.lit(True)
        staged = (df.withColumn("_prompt", F.when(ask, self.template(messages)))
                  .withColumn("_pid", F.when(ask, prompt_id(F.col("_prompt"), params))))
        distinct = staged.where(F.col("_pid").isNotNull()).select("_pid", "_prompt").dropDuplicates(["_pid"])

        def run(batches):
            for b in batches:
                got = [None if pd.isna(a) else str(a) for a in fn(b["_prompt"], pdict)]
                yield pd.DataFrame({"_pid": b["_pid"].to_numpy(), "_answer": pd.Series(got, dtype=object)})

        answers = distinct.mapInPandas(run, "_pid string, _answer string")
        if self.cache_answers:
            answers = cut_lineage(answers)
        return with_answers(staged, answers, out)


class TableModel(Model):
    """Answers read from a completions table ``(prompt_id, text)`` written by offline inference. A
    prompt without a row there has a null answer; of repeated rows the least text counts."""

    def __init__(self, completions: DataFrame):
        self.completions = completions.groupBy(F.col("prompt_id").alias("_pid")).agg(F.min("text").alias("_answer"))

    def answer(self, df, messages, out, options=None, max_tokens=DEFAULTS["max_tokens"],
               temperature=DEFAULTS["temperature"], when=None):
        params = params_json(max_tokens, temperature, options)
        ask = when if when is not None else F.lit(True)
        staged = df.withColumn("_pid", F.when(ask, prompt_id(self.template(messages), params)))
        return with_answers(staged, self.completions, out)


def prompts_table(df: DataFrame, messages: Column, max_tokens: int = DEFAULTS["max_tokens"],
                  temperature: float = DEFAULTS["temperature"], options: list[str] | None = None,
                  template=Model.template) -> DataFrame:
    """The distinct prompts a stage needs, for offline inference: (prompt_id, prompt, params)."""
    params = params_json(max_tokens, temperature, options)
    p = df.select(template(messages).alias("prompt"))
    return (p.select(prompt_id(F.col("prompt"), params).alias("prompt_id"), "prompt",
                     F.lit(params).alias("params"))
            .dropDuplicates(["prompt_id"]))


def validate(completions: DataFrame, options: list[str], text: str = "text") -> DataFrame:
    """A constrained answer must be one of ``options`` after trimming and lower-casing."""
    norm = F.lower(py_strip(F.col(text)))
    return (completions.withColumn("normalized", norm)
            .withColumn("valid", F.coalesce(norm.isin(*options), F.lit(False))))


def plan_batches(prompts: DataFrame, length: str = "n_tokens", key: str = "prompt_id", group: str = "params",
                 size: int = 4, max_pad: float = 0.2, context: int = 16384, max_tokens: int = 400,
                 num_partitions: int | None = None) -> DataFrame:
    """Batch prompts with the same parameters so that each batch has at most ``size`` prompts,
    pads at most ``max_pad`` of its tokens (left padding to the longest prompt), and fits
    ``longest + max_tokens <= context``. Prompts are range-partitioned by (group, length) and
    batched greedily inside each partition; a prompt too long for the context gets ``batch = null``.
    """
    from chatloom.session import default_parallelism
    n = num_partitions or default_parallelism(prompts.sparkSession)
    staged = (prompts.select(F.col(key).alias("prompt_id"), F.col(group).alias("grp"),
                             F.col(length).cast("long").alias("n_tokens"))
              .repartitionByRange(n, "grp", F.col("n_tokens").desc(), "prompt_id")
              .sortWithinPartitions("grp", F.col("n_tokens").desc(), "prompt_id"))

    def greedy(batches):
        import numpy as np
        pid = None
        for b in batches:
            part = int(b["part"].iloc[0]) if len(b) else 0
            out_batch = np.full(len(b), -1, dtype=np.int64)
            if pid is None:
                pid = part
                cur, cur_grp, cur_max, cur_tokens, cur_n, seq = -1, None, 0, 0, 0, 0
            for i, (g, t) in enumerate(zip(b["grp"].tolist(), b["n_tokens"].tolist())):
                if t + max_tokens > context:
                    continue
                longest = max(cur_max, t)
                n_after = cur_n + 1
                pad = (longest * n_after - (cur_tokens + t)) / (longest * n_after) if longest else 0.0
                if cur < 0 or g != cur_grp or n_after > size or pad > max_pad:
                    seq += 1
                    cur = seq
                    cur_grp, cur_max, cur_tokens, cur_n = g, t, t, 1
                else:
                    cur_max, cur_tokens, cur_n = longest, cur_tokens + t, n_after
                out_batch[i] = (pid << 32) + cur
            yield pd.DataFrame({"prompt_id": b["prompt_id"], "grp": b["grp"], "n_tokens": b["n_tokens"],
                                "batch": pd.array([x if x >= 0 else None for x in out_batch], dtype="Int64")})

    planned = staged.withColumn("part", F.spark_partition_id()).mapInPandas(
        greedy, "prompt_id string, grp string, n_tokens long, batch long")
    return planned.withColumnRenamed("grp", group)

"""Stored messages -> training samples (assemble, split, render, pack, export)."""
from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatloom.functions.chat import decode_role, encode_role, message, prepend, render
from chatloom.functions.text import py_strip
from chatloom.schemas import hex_fraction
from chatloom.session import write_once


def assemble(training: DataFrame, revision: str | None = None, system: str | None = None,
             strict: bool = False) -> DataFrame:
    """One row per (conversation, trainer) with its messages ordered by position.

    Sentinel rows (role ``none``) are left out; other unknown roles read as ``assistant``
    (``strict`` fails instead). ``system`` puts a fixed system message first.
    One shuffle by conversation; a conversation is a generator's output (a handful of messages),
    so each group is small by construction.
    """
    t = training
    if revision is not None:
        t = t.where(F.col("revision") == revision)
    t = t.where(F.col("role") != "none")
    role = decode_role(encode_role("role"), strict=strict)
    grouped = (t.groupBy("conversation", "trainer")
               .agg(F.array_sort(F.collect_list(F.struct("position", role.alias("role"), "content"))).alias("_m")))
    messages = F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    first = message("system", F.lit(system)) if system is not None else None
    return grouped.select("conversation", "trainer", prepend(messages, first).alias("messages"))


def split_hash(conversation: Column | str, seed: int = 0) -> Column:
    return hex_fraction(_split_digits(conversation, seed))


def _split_digits(conversation: Column | str, seed: int) -> Column:
    """Eight hex digits, uniform over the conversations."""
    c = F.col(conversation) if isinstance(conversation, str) else conversation
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), c)), 1, 8)


def split(convs: DataFrame, test: float = 0.1, seed: int = 0, exact: bool = False,
          key: str = "conversation") -> DataFrame:
    """train/test at conversation level, seeded.

    Hash mode needs no shuffle: a conversation is ``test`` when its seeded hash falls below
    ``test``. Exact mode takes the first ``ceil(test * n)`` rows by (hash, key): the last of them is found by
    selection (see ``split_bound``) and every row is compared with it, so rows are neither sorted nor
    moved. Rows that share the bounding key stay together, all in ``test``. Rows without a key are not
    counted and train.
    """
    if not exact:
        return convs.withColumn("split", F.when(split_hash(key, seed) < test, "test").otherwise("train"))
    bound = split_bound(convs, test, seed, key)
    if bound is None:
        return convs.withColumn("split", F.lit("train"))
    digits, last = bound
    h = _split_digits(key, seed)
    within = (h < digits) | ((h == digits) & (F.col(key).cast("string") <= last))
    return convs.withColumn("split", F.when(within, "test").otherwise("train"))


def split_bound(convs: DataFrame, test: float, seed: int = 0, key: str = "conversation") -> tuple[str, str] | None:
    """(hash digits, key) of row number ``ceil(test * n)`` by (hash, key); None if that is row 0.

    Selection by digits: a histogram of the first four hex digits, one of the next four below the digits that
    were found (at most 65,536 counts each come to the driver, whatever n is), then the keys of that one hash, some
    n / 2^32 of them, summed up in order. All three passes read the key column only."""
    keys = convs.select(F.col(key).cast("string").alias("_k"), _split_digits(key, seed).alias("_h")).where("_k IS NOT NULL")
    counts = _histogram(keys, 1, "")
    wanted = math.ceil(Fraction(str(test)) * sum(n for _, n in counts))
    if wanted <= 0 or not counts:
        return None
    high, wanted = _reach(counts, wanted)
    low, wanted = _reach(_histogram(keys, 5, high), wanted)
    tied = keys.where(F.col("_h") == high + low).groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    upto = tied.withColumn("_upto", F.sum("_n").over(Window.orderBy("_k")))      # one hash value's keys
    return high + low, upto.where(F.col("_upto") >= wanted).agg(F.min("_k")).first()[0]


def _histogram(keys: DataFrame, position: int, above: str) -> list[tuple[str, int]]:
    part = keys.where(F.col("_h").startswith(above)) if above else keys
    rows = part.groupBy(F.substring("_h", position, 4).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((r["d"], r["n"]) for r in rows)


def _reach(counts: list[tuple[str, int]], wanted: int) -> tuple[str, int]:
    """The digits under which row ``wanted`` lies, and its number among them. Beyond the end: the last row."""
    for digits, n in counts:
        if wanted <= n:
            return digits, wanted
        wanted -= n
    return counts[-1]


def render_dataset(convs: DataFrame, template: str = "chatml", messages: str = "messages") -> DataFrame:
    """Training text by chat template."""
    return convs.withColumn("text", render(F.col(messages), template))


def whitespace_tokens(text: Column) -> Column:
    """Default tokeniser: runs of whitespace separate tokens."""
    s = py_strip(text)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, r"(?U)\s+", -1))


#: hex digits of a level of ``running_ends`` (at most 4,096 siblings under one parent) and rows of a lowest range
LEVEL_DIGITS = 3
LEAF_ROWS = 4_096


def level_widths(rows: int, leaf_rows: int = LEAF_ROWS) -> list[int]:
    """How many hex digits each level has fixed, so that a lowest range of a uniform hash holds about ``leaf_rows``
    rows: [] for few rows, [3] up to 4,096 times as many, then [3, 6] and so on."""
    digits = 0
    while rows > leaf_rows * 16 ** digits:
        digits += 1
    return [min(w, digits) for w in range(LEVEL_DIGITS, digits + LEVEL_DIGITS, LEVEL_DIGITS)] if digits else []


def running_ends(sizes: DataFrame, group: str, h: str, n: str, widths: list[int]) -> DataFrame:
    """``sizes`` with ``end``, the running sum of ``n`` in a group by the hex string ``h`` (a row's own included), and
    ``total``, the group's sum.

    A prefix sum over several levels: the sums of a level's hash ranges are added up under their parent range only,
    so a window never holds more than the siblings of one range (16^3) or the rows of a lowest range. The
    sums of a level are one row per range and are joined by (group, range). The result does not depend on
    ``widths``; rows of equal ``h`` must not occur in a group."""
    if not widths:
        whole = Window.partitionBy(group)
        return (sizes.withColumn("end", F.sum(n).over(whole.orderBy(h).rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("total", F.sum(n).over(whole)))
    ranges = F.substring(h, 1, widths[-1])
    staged = sizes.withColumn("_range", ranges)
    sums = staged.groupBy(group, "_range").agg(F.sum(n).alias("_n")).withColumnRenamed("_range", "_from")
    before = running_ends(sums, group, "_from", "_n", widths[:-1])
    before = before.select(group, F.col("_from").alias("_range"), (F.col("end") - F.col("_n")).alias("_off"), "total")
    inside = Window.partitionBy(group, "_range").orderBy(h).rowsBetween(Window.unboundedPreceding, 0)
    return (staged.withColumn("end", F.sum(n).over(inside)).join(before, [group, "_range"])
            .withColumn("end", F.col("end") + F.col("_off")).drop("_range", "_off"))


def pack(samples: DataFrame, length: int = 6144, shards: int = 4, text: str = "text",
         key: str = "conversation", tokenizer=whitespace_tokens, eos: str = "</s>",
         leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Pack tokenised samples, each followed by ``eos``, into blocks of ``length`` tokens per
    shard, dropping each shard's incomplete last block.

    Samples go to shards by a hash of their key and are packed in hash order. The running token offsets come
    from (key, number of tokens) alone, by prefix sums over as many levels as the number of samples asks for
    (``running_ends``). The texts meet their offset in one join, whose hash table is the offsets (``shuffle_hash``: texts
    are not sorted), are tokenised there and cut into the blocks they touch; each block is regrouped
    from its pieces (at most ``length`` tokens per group). Every step is a function of the data alone,
    so recomputation after a lost executor gives the same blocks.

    Keys tell the samples apart: a repeated key, or a sample without one, fails the job by name. A text that is
    null counts as empty.
    """
    own = samples.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    tokens = F.concat(tokenizer(F.col("_text")), F.array(F.lit(eos)))
    h = F.md5("key")
    bad = (F.count(F.lit(1)) > 1) | F.col("key").isNull()
    sizes = (own.select("key", F.size(tokens).cast("long").alias("n")).groupBy("key")
             .agg(F.when(bad, F.raise_error(F.concat(F.lit("pack: samples without a key of their own: "), F.coalesce("key", F.lit("null")))))
                  .otherwise(F.sum("n")).cast("long").alias("n"))
             .select("key", (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % shards).cast("int").alias("shard"), h.alias("h"), "n"))
    sizes = write_once(sizes, "pack-sizes")           # read once per level, so texts are counted once
    ends = running_ends(sizes, "shard", "h", "n", level_widths(sizes.count() // shards, leaf_rows))
    placed = ends.select("key", "shard", (F.col("end") - F.col("n")).alias("start"), "end", F.col("total").alias("shard_tokens"))
    block = F.explode(F.sequence(F.floor(F.col("start") / length), F.floor((F.col("end") - 1) / length)))
    pieces = (own.join(placed.hint("shuffle_hash"), "key").select("*", tokens.alias("tokens")).withColumn("block", block)
              .withColumn("lo", F.greatest(F.col("start"), F.col("block") * length) - F.col("start"))
              .withColumn("hi", F.least(F.col("end"), (F.col("block") + 1) * length) - F.col("start"))
              .where(F.col("block") < F.floor(F.col("shard_tokens") / length))
              .select("shard", "block", "start",
                      F.slice("tokens", (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int"))
                      .alias("piece")))
    return (pieces.groupBy("shard", "block")
            .agg(F.array_sort(F.collect_list(F.struct("start", "piece"))).alias("_p"),
                 F.count(F.lit(1)).alias("n_samples"))
            .select("shard", F.col("block").cast("long").alias("block"), "n_samples",
                    F.flatten(F.transform("_p", lambda x: x["piece"])).alias("tokens"))
            .withColumn("n_tokens", F.size("tokens").cast("long")))


def export(df: DataFrame, path: str, fmt: str = "parquet", by: str = "split") -> None:
    """Write the dataset, one folder per split. Overwrite makes a rerun replace it."""
    df.write.mode("overwrite").partitionBy(by).format(fmt).save(path)

"""X1-X7, F9, F10 over the stored-training view."""
from __future__ import annotations

from pyspark.sql import functions as F

from chatloom.functions.chat import chatml, decode_role, encode_role, inst
from chatloom.operators import dataset as X
from chatloom.plans.registry import register
from chatloom.plans.sql_views import chatml_sql, strip_sql, with_views
from chatloom.session import scratch_path
from chatloom.sources.tables import BASE_REVISION, training_view

# Caller input with a self-written default: the system message put before every sample.
SYSTEM = "You are a friendly cooking assistant. Answer cooking questions clearly and precisely."
PACK_LENGTH = 512
PACK_SHARDS = 4

_ROLE = "CASE role WHEN 'system' THEN 'system' WHEN 'user' THEN 'user' ELSE 'assistant' END"
_MSGS = f"list({{'role': {_ROLE}, 'content': content}} ORDER BY position)"
_CHATML = f"string_agg({chatml_sql(_ROLE, 'content')}, '' ORDER BY position)"
_SYS_CHATML = chatml_sql("'system'", f"'{SYSTEM}'")
_BASE = "FROM training WHERE revision = 'base' AND role <> 'none' GROUP BY conversation, trainer"


def _hex8_sql(x: str) -> str:
    return f"CAST(('0x' || substr(md5({x}), 1, 8)) AS BIGINT)"


def _assembled(spark, sf_dir, system=None):
    return X.assemble(training_view(spark, sf_dir), revision=BASE_REVISION, system=system)


@register("assemble_conversations", with_views("training") + f"""
SELECT conversation, trainer, to_json({_MSGS}) AS messages_json {_BASE}""")
def assemble_conversations(spark, sf_dir):
    return _assembled(spark, sf_dir).select("conversation", "trainer", F.to_json("messages").alias("messages_json"))


@register("decode_role", with_views("training") + """
SELECT conversation, position, role_code,
       CASE role_code WHEN 0 THEN 'system' WHEN 1 THEN 'user' ELSE 'assistant' END AS role_name
FROM (SELECT conversation, position,
             CAST(CASE role WHEN 'system' THEN 0 WHEN 'user' THEN 1 WHEN 'assistant' THEN 2 ELSE 3 END AS INTEGER)
               AS role_code
      FROM training)""")
def decode_role_q(spark, sf_dir):
    t = training_view(spark, sf_dir).withColumn("role_code", encode_role("role"))
    return t.select("conversation", "position", "role_code", decode_role("role_code").alias("role_name"))


@register("prepend_system", with_views("training") + f"""
SELECT conversation, trainer, CAST(count(*) + 1 AS INTEGER) AS n_messages,
       to_json(list_concat([{{'role': 'system', 'content': '{SYSTEM}'}}], {_MSGS})) AS messages_json {_BASE}""")
def prepend_system(spark, sf_dir):
    a = _assembled(spark, sf_dir, system=SYSTEM)
    return a.select("conversation", "trainer", F.size("messages").alias("n_messages"),
                    F.to_json("messages").alias("messages_json"))


@register("render_chatml", with_views("training") + f"""
SELECT conversation, trainer, {_CHATML} AS text {_BASE}""")
def render_chatml(spark, sf_dir):
    return _assembled(spark, sf_dir).select("conversation", "trainer", chatml("messages").alias("text"))


_INST = ("'<s>' || string_agg(CASE WHEN role = 'user' THEN '[INST] ' || content || '[/INST]' "
         "ELSE content || '</s>' END, '' ORDER BY position)")


@register("render_inst", with_views("training") + f"""
SELECT conversation, trainer, {_INST} AS text {_BASE}""")
def render_inst(spark, sf_dir):
    return _assembled(spark, sf_dir).select("conversation", "trainer", inst("messages").alias("text"))


_SPLIT_HASH = _hex8_sql("'0:' || conversation") + " / 4294967296.0"


@register("train_test_split", with_views("training") + f"""
SELECT conversation, trainer, CASE WHEN {_SPLIT_HASH} < 0.1 THEN 'test' ELSE 'train' END AS split
FROM (SELECT DISTINCT conversation, trainer FROM training WHERE revision = 'base' AND role <> 'none')""")
def train_test_split(spark, sf_dir):
    return X.split(_assembled(spark, sf_dir), test=0.1, seed=0).select("conversation", "trainer", "split")


@register("train_test_split_exact", with_views("training") + f"""
SELECT conversation, trainer,
       CASE WHEN row_number() OVER (ORDER BY {_SPLIT_HASH}, conversation) <= ceil(0.1 * count(*) OVER ())
            THEN 'test' ELSE 'train' END AS split
FROM (SELECT DISTINCT conversation, trainer FROM training WHERE revision = 'base' AND role <> 'none')""")
def train_test_split_exact(spark, sf_dir):
    return X.split(_assembled(spark, sf_dir), test=0.1, seed=0, exact=True).select("conversation", "trainer", "split")


_RENDER_DATASET_SQL = with_views("training") + f"""
SELECT conversation, CASE WHEN {_SPLIT_HASH} < 0.1 THEN 'test' ELSE 'train' END AS split,
       {_SYS_CHATML} || {_CHATML} AS text {_BASE}"""


def _rendered(spark, sf_dir):
    a = _assembled(spark, sf_dir, system=SYSTEM)
    return X.render_dataset(X.split(a, test=0.1, seed=0), "chatml").select("conversation", "split", "text")


@register("render_dataset", _RENDER_DATASET_SQL)
def render_dataset(spark, sf_dir):
    return _rendered(spark, sf_dir)


@register("export_dataset", _RENDER_DATASET_SQL)
def export_dataset(spark, sf_dir):
    path = scratch_path(spark, "export")
    X.export(_rendered(spark, sf_dir), path)
    return spark.read.parquet(path).select("conversation", "split", "text")


@register("pack_sequences", with_views("training", extra=[
    ("conv", f"SELECT conversation, {_CHATML} AS text {_BASE}"),
    ("toks", f"""SELECT conversation AS key, CAST({_hex8_sql('conversation')} % {PACK_SHARDS} AS INTEGER) AS shard,
       md5(conversation) AS h,
       list_concat(CASE WHEN {strip_sql('text')} = '' THEN CAST([] AS VARCHAR[])
                        ELSE regexp_split_to_array({strip_sql('text')}, '\\s+') END, ['</s>']) AS tokens
FROM conv"""),
    ("placed", """SELECT *, sum(len(tokens)) OVER (PARTITION BY shard ORDER BY h, key ROWS UNBOUNDED PRECEDING) AS e,
       len(tokens) AS n, sum(len(tokens)) OVER (PARTITION BY shard) AS shard_tokens FROM toks"""),
    ("blocks", f"""SELECT shard, key, tokens, e - n AS s, e, shard_tokens,
       unnest(range(CAST(floor((e - n) / {PACK_LENGTH}) AS BIGINT), CAST(floor((e - 1) / {PACK_LENGTH}) AS BIGINT) + 1))
         AS block
FROM placed"""),
    ("pieces", f"""SELECT shard, block, s,
       tokens[greatest(s, block * {PACK_LENGTH}) - s + 1 : least(e, (block + 1) * {PACK_LENGTH}) - s] AS piece
FROM blocks WHERE block < floor(shard_tokens / {PACK_LENGTH})"""),
]) + """
SELECT shard, block, count(*) AS n_samples, CAST(len(flatten(list(piece ORDER BY s))) AS BIGINT) AS n_tokens,
       md5(array_to_string(flatten(list(piece ORDER BY s)), ' ')) AS tokens_md5
FROM pieces GROUP BY shard, block""")
def pack_sequences(spark, sf_dir):
    texts = _assembled(spark, sf_dir).select("conversation", chatml("messages").alias("text"))
    packed = X.pack(texts, length=PACK_LENGTH, shards=PACK_SHARDS)
    return packed.select("shard", "block", "n_samples", "n_tokens",
                         F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))

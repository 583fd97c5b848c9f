"""Message arrays and chat templates."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.schemas import ROLE_NAMES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def message(role, content) -> Column:
    r = F.lit(role) if isinstance(role, str) and role in ROLE_NAMES else _c(role)
    return F.struct(r.cast("string").alias("role"), _c(content).cast("string").alias("content"))


def chatml(messages, generation: bool = False) -> Column:
    """``<|im_start|>role\\ncontent<|im_end|>\\n`` per message (+ an open assistant turn)."""
    body = F.array_join(F.transform(_c(messages), lambda m: F.concat(
        F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")
    return F.concat(body, F.lit("<|im_start|>assistant\n")) if generation else body


def inst(messages) -> Column:
    """``<s>`` then ``[INST] user[/INST]`` for user turns and ``content</s>`` for every other role."""
    return F.concat(F.lit("<s>"), F.array_join(F.transform(_c(messages), lambda m: F.when(
        m["role"] == "user", F.concat(F.lit("[INST] "), m["content"], F.lit("[/INST]"))
    ).otherwise(F.concat(m["content"], F.lit("</s>")))), ""))


TEMPLATES = {"chatml": chatml, "inst": inst}


def render(messages, template: str = "chatml") -> Column:
    """Render a message array with a template by name."""
    return TEMPLATES[template](messages)


def decode_role(code, strict: bool = False) -> Column:
    """0 system, 1 user, anything else assistant; ``strict`` fails on codes other than 0-2."""
    code = _c(code)
    out = F.when(code == 0, "system").when(code == 1, "user")
    if strict:
        return out.when(code == 2, "assistant").otherwise(
            F.raise_error(F.concat(F.lit("unknown role code "), code.cast("string"))))
    return out.otherwise("assistant")


def encode_role(role) -> Column:
    role = _c(role)
    return (F.when(role == "system", 0).when(role == "user", 1).when(role == "assistant", 2)
            .otherwise(3).cast("int"))


def prepend(messages, first: Column | None) -> Column:
    """Put a message (e.g. a system prompt) before each conversation."""
    if first is None:
        return _c(messages)
    return F.concat(F.array(first), _c(messages))

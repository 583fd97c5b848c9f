"""Attribute values of a single HTML tag, and entity decoding, as Spark expressions."""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# entities that page markup uses in attribute values; others stay as they are
NAMED = {"quot": '"', "apos": "'", "lt": "<", "gt": ">", "nbsp": "\u00a0", "copy": "\u00a9", "middot": "\u00b7"}


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of ``tag`` (one start tag): double quoted, single quoted or unquoted,
    null if it has none. The name starts after white space, a quote or a slash, so ``data-name`` does
    not count as ``name``."""
    pattern = rf"""(?is)(?<=[\s"'/]){re.escape(name)}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(pattern), value)


def decode_entities(text: Column) -> Column:
    """The common named entities; ``&amp;`` last, so that nothing is decoded twice."""
    for name, char in NAMED.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(char))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))

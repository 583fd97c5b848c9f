"""HTML helpers that need Python: entity decoding and selector-based direct text.

Both are Arrow-batched pandas UDFs (one call per batch, not per row), used only where a Spark
expression cannot do the job.
"""
from __future__ import annotations

import html as _html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track",
        "wbr"}


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML entities decoded (``html.unescape``)."""
    return s.map(lambda x: None if x is None else _html.unescape(x))


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape_all(s: pd.Series) -> pd.Series:
    """D4 for array columns."""
    return s.map(lambda a: None if a is None else [None if x is None else _html.unescape(x) for x in a])


def unescape_map(m: Column) -> Column:
    return F.map_from_arrays(F.map_keys(m), unescape_all(F.map_values(m)))


def parse_selector(selector: str) -> list[tuple[str | None, set[str]]]:
    """``"article .text-passage p.comp"`` -> [(tag, classes)] for a descendant chain."""
    steps = []
    for part in selector.split():
        tag, *classes = part.split(".")
        steps.append((tag or None, set(classes)))
    return steps


class _DirectText(HTMLParser):
    """Collects the text directly inside elements matching a descendant selector (not the text of
    nested tags), in document order. ``<p>`` closes an open ``<p>``, as browsers do."""

    def __init__(self, steps):
        super().__init__(convert_charrefs=False)
        self.steps = steps
        self.stack: list[tuple[str, set[str], bool]] = []  # (tag, classes, matched-as-target)
        self.out: list[str] = []

    def _matches_chain(self, tag, classes) -> bool:
        *ancestors, (t_tag, t_cls) = self.steps
        if (t_tag and t_tag != tag) or not t_cls <= classes:
            return False
        i = len(ancestors) - 1
        for a_tag, a_cls, _ in reversed(self.stack):
            if i < 0:
                break
            s_tag, s_cls = ancestors[i]
            if (not s_tag or s_tag == a_tag) and s_cls <= a_cls:
                i -= 1
        return i < 0

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            for j in range(len(self.stack) - 1, -1, -1):
                if self.stack[j][0] == "p":
                    del self.stack[j:]
                    break
        if tag in VOID:
            return
        classes = set((dict(attrs).get("class") or "").split())
        self.stack.append((tag, classes, self._matches_chain(tag, classes)))

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        for j in range(len(self.stack) - 1, -1, -1):
            if self.stack[j][0] == tag:
                del self.stack[j:]
                return

    def handle_data(self, data):
        if self.stack and self.stack[-1][2]:
            self.out.append(data)

    def handle_entityref(self, name):
        self.handle_data(f"&{name};")

    def handle_charref(self, name):
        self.handle_data(f"&#{name};")


def direct_text(html: str | None, selector: str) -> str | None:
    if html is None:
        return None
    p = _DirectText(parse_selector(selector))
    p.feed(html)
    p.close()
    return "".join(p.out)


def article_text(html: Column, selector: str = "article .text-passage p.comp") -> Column:
    """D3: direct text of the elements matching ``selector``, joined without separator
    (entities still encoded; decode with ``unescape``)."""
    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda h: direct_text(h, selector))
    return run(html)

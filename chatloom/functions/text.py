"""Column -> Column text helpers (formatting, Python-compatible strip/splitlines, durations).

Everything here is a built-in Spark expression, so it stays inside whole-stage codegen.
"""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------------------------
# Python str semantics on the JVM
# ---------------------------------------------------------------------------------------------
# Python's str.isspace() is Unicode White_Space plus the four separators \x1c-\x1f.
_WS = r"[\s\x1c-\x1f]"
# Python's str.splitlines() boundaries.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def py_strip(x) -> Column:
    """``str.strip()``: Spark's ``trim`` only removes spaces, this removes all whitespace."""
    return F.regexp_replace(_c(x), rf"(?U)^{_WS}+|{_WS}+\z", "")


def splitlines(x) -> Column:
    """``str.splitlines()``: one trailing line break does not open an empty last line."""
    x = _c(x)
    body = F.regexp_replace(x, rf"(?:{LINE_BREAK})\z", "")
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK, -1))


# ---------------------------------------------------------------------------------------------
# Recipe formatting
# ---------------------------------------------------------------------------------------------
def lines(arr) -> Column:
    """one element per line."""
    return F.array_join(_c(arr), "\n")


def numbered(arr) -> Column:
    """``1. first``, ``2. second`` ..."""
    return F.array_join(F.transform(_c(arr), lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")


def key_values(m) -> Column:
    """``key: value`` lines in the map's own order."""
    return F.array_join(F.transform(F.map_entries(_c(m)), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n")


def recipe_card(title, ingredients, directions) -> Column:
    """title, a line of eight spaces, the ingredient block, a blank line, the numbered steps."""
    return F.concat(_c(title), F.lit("\n        \nIngredients:\n"), lines(ingredients),
                    F.lit("\n\nInstructions:\n"), numbered(directions), F.lit("\n"))


# ---------------------------------------------------------------------------------------------
# Answer phrasing
# ---------------------------------------------------------------------------------------------
def natural_list(arr) -> Column:
    """``a``; ``a and b``; ``a, b and c`` (no serial comma). Empty -> null."""
    a = _c(arr)
    n = F.size(a)
    return (F.when(n <= 0, F.lit(None).cast("string"))
            .when(n == 1, F.element_at(a, 1))
            .otherwise(F.concat(F.array_join(F.slice(a, F.lit(1), n - 1), ", "), F.lit(" and "),
                                F.element_at(a, -1))))


def natural_duration(seconds) -> Column:
    """a duration in seconds as a short English phrase (months on, as the common default).

    Under a day: "a moment", "a second", "N seconds", "a minute", "N minutes", "an hour",
    "N hours". Then days, months (30.5-day), years.
    """
    s_total = _c(seconds).cast("long")
    days_total = F.floor(s_total / 86400)
    s = s_total - days_total * 86400
    years = F.floor(days_total / 365)
    days = days_total - years * 365
    months = F.floor(days / 30.5).cast("long")
    d_str = days.cast("long").cast("string")
    under_day = (F.when(s == 0, "a moment")
                 .when(s == 1, "a second")
                 .when(s < 60, F.concat(s.cast("string"), F.lit(" seconds")))
                 .when(s < 120, "a minute")
                 .when(s < 3600, F.concat(F.floor(s / 60).cast("string"), F.lit(" minutes")))
                 .when(s < 7200, "an hour")
                 .otherwise(F.concat(F.floor(s / 3600).cast("string"), F.lit(" hours"))))
    in_year = (F.when(days == 1, "a day")
               .when(months == 0, F.concat(d_str, F.lit(" days")))
               .when(months == 1, "a month")
               .otherwise(F.concat(months.cast("string"), F.lit(" months"))))
    one_year = (F.when((months == 0) & (days == 0), "a year")
                .when(months == 0, F.concat(F.lit("1 year, "), d_str, F.lit(" days")))
                .when(months == 1, "1 year, 1 month")
                .otherwise(F.concat(F.lit("1 year, "), months.cast("string"), F.lit(" months"))))
    return (F.when(s_total.isNull(), F.lit(None).cast("string"))
            .when((years == 0) & (days < 1), under_day)
            .when(years == 0, in_year)
            .when(years == 1, one_year)
            .otherwise(F.concat(years.cast("long").cast("string"), F.lit(" years"))))


def fmt(template, *values) -> Column:
    """Positional ``{}`` fill. The template is split on ``{}`` and the values are interleaved,
    so braces inside a value are left alone. Extra values are ignored, like ``str.format``."""
    parts = F.split(_c(template), r"\{\}", -1)
    pieces = [F.element_at(parts, 1)]
    for i, v in enumerate(values, start=1):
        pieces.append(F.when(F.size(parts) > i, F.concat(_c(v).cast("string"), F.element_at(parts, i + 1)))
                      .otherwise(F.lit("")))
    return F.concat(*pieces)


def fill(template, *values) -> Column:
    """F8: positional ``{}`` fill, then strip."""
    return py_strip(fmt(template, *values))


# ---------------------------------------------------------------------------------------------
# ISO-8601 durations
# ---------------------------------------------------------------------------------------------
_NUM = r"(\d+(?:[.,]\d+)?)"
ISO_DURATION = rf"^([-+])?P(?:{_NUM}W)?(?:{_NUM}D)?(?:T(?:{_NUM}H)?(?:{_NUM}M)?(?:{_NUM}S)?)?$"
_ISO_CALENDAR = r"^[-+]?P(?:\d+(?:[.,]\d+)?[YM])"


def iso_valid(x) -> Column:
    """True when ``x`` is a time-based ISO duration we can turn into seconds."""
    x = _c(x)
    return x.rlike(ISO_DURATION) & (x != "P") & ~x.endswith("T")


def iso_seconds(x, wrap_days: bool = False) -> Column:
    """ISO-8601 duration -> whole seconds (null when absent or not parseable).

    ``wrap_days`` keeps only the part below one day, like a timedelta's ``.seconds``.
    """
    x = _c(x)

    def part(i: int) -> Column:
        g = F.regexp_extract(x, ISO_DURATION, i)
        return F.when(g == "", F.lit(0.0)).otherwise(F.regexp_replace(g, ",", ".").cast("double"))

    total = part(2) * 604800 + part(3) * 86400 + part(4) * 3600 + part(5) * 60 + part(6)
    sign = F.when(F.regexp_extract(x, ISO_DURATION, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    secs = F.floor(total * sign).cast("long")
    if wrap_days:
        secs = F.pmod(secs, F.lit(86400)).cast("long")
    return F.when(iso_valid(x), secs)


def iso_is_calendar(x) -> Column:
    """Years or months: not a fixed number of seconds."""
    return _c(x).rlike(_ISO_CALENDAR)


# ---------------------------------------------------------------------------------------------
# model output and model names
# ---------------------------------------------------------------------------------------------
def clean_completion(x, prompt, pad: str = "<unk>", eos: str = "</s>") -> Column:
    """drop leading pad and trailing end tokens, cut the echoed prompt, strip."""
    body = F.regexp_replace(_c(x), f"^(?:{re.escape(pad)})*", "")
    body = F.regexp_replace(body, f"(?:{re.escape(eos)})*\\z", "")
    return py_strip(F.substring(body, F.length(_c(prompt)) + 1, 1 << 30))


def revision_label(path, style: str = "underscore") -> Column:
    """dataset revision from a model path.

    ``underscore``: last path part, then its last ``_`` part.
    ``dotted``: last path part without its last two dot parts, the rest joined without dots.
    """
    last = F.element_at(F.split(_c(path), "/", -1), -1)
    if style == "underscore":
        return F.element_at(F.split(last, "_", -1), -1)
    if style == "dotted":
        parts = F.split(last, r"\.", -1)
        return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 2, F.lit(0))), "")
    raise ValueError(f"unknown style {style!r}")

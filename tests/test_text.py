from pyspark.sql import functions as F

from chatloom.functions import text as TX


def one(spark, col, data, schema="x string"):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_strip_and_splitlines_follow_python(spark):
    samples = [" a \n", "\t\nb\x0c", "", "x\r\ny\rz\n", "a\n\nb\n", " l1 ", "one"]
    got = one(spark, TX.py_strip("x"), [(s,) for s in samples])
    assert got == [s.strip() for s in samples]
    got = one(spark, TX.splitlines("x"), [(s,) for s in samples])
    assert got == [s.splitlines() for s in samples]


def test_natural_list(spark):
    got = one(spark, TX.natural_list("x"), [(["a"],), (["a", "b"],), (["a", "b", "c"],), ([],)], "x array<string>")
    assert got == ["a", "a and b", "a, b and c", None]


def test_natural_duration(spark):
    cases = {0: "a moment", 1: "a second", 45: "45 seconds", 90: "a minute", 2700: "45 minutes",
             3600: "an hour", 5400: "an hour", 7200: "2 hours", 86399: "23 hours", 86400: "a day",
             3 * 86400: "3 days", 40 * 86400: "a month", 100 * 86400: "3 months", 365 * 86400: "a year",
             400 * 86400: "1 year, 1 month", 800 * 86400: "2 years"}
    got = one(spark, TX.natural_duration("x"), [(k,) for k in cases], "x long")
    assert got == list(cases.values())


def test_fill_keeps_braces_in_values(spark):
    df = spark.createDataFrame([("Rated {} because {} ",)], "t string")
    got = df.select(TX.fill(F.col("t"), F.lit("4.5"), F.lit("it has {} inside"))).first()[0]
    assert got == "Rated 4.5 because it has {} inside"


def test_iso_durations(spark):
    cases = [("PT45M", 2700, 2700), ("PT1H30M", 5400, 5400), ("P1DT2H", 93600, 7200), ("PT0S", 0, 0),
             (None, None, None), ("soon", None, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "x string")
    got = df.select(TX.iso_seconds("x"), TX.iso_seconds("x", wrap_days=True), TX.iso_valid("x")).collect()
    assert [(r[0], r[1]) for r in got] == [(c[1], c[2]) for c in cases]
    assert got[5][2] is False


def test_revision_label(spark):
    df = spark.createDataFrame([("models/org/Thing_7B_v2",), ("/m/mistral-7b.Q4_K_M.gguf",)], "p string")
    u = [r[0] for r in df.select(TX.revision_label("p", "underscore")).collect()]
    d = [r[0] for r in df.select(TX.revision_label("p", "dotted")).collect()]
    assert u == ["v2", "M.gguf"]
    assert d[1] == "mistral-7b"


def test_clean_completion(spark):
    df = spark.createDataFrame([("<unk><unk>PROMPT  answer \n</s></s>", "PROMPT")], "x string, p string")
    assert df.select(TX.clean_completion("x", "p")).first()[0] == "answer"

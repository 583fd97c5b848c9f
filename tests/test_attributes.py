"""Attribute matching of tags, link rows and quarantine shapes, null statuses, checkpoint folder."""
import pytest
from pyspark.sql import functions as F

from chatloom.functions.attributes import attribute, decode_entities
from chatloom.operators import extract, links
from chatloom import session


def test_links_of_any_quoting(spark):
    html = ("<a data-href=\"/wrong\" href=\"/right\">x</a><a class='big card' href='/s?a&amp;o=24'>x</a><a href=/unq>x</a>"
            "<a title=\"a > b\" class=\"cardigan\" href=\"/gt\">x</a><a name=\"n\">no link</a>")
    pages = spark.createDataFrame([(1, "http://h/p", html)], "page_id long, url string, html string")
    assert [r.href for r in links.extract_links(pages).orderBy("ordinal").collect()] == ["/right", "/s?a&o=24", "/unq", "/gt"]
    assert [(r.url, r.href) for r in links.extract_links(pages, css_class="card", carry=["url"]).collect()] == [("http://h/p", "/s?a&o=24")]
    assert links.extract_links(pages, css_class="c.rd").count() == 0


def test_meta_and_script_attributes(spark):
    pages = spark.createDataFrame([
        (1, "<meta content='sub' name='description'><script type=x id='recipe-meta'>[1]</script>"),
        (2, "<meta name=\"description\" content=\"a &amp; b\"><script id=recipe-meta>[2]</script>"),
        (3, "<meta name=other content=x><script data-id=\"recipe-meta\">[3]</script>")], "id long, html string")
    rows = pages.select("id", extract.meta_description(F.col("html")).alias("m"), extract.jsonld_block(F.col("html"), "recipe-meta").alias("j"),
                        extract.has_block(F.col("html"), "recipe-meta").alias("h")).orderBy("id").collect()
    assert [(r.m, r.j, r.h) for r in rows] == [("sub", "[1]", True), ("a &amp; b", "[2]", True), (None, "", False)]


def test_entities_are_decoded_once(spark):
    row = spark.createDataFrame([("&amp;lt; &quot;x&quot;",)], "t string").select(decode_entities(F.col("t")).alias("d"), attribute(F.col("t"), "a").alias("a")).first()
    assert (row.d, row.a) == ('&lt; "x"', None)


def test_every_status_is_counted(spark):
    log = spark.createDataFrame([("a", 200), ("b", 404), ("c", None)], "url string, status int")
    ok, errors = links.fetch_ok(log)
    assert ok.count() == 1 and {r.status: r.n for r in errors.collect()} == {404: 1, None: 1}


def test_reachability_has_no_round_cap(spark):
    import inspect
    assert "max_rounds" not in inspect.signature(links.reachable).parameters


def test_only_a_local_master_gets_its_own_folder(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://h:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())

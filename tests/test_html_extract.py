from chatloom.functions.html import direct_text
from chatloom.operators.extract import PageSpec, extract_pages

from conftest import rows


def test_direct_text_excludes_nested_tags():
    html = ('<article><div class="text-passage"><p class="comp">One <a href="/x">link</a> two</p>'
            '<p class="other">no</p><p class="comp">Three<p class="comp">Four</div></article>'
            '<p class="comp">outside</p>')
    assert direct_text(html, "article .text-passage p.comp") == "One  twoThreeFour"
    assert direct_text("<article><p>a<b>b</b>c</p></article>", "article p") == "ac"


def page(meta: str | None, text="Hello &amp; welcome", desc=None):
    head = f'<meta name="description" content="{desc}">' if desc else ""
    script = f'<script type="application/ld+json" id="recipe-meta">{meta}</script>' if meta is not None else ""
    return (f"<html><head>{head}{script}</head><body><article><div class=\"text-passage\">"
            f"<p class=\"comp\">{text}</p></div></article></body></html>")


def test_extraction_cases(spark):
    ok = '[{"@type": ["Recipe"], "headline": "Pie &amp; co", "author": [{"name": "Ann"}], "prepTime": "PT45M", ' \
         '"aggregateRating": {"ratingValue": 4.5, "ratingCount": 12}, "recipeYield": ["4", "6"], ' \
         '"nutrition": {"@type": "N", "calories": "10 &amp; more"}}]'
    cases = {
        "ok": page(ok, desc="Nice"),
        "newline": page('[{"@type": ["Article"], "headline": "line\nbreak", "author": [{"name": "B"}]}]'),
        "quote": page('[{"@type": ["Recipe"], "headline": "bad "quote"", "author": [{"name": "B"}]}]'),
        "noscript": page(None),
        "nohead": page('[{"@type": ["Article"], "author": [{"name": "B"}]}]'),
        "noauthor": page('[{"@type": ["Article"], "headline": "H", "author": []}]'),
        "empty": page('[{"@type": ["Article"], "headline": "E", "author": [{"name": "B"}]}]', text="  "),
        "bare": page('[{"@type": "Recipe", "headline": "Bare", "author": [{"name": "B"}]}]'),
        "badnum": page('[{"@type": ["Recipe"], "headline": "N", "author": [{"name": "B"}], '
                       '"aggregateRating": {"ratingValue": "abc"}}]'),
        "baddur": page('[{"@type": ["Recipe"], "headline": "D", "author": [{"name": "B"}], "totalTime": "soon"}]'),
    }
    df = spark.createDataFrame(list(cases.items()), "source string, html string")
    ex = extract_pages(df, PageSpec())
    q = {r["source"]: r["reason"] for r in rows(ex.quarantine)}
    assert q == {"quote": "json", "noscript": "no_script", "nohead": "missing_headline",
                 "noauthor": "missing_author", "empty": "empty_text", "badnum": "bad_number",
                 "baddur": "bad_duration"}
    docs = {r["source"]: r for r in rows(ex.document)}
    assert set(docs) == {"ok", "newline", "bare"}
    assert docs["ok"]["title"] == "Pie & co" and docs["ok"]["text"] == "Hello & welcome"
    assert docs["ok"]["subtitle"] == "Nice" and docs["newline"]["subtitle"] is None
    rec = rows(ex.recipe)
    assert len(rec) == 1  # a bare-string @type is not a recipe
    r = rec[0]
    assert r["prep_time"] == 2700 and r["review_score"] == 4.5 and r["review_count"] == 12
    assert r["recipe_yield"] == '["4","6"]' and r["nutrition"] == {"calories": "10 & more"}
    assert r["document"] == docs["ok"]["id"]

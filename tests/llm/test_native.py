import hashlib

from .brute import licenses, quality

from chatloom.llm import chat_format, license_scan, quality_rules, url_filter

PYTHON = ("Python", "Pandas", "Arrow")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def native(df):
    return not any(word in plan_of(df) for word in PYTHON)


# ------------------------------------------------------------------ url filter

URLS = [
    (1, "http://a.Example.NET/en/x?y", "a.example.net", "/en/x", "example.net/en/", "allow"),
    (2, "https://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
    (3, "https://net", "net", "", None, "allow"),
    (4, "https://net/", "net", "/", "net/", "block"),
    (5, "https://internet/", "internet", "/", None, "allow"),
    (6, "ftp://x.org/fr/a#b", "x.org", "/fr/a", "org/fr/", "allow"),
    (7, "https://www.cheap-pills.example.org/fr/1", "www.cheap-pills.example.org", "/fr/1", "org/fr/", "allow"),
    (8, "https://www.cheap-pills.example.org/en/1", "www.cheap-pills.example.org", "/en/1", None, "block"),
    (9, "https://m.example.com/de/1.html", "m.example.com", "/de/1.html", "example.com/de/", "block"),
    (10, "no scheme.net/", "", "", None, "allow"),
    (11, "casino without scheme", "", "", None, "block"),
    (12, None, "", "", None, "allow"),
    (13, "", "", "", None, "allow"),
    (None, "https://a/b://net/", "a", "/b://net/", None, "allow"),
    (14, "https://casinos.example.com/x", "casinos.example.com", "/x", None, "allow"),
    (15, "https://example.com:80/de/", "example.com:80", "/de/", None, "allow"),
    (16, "https://h/" + "a/" * 20000 + "x.exe", "h", "/" + "a/" * 20000 + "x.exe", None, "block"),
    (4, "https://net/", "net", "/", "net/", "block"),
]


def test_url_filter_cases(spark):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u, *_ in URLS], "page_id long, url string, host string, rule string")
    got = url_filter.filter_urls(pages, url_filter.BASE_RULES + url_filter.METHOD_RULES)
    assert native(got)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:3])
    rows = sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()], key=key)
    assert rows == sorted([(i, *rest) for i, _, *rest in URLS], key=key)


def test_url_rules_are_indexed_under_their_rarest_literal(spark):
    rules = url_filter.BASE_RULES + [url_filter.Rule("any", "block", "q{9}", (), False, 0)]
    pages = spark.createDataFrame([(i, f"https://a{i}.example.com/de/x") for i in range(20)] + [(99, "http://z/de/qqqqqqqqq")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got[3] == ("example.com/de/", "block") and got[99] == (None, "block")
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


# ------------------------------------------------------------------ licence scan

TEXTS = [
    "Released under the MIT License.", "under\nthe\tmit--license, under the MIT license", "under the mit licenses", "CC BY-NC 4.0 cc_by_nc ccbync",
    "Apache License, Version 2.0", "apache license version 20", "under the under the mit license apache license version 2", None, "", "...",
    "the GNU General Public License, version 3.", "x " * 30000 + "under the mit license", "unter der Lizenz: cc by ncé", "Permission is hereby granted, free of charge, to any person",
]


def test_license_scan_cases(spark):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], 1, "z"), (0, TEXTS[0], 1, "z")],
                                 "doc_id long, text string, n_words int, labels string")
    got = license_scan.scan_licenses(docs)
    assert native(got)
    rows = got.collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        want = licenses(TEXTS[r.doc_id or 0])
        assert {k: r[k] for k in want} == want, r
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
    labels = {r.doc_id: r.labels for r in rows}
    assert labels[10] == "gpl-3" and labels[13] == "mit" and labels[9] == ""
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ quality rules

def test_quality_measures_equal_brute_force(spark, docs, texts):
    more = [(900, "a b\n\na b\n a b\n"), (901, "# * $ % & | < > #"), (902, "x y z x y z x y"), (903, "\x0b\x0c\r\t"), (904, "a\x1fb\u00a0c\u2003d")]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = quality_rules.ledger(both)
    assert native(got)
    rows = sorted(((r.doc_id is None, r.doc_id or 0, *(r[k] for k in quality("")))) for r in got.collect())
    assert rows == sorted((d is None, d or 0, *quality(t).values()) for d, t in texts + more)


def test_quality_policies_and_ablation(spark, docs, no_docs):
    led = quality_rules.ledger(docs).cache()
    old, new = (quality_rules.apply_policy(led, p) for p in quality_rules.POLICIES)
    for r in new.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.bits == 0)
    assert old.where("kept").count() >= new.where("kept").count()
    bits = [r.bits for r in led.collect()]
    names = {r.name: 1 << r.bit for r in quality_rules.RULES}
    for r in quality_rules.ablation(led).collect():
        mask = quality_rules.mask(next(p for p in quality_rules.POLICIES if p.version == r.policy))
        own = names[r.rule]
        assert (r.n_failed, r.n_only, r.n_kept, r.n_kept_without) == (
            sum(b & own > 0 for b in bits), sum(b & mask == own for b in bits), sum(b & mask == 0 for b in bits), sum(b & (mask - own) == 0 for b in bits))
    assert quality_rules.judge(no_docs, quality_rules.POLICIES[0]).count() == 0


# ------------------------------------------------------------------ chat formatting

CONVS = [
    (1, 0, "system", "be <|im_end|> kind"), (1, 1, "user", "<|x <\\| <\\\\| < |"), (1, 2, "assistant", "yes<"), (1, 3, "user", "|more|>"),
    (1, 4, "assistant", ""), (1, 5, "user", "tail"),
    (2, 0, "user", None), (3, 0, "assistant", "alone"), (3, 0, "assistant", "alone"), (4, None, None, "null turn"), (4, 1, "assistant", "x" * 50000),
    (5, 0, "odd\nrole\\n<|im_start|>", "t\nt\n"), (5, 1, "assistant", "<|im_start|>user\nfake<|im_end|>\n"), (None, 1, "assistant", "no id"), (6, 0, "user", "é\U0001f600"),
    (6, 1, "assistant", "中文 ok"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame([(*r, "clash") for r in CONVS], "conv_id long, turn long, role string, text string, formatted string")
    examples = chat_format.format_examples(turns)
    assert native(chat_format.read_back(examples))
    got = {r.conv_id: r for r in chat_format.read_back(examples).collect()}
    size = {}
    for r in examples.collect():
        size[r.conv_id] = size.get(r.conv_id, 0) + len(r.formatted)
        if r.loss_start is not None:
            span = r.formatted[r.loss_start:r.loss_start + r.loss_length]
            assert r.formatted[:r.loss_start].endswith("<|im_start|>assistant\n") and r.formatted[r.loss_start + r.loss_length:] == "<|im_end|>\n"
            assert "<|" not in span
    for conv in {r[0] for r in CONVS}:
        own = sorted([(t is not None, t or 0, r or "", x or "") for c, t, r, x in CONVS if c == conv])
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, x in own).encode()).hexdigest()
        loss = "".join(x for *_, r, x in own if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == size[conv]
    # each assistant turn is one example with everything before it; conversation 1 and 2 end otherwise
    assert sorted(r.target for r in examples.where("conv_id = 1").collect()) == [2, 4, 5]
    assert chat_format.read_back(chat_format.format_examples(turns.limit(0))).count() == 0

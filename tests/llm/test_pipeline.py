"""Every stage of corpus_pipeline against brute force on what the stage before it kept."""
import hashlib
import random
import re

import corpus_pipeline
import public_tokenizers
from .brute import quality, substring, words
from .conftest import DOC_SCHEMA
from .test_models import check_packing
from .test_pairs import kept_rows

import __spark_entry__

COLUMNS = corpus_pipeline.COLUMNS
LETTERS = str.maketrans("0123456789", "aeioubdfgh")


def corpus():
    rng = random.Random(11)
    say = lambda k, v=4000: " ".join(f"w{rng.randrange(v)}" for _ in range(k)).translate(LETTERS)
    texts = [say(rng.randint(60, 200)) for _ in range(30)]
    base = say(150)
    near = base.split()
    near[70] = "edited"
    passage = say(70)
    item = say(30)
    texts += [base, base, " ".join(near), "short", None, "", "# " * 80, "A B C " * 30, say(80).upper()]
    texts += [say(60) + "\n" + passage + "\n" + say(50) for _ in range(4)]
    texts += [say(70) + " " + item + " " + say(40), say(2500)]
    rows = [(i * 2 + 1, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows.append(rows[2])
    # unlike texts under one id, beside a copy under it
    rows += [(5, say(90), "en", "s", None), (5, base + " again", "en", "s", None), (9, say(70), "en", "s", None)]
    rows = [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s, _ in rows]
    rng.shuffle(rows)
    # one short item occurs in many documents: it must cost none of them
    return rows, [(0, item), (1, say(25)), (2, None), (3, base.split()[0]), (4, passage.split()[0])]


def plain(rows):
    return sorted((r["doc_id"], r["text"]) for r in rows)


def letters(text):
    return len(re.findall(r"[^\W\d_]", text or "")), len([c for c in text or "" if c.isupper()])


def test_stages_equal_brute_force(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame(rows, DOC_SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "substring_dedup", "decontamination", "packing"]

    out, docs = [], spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / f"out-{name}")
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append([r.asDict() for r in docs.collect()])
        if name != "packing":
            assert docs.columns == COLUMNS
            assert all(r["n_chars"] == len(r["text"]) for r in out[-1])

    def keeps(text):
        q = quality(text)
        n, caps = letters(text)
        lines = sum(bool(words(x)) for x in (text or "").split("\n"))
        return (q["n_words"] >= 50 and 100 * q["n_repeat_words"] <= 50 * q["n_words"] and 10 * q["n_symbols"] <= q["n_words"]
                and 2 * q["n_dup_lines"] <= lines and 2 * caps <= n and q["word_chars"] <= 30 * q["n_words"] and 2 * n >= q["word_chars"])

    want = sorted((r[0], r[1]) for r in rows if keeps(r[1]))
    assert plain(out[0]) == want and 30 < len(want) < len(rows)

    want = sorted(kept_rows(want))
    assert plain(out[1]) == want

    kept = substring(want)
    got = plain(out[2])
    assert sorted((d, hashlib.sha256(" ".join(words(t)).encode()).hexdigest()) for d, t in got) == sorted((d, sha) for d, _, _, sha in kept)
    assert sum(gone for _, _, gone, _ in kept) == 3 * 70

    item = words(items[0][1])
    want = [(d, t) for d, t in got if items[0][1] not in t]
    assert plain(out[3]) == want and len(want) == len(got) - 1 and item

    class Row:
        def __init__(self, r):
            self.__dict__.update(r)
    assert check_packing([Row(r) for r in out[4]], want, 1024) > 0.8

    # run() gives the same rows
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    assert sorted(map(key, ran)) == sorted(map(key, out[4]))


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_registers_the_operators():
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if re.match(r"op\d+_", x)} and "pipeline" in names
    assert public_tokenizers.path("byte_bpe_50k.tiktoken")

"""Small tables with the awkward cases every operator must take: nulls in any column, empty and very
long texts, ties, repeated rows, empty tables and extra columns with clashing names."""
import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def doc_rows(seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = []

    def add(text, doc_id=None):
        rows.append((len(rows) * 3 if doc_id is None else doc_id, text, "en", "s0", None if text is None else len(text)))

    for _ in range(25):
        add(prose(rng, rng.randint(1, 160)))
    base = prose(rng, 140)
    add(base)
    add(base)                                                       # an exact copy
    add(base.upper())                                               # equal but for case
    for cut in (1, 2, 6, 14):                                       # near copies, near and beyond the threshold
        words = base.split()
        for at in rng.sample(range(len(words)), cut):
            words[at] = f"x{rng.randrange(9999)}"
        add(" ".join(words))
    chain = base.split()
    for step in range(6):                                           # each like the one before, drifting away
        chain = chain[2:] + [f"d{step}a", f"d{step}b", f"d{step}c"]
        add(" ".join(chain))
    passage = prose(rng, 60, 5000)
    for _ in range(6):                                              # a passage that unlike documents share
        add(prose(rng, rng.randint(10, 90), 5000) + "\n" + passage + "\t" + prose(rng, rng.randint(0, 40), 5000))
    add("again and again " * 80)                                    # periodic
    add("again and again " * 55)
    add("same " * 130)
    add(None)
    add("")
    add(" \n\t ")
    add("one two three")
    add("One two  THREE")
    add("é" * 10 + " ß中文 \U0001f600 " + passage[:200])
    add(prose(rng, 6000, 3000))                                     # very long
    rows.append(rows[0])                                            # a repeated row
    rows.append((rows[3][0], "other text under an id that exists " + passage, "en", "s1", 9))
    rows.append((None, passage + " " + prose(rng, 30), None, None, None))
    rows.append((None, None, None, None, None))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(doc_rows(), DOC_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [(r[0], r[1]) for r in doc_rows()]

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents with copies, near copies, shared passages, nulls, blanks, ties and a long text."""
    dice = random.Random(4)
    en = "the and of thing under water house green quickly river stone bright".split()
    fr = "le la les maison être étoile rivière vert pierre où même pourquoi".split()
    sentence = lambda words, n: " ".join(dice.choice(words) + dice.choice(["", "", "s", "x"]) for _ in range(n))
    passage = sentence(en, 40)
    rows = []
    for i in range(60):
        lang, words = ("en", en) if i % 3 else ("fr", fr)
        text = sentence(words, dice.randint(1, 120))
        if i % 5 == 0:
            text = f"{text} {passage}\n{sentence(words, 5)}"
        if i % 7 == 6:
            text = rows[dice.randrange(len(rows))][1] or ""
        if i % 11 == 10:
            text = (rows[dice.randrange(len(rows))][1] or "") + " end"
        rows.append((i * 3, text, lang, "src0" if i % 2 else f"src{i % 4}", len(text)))
    rows += [
        (500, None, "en", None, None),
        (501, "", "en", "src0", 0),
        (502, " \n\t ", None, "src0", 4),
        (503, "... 123 !!!", "fr", "src9", 11),
        (504, sentence(en, 6000), "en", "src0", None),
        (505, "a" * 5000, "en", "src0", 5000),
        (506, "ab " * 900, None, "src1", 2700),
        (507, "ümlaut 日本語 text mit ß and 🙂 " * 9, "fr", "src1", 0),
        (None, sentence(en, 30), "en", "src1", 9),
        (1, passage, "en", "src2", 9),
    ]
    rows += [rows[3], rows[3]]  # repeated rows
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

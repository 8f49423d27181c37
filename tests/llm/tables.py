from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns that clash with inner names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five six", "en", "a", 27), (1, "one two three four five six", "en", "a", 27),
        (2, "ONE two three\tfour five\nsix", "en", "b", 27), (3, "", "en", "a", 0), (4, None, None, None, None),
        (None, "one two three four five six", None, "a", None), (5, long, "de", "c", len(long)), (6, long, "de", None, None),
        (7, "only three words", "fr", "a", 16), (8, "  é x <|endoftext|> İΣ", "fr", "b", 5),
    ]
    more = ("row", "label", "size", "rep")
    return spark.createDataFrame(
        [(*r, "x", "y", "z", 1) for r in rows], DOCS + "".join(f", {c} string" if c != "rep" else ", rep int" for c in more))


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture
def marks(spark):
    """Labels of made documents: every third toxic or of low quality."""
    return spark.createDataFrame([(i, int(i % 3 != 0), int(i % 3 == 1)) for i in range(120)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture
def marked_docs(spark):
    import random

    dice = random.Random(5)
    words = [f"word{i}" for i in range(60)]
    rows = []
    for i in range(180):
        text = [dice.choice(words) for _ in range(dice.randint(20, 60))]
        if i % 3 == 0:
            text = [w for w in text for _ in range(3)] + ["JUNK!!"] * 5
        if i % 3 == 1:
            for bad in dice.sample(["vile", "nasty", "rotten"], dice.randint(1, 3)):
                text.insert(dice.randrange(len(text)), bad)
        rows.append((i, " ".join(text), "en", f"s{i % 4}", len(" ".join(text))))
    return spark.createDataFrame(rows, DOCS)

"""Small documents with the awkward cases, as Spark tables."""

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"

PASSAGE = "the quick brown fox jumps over the lazy dog while nobody in the whole town is watching it run away"
LONG = " ".join(f"word{i % 977} line{i % 31}" for i in range(6000))


@pytest.fixture(scope="session")
def awkward():
    """doc_id and text: nulls, empty and very long texts, ties and repeated rows."""
    return [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa " + PASSAGE),
        (2, PASSAGE + " and then something else comes, with é and 中文 and \U0001f600 in it"),
        (3, PASSAGE + " and then something else comes, with é and 中文 and \U0001f600 in it"),
        (4, None),
        (5, ""),
        (6, "   \n\t "),
        (7, "one"),
        (8, "One two"),
        (9, "one  two\n\nthree \n four"),
        (10, LONG),
        (11, LONG + " tail"),
        (12, "x" * 5000),
        (12, "x" * 5000),
        (13, "same id"),
        (13, "other text"),
        (None, "no id at all, " + PASSAGE),
        (14, " <|endoftext|> ▁ odd   marks　"),
    ]


@pytest.fixture
def documents(spark):
    def make(rows, parts=3):
        full = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, COLUMNS).repartition(parts) if full else spark.createDataFrame([], COLUMNS)

    return make

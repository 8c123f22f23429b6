import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: an extra column for every name that operators use inside
CLASHES = ["id", "h", "fp", "item", "own", "toxic", "quality", "word", "words", "text_crc32", "k0", "score", "n", "held_out"]

SYLLABLES = "an the re tion ou er es st ha on en nd ed ing wh at or ti he ble".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(words))


def hard_cases(rng: random.Random) -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    long = prose(rng, 6000)
    rows = [(None, None), (1, None), (None, "null id here"), (2, ""), (3, " \n\t "), (4, long), (5, long), (6, "one"), (7, "one"),
            (8, "One TWO"), (9, "x" * 5000), (10, "a\n\nb\na\nb"), (11, "é ß İ ½ 日本 𝄞 \x00 x"), (11, "the same id")]
    rows += [(12, "repeated row"), (12, "repeated row"), (12, "repeated row"), (13, "repeated row")]
    return [(i, t, None, None, None) for i, t in rows]


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def hard(spark):
    """A documents table of hard cases, with columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(hard_cases(random.Random(7)), SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(df) -> list[tuple]:
    """(doc_id, text) of all rows, a null text as an empty one."""
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]

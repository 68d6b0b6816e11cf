"""Documents that are hard on an operator: nulls, blanks, repeats, ties, long texts, clashing column names."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n int, row string, key string, hub long, part int, _place int"


def prose(seed: int, n: int, stock: int = 400) -> str:
    rng = random.Random(seed)
    words = [f"w{rng.randrange(stock)}" + rng.choice(["", "", "", ",", "."]) for _ in range(n)]
    return " ".join(words)


def rows() -> list[tuple]:
    base = prose(1, 120)
    texts = [
        (1, base, "en", "b"),
        (2, base, "en", "b"),  # exact copy
        (3, base.replace("w1", "W1", 3), "en", None),  # a copy but for case
        (4, base + " and one more", "en", "a"),  # near copy
        (5, prose(2, 300), "de", "a"),
        (6, None, "en", "b"),
        (7, "", None, None),
        (8, " \n\t ", "en", ""),
        (9, "two words", None, "c"),
        (10, "one two three four five six", "en", "c"),
        (11, "one two three four five six seven", "en", "c"),
        (12, "éÉ ßü ñ ... !!! 漢字 " + "x" * 3000, "fr", "a"),
        (13, prose(3, 9000), "de", "a"),  # long
        (14, "same same same same same same same same same same same same", "en", "d"),
        (15, "Line one here\nLine one here\n\nLine one here", "en", "d"),
        (16, "1234 5678", "en", "d"),
        (None, base, "en", "b"),
        (None, "nobody owns this text at all here", None, "b"),
        (18, prose(4, 50), "en", "a"),
        (18, prose(4, 50), "en", "a"),  # the same row again
    ]
    more = [(100 + i, prose(50 + i, 30 + 7 * i), "en" if i % 2 else "de", "abc"[i % 3]) for i in range(40)]
    return [(i, t, lang, source, len(t or ""), "s", 1, "r", "k", 5, 0, 9) for i, t, lang, source in texts + more]


@pytest.fixture(scope="session")
def odd_rows():
    return rows()


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

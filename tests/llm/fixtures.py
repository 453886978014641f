"""Small tables with the odd cases every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, fingerprint int"
WORDS = "the of and alpha beta gamma delta river stone cloud paper light green window".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", str(rng.randrange(99))]) for _ in range(words))


def odd_docs(spark, more=()):
    """Nulls in any column, empty and long texts, repeated ids and rows, columns with names the operators use."""
    long = prose(1, 6000)
    rows = [
        (1, prose(2, 80), "en", "a", 10, None, 1), (2, "", "en", "a", 0, "x", 2), (3, None, None, None, None, None, None),
        (None, prose(3, 30), "en", "b", 5, None, None), (None, None, None, None, None, None, None),
        (4, long, "en", "b", len(long), None, 3), (5, "  leading\tand \n trailing  ", "de", "b", 1, None, 4),
        (6, prose(2, 80), "en", "c", 10, None, 1), (6, prose(2, 80), "en", "c", 10, None, 1),
        (7, prose(4, 60), "en", "c", 3, None, 1), (7, prose(5, 60), "en", "c", 3, None, 1),
        (8, "<|endoftext|> é ü  x 日本語 \x1c", "xx", "", 9, None, 1), (9, "x" * 3000, "en", "a", 1, None, 1), *more,
    ]
    return spark.createDataFrame(rows, DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)

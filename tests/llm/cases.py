"""Small tables with everything that may be wrong with one."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "".join(f"w{i % 977} " for i in range(30_000))


def prose(seed: int, n: int = 120) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty, short, very long and repeated texts, ties and repeated rows."""
    base = prose(1)
    changed = base.split()
    changed[60] = "CHANGED"
    rows = [
        (1, base, "en", "s", 1), (2, base, "en", "s", 1), (3, " ".join(changed), "en", "t", None),
        (4, None, "en", "s", 0), (5, "", None, "s", 0), (6, " \n\t ", "de", None, 3), (7, "two words", "de", "s", 9),
        (8, "Two WORDS", "de", "s", 9), (9, LONG, "en", "s", len(LONG)), (10, "ümläut ▁ mark  spaces \n\n x<|endoftext|>y ", None, None, 1),
        (11, prose(2) + " " + base[:300], "en", "t", 1), (12, "a" * 400, "fr", "t", 400), (13, prose(3) + "a" * 150, "fr", "t", 1),
        (14, "One line. One line.\nOne line. One line.\n" * 20, "en", "s", 1), (15, "日本語のテキスト" * 30, "ja", "s", 1),
        (16, base, "en", "s", 1), (16, base, "en", "s", 1), (17, "trailing spaces   ", "en", "s", 1),
    ]
    return rows


def frame(spark, rows=None, schema: str = DOCS):
    return spark.createDataFrame(odd_rows() if rows is None else rows, schema)


def clashing(docs, *names: str):
    """The same rows with columns of names that the operator adds or might use."""
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit("x").alias(n) for n in names))

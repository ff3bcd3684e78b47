"""Tables with everything that may go wrong in a column, and plain-Python answers to compare with."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, TEXT string, n_words int, c0 string, h1 long, score double, d int"
LONG = "Lorem ipsum dolor sit amet, consectetur adipiscing elit. " * 4000


def rows() -> list[tuple]:
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7)))
    base = [word() for _ in range(120)]
    near = list(base)
    near[60] = "changed"
    texts = [
        (0, " ".join(base)),
        (1, " ".join(base)),
        (2, " ".join(near)),
        (3, " ".join(near)),  # repeated below as a whole row
        (3, " ".join(near)),
        (4, None),
        (5, ""),
        (6, " \t\n"),
        (7, "short"),
        (8, "SHORT"),
        (9, LONG),
        (10, "a a a a a a " * 40),
        (11, "x " + " ".join(base[:50]) + " y"),
        (12, "1234 !!! ..."),
        (None, " ".join(base)),
        (None, None),
        (13, "你好 世界   été \x1c end"),
        (14, "first\nSecond line \n\nfirst\r\n second LINE"),
        (15, "<|endoftext|> it's <|startoftext|>x"),
        (-5, "negative id"),
    ]
    return [(i, t, "en" if n % 3 else None, None if n % 4 == 0 else f"s{n % 2}", 1, "other", 7, "c", 3, 0.5, 9) for n, (i, t) in enumerate(texts)]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sample(spark, data: str, n: int | None = None):
    return spark.read.parquet(f"{data}/documents.parquet")

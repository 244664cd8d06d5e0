"""Rows that every operator on documents must take: nulls, empties, ties, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id long, row string, digest string, size long, shard int, takes string, block string, ord string")


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows() -> list[tuple]:
    long_ = words(6000, 1)
    plain = [
        (1, words(60, 2), "xx", "a"), (2, words(60, 2), "xx", "a"), (3, words(60, 2) + " more words here", "xx", "b"),
        (4, None, "xx", "a"), (5, "", "yy", None), (6, "   \n\t ", None, "c"), (7, "one", "yy", "c"),
        (8, long_, "yy", "a"), (9, long_[:20_000] + " cut", "yy", "a"), (10, words(40, 3), None, "b"),
        (None, words(50, 4), "xx", "b"), (None, words(50, 4), "xx", "b"), (12, words(30, 5), "yy", None),
        (12, words(30, 6), "yy", None), (13, words(20, 7), "xx", "a"), (13, words(20, 7), "xx", "a"),
        (14, "é \U0001F600 ▁ <|turn|> \\ " + words(15, 8), "xx", "é"), (15, "1234 5678", "xx", "z"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), 7, "r", "d", 1, 2, "t", "b", "o") for i, t, lang, s in plain]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)

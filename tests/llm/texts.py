"""Small tables with everything an operator must live with."""

from __future__ import annotations

import random

CLASHING = "doc_id long, text string, shard int, slot long, _row long, _key binary, _text string, _doc string, n_chars long, rank int"


def odd_documents(spark, empty: bool = False):
    """Nulls in every column, empty and long texts, ties, repeated rows, columns with clashing names."""
    plain = "the cat sat on the mat and the dog ran of the hill to see it. " * 4
    rows = [
        (1, plain), (2, plain), (2, plain), (2, plain + "x"), (None, plain), (None, None), (3, None), (4, ""), (4, ""),
        (5, " "), (6, "a"), (7, "mail a.b@c.org or +1 (414) 555-7134, 4111 1111 1111 1111 from 10.0.0.1"),
        (8, "Und der die das " * 20_000), (9, "é\n\u2003ß Σ'll <|endoftext|>  x"), (10, "1" * 30_000),
        (11, "***### $$$ " * 50), (-5, "zwei drei vier"),
    ]
    rows = [(i, t, 1, 2, 3, b"k", "t", "d", 5, None) for i, t in rows]
    return spark.createDataFrame([] if empty else rows, CLASHING)


def words(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("aeinrst") for _ in range(draw.randint(2, 7))) for _ in range(n))

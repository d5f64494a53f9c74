"""Counter-based random columns.

``rand(seed)`` depends on how rows are laid out in partitions, so a retried or
re-partitioned stage can draw other numbers.  Here a draw is a pure function of
(stream, key, counter): whole-stage codegen, no state, the same value on every
attempt and for every partition count.

Keys and counters are SQL expressions (column names mostly); one parsed expression
per draw keeps plan building cheap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 1 << 32
_MASK = WORD - 1

# Odd multipliers of the counter mix and the finaliser multiplier.
KEY_MULT = 1664525
COUNTER_MULT = 22695477
STREAM_STEP = 1013904223
FINAL_MULT = 73244475


def key32(seed: int, *columns: str) -> Column:
    """32-bit key of a seed and some columns (leading 8 hex digits of their MD5)."""
    parts = ", ".join([f"'{seed}'", *[f"CAST({c} AS STRING)" for c in columns]])
    return F.expr(f"CAST(conv(substring(md5(concat_ws(':', {parts})), 1, 8), 16, 10) AS BIGINT)")


def _scramble(x: str) -> str:
    return f"(((shiftright({x}, 16) ^ {x}) * {FINAL_MULT}L) & {_MASK}L)"


def uniform_sql(key: str, counter: str, stream: int) -> str:
    """Uniform on (0, 1); key is 32-bit, counter a non-negative bigint below 2^38."""
    offset = (stream * STREAM_STEP) % WORD
    word = (
        f"((CAST({key} AS BIGINT) * {KEY_MULT}L + CAST({counter} AS BIGINT) * {COUNTER_MULT}L"
        f" + {offset}L) & {_MASK}L)"
    )
    x = _scramble(_scramble(word))
    return f"(((shiftright({x}, 16) ^ {x}) + 0.5D) / {WORD}D)"


def uniform(key: str, counter: str, stream: int) -> Column:
    return F.expr(uniform_sql(key, counter, stream))


def normal(key: str, counter: str, stream: int) -> Column:
    """Standard normal by Box-Muller from streams ``2*stream`` and ``2*stream + 1``."""
    u = uniform_sql(key, counter, 2 * stream)
    v = uniform_sql(key, counter, 2 * stream + 1)
    return F.expr(f"sqrt(-2.0D * ln({u})) * cos({2.0 * math.pi!r}D * {v})")

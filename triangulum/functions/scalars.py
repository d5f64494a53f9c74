"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_sql(expr: str, digits: int) -> str:
    """SQL text of ``fixed``."""
    scale = f"{10**digits}D"
    y = f"(({expr}) * {scale})"
    return (
        f"if(abs{y} < {1 << 52}D, signum{y} * floor(abs{y} + 0.5D), {y}) / {scale}"
    )


def fixed(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the binary value: round(x * 10^d) / 10^d.

    Unlike ``F.round(x, d)``, which rounds the printed decimal through BigDecimal,
    this stays in primitive arithmetic and gives the same answer in every engine
    with IEEE doubles.  From 2^52 on a scaled double has no fraction left.  A string
    is read as a SQL expression.
    """
    if isinstance(c, str):
        return F.expr(fixed_sql(c, digits))
    scale = float(10**digits)
    y = c * scale
    size = F.abs(y)
    return F.when(size < float(1 << 52), F.signum(y) * F.floor(size + 0.5)).otherwise(y) / scale


def segment_key(*parts: Column | str, sep: str = "__") -> Column:
    return F.concat_ws(sep, *[_col(p) for p in parts])


def split_segment(segment: Column | str, sep: str = "__") -> tuple[Column, Column]:
    """(product_line, region) of a composed segment key."""
    parts = F.split(_col(segment), sep, 2)
    return F.get(parts, 0), F.get(parts, 1)


def safe_ratio(num: Column | str, den: Column | str, default: float | None = None) -> Column:
    """num / den where den > 0, else ``default`` (NULL when None)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num / den).otherwise(F.lit(default).cast("double"))


def pct_change(cur: Column | str, prev: Column | str) -> Column:
    """Percent change against ``prev``; 0.0 when prev is NULL or 0."""
    cur, prev = _col(cur), _col(prev)
    return F.when(prev != 0, (cur - prev) / prev * 100).otherwise(F.lit(0.0))


def growth_pct(cur: Column | str, prev: Column | str) -> Column:
    """Percent growth against ``prev``; NULL unless prev > 0."""
    cur, prev = _col(cur), _col(prev)
    return F.when(prev > 0, (cur - prev) / prev * 100.0)


def map_lookup(key: Column | str, mapping: Mapping[str, object]) -> Column:
    """Literal-map lookup; a missing key gives NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), _col(key))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (least/greatest alone would drop it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def snap(c: Column | str, step: float = 0.05, lo: float = 0.05, hi: float = 1.0) -> Column:
    """Nearest multiple of ``step``, kept inside [lo, hi]."""
    c = _col(c)
    return clip(fixed(F.round(c / F.lit(step)) * F.lit(step), 2), lo, hi)


def calendar_features(month: Column | str) -> dict[str, Column]:
    month = _col(month)
    return {
        "month_of_year": F.month(month),
        "quarter": F.quarter(month),
        "is_q1": (F.quarter(month) == 1).cast("int"),
        "is_winter": F.month(month).isin(12, 1, 2).cast("int"),
    }


def money_label(value_m: Column | str, digits: int = 1) -> Column:
    """'$12.3M', or '$1.2B' from 1000 million upwards."""
    v = _col(value_m)
    big = F.abs(v) >= 1000

    def text(x: Column) -> Column:
        return F.format_string(f"%.{digits}f", fixed(x, digits))

    return F.when(big, F.concat(F.lit("$"), text(v / 1000), F.lit("B"))).otherwise(
        F.concat(F.lit("$"), text(v), F.lit("M"))
    )


def display_name(c: Column | str) -> Column:
    return F.translate(_col(c), "_", " ")


def wide_select(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """All derived columns in one projection, so analysis stays linear in their number."""
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])


def first_of_month(c: Column | str) -> Column:
    return F.trunc(F.to_date(_col(c)), "month")

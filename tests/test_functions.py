from __future__ import annotations


import numpy as np
import pytest
from pyspark.sql import functions as F

from triangulum.functions import randoms
from triangulum.functions import scalars as sc


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "value,digits,want",
    [(2.5, 0, 3.0), (-2.5, 0, -3.0), (1.25, 1, 1.3), (123.456, 2, 123.46), (1e300, 2, 1e300), (0.0, 3, 0.0)],
)
def test_fixed_rounds_half_away(spark, value, digits, want):
    assert one(spark, sc.fixed(F.lit(value), digits)) == pytest.approx(want, rel=1e-15)


def test_scalars(spark):
    null = F.lit(None).cast("double")
    assert one(spark, sc.clip(null, 0.1, 0.9)) is None
    assert one(spark, sc.clip(F.lit(2.0), 0.1, 0.9)) == 0.9
    assert one(spark, sc.snap(F.lit(0.163))) == 0.15
    assert one(spark, sc.snap(F.lit(0.0))) == 0.05
    assert one(spark, sc.safe_ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, sc.safe_ratio(F.lit(1.0), F.lit(0.0), 0.0)) == 0.0
    assert one(spark, sc.pct_change(F.lit(5.0), F.lit(0.0))) == 0.0
    assert one(spark, sc.pct_change(F.lit(5.0), null)) == 0.0
    assert one(spark, sc.growth_pct(F.lit(5.0), F.lit(-1.0))) is None
    assert one(spark, sc.map_lookup(F.lit("z"), {"a": 1})) is None
    assert one(spark, sc.money_label(F.lit(12.34))) == "$12.3M"
    assert one(spark, sc.money_label(F.lit(1234.5))) == "$1.2B"


def test_random_columns_do_not_depend_on_partitions(spark):
    def draw(parts):
        df = spark.range(0, 20_000, 1, parts)
        df = df.withColumn("k", randoms.key32(7, "'a'"))
        rows = df.select("id", randoms.uniform("k", "id", 3).alias("u"), randoms.normal("k", "id", 5).alias("z"))
        return rows.orderBy("id").toPandas()

    a, b = draw(1), draw(7)
    assert a.equals(b)
    assert abs(a.u.mean() - 0.5) < 0.01 and abs(a.u.var() - 1 / 12) < 0.002
    assert abs(a.z.mean()) < 0.03 and abs(a.z.std() - 1) < 0.02
    assert abs(np.corrcoef(a.u[:-1], a.u[1:])[0, 1]) < 0.03
    assert a.u.nunique() > 19_900

"""Rounding equals Python's, on ties, near ties and every magnitude."""
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from trafficwatch.functions.numbers import round_half_even
from trafficwatch.plans.report import rounded_mean


def values():
    rng = random.Random(6)
    found = [0.0, -0.0, 2.675, 1.005, 0.125, 0.375, 2.5, 3.5, -2.5, 0.5, 1e-320, 5e-324, 2.0**46, 2.0**46 - 0.25, 2.0**52 + 1, 1e300, -1e300,
             2.0**-53, 0.005, 0.015, 0.025, math.nextafter(0.125, 0), math.nextafter(0.125, 1), 2.0**43 - 2.0**-10]
    found += [rng.uniform(0, 250) for _ in range(40_000)]
    found += [k / 1000 for k in range(-6000, 6000)]  # texts that look like ties
    found += [rng.randrange(1 << 20) / (1 << rng.randrange(1, 12)) * rng.choice((1, -1)) for _ in range(30_000)]  # exact ties
    found += [math.nextafter((2 * rng.randrange(10**6) + 1) / 200, rng.choice((0, 1e9))) for _ in range(10_000)]
    found += [v for v in (struct.unpack("<d", rng.randbytes(8))[0] for _ in range(12_000)) if not math.isnan(v)]
    return found


@pytest.mark.parametrize("places", [0, 1, 2, 3])
def test_rounding_equals_python(spark, places):
    numbers = values()
    assert len(numbers) > 100_000
    df = spark.createDataFrame([(v,) for v in numbers], "x double").repartition(4)
    wrong = []
    for r in df.select("x", round_half_even(F.col("x"), places).alias("y")).collect():
        expected = r.x if math.isinf(r.x) else float(round(r.x, places))
        if r.y != expected:
            wrong.append((r.x, r.y, expected))
    assert not wrong, wrong[:5]


def test_rounding_of_nothing(spark):
    row = spark.sql("select cast(null as double) n, double('nan') q, double('-inf') i").select(
        *[round_half_even(F.col(c), 2).alias(c) for c in "nqi"]).first()
    assert row.n is None and math.isnan(row.q) and row.i == -math.inf
    with pytest.raises(ValueError):
        round_half_even(F.lit(1.0), 4)


def test_means_round_the_binary_value(spark):
    df = spark.createDataFrame([(2.675, 1), (5.35, 2), (0.25, 2), (None, 0)], "total double, n long")
    found = [r[0] for r in df.select(rounded_mean(F.col("total"), F.nullif("n", F.lit(0)), 2)).collect()]
    assert found == [round(2.675, 2), round(5.35 / 2, 2), round(0.125, 2), 0.0] == [2.67, 2.67, 0.12, 0.0]

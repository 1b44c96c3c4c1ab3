import math
import random

import pytest
from pyspark.sql import functions as F

from recordlens.operators.quantiles import exact_quantiles

PROBABILITIES = (0.0, 0.25, 0.5, 0.75, 1.0)


def expected(values, p):
    return sorted(values)[max(math.ceil(p * len(values)), 1) - 1]


def draw(kind, n=3000):
    rng = random.Random(kind)
    if kind == "uniform":
        return [rng.random() for _ in range(n)]
    if kind == "one value in three":
        return [7.0 if rng.random() < 0.4 else rng.uniform(0, 14) for _ in range(n)]
    if kind == "wide":
        return [rng.choice((-1, 1)) * 10 ** rng.uniform(-300, 300) for _ in range(n)]
    return [float(rng.randrange(4)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["uniform", "one value in three", "wide", "few values"])
@pytest.mark.parametrize("in_memory", [20, 10**6])
def test_exact(spark, kind, in_memory):
    values = draw(kind)
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(4)
    found = exact_quantiles(df, F.col("v"), PROBABILITIES, in_memory=in_memory)
    assert found == [expected(values, p) for p in PROBABILITIES]


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, F.col("v"), (0.25, 0.75)) == [None, None]

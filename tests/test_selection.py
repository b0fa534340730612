"""Exact median by narrowing, against sorting."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from wardmill.operators import cleaning, selection


def median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    return selection.median(df, F.col("v"), "m").first().m


@pytest.mark.parametrize(
    "values",
    [
        [3.0], [1.0, 2.0], [1.5, None, 2.25, 7.0], [-1.0, -2.0, -3.5, 4.0], [0.0, -0.0, 1e-300, -1e300],
        [5e-324, -5e-324, 1.7e308], [40.0] * 900 + [1.0] * 899, [0.1 * k for k in range(1001)], [math.inf, 1.0, 2.0],
    ],
)
def test_median(spark, values):
    assert median(spark, values) == statistics.median(v for v in values if v is not None)


def test_median_of_random_doubles(spark):
    rnd = random.Random(13)
    values = [rnd.gauss(0, 1) * 10 ** rnd.randrange(-200, 200) for _ in range(3000)]
    assert median(spark, values) == statistics.median(values)


def test_median_of_nothing(spark):
    assert median(spark, []) is None and median(spark, [None, None]) is None


def test_ages_with_fractions(spark, make):
    raw = spark.createDataFrame(
        [(k, a, "Male", "A", None) for k, a in enumerate(["1.5", "33.25", "70.5", "x", "200"])],
        "patient_id bigint, age string, gender string, city string, registration_date date",
    )
    got = {r.patient_id: r.age for r in cleaning.clean_patients(raw).collect()}
    assert got == {0: 1.5, 1: 33.25, 2: 70.5, 3: 33.25, 4: 33.25}
    plan = cleaning.clean_patients(raw)._jdf.queryExecution().executedPlan().toString()
    assert "median(" not in plan and "percentile" not in plan

"""Rounding, calendar and text rules against exact arithmetic."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from helpers import rows

from wardmill.functions import arith, dates, text


def half_up(x, digits):
    return Decimal(x).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


def test_share_is_exact(spark):
    pairs = [(a, b) for b in range(1, 121) for a in range(b + 1)] + [(10**12 + 1, 2 * 10**12), (1, 0), (None, 5)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for a, b, got in df.select("a", "b", arith.share_pct(F.col("a"), F.col("b"))).collect():
        want = half_up(Decimal(a) * 100 / Decimal(b), 2) if a is not None and b else None
        assert got == want, (a, b)


def test_money_mean_rounds_once(spark):
    pairs = [(c, n) for n in range(1, 41) for c in range(0, 400, 7)] + [(999999999999, 2), (10**9 + 1, 3), (5, 0)]
    df = spark.createDataFrame([(Decimal(c) / 100, n) for c, n in pairs], "s decimal(24,2), n bigint")
    for s, n, got in df.select("s", "n", arith.money_mean(F.col("s"), F.col("n"))).collect():
        assert got == (half_up(s / n, 2) if n else None), (s, n)


def test_growth_is_symmetric_and_guarded(spark):
    data = [("100.00", "80.00", "25.00"), ("80.00", "100.00", "-20.00"), ("1.00", "3.00", "-66.67"),
            ("1.00", "0.00", None), ("1.00", None, None), (None, "1.00", None)]
    df = spark.createDataFrame([(c and Decimal(c), p and Decimal(p), w) for c, p, w in data], "c decimal(24,2), p decimal(24,2), w string")
    for got, want in df.select(arith.growth_pct(F.col("c"), F.col("p")), "w").collect():
        assert got == (want and Decimal(want))


def test_guarded_division_and_clip(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 4), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(arith.divide_or_zero(F.col("a"), F.col("b"))).collect()] == [0.25, 0.0, 0.0, 0.0]
    df = spark.createDataFrame([(-1,), (5,), (11,), (None,)], "a int")
    assert [r[0] for r in df.select(arith.clip(F.col("a"), 0, 10)).collect()] == [0, 5, 10, None]


def test_calendar(spark):
    days = [dt.date(2023, 12, 31) + dt.timedelta(days=i) for i in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d",
        dates.weekday_num("d").alias("n"),
        dates.weekday_name(dates.weekday_num("d")).alias("name"),
        dates.month_of("d").alias("m"),
        dates.quarter_of("d").alias("q"),
    )
    for d, n, name, m, q in df.collect():
        assert n == (d.weekday() + 1) % 7 and name == d.strftime("%A")
        assert m == d.replace(day=1) and q == dt.date(d.year, (d.month - 1) // 3 * 3 + 1, 1)


def test_report_text(spark):
    df = spark.createDataFrame([(1234567, Decimal("1234567.80"), Decimal("16.70")), (0, Decimal("0.05"), Decimal("16.00"))],
                               "n bigint, m decimal(24,2), r decimal(10,2)")
    assert rows(df.select(text.thousands(F.col("n")), text.dollars(F.col("m")), text.plain_number(F.col("r")))) == [
        ("0", "$0.05", "16.0"), ("1,234,567", "$1,234,567.80", "16.7"),
    ]

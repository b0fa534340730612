"""Dashboard measures, each evaluated at an explicit grain.

Ratios of a measure are doubles and blank ratios are 0. Windows here run over days or months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardmill.functions.arith import MONEY_SUM, divide_or_zero
from wardmill.functions.dates import month_of
from wardmill.operators import ranking
from wardmill.plans.business import side_by_side
from wardmill.plans.views import COMPLETED, NO_SHOW, completed_cost, is_status


def _revenue() -> Column:
    return F.sum(completed_cost()).cast(MONEY_SUM).alias("revenue")


def dax_core(appointments: DataFrame) -> DataFrame:
    done_wait = F.when(is_status(COMPLETED), F.col("waiting_time_minutes"))
    return appointments.agg(
        _revenue(),
        F.count(F.lit(1)).alias("total_appointments"),
        F.count_distinct("patient_id").alias("total_patients"),
        F.count_if(is_status(NO_SHOW)).alias("total_no_shows"),
        F.sum(done_wait).alias("wait"),
        F.count(done_wait).alias("wait_n"),
    ).select(
        F.col("revenue").alias("total_revenue"),
        "total_appointments",
        "total_patients",
        "total_no_shows",
        (divide_or_zero(F.col("total_no_shows"), F.col("total_appointments")) * 100).alias("no_show_rate_pct"),
        F.try_divide(F.col("wait").cast("double"), F.col("wait_n")).alias("avg_waiting_time"),
    )


def dax_revenue_total(visits: DataFrame, treatments: DataFrame) -> DataFrame:
    return side_by_side(
        [
            visits.agg(_revenue()),
            treatments.agg(F.sum("treatment_cost").cast(MONEY_SUM).alias("total_treatment_revenue")),
        ]
    ).select(
        F.col("revenue").alias("total_revenue"),
        "total_treatment_revenue",
        (F.coalesce("revenue", F.lit(0)) + F.coalesce("total_treatment_revenue", F.lit(0))).alias(
            "grand_total_revenue"
        ),
    )


def daily_revenue(visits: DataFrame) -> DataFrame:
    """One row per day with appointments of any status."""
    return visits.groupBy("appointment_date").agg(_revenue())


def _to_date(visits: DataFrame, period: list[Column], out: str) -> DataFrame:
    window = Window.partitionBy(*period).orderBy("appointment_date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        daily_revenue(visits)
        .select("appointment_date", F.sum("revenue").over(window).alias(out))
        .orderBy("appointment_date")
    )


def dax_mtd(visits: DataFrame) -> DataFrame:
    return _to_date(visits, [F.year("appointment_date"), F.month("appointment_date")], "monthly_revenue")


def dax_ytd(visits: DataFrame) -> DataFrame:
    return _to_date(visits, [F.year("appointment_date")], "ytd_revenue")


def dax_mom(visits: DataFrame) -> DataFrame:
    """Growth on the previous calendar month; 0 when that month is missing or zero."""
    monthly = visits.groupBy(month_of("appointment_date").alias("month")).agg(_revenue())
    in_order = Window.orderBy("month")
    adjacent = F.lag("month").over(in_order) == F.add_months("month", -1)
    return (
        monthly.withColumn("prev_month_revenue", F.when(adjacent, F.lag("revenue").over(in_order)))
        .select(
            "month",
            F.col("revenue").alias("monthly_revenue"),
            "prev_month_revenue",
            (divide_or_zero(F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")) * 100).alias(
                "mom_growth_pct"
            ),
        )
        .orderBy("month")
    )


def dax_rolling_3m(visits: DataFrame) -> DataFrame:
    """Per month the revenue of (last - 3 months, last], ``last`` being its last appointment day.

    A range frame includes both of its ends, so the day exactly three months back is taken off again.
    """
    daily = daily_revenue(visits).withColumn("month", month_of("appointment_date"))
    days = "OVER (ORDER BY appointment_date RANGE BETWEEN INTERVAL 3 MONTHS PRECEDING AND {})"
    upto_today = F.expr("sum(revenue) " + days.format("CURRENT ROW"))
    far_end = F.expr("sum(revenue) " + days.format("INTERVAL 3 MONTHS PRECEDING"))
    last = F.max("appointment_date").over(Window.partitionBy("month"))
    return (
        daily.withColumn("rolling_3m_revenue", (upto_today - F.coalesce(far_end, F.lit(0))).cast(MONEY_SUM))
        .withColumn("last_date", last)
        .where("appointment_date = last_date")
        .select("month", "last_date", "rolling_3m_revenue")
        .orderBy("month")
    )


def dax_resources(resources: DataFrame) -> DataFrame:
    """Ratio of sums by department and for all of them ('ALL')."""
    return (
        resources.rollup("department")
        .agg(
            F.grouping("department").alias("is_total"),
            F.sum("occupied_beds").alias("occupied_beds"),
            F.sum("total_beds").alias("total_beds"),
            F.avg(F.col("equipment_utilization").cast("double") * 100).alias("utilization"),
        )
        .select(
            F.when(F.col("is_total") == 1, "ALL").otherwise(F.col("department")).alias("department"),
            (divide_or_zero(F.col("occupied_beds"), F.col("total_beds")) * 100).alias("bed_occupancy_pct"),
            F.round("utilization", 4).alias("avg_equipment_utilization"),
        )
    )


def monthly_loss(visits: DataFrame) -> DataFrame:
    """Missed appointments times the mean value of completed ones (unrounded), by month."""
    monthly = visits.groupBy(month_of("appointment_date").alias("month")).agg(
        _revenue(),
        F.count_if(is_status(COMPLETED)).alias("completed"),
        F.count_if(is_status(NO_SHOW)).alias("no_shows"),
    )
    return monthly.withColumn(
        "avg_appointment_value", divide_or_zero(F.col("revenue"), F.col("completed"))
    ).withColumn("estimated_lost_revenue", F.col("no_shows") * F.col("avg_appointment_value"))


def dax_lost_revenue(visits: DataFrame) -> DataFrame:
    return (
        monthly_loss(visits)
        .select("month", "no_shows", "avg_appointment_value", "estimated_lost_revenue")
        .orderBy("month")
    )


def dax_doctor_rank(doctor_totals: DataFrame) -> DataFrame:
    """Dense rank over all doctors; a doctor without revenue counts as 0."""
    revenue = F.coalesce("total_revenue", F.lit(0).cast(MONEY_SUM)).alias("total_revenue")
    df = ranking.durable(doctor_totals.select("doctor_id", "doctor_name", revenue))
    return ranking.rank_desc(df, "total_revenue", "revenue_rank", dense=True)


def dim_calendar(dates: list[tuple[DataFrame, str]]) -> DataFrame:
    """All days from 1 January of the first year to 31 December of the last, over the given columns."""
    ends = None
    for df, column in dates:
        one = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
        ends = one if ends is None else ends.unionByName(one)
    span = ends.agg(F.year(F.min("low")).alias("y0"), F.year(F.max("high")).alias("y1"))
    days = F.explode(
        F.sequence(F.make_date("y0", F.lit(1), F.lit(1)), F.make_date("y1", F.lit(12), F.lit(31)))
    )
    return span.select(days.alias("date")).select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
    )

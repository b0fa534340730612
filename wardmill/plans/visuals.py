"""Data behind the dashboard visuals that is not already a view, query or measure."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardmill.functions.arith import MONEY_SUM, share_pct
from wardmill.functions.dates import weekday_num
from wardmill.operators.integrity import with_known
from wardmill.plans.business import side_by_side
from wardmill.plans.measures import monthly_loss
from wardmill.plans.views import NO_SHOW, is_status

# Heatmap columns, Sunday = 0.
WEEKDAYS = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]


def viz_status_breakdown(visits: DataFrame) -> DataFrame:
    return visits.groupBy("appointment_status").agg(F.count(F.lit(1)).alias("total"))


def viz_gender_distribution(patients: DataFrame) -> DataFrame:
    return patients.groupBy("gender").agg(F.count(F.lit(1)).alias("patients"))


def _seen(appointments: DataFrame, patients: DataFrame) -> DataFrame:
    """Patients with appointments; the ids are made distinct before the join."""
    return with_known(patients, appointments.select("patient_id").distinct(), "patient_id")


def viz_age_histogram(appointments: DataFrame, patients: DataFrame, width: int = 10) -> DataFrame:
    """Known patients with appointments, each once, by age bin."""
    start = F.floor(F.col("age") / width) * width
    return (
        _seen(appointments, patients)
        .groupBy(start.cast("int").alias("age_bin"))
        .agg(F.count("patient_id").alias("patients"))
        .orderBy(F.desc("patients"), "age_bin")
    )


def viz_noshow_heatmap(visits: DataFrame, doctors: DataFrame) -> DataFrame:
    """No-show percentage, department by weekday."""
    by_doctor = visits.groupBy("doctor_id", weekday_num("appointment_date").alias("weekday")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_status(NO_SHOW)).alias("missed")
    )
    wide = (
        by_doctor.join(doctors.select("doctor_id", "department"), "doctor_id")
        .groupBy("department")
        .pivot("weekday", list(range(7)))
        .agg(share_pct(F.sum("missed"), F.sum("n")))
    )
    return wide.select("department", *[F.col(str(i)).alias(name) for i, name in enumerate(WEEKDAYS)]).orderBy(
        "department"
    )


def viz_bed_stack(resources: DataFrame) -> DataFrame:
    """Occupied and available beds of each department with their share."""
    return (
        resources.select("department", "total_beds", "occupied_beds", "available_beds")
        .unpivot(["department", "total_beds"], ["occupied_beds", "available_beds"], "bed_state", "beds")
        .select("department", "bed_state", "beds", share_pct(F.col("beds"), F.col("total_beds")).alias("share_pct"))
    )


def viz_dept_revenue(department_totals: DataFrame) -> DataFrame:
    return department_totals.select(
        "department", F.col("total_revenue").alias("revenue"), F.col("no_show_rate_pct").alias("no_show_pct")
    ).orderBy(F.desc_nulls_first("revenue"), "department")


def viz_revenue_drill(monthly_revenue: DataFrame) -> DataFrame:
    """Department totals drilled down by year, quarter and month; ``level`` counts the date parts."""
    parts = monthly_revenue.select(
        "department",
        F.year("month").alias("year"),
        F.quarter("month").alias("quarter"),
        F.month("month").alias("month"),
        "total_revenue",
    )
    d, y, q, m = (F.col(c) for c in ["department", "year", "quarter", "month"])
    return parts.groupingSets([[d, y], [d, y, q], [d, y, q, m]], d, y, q, m).agg(
        (F.lit(3) - F.grouping("quarter") - F.grouping("month")).cast("int").alias("level"),
        F.sum("total_revenue").cast(MONEY_SUM).alias("total_revenue"),
    )


def viz_diagnosis_breakdown(treatments: DataFrame) -> DataFrame:
    return treatments.groupBy("diagnosis").agg(F.count(F.lit(1)).alias("cases"))


def viz_revenue_vs_loss(visits: DataFrame) -> DataFrame:
    """Revenue of the month next to the estimate of what missed appointments cost."""
    return monthly_loss(visits).select("month", "revenue", "estimated_lost_revenue").orderBy("month")


def viz_top_doctors(doctor_totals: DataFrame, k: int = 10) -> DataFrame:
    return (
        doctor_totals.orderBy(F.desc_nulls_first("total_revenue"), "doctor_id")
        .limit(k)
        .select("doctor_name", "total_revenue")
    )


def viz_page1_cards(department_totals: DataFrame, appointments: DataFrame, patients: DataFrame) -> DataFrame:
    """Revenue over departments, appointments, and distinct known patients."""
    seen = _seen(appointments, patients)
    return side_by_side(
        [
            department_totals.agg(F.sum("total_revenue").cast(MONEY_SUM).alias("revenue")),
            appointments.agg(F.count("appointment_id").alias("appointments")),
            seen.agg(F.count("patient_id").alias("patients")),
        ]
    )

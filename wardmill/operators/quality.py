"""Data-quality checks: one aggregation pass per table, one report row per check.

Check names, columns, severities and details are fixed values of the report.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from wardmill.sources.schemas import GENDERS, STATUSES

REPORT_COLUMNS = [
    "table_name", "check_name", "column_name", "severity", "issues_found", "total_rows",
    "pct_affected", "detail",
]


class Check(NamedTuple):
    name: str
    column: str
    severity: str
    issues: Column
    detail: str = ""


def repeated(key: str) -> Column:
    """Rows beyond the first of every non-null key."""
    return F.count(key) - F.count_distinct(key)


def unlisted(column: str, allowed: list[str]) -> Column:
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(allowed))


def missing(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def report(df: DataFrame, table: str, checks: list[Check], checked_at: dt.datetime | None = None) -> DataFrame:
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[c.issues.alias(f"issues_{i}") for i, c in enumerate(checks)]
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(c.name).alias("check_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.severity).alias("severity"),
            F.col(f"issues_{i}").cast("bigint").alias("issues_found"),
            F.col("total_rows"),
            F.lit(c.detail).alias("detail"),
        )
        for i, c in enumerate(checks)
    ]
    long = counted.select(F.inline(F.array(*rows)))
    pct = F.round(
        F.col("issues_found").cast("decimal(20,0)") * 100 / F.nullif(F.col("total_rows"), F.lit(0)), 3
    )
    out = long.withColumn("pct_affected", F.coalesce(pct, F.lit(0)).cast("decimal(6,3)")).select(REPORT_COLUMNS)
    return out if checked_at is None else out.withColumn("checked_at", F.lit(checked_at).cast("timestamp"))


def check_patients(df: DataFrame, as_of: dt.date, checked_at=None) -> DataFrame:
    age = F.expr("try_cast(age AS double)")
    checks = [
        Check("Null primary key", "patient_id", "HIGH", missing("patient_id")),
        Check("Duplicate primary key", "patient_id", "HIGH", repeated("patient_id")),
        Check("Null value", "age", "MEDIUM", missing("age")),
        Check("Out-of-range value", "age", "HIGH", F.count_if((age <= 0) | (age > 120)), "age must be 1-120"),
        Check("Invalid category", "gender", "MEDIUM", unlisted("gender", GENDERS)),
        Check("Null value", "gender", "HIGH", missing("gender")),
        Check("Future date", "registration_date", "HIGH", F.count_if(F.col("registration_date") > F.lit(as_of))),
    ]
    return report(df, "patients", checks, checked_at)


def check_appointments(df: DataFrame, checked_at=None) -> DataFrame:
    cost, wait = F.col("appointment_cost"), "waiting_time_minutes"
    open_wait = (F.col("appointment_status") == "Completed") & F.col(wait).isNull()
    checks = [
        Check("Duplicate primary key", "appointment_id", "HIGH", repeated("appointment_id")),
        Check("Null foreign key", "patient_id", "HIGH", missing("patient_id")),
        Check("Invalid category", "appointment_status", "HIGH", unlisted("appointment_status", STATUSES)),
        Check("Negative value", "appointment_cost", "HIGH", F.count_if(cost < 0)),
        Check("Null value", "appointment_cost", "MEDIUM", missing("appointment_cost")),
        Check("Null waiting time on completed record", wait, "MEDIUM", F.count_if(open_wait)),
    ]
    return report(df, "appointments", checks, checked_at)


def check_treatments(df: DataFrame, as_of: dt.date, checked_at=None) -> DataFrame:
    checks = [
        Check("Duplicate primary key", "treatment_id", "HIGH", repeated("treatment_id")),
        Check("Future date", "treatment_date", "HIGH", F.count_if(F.col("treatment_date") > F.lit(as_of))),
        Check("Negative value", "treatment_cost", "HIGH", F.count_if(F.col("treatment_cost") < 0)),
        Check("Null value", "diagnosis", "MEDIUM", missing("diagnosis")),
    ]
    return report(df, "treatments", checks, checked_at)


def quality_report(
    patients: DataFrame, appointments: DataFrame, treatments: DataFrame, as_of: dt.date, checked_at=None
) -> DataFrame:
    return (
        check_patients(patients, as_of, checked_at)
        .unionByName(check_appointments(appointments, checked_at))
        .unionByName(check_treatments(treatments, as_of, checked_at))
    )


def severity_summary(quality: DataFrame) -> DataFrame:
    return quality.groupBy("table_name", "severity").agg(
        F.sum("issues_found").alias("total_issues"), F.count("check_name").alias("checks")
    )


def high_total(quality: DataFrame) -> DataFrame:
    return quality.where("severity = 'HIGH'").agg(
        F.coalesce(F.sum("issues_found"), F.lit(0)).alias("high_issues")
    )

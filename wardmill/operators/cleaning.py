"""Cleaning of the raw tables, and an account of what it changed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from wardmill.operators import selection
from wardmill.operators.dedupe import keep_first
from wardmill.session import durable
from wardmill.sources.schemas import GENDERS, STATUSES


def _valid_age() -> Column:
    return F.col("age").between(1, 120)


def _listed_gender() -> Column:
    return F.col("gender").isin(GENDERS)


def _sound_appointment() -> Column:
    cost, wait = F.col("appointment_cost"), F.col("waiting_time_minutes")
    return (
        F.col("patient_id").isNotNull()
        & F.col("appointment_status").isin(STATUSES)
        & (cost.isNull() | (cost >= 0))
        & (wait.isNull() | (wait >= 0))
    )


def _sound_treatment(as_of: dt.date) -> Column:
    cost = F.col("treatment_cost")
    return (F.col("treatment_date") <= F.lit(as_of)) & (cost.isNull() | (cost >= 0))


def _typed_patients(raw: DataFrame, order_by: list[str] | None) -> DataFrame:
    """Unique, identified patients; an age that is not a number becomes NULL."""
    return (
        keep_first(raw, ["patient_id"], order_by)
        .where("patient_id IS NOT NULL")
        .withColumn("age", F.expr("try_cast(age AS double)"))
    )


def median_age(typed: DataFrame) -> DataFrame:
    """One row. Ages may have fractions; the median is found by narrowing, not by gathering the values."""
    return selection.median(typed, F.when(_valid_age(), F.col("age")), "median_age")


def clean_patients(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Keep-first, drop unidentified, replace missing and out-of-range ages by the median of the
    valid ones, then drop rows without a listed gender. The median is taken before that last step."""
    typed = _typed_patients(raw, order_by)
    imputed = F.when(_valid_age(), F.col("age")).otherwise(median_age(typed).scalar())
    return typed.withColumn("age", imputed).where(_listed_gender())


def clean_appointments(raw: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    return keep_first(raw, ["appointment_id"], order_by).where(_sound_appointment())


def clean_treatments(raw: DataFrame, as_of: dt.date, order_by: list[str] | None = None) -> DataFrame:
    return (
        keep_first(raw, ["treatment_id"], order_by)
        .where(_sound_treatment(as_of))
        .fillna("Unspecified", ["diagnosis"])
    )


def clean_audit(
    patients: DataFrame, appointments: DataFrame, treatments: DataFrame, as_of: dt.date, orders: dict | None = None
) -> DataFrame:
    """Rows before and after each cleaner; for patients also the two kinds of imputed ages, the median
    used and the rows dropped for their gender. The deduplication carries the number of rows it saw; the
    unique patients are stored, as the median reads them several times."""
    orders = orders or {}

    def first(raw: DataFrame, name: str, key: str) -> DataFrame:
        return keep_first(raw, [key], orders.get(name), copies="_copies")

    def counts(kept: Column) -> list[Column]:
        return [
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_before"),
            F.count_if(kept).alias("rows_after"),
        ]

    identified = F.col("patient_id").isNotNull()
    typed = durable(first(patients, "patients", "patient_id").withColumn("age", F.expr("try_cast(age AS double)")))
    parts = {
        "patients": typed.agg(
            *counts(identified & _listed_gender()),
            F.count_if(identified & ~_valid_age()).alias("ages_out_of_range"),
            F.count_if(identified & F.col("age").isNull()).alias("ages_missing"),
            F.count_if(identified & ~F.coalesce(_listed_gender(), F.lit(False))).alias("bad_gender_dropped"),
        ).withColumn("median_age", median_age(typed.where(identified)).scalar()),
        "appointments": first(appointments, "appointments", "appointment_id").agg(*counts(_sound_appointment())),
        "treatments": first(treatments, "treatments", "treatment_id").agg(*counts(_sound_treatment(as_of))),
    }
    out = None
    for name, counted in parts.items():
        one = counted.withColumn("table_name", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))

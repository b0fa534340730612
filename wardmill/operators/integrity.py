"""Referential integrity: rows to keep, rows that would be lost."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_known(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts whose key exists in the dimension; facts without a key drop too."""
    return facts.join(dimension.select(key), key, "left_semi")


def orphans(facts: DataFrame, dimension: DataFrame, key: str, id_column: str, table: str) -> DataFrame:
    """Facts whose non-null key has no match."""
    return (
        facts.where(F.col(key).isNotNull())
        .join(dimension.select(key), key, "left_anti")
        .select(
            F.lit(table).alias("table_name"),
            F.col(id_column).cast("string").alias("row_id"),
            F.lit(key).alias("column_name"),
            F.col(key).cast("string").alias("missing_key"),
        )
    )


def orphan_report(
    patients: DataFrame, doctors: DataFrame, appointments: DataFrame, treatments: DataFrame
) -> DataFrame:
    return (
        orphans(appointments, patients, "patient_id", "appointment_id", "appointments")
        .unionByName(orphans(appointments, doctors, "doctor_id", "appointment_id", "appointments"))
        .unionByName(orphans(treatments, patients, "patient_id", "treatment_id", "treatments"))
    )

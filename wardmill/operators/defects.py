"""Defect injection by rule, so that the number of every defect can be computed beforehand."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

Rule = tuple[str, str, object]  # column, SQL predicate on the id, replacement


def patient_rules() -> list[Rule]:
    return [
        ("age", "patient_id % 97 = 0", None),
        ("age", "patient_id % 331 = 1", -3),
        ("gender", "patient_id % 199 = 2", None),
        ("gender", "patient_id % 499 = 3", "Unknown_XYZ"),
    ]


def appointment_rules() -> list[Rule]:
    return [
        ("patient_id", "appointment_id % 200 = 5", None),
        ("appointment_cost", "appointment_id % 333 = 6", -50),
        ("appointment_status", "appointment_id % 250 = 7", "INVALID_STATUS"),
        ("waiting_time_minutes", "appointment_id % 501 = 8", None),
    ]


def treatment_rules(as_of: dt.date) -> list[Rule]:
    return [
        ("treatment_date", "treatment_id % 125 = 9", as_of + dt.timedelta(days=30)),
        ("treatment_cost", "treatment_id % 250 = 11", -100),
    ]


def inject(df: DataFrame, rules: list[Rule], duplicate: str | None = None) -> DataFrame:
    """Replace values where a rule holds (a later rule wins), then append the rows that
    ``duplicate`` selects a second time."""
    types = dict(zip(df.columns, (f.dataType for f in df.schema.fields)))
    columns = {c: F.col(c) for c in df.columns}
    for name, predicate, value in rules:
        columns[name] = F.when(F.expr(predicate), F.lit(value).cast(types[name])).otherwise(columns[name])
    dirty = df.select(*[c.alias(n) for n, c in columns.items()])
    if duplicate is None:
        return dirty
    copies = F.when(F.expr(duplicate), 2).otherwise(1)
    return dirty.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies))).drop("_copy")

"""Table schemas. Ids may be text or whole numbers; the text form is what the CSV files carry."""

from __future__ import annotations

from pyspark.sql import types as T

# Accepted categories.
GENDERS = ["Male", "Female"]
STATUSES = ["Completed", "No-show", "Cancelled", "Rescheduled"]
TREATMENT_TYPES = [
    "Surgery", "Medication", "Physiotherapy", "Chemotherapy",
    "Radiation", "Counseling", "Observation", "Diagnostic Imaging",
]
SEVERITIES = ["HIGH", "MEDIUM", "LOW"]

MONEY = T.DecimalType(12, 2)


def _table(key: T.DataType, *fields: tuple[str, T.DataType | str]) -> T.StructType:
    return T.StructType([T.StructField(n, key if t == "key" else t) for n, t in fields])


def patients(key: T.DataType = T.StringType(), age: T.DataType = T.IntegerType()) -> T.StructType:
    return _table(
        key,
        ("patient_id", "key"), ("age", age), ("gender", T.StringType()),
        ("city", T.StringType()), ("registration_date", T.DateType()),
    )


def doctors(key: T.DataType = T.StringType()) -> T.StructType:
    return _table(
        key,
        ("doctor_id", "key"), ("doctor_name", T.StringType()), ("gender", T.StringType()),
        ("specialty", T.StringType()), ("department", T.StringType()),
    )


def appointments(key: T.DataType = T.StringType()) -> T.StructType:
    return _table(
        key,
        ("appointment_id", "key"), ("patient_id", "key"), ("doctor_id", "key"),
        ("appointment_date", T.DateType()), ("appointment_status", T.StringType()),
        ("waiting_time_minutes", T.IntegerType()), ("appointment_cost", MONEY),
    )


def treatments(key: T.DataType = T.StringType()) -> T.StructType:
    return _table(
        key,
        ("treatment_id", "key"), ("patient_id", "key"), ("diagnosis", T.StringType()),
        ("treatment_type", T.StringType()), ("treatment_cost", MONEY), ("treatment_date", T.DateType()),
    )


def resources() -> T.StructType:
    return _table(
        T.StringType(),
        ("department", T.StringType()), ("available_beds", T.IntegerType()),
        ("occupied_beds", T.IntegerType()), ("staff_count", T.IntegerType()),
        ("equipment_utilization", T.DecimalType(4, 2)), ("snapshot_date", T.DateType()),
    )

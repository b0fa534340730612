"""The table rules as row predicates, reported instead of enforced.

A rule is broken when its predicate is false; NULL passes, as in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from wardmill.sources.schemas import GENDERS, STATUSES, TREATMENT_TYPES


def _listed(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def table_rules(as_of: dt.date) -> dict[str, dict]:
    """Key, required columns, text lengths and value rules of each table."""
    return {
        "patients": {
            "key": "patient_id",
            "required": ["gender", "registration_date"],
            "length": {"patient_id": 12, "gender": 10, "city": 60},
            "values": {
                "age": "age BETWEEN 1 AND 120",
                "gender": f"gender IN {_listed(GENDERS)}",
            },
        },
        "doctors": {
            "key": "doctor_id",
            "required": ["doctor_name", "gender", "specialty", "department"],
            "length": {"doctor_id": 8, "doctor_name": 100, "gender": 10, "specialty": 60, "department": 80},
            "values": {"gender": f"gender IN {_listed(GENDERS)}"},
        },
        "appointments": {
            "key": "appointment_id",
            "required": ["appointment_date", "appointment_status"],
            "length": {"appointment_id": 12, "patient_id": 12, "doctor_id": 8, "appointment_status": 20},
            "values": {
                "appointment_status": f"appointment_status IN {_listed(STATUSES)}",
                "waiting_time_minutes": "waiting_time_minutes >= 0",
                "appointment_cost": "appointment_cost >= 0",
            },
            "numeric": {"appointment_cost": (12, 2)},
        },
        "treatments": {
            "key": "treatment_id",
            "required": ["treatment_type", "treatment_date"],
            "length": {"treatment_id": 10, "patient_id": 12, "diagnosis": 100, "treatment_type": 60},
            "values": {
                "treatment_type": f"treatment_type IN {_listed(TREATMENT_TYPES)}",
                "treatment_cost": "treatment_cost >= 0",
                "treatment_date": f"treatment_date <= DATE '{as_of.isoformat()}'",
            },
            "numeric": {"treatment_cost": (12, 2)},
        },
        "resources": {
            "key": None,
            "required": [
                "department", "available_beds", "occupied_beds", "staff_count",
                "equipment_utilization", "snapshot_date",
            ],
            "length": {"department": 80},
            "values": {
                "available_beds": "available_beds >= 0",
                "occupied_beds": "occupied_beds >= 0",
                "staff_count": "staff_count >= 0",
                "equipment_utilization": "equipment_utilization BETWEEN 0 AND 1",
            },
            "numeric": {"equipment_utilization": (4, 2)},
        },
        "quality_report": {
            "key": None,
            "required": ["table_name", "check_name", "severity", "issues_found", "total_rows"],
            "length": {"table_name": 50, "check_name": 100, "column_name": 60, "severity": 10},
            "values": {"severity": "severity IN ('HIGH', 'MEDIUM', 'LOW')"},
            "numeric": {"pct_affected": (6, 3)},
        },
    }


def _exact(c: Column) -> Column:
    """A number in all its digits, from the text of the value; NULL for what is no number of fewer than 27 digits."""
    return F.trim(c.cast("string")).try_cast("decimal(38,11)")


def fits_numeric(c: Column, precision: int, scale: int) -> Column:
    """Whether a value, given as text or a number, can be stored as NUMERIC(precision, scale) after rounding: it is a
    number, and has at most precision - scale digits before the point once it is rounded. NULL passes."""
    limit = F.lit(10 ** (precision - scale)).cast("decimal(38,11)")
    fits = F.abs(F.round(_exact(c), scale)) < limit
    return c.isNull() | F.coalesce(fits, F.lit(False))


def keeps_scale(c: Column, scale: int) -> Column:
    """Whether storing a value with ``scale`` digits after the point leaves it as it is. What is no number passes here."""
    return F.coalesce(_exact(c) == F.round(_exact(c), scale), F.lit(True))


def constraint_report(tables: dict[str, DataFrame], as_of: dt.date) -> DataFrame:
    """One row per rule: (table_name, column_name, rule, violations). One pass per table."""
    rules = table_rules(as_of)
    out = None
    for name, df in tables.items():
        spec = rules[name]
        counts = []
        if spec["key"]:
            key = spec["key"]
            counts.append((key, "unique", F.count(key) - F.count_distinct(key)))
        for column in [*([spec["key"]] if spec["key"] else []), *spec["required"]]:
            counts.append((column, "not null", F.count_if(F.col(column).isNull())))
        for column, limit in spec["length"].items():
            too_long = F.length(F.col(column).cast("string")) > limit
            counts.append((column, "length", F.count_if(too_long)))
        for column, predicate in spec["values"].items():
            counts.append((column, "check", F.count_if(~F.expr(predicate))))
        for column, (precision, scale) in spec.get("numeric", {}).items():
            counts.append((column, "numeric", F.count_if(~fits_numeric(F.col(column), precision, scale))))
            counts.append((column, "scale", F.count_if(~keeps_scale(F.col(column), scale))))
        one = df.agg(*[c.cast("bigint").alias(f"v{i}") for i, (_, _, c) in enumerate(counts)]).select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("table_name"),
                            F.lit(column).alias("column_name"),
                            F.lit(rule).alias("rule"),
                            F.col(f"v{i}").alias("violations"),
                        )
                        for i, (column, rule, _) in enumerate(counts)
                    ]
                )
            )
        )
        out = one if out is None else out.unionByName(one)
    return out

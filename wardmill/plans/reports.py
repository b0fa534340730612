"""KPI extracts for the report sheets, and their text form."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from wardmill.functions.arith import share_pct
from wardmill.functions.text import dollars, plain_number, thousands
from wardmill.plans.business import overall_kpis
from wardmill.session import durable


def sheet_exec_kpis(appointments: DataFrame, as_of: dt.date) -> DataFrame:
    return overall_kpis(appointments).select(
        F.lit(as_of.isoformat()).alias("report_date"),
        "total_patients",
        "total_appointments",
        "total_no_shows",
        "no_show_rate_pct",
        "total_revenue",
        "avg_wait_minutes",
    )


def sheet_monthly_kpis(monthly_kpis: DataFrame, months: int = 24) -> DataFrame:
    return monthly_kpis.orderBy(F.desc("month")).limit(months)


def sheet_department_kpis(department_performance: DataFrame) -> DataFrame:
    return department_performance.orderBy(F.desc_nulls_first("total_revenue"), "department")


def sheet_top_doctors(doctor_performance: DataFrame, k: int = 20) -> DataFrame:
    return (
        doctor_performance.orderBy(F.desc_nulls_first("total_revenue"), "doctor_id")
        .limit(k)
        .select(
            "doctor_name", "department", "total_appointments", "no_show_rate_pct", "total_revenue", "avg_wait_minutes"
        )
    )


def sheet_resource_snapshot(resources: DataFrame) -> DataFrame:
    return resources.select(
        "department",
        "available_beds",
        "occupied_beds",
        "total_beds",
        share_pct(F.col("occupied_beds"), F.col("total_beds")).alias("occupancy_pct"),
        "staff_count",
        F.round(F.col("equipment_utilization") * 100, 2).alias("equipment_util_pct"),
    ).orderBy(F.desc_nulls_first("occupancy_pct"), "department")


def sheet_kpi_cards(exec_kpis: DataFrame) -> DataFrame:
    """The wide KPI row as (position, kpi, value, notes). Labels and notes are fixed values; the notes
    are kept as the sheet words them, although patients are those with appointments and the wait is
    over all statuses."""
    cards = [
        ("Total Patients", thousands(F.col("total_patients")), "All registered"),
        ("Total Appointments", thousands(F.col("total_appointments")), "All time"),
        ("Total No-shows", thousands(F.col("total_no_shows")), ""),
        ("No-show Rate", F.concat(plain_number(F.col("no_show_rate_pct")), F.lit("%")), "Target: <15%"),
        ("Total Revenue (Appts)", dollars(F.col("total_revenue")), "Completed only"),
        ("Avg Waiting Time", F.concat(plain_number(F.col("avg_wait_minutes")), F.lit(" min")), "All completed"),
        ("Report Date", F.col("report_date"), ""),
    ]
    return exec_kpis.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("position"), F.lit(k).alias("kpi"), v.alias("value"), F.lit(n).alias("notes")
                    )
                    for i, (k, v, n) in enumerate(cards, start=1)
                ]
            )
        )
    )


def report_rows(df: DataFrame) -> DataFrame:
    """Every value as text, NULL as an empty string."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def numbered_rows(df: DataFrame) -> DataFrame:
    """Add ``line``, the place of a row in a frame that is in order, from 1.

    An ordered frame keeps its order from partition to partition and inside each. The rows are stored with the
    partition they are in and their place there; a line is that place and the rows of the partitions before it,
    so no task sees more than its own rows.
    """
    marked = df.withColumn("_place", F.monotonically_increasing_id())
    rows = durable(marked.withColumn("_part", F.shiftright("_place", 33)))  # the upper bits number the partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = rows.groupBy("_part").agg(F.count("*").alias("_n"))  # one row for each partition
    shifts = shifts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = F.col("_place") - F.shiftleft("_part", 33)
    return rows.join(F.broadcast(shifts), "_part").select((F.col("_shift") + inside + 1).alias("line"), *df.columns)


def sheet_layout(df: DataFrame, updated_at: dt.datetime | None = None) -> DataFrame:
    """A whole report sheet as (line, c1..cN): the update stamp and a blank line, the header, then the
    rows in their order, however many."""
    names = [f"c{i}" for i in range(1, len(df.columns) + 1)]
    top = [] if updated_at is None else [[f"🔄 Last updated: {updated_at:%Y-%m-%d %H:%M} UTC"], []]
    head = [row + [""] * (len(names) - len(row)) for row in [*top, list(df.columns)]]
    lines = df.sparkSession.createDataFrame(
        [(i, *row) for i, row in enumerate(head, start=1)], ["line", *names]
    ).withColumn("line", F.col("line").cast("bigint"))
    body = numbered_rows(report_rows(df).toDF(*names)).withColumn("line", F.col("line") + len(head))
    return lines.unionByName(body).orderBy("line")


def write_sheet(df: DataFrame, path: str, updated_at: dt.datetime | None = None) -> str:
    """Store a report sheet as headerless CSV files, whose names put their lines in order; a short one is one file."""
    sheet_layout(df, updated_at).drop("line").write.mode("overwrite").csv(path, header=False, emptyValue="")
    return path

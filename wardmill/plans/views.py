"""The reusable views. Each is a function from frames to a frame.

Plans that do not use the patient accept ``visits``: appointments without ``patient_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardmill.functions.arith import MONEY_SUM, money_mean, share_pct, whole_mean
from wardmill.functions.dates import month_of, weekday_num

COMPLETED = "Completed"
NO_SHOW = "No-show"


def is_status(status: str) -> Column:
    return F.col("appointment_status") == status


def completed_cost() -> Column:
    """Cost of completed appointments, NULL otherwise, so that a group without any sums to NULL."""
    return F.when(is_status(COMPLETED), F.col("appointment_cost"))


def visit_sums() -> list[Column]:
    """Sums over appointments that can be added up again at a coarser grain."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_status(COMPLETED)).alias("completed"),
        F.count_if(is_status(NO_SHOW)).alias("no_shows"),
        F.sum(completed_cost()).alias("revenue"),
        F.count(completed_cost()).alias("revenue_n"),
        F.sum("waiting_time_minutes").alias("wait"),
        F.count("waiting_time_minutes").alias("wait_n"),
    ]


def add_up(df: DataFrame, *keys: str | Column) -> DataFrame:
    counts = ["n", "completed", "no_shows", "revenue_n", "wait", "wait_n"]
    return df.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in counts], F.sum("revenue").cast(MONEY_SUM).alias("revenue")
    )


def avg_wait() -> Column:
    return whole_mean(F.col("wait"), F.col("wait_n"))


def v_appointment_detail(appointments: DataFrame, patients: DataFrame, doctors: DataFrame) -> DataFrame:
    """Flat fact. Ids come from the dimension side: NULL where there is no match."""
    a, p, d = appointments.alias("a"), patients.alias("p"), doctors.alias("d")
    return (
        a.join(p, F.col("a.patient_id") == F.col("p.patient_id"), "left")
        .join(d, F.col("a.doctor_id") == F.col("d.doctor_id"), "left")
        .select(
            "a.appointment_id", "a.appointment_date", "a.appointment_status", "a.waiting_time_minutes",
            "a.appointment_cost", "p.patient_id", "p.age", "p.gender", "p.city", "d.doctor_id",
            "d.doctor_name", "d.specialty", "d.department",
        )
    )


def v_monthly_kpis(visits: DataFrame) -> DataFrame:
    monthly = visits.groupBy(month_of("appointment_date").alias("month")).agg(
        *visit_sums(), F.count_if(is_status("Cancelled")).alias("cancelled")
    )
    return monthly.select(
        "month",
        F.col("n").alias("total_appointments"),
        "completed",
        "no_shows",
        "cancelled",
        share_pct(F.col("no_shows"), F.col("n")).alias("no_show_rate_pct"),
        money_mean(F.col("revenue"), F.col("revenue_n")).alias("avg_revenue"),
        F.col("revenue").alias("total_revenue"),
        avg_wait().alias("avg_wait_minutes"),
    ).orderBy("month")


def _department_columns() -> list[Column]:
    return [
        F.col("department"),
        F.col("n").alias("total_appointments"),
        F.col("completed"),
        F.col("no_shows"),
        share_pct(F.col("no_shows"), F.col("n")).alias("no_show_rate_pct"),
        F.col("revenue").alias("total_revenue"),
        avg_wait().alias("avg_wait_minutes"),
    ]


def department_totals(visits: DataFrame, doctors: DataFrame) -> DataFrame:
    """``v_department_performance`` without the distinct patients: summed by doctor before the join."""
    by_doctor = visits.groupBy("doctor_id").agg(*visit_sums())
    joined = by_doctor.join(doctors.select("doctor_id", "department"), "doctor_id")
    return add_up(joined, "department").select(_department_columns())


def v_department_performance(appointments: DataFrame, doctors: DataFrame) -> DataFrame:
    """Inner join: a department without appointments does not appear."""
    joined = appointments.join(doctors.select("doctor_id", "department"), "doctor_id")
    return (
        joined.groupBy("department")
        .agg(*visit_sums(), F.count_distinct("patient_id").alias("unique_patients"))
        .select(*_department_columns(), "unique_patients")
    )


def v_no_show_risk_features(appointments: DataFrame, patients: DataFrame, doctors: DataFrame) -> DataFrame:
    """One row per completed or missed appointment, with the patient's history before that day.

    The history counts rows of all statuses on strictly earlier days. It is a running sum over one
    row per patient and day, so a window holds at most as many rows as there are days, however many
    appointments a patient has; the appointments then look up their day.
    """
    daily = (
        appointments.where("patient_id IS NOT NULL")
        .groupBy("patient_id", "appointment_date")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_status(NO_SHOW)).alias("missed"))
    )
    earlier = Window.partitionBy("patient_id").orderBy("appointment_date").rowsBetween(
        Window.unboundedPreceding, -1
    )
    history = daily.select(
        "patient_id",
        "appointment_date",
        F.coalesce(F.sum("missed").over(earlier), F.lit(0)).alias("prior_no_shows"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("prior_total_appointments"),
    ).join(patients.select("patient_id", "age", "registration_date"), "patient_id")
    rated = appointments.where(F.col("appointment_status").isin(COMPLETED, NO_SHOW))
    return (
        rated.join(history, ["patient_id", "appointment_date"])
        .join(doctors.select("doctor_id", "department"), "doctor_id")
        .select(
            "appointment_id",
            "patient_id",
            "age",
            "department",
            weekday_num("appointment_date").alias("appointment_weekday"),
            F.datediff("appointment_date", "registration_date").alias("days_since_registration"),
            "prior_no_shows",
            "prior_total_appointments",
            F.when(is_status(NO_SHOW), 1).otherwise(0).alias("no_show"),
        )
    )


def mv_monthly_revenue(appointments: DataFrame, treatments: DataFrame, doctors: DataFrame) -> DataFrame:
    """Month and department revenue where every appointment counts once per treatment of the same
    patient and month, and every treatment once per such appointment.

    The pairs are never formed. Both facts are summed by patient, month and department (none for
    treatments) in one aggregation, and a patient's month, now at most one row per department, hands
    the number and cost of its treatments to its appointment rows.
    """
    blank = F.lit(None)
    visits = appointments.join(doctors.select("doctor_id", "department"), "doctor_id").select(
        "patient_id",
        month_of("appointment_date").alias("month"),
        "department",
        F.lit(1).alias("visit"),
        completed_cost().alias("visit_cost"),
        blank.cast("int").alias("care"),
        blank.cast("decimal(12,2)").alias("care_cost"),
    )
    care = treatments.where("patient_id IS NOT NULL").select(
        "patient_id",
        month_of("treatment_date").alias("month"),
        blank.cast("string").alias("department"),
        blank.cast("int").alias("visit"),
        blank.cast("decimal(12,2)").alias("visit_cost"),
        F.lit(1).alias("care"),
        "treatment_cost",
    )
    sums = (
        visits.union(care)
        .groupBy("patient_id", "month", "department")
        .agg(*[F.sum(c).alias(c) for c in ["visit", "visit_cost", "care", "care_cost"]])
    )
    same_month = Window.partitionBy("patient_id", "month")
    weighted = (
        sums.withColumn("care", F.coalesce(F.sum("care").over(same_month), F.lit(1)))
        .withColumn("care_cost", F.sum("care_cost").over(same_month).cast(MONEY_SUM))
        .where("visit IS NOT NULL")
    )
    grouped = weighted.groupBy("month", "department").agg(
        F.sum(F.col("visit") * F.col("care")).alias("total_appointments"),
        F.sum(F.col("visit_cost") * F.col("care")).cast(MONEY_SUM).alias("appointment_revenue"),
        F.sum(F.col("care_cost") * F.col("visit")).cast(MONEY_SUM).alias("treatment_revenue"),
    )
    return _with_total(grouped)


def _with_total(grouped: DataFrame) -> DataFrame:
    zero = F.lit(0).cast(MONEY_SUM)
    total = F.coalesce("appointment_revenue", zero) + F.coalesce("treatment_revenue", zero)
    return grouped.withColumn("total_revenue", total.cast(MONEY_SUM)).orderBy(
        "month", F.desc("total_revenue"), "department"
    )


def mv_monthly_revenue_dedup(visits: DataFrame, doctors: DataFrame) -> DataFrame:
    """Completed appointment revenue by month and department, each appointment once."""
    by_doctor = visits.groupBy("doctor_id", month_of("appointment_date").alias("month")).agg(*visit_sums())
    joined = by_doctor.join(doctors.select("doctor_id", "department"), "doctor_id")
    return add_up(joined, "month", "department").select(
        "month",
        "department",
        F.col("n").alias("total_appointments"),
        F.col("revenue").alias("appointment_revenue"),
    )


def mv_doctor_performance(appointments: DataFrame, doctors: DataFrame) -> DataFrame:
    """One row per doctor, also for those without appointments: their count is 0, and their rate is
    0.00 because the outer-join row counts as one in its denominator."""
    by_doctor = appointments.groupBy("doctor_id").agg(
        *visit_sums(), F.count_distinct("patient_id").alias("unique_patients")
    )
    return _doctor_rows(by_doctor, doctors).select(*_DOCTOR_COLUMNS, "unique_patients")


_DOCTOR_COLUMNS = [
    "doctor_id", "doctor_name", "specialty", "department", "total_appointments", "completed", "no_shows",
    "no_show_rate_pct", "avg_wait_minutes", "total_revenue",
]


def _doctor_rows(by_doctor: DataFrame, doctors: DataFrame) -> DataFrame:
    return (
        doctors.select("doctor_id", "doctor_name", "specialty", "department")
        .join(by_doctor, "doctor_id", "left")
        .fillna(0, ["n", "completed", "no_shows", *(["unique_patients"] if "unique_patients" in by_doctor.columns else [])])
        .withColumn("total_appointments", F.col("n"))
        .withColumn("no_show_rate_pct", share_pct(F.col("no_shows"), F.greatest(F.col("n"), F.lit(1))))
        .withColumn("avg_wait_minutes", avg_wait())
        .withColumn("total_revenue", F.col("revenue").cast(MONEY_SUM))
    )


def doctor_totals(visits: DataFrame, doctors: DataFrame) -> DataFrame:
    """``mv_doctor_performance`` without the distinct patients."""
    return _doctor_rows(visits.groupBy("doctor_id").agg(*visit_sums()), doctors).select(_DOCTOR_COLUMNS)


def register(
    patients: DataFrame, doctors: DataFrame, appointments: DataFrame, treatments: DataFrame, resources: DataFrame
) -> None:
    """Make tables and views available to SQL under their names. Views stay lazy; the two stored ones are
    overridden when a ``TableStore`` publishes them."""
    frames = {
        "patients": patients,
        "doctors": doctors,
        "appointments": appointments,
        "treatments": treatments,
        "resources": resources,
        "v_appointment_detail": v_appointment_detail(appointments, patients, doctors),
        "v_monthly_kpis": v_monthly_kpis(appointments),
        "v_department_performance": v_department_performance(appointments, doctors),
        "v_no_show_risk_features": v_no_show_risk_features(appointments, patients, doctors),
        "mv_monthly_revenue": mv_monthly_revenue(appointments, treatments, doctors),
        "mv_doctor_performance": mv_doctor_performance(appointments, doctors),
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)

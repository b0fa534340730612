"""The business queries Q01-Q21.

Where the source leaves the order of ties open, a unique key is appended. Windows without a
partition run over months, days, departments or categories only; ranks over doctors go through
``operators.ranking``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from wardmill.functions.arith import MONEY_SUM, growth_pct, money_mean, share_pct, whole_mean
from wardmill.functions.dates import month_of, quarter_number, quarter_of, weekday_name, weekday_num
from wardmill.operators import ranking
from wardmill.operators.quantiles import percentile_cont
from wardmill.plans.views import COMPLETED, NO_SHOW, completed_cost, is_status, visit_sums


def q01_top_departments(department_performance: DataFrame, k: int = 10) -> DataFrame:
    by_revenue = Window.orderBy(F.desc_nulls_first("total_revenue"))
    return (
        department_performance.select("department", "total_revenue", F.rank().over(by_revenue).alias("revenue_rank"))
        .orderBy(F.desc_nulls_first("total_revenue"), "department")
        .limit(k)
    )


def q02_patient_growth(patients: DataFrame) -> DataFrame:
    monthly = patients.groupBy(month_of("registration_date").alias("month")).agg(
        F.count(F.lit(1)).alias("new_patients")
    )
    in_order = Window.orderBy("month")
    previous = F.lag("new_patients").over(in_order)
    return monthly.select(
        "month",
        "new_patients",
        F.sum("new_patients").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("cumulative_patients"),
        growth_pct(F.col("new_patients").cast("decimal(20,0)"), previous.cast("decimal(20,0)")).alias(
            "mom_growth_pct"
        ),
    ).orderBy("month")


def q03_noshow_dept_weekday(visits: DataFrame, doctors: DataFrame) -> DataFrame:
    by_doctor = visits.groupBy("doctor_id", weekday_num("appointment_date").alias("weekday_num")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_status(NO_SHOW)).alias("missed"),
    )
    return (
        by_doctor.join(doctors.select("doctor_id", "department"), "doctor_id")
        .groupBy("department", "weekday_num")
        .agg(F.sum("n").alias("total_appointments"), F.sum("missed").alias("no_shows"))
        .withColumn("weekday", weekday_name("weekday_num"))
        .withColumn("no_show_rate_pct", share_pct(F.col("no_shows"), F.col("total_appointments")))
        .orderBy(F.desc_nulls_first("no_show_rate_pct"), "department", "weekday_num")
    )


def q04_doctor_ranking(doctor_performance: DataFrame) -> DataFrame:
    """Revenue rank inside the department and quartile of the no-show rate. The doctors are stored once;
    both ranks come from one stored order."""
    columns = [
        "doctor_id", "doctor_name", "department", "total_appointments", "no_show_rate_pct", "total_revenue",
        "avg_wait_minutes",
    ]
    df = ranking.durable(doctor_performance.select(columns))
    ranks = {
        "dept_revenue_rank": ranking.Rank("total_revenue", within="department"),
        "no_show_quartile": ranking.Tile("no_show_rate_pct", 4),
    }
    df = ranking.several(df, "doctor_id", ranks)
    return df.orderBy(F.desc_nulls_first("total_revenue"), "doctor_id").drop("doctor_id")


def q05_rolling_3m(monthly_revenue: DataFrame) -> DataFrame:
    """Mean over the current and the two preceding rows of the department; months may be missing."""
    last3 = Window.partitionBy("department").orderBy("month").rowsBetween(-2, 0)
    total = F.col("total_revenue")
    return monthly_revenue.select(
        "month",
        "department",
        "total_revenue",
        money_mean(F.sum(total).over(last3), F.count(total).over(last3)).alias("rolling_3m_revenue"),
    ).orderBy("department", "month")


def q06_retention_cohort(patients: DataFrame, appointments: DataFrame) -> DataFrame:
    """Active patients by registration quarter and activity quarter. A patient is reduced to one row
    per active quarter before the join."""
    active = (
        appointments.where(is_status(COMPLETED))
        .select("patient_id", quarter_of("appointment_date").alias("activity_quarter"))
        .distinct()
    )
    cohorts = patients.select("patient_id", quarter_of("registration_date").alias("cohort_quarter"))
    return (
        active.join(cohorts, "patient_id")
        .where("activity_quarter >= cohort_quarter")
        .groupBy("cohort_quarter", "activity_quarter")
        .agg(F.count("patient_id").alias("active_patients"))
        .select(
            "cohort_quarter",
            "activity_quarter",
            quarter_number("activity_quarter", "cohort_quarter").alias("quarters_since_reg"),
            "active_patients",
        )
        .orderBy("cohort_quarter", "quarters_since_reg")
    )


def q07_wait_trend(visits: DataFrame) -> DataFrame:
    """Daily mean wait and the mean of the last 30 daily means (rows, not calendar days). Daily means
    enter with 16 digits, so that their mean does not depend on the order of summation."""
    daily = (
        visits.where(is_status(COMPLETED))
        .groupBy("appointment_date")
        .agg(F.sum("waiting_time_minutes").alias("wait"), F.count("waiting_time_minutes").alias("wait_n"))
        .withColumn("mean", whole_mean(F.col("wait"), F.col("wait_n"), 16).cast("decimal(26,16)"))
    )
    last30 = Window.orderBy("appointment_date").rowsBetween(-29, 0)
    days = F.nullif(F.count("mean").over(last30), F.lit(0))
    return daily.select(
        "appointment_date",
        whole_mean(F.col("wait"), F.col("wait_n")).alias("daily_avg_wait"),
        F.round(F.sum("mean").over(last30) / days, 1).alias("rolling_30d_avg_wait"),
    ).orderBy("appointment_date")


def q08_bed_occupancy(resources: DataFrame) -> DataFrame:
    occupied = F.col("occupied_beds").cast("decimal(20,0)")
    return resources.select(
        "department",
        "occupied_beds",
        "total_beds",
        share_pct(F.col("occupied_beds"), F.col("total_beds")).alias("occupancy_rate_pct"),
        (F.col("equipment_utilization") * 100).alias("equipment_util_pct"),
        "staff_count",
        F.round(occupied / F.nullif(F.col("staff_count"), F.lit(0)), 2).alias("patients_per_staff"),
    ).orderBy(F.desc_nulls_first("occupancy_rate_pct"), "department")


def q09_top_diagnoses(treatments: DataFrame, k: int = 10) -> DataFrame:
    """The share is of all diagnosed cases, counted by a subquery that reads one column."""
    diagnosed = treatments.where("diagnosis IS NOT NULL")
    every = diagnosed.agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        diagnosed.groupBy("diagnosis")
        .agg(
            F.count(F.lit(1)).alias("total_cases"),
            F.count("treatment_cost").alias("priced"),
            F.sum("treatment_cost").cast(MONEY_SUM).alias("total_revenue"),
        )
        .select(
            "diagnosis",
            "total_cases",
            money_mean(F.col("total_revenue"), F.col("priced")).alias("avg_treatment_cost"),
            "total_revenue",
            share_pct(F.col("total_cases"), every).alias("pct_of_total"),
        )
        .orderBy(F.desc("total_cases"), "diagnosis")
        .limit(k)
    )


def q10_noshow_loss(visits: DataFrame) -> DataFrame:
    """Missed appointments times the rounded mean cost over all statuses."""
    monthly = visits.groupBy(month_of("appointment_date").alias("month")).agg(
        F.count_if(is_status(NO_SHOW)).alias("no_show_count"),
        money_mean(F.sum("appointment_cost"), F.count("appointment_cost")).alias("avg_appointment_cost"),
    )
    lost = F.col("no_show_count") * F.col("avg_appointment_cost").cast("decimal(14,2)")
    return monthly.withColumn("estimated_revenue_lost", F.round(lost, 2)).orderBy("month")


def q11_multi_diagnosis(treatments: DataFrame, at_least: int = 3, k: int = 20) -> DataFrame:
    """Patients with several distinct diagnoses. Rows are reduced to one per patient and diagnosis
    before they are counted, and the text lists are built for the k patients of the report only."""
    diagnosed = treatments.where("diagnosis IS NOT NULL")
    top = (
        diagnosed.groupBy("patient_id", "diagnosis")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("treatment_cost").alias("cost"))
        .groupBy("patient_id")
        .agg(
            F.count(F.lit(1)).alias("distinct_diagnoses"),
            F.sum("n").alias("total_treatments"),
            F.sum("cost").cast(MONEY_SUM).alias("total_spend"),
        )
        .where(F.col("distinct_diagnoses") >= at_least)
        .orderBy(F.desc("distinct_diagnoses"), F.desc_nulls_first("total_spend"), "patient_id")
        .limit(k)
    )
    # the report has k rows, so it can be broadcast to the second scan
    listed = (
        diagnosed.select(F.col("patient_id").alias("_patient"), "diagnosis")
        .join(F.broadcast(top), F.col("_patient").eqNullSafe(F.col("patient_id")))
        .groupBy(*top.columns)
        .agg(F.array_join(F.array_sort(F.collect_set("diagnosis")), ", ").alias("diagnoses_list"))
    )
    return listed.orderBy(F.desc("distinct_diagnoses"), F.desc_nulls_first("total_spend"), "patient_id")


def q12_dept_qoq(visits: DataFrame, doctors: DataFrame) -> DataFrame:
    by_doctor = visits.groupBy("doctor_id", quarter_of("appointment_date").alias("quarter")).agg(
        F.sum(completed_cost()).alias("revenue")
    )
    quarterly = (
        by_doctor.join(doctors.select("doctor_id", "department"), "doctor_id")
        .groupBy("quarter", "department")
        .agg(F.sum("revenue").cast(MONEY_SUM).alias("revenue"))
    )
    previous = F.lag("revenue").over(Window.partitionBy("department").orderBy("quarter"))
    return (
        quarterly.withColumn("prev_quarter_revenue", previous)
        .withColumn("qoq_growth_pct", growth_pct(F.col("revenue"), F.col("prev_quarter_revenue")))
        .orderBy("department", "quarter")
    )


def q13_age_by_dept(appointments: DataFrame, patients: DataFrame, doctors: DataFrame) -> DataFrame:
    """Distinct patients by department and decade; 100 and above share the last bucket."""
    seen = (
        appointments.join(doctors.select("doctor_id", "department"), "doctor_id")
        .select("department", "patient_id")
        .distinct()
    )
    bucket = F.width_bucket(F.col("age").cast("double"), F.lit(0.0), F.lit(100.0), F.lit(10))
    return (
        seen.join(patients.select("patient_id", "age").where("age IS NOT NULL"), "patient_id")
        .groupBy("department", bucket.alias("bucket"))
        .agg(F.count("patient_id").alias("patient_count"))
        .select(
            "department",
            (F.col("bucket") * 10 - 10).alias("age_bucket_start"),
            (F.col("bucket") * 10).alias("age_bucket_end"),
            "patient_count",
        )
        .orderBy("department", "age_bucket_start")
    )


def q14_daily_bookings(visits: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    daily = (
        visits.where(F.col("appointment_date") >= F.lit(as_of - dt.timedelta(days=days)))
        .groupBy("appointment_date")
        .agg(F.count(F.lit(1)).alias("appointments_booked"))
    )
    last7 = Window.orderBy("appointment_date").rowsBetween(-6, 0)
    return daily.withColumn("rolling_7d_bookings", F.sum("appointments_booked").over(last7)).orderBy(
        "appointment_date"
    )


def q15_new_vs_return(appointments: DataFrame) -> DataFrame:
    """All completed visits on a patient's first date count as new. The first date is looked up among
    one row per patient and day."""
    daily = (
        appointments.where(is_status(COMPLETED) & F.col("patient_id").isNotNull())
        .groupBy("patient_id", "appointment_date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("appointment_cost").alias("cost"),
            F.count("appointment_cost").alias("priced"),
        )
    )
    first = F.min("appointment_date").over(Window.partitionBy("patient_id"))
    kind = F.when(F.col("appointment_date") == first, "New Patient").otherwise("Return Patient")
    return (
        daily.withColumn("patient_type", kind)
        .groupBy("patient_type")
        .agg(
            F.sum("n").alias("appointments"),
            F.sum("cost").cast(MONEY_SUM).alias("total_revenue"),
            F.sum("priced").alias("priced"),
        )
        .select(
            "patient_type",
            "appointments",
            "total_revenue",
            money_mean(F.col("total_revenue"), F.col("priced")).alias("avg_revenue_per_visit"),
        )
    )


def q16_weekday_density(visits: DataFrame) -> DataFrame:
    return (
        visits.where(is_status(COMPLETED))
        .groupBy(weekday_num("appointment_date").alias("weekday_num"))
        .agg(
            F.count(F.lit(1)).alias("total_appointments"),
            whole_mean(F.sum("waiting_time_minutes"), F.count("waiting_time_minutes")).alias("avg_wait_minutes"),
            money_mean(F.sum("appointment_cost"), F.count("appointment_cost")).alias("avg_cost"),
        )
        .withColumn("weekday", weekday_name("weekday_num"))
        .orderBy("weekday_num")
    )


def q17_treatment_type(treatments: DataFrame) -> DataFrame:
    grouped = treatments.groupBy("treatment_type").agg(
        F.count(F.lit(1)).alias("total_treatments"),
        money_mean(F.sum("treatment_cost"), F.count("treatment_cost")).alias("avg_cost"),
        F.min("treatment_cost").alias("min_cost"),
        F.max("treatment_cost").alias("max_cost"),
        F.sum("treatment_cost").cast(MONEY_SUM).alias("total_revenue"),
    )
    median = percentile_cont(treatments, "treatment_type", "treatment_cost", 0.5, "median_cost")
    by_revenue = Window.orderBy(F.desc_nulls_first("total_revenue"))
    return (
        grouped.join(median, "treatment_type", "left")
        .withColumn("median_cost", F.round(F.col("median_cost").cast("decimal(16,4)"), 2))
        .withColumn("revenue_rank", F.rank().over(by_revenue))
        .orderBy(F.desc_nulls_first("total_revenue"), "treatment_type")
    )


def q18_repeat_noshow(appointments: DataFrame, at_least: int = 3, k: int = 50) -> DataFrame:
    missed = is_status(NO_SHOW)
    return (
        appointments.groupBy("patient_id")
        .agg(
            F.count_if(missed).alias("no_show_count"),
            F.count(F.lit(1)).alias("total_appointments"),
            F.max(F.when(missed, F.col("appointment_date"))).alias("last_no_show_date"),
        )
        .where(F.col("no_show_count") >= at_least)
        .withColumn("personal_no_show_rate", share_pct(F.col("no_show_count"), F.col("total_appointments")))
        .orderBy(F.desc("no_show_count"), "patient_id")
        .limit(k)
    )


def q19_bottleneck(resources: DataFrame, department_performance: DataFrame) -> DataFrame:
    """``monthly_appointments`` is the all-time number, as named at the source."""
    load = F.try_divide(F.col("occupied_beds").cast("decimal(20,0)"), F.col("total_beds"))
    staffed = F.col("monthly_appointments").cast("decimal(20,0)") / F.nullif(F.col("staff_count"), F.lit(0))
    performance = department_performance.select("department", "total_appointments")
    return (
        resources.join(performance, "department", "left")
        .withColumn("monthly_appointments", F.coalesce("total_appointments", F.lit(0)))
        .select(
            "department",
            "occupied_beds",
            "total_beds",
            share_pct(F.col("occupied_beds"), F.col("total_beds")).alias("occupancy_pct"),
            "staff_count",
            "monthly_appointments",
            F.round(staffed, 2).alias("appointments_per_staff"),
            F.when(load > 0.90, "🔴 CRITICAL").when(load > 0.75, "🟡 HIGH").otherwise("🟢 OK").alias(
                "capacity_status"
            ),
        )
        .orderBy(F.desc_nulls_first("occupancy_pct"), "department")
    )


def overall_kpis(appointments: DataFrame) -> DataFrame:
    """One row over all appointments."""
    return appointments.agg(*visit_sums(), F.count_distinct("patient_id").alias("total_patients")).select(
        "total_patients",
        F.col("n").alias("total_appointments"),
        F.col("no_shows").alias("total_no_shows"),
        share_pct(F.col("no_shows"), F.col("n")).alias("no_show_rate_pct"),
        F.col("revenue").cast(MONEY_SUM).alias("total_revenue"),
        whole_mean(F.col("wait"), F.col("wait_n")).alias("avg_wait_minutes"),
    )


def side_by_side(frames: list[DataFrame]) -> DataFrame:
    """One-row frames with different columns as one row."""
    stacked = frames[0]
    for df in frames[1:]:
        stacked = stacked.unionByName(df, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def q20_exec_summary(appointments: DataFrame, treatments: DataFrame, resources: DataFrame) -> DataFrame:
    kpis = overall_kpis(appointments)
    care = treatments.agg(
        F.count(F.lit(1)).alias("total_treatments"),
        F.sum("treatment_cost").cast(MONEY_SUM).alias("treatment_revenue"),
    )
    occupancy = F.col("occupied_beds").cast("decimal(20,0)") / F.nullif(F.col("total_beds"), F.lit(0))
    capacity = resources.agg(
        F.round(F.avg(occupancy) * 100, 2).alias("avg_occupancy_pct"),
        F.round(F.avg("equipment_utilization") * 100, 2).alias("avg_equipment_util_pct"),
    )
    return side_by_side([kpis, care, capacity]).select(
        "total_patients",
        "total_appointments",
        "total_no_shows",
        F.col("no_show_rate_pct").alias("overall_no_show_rate"),
        F.col("total_revenue").alias("total_apt_revenue"),
        "avg_wait_minutes",
        "total_treatments",
        (F.col("total_revenue") + F.col("treatment_revenue")).alias("grand_total_revenue"),
        "avg_occupancy_pct",
        "avg_equipment_util_pct",
    )


def q21_city_volume(patients: DataFrame, appointments: DataFrame) -> DataFrame:
    """The mean age counts a patient once per appointment (once without any). Appointments are summed
    by patient before the join, so that it carries one row per patient."""
    per_patient = appointments.groupBy("patient_id").agg(
        F.count("appointment_id").alias("n"), F.sum(completed_cost()).alias("revenue")
    )
    weight = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))
    return (
        patients.select("patient_id", "city", "age")
        .join(per_patient, "patient_id", "left")
        .groupBy("city")
        .agg(
            F.count("patient_id").alias("total_patients"),
            F.sum(F.coalesce("n", F.lit(0))).alias("total_appointments"),
            F.sum("revenue").cast(MONEY_SUM).alias("total_revenue"),
            F.round(
                F.sum(F.col("age").cast("decimal(12,2)") * weight).cast("decimal(24,2)")
                / F.nullif(F.sum(F.when(F.col("age").isNotNull(), weight)), F.lit(0)),
                1,
            ).alias("avg_patient_age"),
        )
        .orderBy(F.desc("total_patients"), "city")
    )

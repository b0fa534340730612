"""The batch pipeline: quality -> load -> refresh -> report -> model.

Each step is a function of its inputs and writes its outputs; a step that fails stops the ones that
depend on it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, types as T

from wardmill.jobs.store import TableStore
from wardmill.operators import cleaning, integrity, quality
from wardmill.plans import model, reports, views
from wardmill.session import durable
from wardmill.sources import files, schemas

TABLES = ["patients", "doctors", "appointments", "treatments", "resources"]
POSITION = "ingest_seq"


def export_raw(tables: dict[str, DataFrame], raw_dir: str) -> None:
    """Write raw tables as the CSV files the pipeline starts from."""
    for name, df in tables.items():
        files.write_csv(df, f"{raw_dir}/{name}")


def quality_job(
    spark: SparkSession, raw_dir: str, clean_dir: str, report_dir: str, as_of: dt.date, run_at: dt.datetime
) -> DataFrame:
    """Check the raw files, write report and summary, clean the tables. Returns the report.

    Raw ages are read as text, so that a value that is no number is told apart from a missing one. Of rows with
    one key the first of the file is kept.
    """
    def scan(name: str, schema: T.StructType) -> DataFrame:
        path = f"{raw_dir}/{name}"
        return files.scan_csv(spark, path, schema, files.date_forms(spark, path, schema), position=POSITION)

    patients = scan("patients", schemas.patients(age=T.StringType()))
    appointments = scan("appointments", schemas.appointments())
    treatments = scan("treatments", schemas.treatments())

    report = durable(quality.quality_report(*[t.drop(POSITION) for t in (patients, appointments, treatments)], as_of, run_at))
    files.write_csv(report, f"{report_dir}/quality_report")
    files.write_csv(quality.severity_summary(report), f"{report_dir}/quality_summary")

    clean = {
        "patients": cleaning.clean_patients(patients, [POSITION]),
        "appointments": cleaning.clean_appointments(appointments, [POSITION]),
        "treatments": cleaning.clean_treatments(treatments, as_of, [POSITION]),
    }
    for name, df in clean.items():
        files.write_csv(df.drop(POSITION), f"{clean_dir}/{name}")
    files.write_csv(files.scan_csv(spark, f"{raw_dir}/doctors", schemas.doctors()), f"{clean_dir}/doctors")
    forms = files.date_forms(spark, f"{raw_dir}/resources", schemas.resources())
    files.write_csv(files.scan_csv(spark, f"{raw_dir}/resources", schemas.resources(), forms), f"{clean_dir}/resources")
    return report


def load_job(spark: SparkSession, clean_dir: str, store: TableStore, run_at: dt.datetime) -> DataFrame:
    """Replace the stored tables by the clean files; facts of unknown patients are left out. Returns
    the row counts."""
    def scan(name: str, schema: T.StructType) -> DataFrame:
        return files.scan_csv(spark, f"{clean_dir}/{name}", schema)

    store.publish("doctors", files.for_load(scan("doctors", schemas.doctors()), run_at), run_at)
    resources = files.with_total_beds(files.for_load(scan("resources", schemas.resources()), run_at))
    store.publish("resources", resources, run_at)
    patients = files.for_load(scan("patients", schemas.patients(age=T.DoubleType())), run_at)
    patients = store.publish("patients", patients, run_at, cluster_by=["registration_date", "patient_id"])
    for name, schema, order in [
        ("appointments", schemas.appointments(), ["appointment_date", "appointment_id"]),
        ("treatments", schemas.treatments(), ["treatment_date", "treatment_id"]),
    ]:
        known = integrity.with_known(scan(name, schema), patients, "patient_id")
        store.publish(name, files.for_load(known, run_at), run_at, cluster_by=order)
    return files.row_counts({name: store.current(name) for name in TABLES})


def refresh_job(store: TableStore, run_at: dt.datetime) -> None:
    """Recompute the two stored views from the stored tables."""
    t = {name: store.current(name) for name in TABLES}
    store.publish(
        "mv_monthly_revenue", views.mv_monthly_revenue(t["appointments"], t["treatments"], t["doctors"]), run_at
    )
    store.publish("mv_doctor_performance", views.mv_doctor_performance(t["appointments"], t["doctors"]), run_at)


def report_job(store: TableStore, report_dir: str, as_of: dt.date, run_at: dt.datetime) -> None:
    """Write the report sheets as CSV."""
    appointments, doctors = store.current("appointments"), store.current("doctors")
    cards = reports.sheet_kpi_cards(reports.sheet_exec_kpis(appointments, as_of)).drop("position")
    sheets = {
        "executive_kpis": cards,
        "monthly_kpis": reports.sheet_monthly_kpis(views.v_monthly_kpis(appointments)),
        "department_performance": reports.sheet_department_kpis(views.v_department_performance(appointments, doctors)),
        "top_doctors": reports.sheet_top_doctors(store.current("mv_doctor_performance")),
        "resource_snapshot": reports.sheet_resource_snapshot(store.current("resources")),
    }
    for name, df in sheets.items():
        reports.write_sheet(df, f"{report_dir}/{name}", run_at)


def model_job(store: TableStore, report_dir: str, forest: dict | None = None, boosted: dict | None = None) -> DataFrame:
    """Train both classifiers on the stored tables, write their metrics and importances. Returns the
    metrics; ``model.best_model`` picks the better one."""
    features = model.prepared(
        views.v_no_show_risk_features(
            store.current("appointments"), store.current("patients"), store.current("doctors")
        )
    )
    metrics = None
    for kind, params in [("Random Forest", forest or {}), ("Gradient-boosted trees", boosted or {})]:
        fitted, row = model.train_and_evaluate(features, kind, **params)
        name = kind.lower().replace(" ", "_").replace("-", "_")
        files.write_csv(model.importances(fitted, store.spark), f"{report_dir}/importances_{name}")
        metrics = row if metrics is None else metrics.unionByName(row)
    files.write_csv(metrics, f"{report_dir}/ml_metrics")
    return store.spark.read.schema(metrics.schema).csv(f"{report_dir}/ml_metrics", header=True)


def run_pipeline(
    spark: SparkSession,
    raw_dir: str,
    work_dir: str,
    as_of: dt.date,
    run_at: dt.datetime,
    forest: dict | None = None,
    boosted: dict | None = None,
) -> dict[str, DataFrame]:
    """All steps in order. An exception ends the run, so nothing is built on stale inputs."""
    clean_dir, report_dir = f"{work_dir}/clean", f"{work_dir}/reports"
    store = TableStore(spark, f"{work_dir}/tables")
    out = {"quality": quality_job(spark, raw_dir, clean_dir, report_dir, as_of, run_at)}
    out["row_counts"] = load_job(spark, clean_dir, store, run_at)
    refresh_job(store, run_at)
    report_job(store, report_dir, as_of, run_at)
    out["ml_metrics"] = model_job(store, report_dir, forest, boosted)
    return out

"""Jobs, read back from what they wrote."""

import datetime as dt

import pytest

from helpers import rows

from wardmill.jobs import pipeline
from wardmill.jobs.store import TableStore
from wardmill.operators import cleaning
from wardmill.plans import views
from wardmill.sources import files, schemas
from wardmill.sources.starmap import AS_OF

RUN_AT = dt.datetime(2001, 11, 5, 2, 0)


@pytest.fixture(scope="module")
def run(spark, clinic, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    raw, work = str(root / "raw"), str(root / "work")
    pipeline.export_raw(
        {
            "patients": clinic.raw_patients,
            "doctors": clinic.doctors,
            "appointments": clinic.raw_appointments,
            "treatments": clinic.raw_treatments,
            "resources": clinic.resources.drop("total_beds"),
        },
        raw,
    )
    out = pipeline.run_pipeline(
        spark, raw, work, AS_OF, RUN_AT, forest={"numTrees": 5, "maxDepth": 3}, boosted={"maxIter": 3, "maxDepth": 2}
    )
    return out, raw, work


def test_report_counts_follow_the_defect_rules(run, clinic):
    """The expected numbers come from the injection rules alone."""
    found = {(r.table_name, r.check_name, r.column_name): r.issues_found for r in run[0]["quality"].collect()}
    ids = [r[0] for r in clinic.patients.select("patient_id").collect()]
    copies = [i for i in ids if i % 200 == 4]
    every = ids + copies
    assert found["patients", "Duplicate primary key", "patient_id"] == len(copies)
    assert found["patients", "Null value", "age"] == sum(i % 97 == 0 and i % 331 != 1 for i in every)
    assert found["patients", "Out-of-range value", "age"] == sum(i % 331 == 1 for i in every)
    assert found["patients", "Null value", "gender"] == sum(i % 199 == 2 and i % 499 != 3 for i in every)
    assert found["patients", "Invalid category", "gender"] == sum(i % 499 == 3 for i in every)
    visits = [(r[0], r[1]) for r in clinic.raw_appointments.select("appointment_id", "appointment_status").collect()]
    assert found["appointments", "Duplicate primary key", "appointment_id"] == len(visits) - len({i for i, _ in visits})
    assert found["appointments", "Null foreign key", "patient_id"] == sum(i % 200 == 5 for i, _ in visits)
    assert found["appointments", "Negative value", "appointment_cost"] == sum(i % 333 == 6 for i, _ in visits)
    assert found["appointments", "Invalid category", "appointment_status"] == sum(i % 250 == 7 for i, _ in visits)
    care = [r[0] for r in clinic.treatments.select("treatment_id").collect()]
    care += [i for i in care if i % 300 == 13]
    assert found["treatments", "Future date", "treatment_date"] == sum(i % 125 == 9 for i in care)
    assert found["treatments", "Negative value", "treatment_cost"] == sum(i % 250 == 11 for i in care)
    assert found["treatments", "Null value", "diagnosis"] == sum(i % 167 == 0 for i in care)
    assert len(found) == 17


def test_report_is_written(run, spark):
    report = spark.read.csv(f"{run[2]}/reports/quality_report", header=True)
    assert report.count() == 17 and "checked_at" in report.columns
    assert spark.read.csv(f"{run[2]}/reports/quality_summary", header=True).count() == 6


def test_loaded_tables(run, spark, clinic):
    counts = {r.table_name: r.row_count for r in run[0]["row_counts"].collect()}
    patients = cleaning.clean_patients(clinic.raw_patients)
    visits = cleaning.clean_appointments(clinic.raw_appointments)
    care = cleaning.clean_treatments(clinic.raw_treatments, AS_OF)
    assert counts == {
        "patients": patients.count(),
        "doctors": clinic.doctors.count(),
        "appointments": visits.join(patients, "patient_id", "left_semi").count(),
        "treatments": care.join(patients, "patient_id", "left_semi").count(),
        "resources": 25,
    }
    store = TableStore(spark, f"{run[2]}/tables")
    assert "created_at" in store.current("patients").columns
    assert store.current("resources").where("total_beds <> available_beds + occupied_beds").count() == 0


def test_stored_views_are_unique_and_current(run, spark):
    store = TableStore(spark, f"{run[2]}/tables")
    t = {n: store.current(n) for n in pipeline.TABLES}
    for name, keys, fresh in [
        ("mv_monthly_revenue", ["month", "department"], views.mv_monthly_revenue(t["appointments"], t["treatments"], t["doctors"])),
        ("mv_doctor_performance", ["doctor_id"], views.mv_doctor_performance(t["appointments"], t["doctors"])),
    ]:
        stored = store.current(name)
        assert stored.select(keys).distinct().count() == stored.count()
        assert rows(stored) == rows(fresh)
        assert spark.table(name).count() == stored.count()


def test_sheets_and_metrics(run, spark):
    sheet = [r.value for r in spark.read.text(f"{run[2]}/reports/top_doctors").collect()]
    assert sheet[0].startswith("🔄 Last updated: 2001-11-05 02:00 UTC") and len(sheet) == 3 + 10
    assert {r.model for r in run[0]["ml_metrics"].collect()} == {"Random Forest", "Gradient-boosted trees"}


def test_a_failed_step_stops_the_run(spark, run, tmp_path):
    with pytest.raises(Exception):
        pipeline.run_pipeline(spark, str(tmp_path / "nothing"), str(tmp_path / "work"), AS_OF, RUN_AT)
    assert not (tmp_path / "work" / "tables").exists()


def test_refresh_replaces_and_keeps_the_old_version_for_readers(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    first = store.publish("t", spark.range(3), RUN_AT)
    second = store.publish("t", spark.range(5), RUN_AT)
    assert (first.count(), second.count(), store.current("t").count(), spark.table("t").count()) == (3, 5, 5, 5)

    def fail():
        raise RuntimeError("half way")

    broken = spark.range(10).selectExpr("raise_error('half way') AS x")
    with pytest.raises(Exception):
        store.publish("t", broken, RUN_AT)
    assert store.current("t").count() == 5
    with pytest.raises(LookupError):
        store.current("unknown")


def test_csv_round_trip(clinic, spark, tmp_path):
    from pyspark.sql import types as T

    path = files.write_csv(clinic.raw_appointments, str(tmp_path / "a"))
    assert rows(files.scan_csv(spark, path, schemas.appointments(T.LongType()))) == rows(clinic.raw_appointments)


def test_table_is_overwritten(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(5), path)
    files.write_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2

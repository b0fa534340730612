"""All registered queries over the star schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wardmill.jobs import pipeline
from wardmill.jobs.store import TableStore
from wardmill.operators import cleaning, constraints, fuzzy, integrity, quality, trees
from wardmill.plans import business, measures, model, reports, views, visuals
from wardmill.session import durable, scratch_path
from wardmill.sources import files, schemas
from wardmill.sources.starmap import AS_OF, VISIT_ORDER, StarClinic


def published(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles, so that results compare by value with other engines."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _monthly_revenue(c: StarClinic) -> DataFrame:
    return views.mv_monthly_revenue(c.appointments, c.treatments, c.doctors)


def _department_totals(c: StarClinic) -> DataFrame:
    return views.department_totals(c.visits, c.doctors)


def _department_performance(c: StarClinic) -> DataFrame:
    return views.v_department_performance(c.appointments, c.doctors)


def _doctor_totals(c: StarClinic) -> DataFrame:
    return views.doctor_totals(c.visits, c.doctors)


def _exec_kpis(c: StarClinic) -> DataFrame:
    return reports.sheet_exec_kpis(c.appointments, AS_OF)


def _clean_appointments(c: StarClinic) -> DataFrame:
    return cleaning.clean_appointments(c.raw_appointments, VISIT_ORDER)


def _clean_treatments(c: StarClinic) -> DataFrame:
    return cleaning.clean_treatments(c.raw_treatments, AS_OF)


def _clean_patients(c: StarClinic) -> DataFrame:
    return cleaning.clean_patients(c.raw_patients)


def _known_patients(c: StarClinic) -> DataFrame:
    """The cleaned dimension is stored before the facts are checked against it. Read back, both sides of
    the check are shuffled afresh, which is what lets Spark split a patient who holds many rows."""
    return durable(_clean_patients(c).select("patient_id"))


def _quality(c: StarClinic) -> DataFrame:
    return quality.quality_report(c.raw_patients, c.raw_appointments, c.raw_treatments, AS_OF)


def _scan(table: str) -> Callable[[StarClinic], DataFrame]:
    """The raw table written as CSV and scanned again under its schema."""

    def run(c: StarClinic) -> DataFrame:
        schema = schemas.resources() if table == "resources" else getattr(schemas, table)(T.LongType())
        df = _tables(c, raw=True)[table].select(*schema.fieldNames())
        return files.scan_csv(c.spark, files.write_csv(df, scratch_path(c.spark, f"{table}_csv")), schema)

    return run


def _patients_by_vote(c: StarClinic, result: str) -> DataFrame:
    """The raw patients with dates written day first and every 7th age as a word: scanned, or what the scan rejects."""
    schema = schemas.patients(T.LongType())
    age = F.when(F.col("patient_id") % 7 == 0, "unknown").otherwise(F.col("age").cast("string"))
    text = c.raw_patients.withColumn("registration_date", F.date_format("registration_date", "dd/MM/yyyy")).withColumn("age", age)
    path = files.write_csv(text.select(*schema.fieldNames()), scratch_path(c.spark, "patients_by_day"))
    forms = files.date_forms(c.spark, path, schema)
    return files.scan_csv(c.spark, path, schema, forms) if result == "rows" else files.rejects(c.spark, path, schema, forms)


#: Times of the registered jobs; results leave them out.
RUN_AT = dt.datetime(2001, 11, 5, 2, 0)
FILE_ORDER = {"patients": ["patient_id"], "appointments": ["appointment_id", *VISIT_ORDER], "treatments": ["treatment_id"]}


def _jobs(c: StarClinic, last: str) -> DataFrame:
    """The daily jobs over the raw tables as CSV files, as far as ``last``: the quality report, the row counts of the
    loaded tables, or a refreshed view. Raw files are in order of their keys, as the first row of a key is kept."""
    work = scratch_path(c.spark, "jobs")
    tables = _tables(c, raw=True)
    for name, df in tables.items():
        df = df.drop("total_beds")
        pipeline.export_raw({name: df.orderBy(*FILE_ORDER[name]) if name in FILE_ORDER else df}, f"{work}/raw")
    report = pipeline.quality_job(c.spark, f"{work}/raw", f"{work}/clean", f"{work}/reports", AS_OF, RUN_AT)
    if last == "quality":
        return report.drop("checked_at")
    store = TableStore(c.spark, f"{work}/tables")
    counts = pipeline.load_job(c.spark, f"{work}/clean", store, RUN_AT)
    if last == "load":
        return counts
    pipeline.refresh_job(store, RUN_AT)
    return store.current(last)


def _reloaded(c: StarClinic) -> DataFrame:
    """A stored table replaced by its rows with a load timestamp: the second write leaves nothing of the first."""
    path = scratch_path(c.spark, "reloaded")
    files.write_table(c.treatments.withColumn("created_at", F.lit(None).cast("timestamp")), path)
    files.write_table(files.for_load(c.raw_treatments, RUN_AT), path)
    return c.spark.read.parquet(path).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


def _report_rows(sheet: Callable[[StarClinic], DataFrame]) -> Callable[[StarClinic], DataFrame]:
    """A report sheet as text, with the number of each line."""
    return lambda c: reports.numbered_rows(reports.report_rows(sheet(c)))


def _risk_features(c: StarClinic) -> DataFrame:
    return views.v_no_show_risk_features(c.appointments, c.patients, c.doctors)


def _usable(c: StarClinic) -> DataFrame:
    return durable(model.usable(_risk_features(c)))


def _parts(c: StarClinic) -> tuple[DataFrame, DataFrame]:
    """Training and test part of the model features, stored."""
    train, test = model.split(durable(model.prepared(_risk_features(c))))
    return durable(train), test


#: Ensembles for node tables and importances, which a second engine fits again in SQL; the rows are all rows of the
#: training part. The boosted trees that score are all 200 rounds in full depth.
SMALL_BOOSTED = dict(rounds=3, depth=3, rate=0.3, bins=32)
SMALL_FOREST = dict(count=3, depth=3, bins=32)


def _fitted(kind: str, result: str) -> Callable[[StarClinic], DataFrame]:
    def run(c: StarClinic) -> DataFrame:
        train, test = _parts(c)
        if kind == "forest":
            fitted = model.bagged_forest(train, **SMALL_FOREST)
        else:
            fitted = model.newton_boosted(train, **({} if result == "scores" else SMALL_BOOSTED))
        if result == "nodes":
            nodes = trees.node_table(fitted, c.spark)
            return nodes.withColumns({x: F.round(x, 9) for x in ("value", "gain")})
        if result == "importances":
            return trees.importances(fitted, c.spark).withColumn("importance", F.round("importance", 9))
        return model.scored(fitted, test).withColumn("score", F.round("score", 9))

    return run


def _scored(c: StarClinic) -> DataFrame:
    """A deterministic score in place of a model: the earlier no-show rate."""
    _, test = model.split(model.with_rate(_usable(c)))
    rate = F.col("prior_no_show_rate")
    return test.select(
        F.col(model.LABEL).alias("label"), (rate >= 0.5).cast("int").alias("prediction"), rate.alias("score")
    )


def _train(kind: str) -> Callable[[StarClinic], DataFrame]:
    def run(c: StarClinic) -> DataFrame:
        return model.train_and_evaluate(model.prepared(_risk_features(c)), kind)[1]

    return run


def _tables(c: StarClinic, raw: bool) -> dict[str, DataFrame]:
    return {
        "patients": c.raw_patients if raw else c.patients,
        "doctors": c.doctors,
        "appointments": c.raw_appointments if raw else c.appointments,
        "treatments": c.raw_treatments if raw else c.treatments,
        "resources": c.resources,
    }


BUILDERS: dict[str, Callable[[StarClinic], DataFrame]] = {
    # sources, sinks, loading
    "scan_csv": _scan("patients"),
    "scan_csv_doctors": _scan("doctors"),
    "scan_csv_appointments": _scan("appointments"),
    "scan_csv_treatments": _scan("treatments"),
    "scan_csv_resources": _scan("resources"),
    "scan_csv_dates": lambda c: _patients_by_vote(c, "rows"),
    "scan_csv_rejects": lambda c: _patients_by_vote(c, "rejects"),
    "reload_table": _reloaded,
    "job_quality": lambda c: _jobs(c, "quality"),
    "job_load": lambda c: _jobs(c, "load"),
    "job_refresh": lambda c: _jobs(c, "mv_doctor_performance"),
    "load_dedup": lambda c: files.for_load(c.raw_treatments),
    "row_counts": lambda c: files.row_counts(_tables(c, raw=False) | {"appointments": c.visits}),
    "inject_defects": lambda c: c.raw_patients,
    "inject_defects_appointments": lambda c: c.raw_appointments,
    "inject_defects_treatments": lambda c: c.raw_treatments,
    # integrity
    "ri_appointments": lambda c: integrity.with_known(_clean_appointments(c), _known_patients(c), "patient_id"),
    "ri_treatments": lambda c: integrity.with_known(_clean_treatments(c), _known_patients(c), "patient_id"),
    "ri_orphans": lambda c: integrity.orphan_report(
        _known_patients(c), c.doctors, _clean_appointments(c), _clean_treatments(c)
    ),
    # quality and cleaning
    "dq_patients": lambda c: quality.check_patients(c.raw_patients, AS_OF),
    "dq_appointments": lambda c: quality.check_appointments(c.raw_appointments),
    "dq_treatments": lambda c: quality.check_treatments(c.raw_treatments, AS_OF),
    "dq_summary": lambda c: quality.severity_summary(_quality(c)),
    "dq_high_total": lambda c: quality.high_total(_quality(c)),
    "constraint_report": lambda c: constraints.constraint_report(
        _tables(c, raw=True) | {"quality_report": durable(_quality(c))}, AS_OF
    ),
    "clean_patients": _clean_patients,
    "clean_appointments": _clean_appointments,
    "clean_treatments": _clean_treatments,
    "clean_audit": lambda c: cleaning.clean_audit(
        c.raw_patients, c.raw_appointments, c.raw_treatments, AS_OF, {"appointments": VISIT_ORDER}
    ),
    # views
    "v_appointment_detail": lambda c: views.v_appointment_detail(c.appointments, c.patients, c.doctors),
    "v_monthly_kpis": lambda c: views.v_monthly_kpis(c.visits),
    "v_department_performance": _department_performance,
    "v_no_show_risk_features": _risk_features,
    "mv_monthly_revenue": _monthly_revenue,
    "mv_monthly_revenue_dedup": lambda c: views.mv_monthly_revenue_dedup(c.visits, c.doctors),
    "mv_doctor_performance": lambda c: views.mv_doctor_performance(c.appointments, c.doctors),
    # business queries
    "q01_top_departments": lambda c: business.q01_top_departments(_department_totals(c)),
    "q02_patient_growth": lambda c: business.q02_patient_growth(c.patients),
    "q03_noshow_dept_weekday": lambda c: business.q03_noshow_dept_weekday(c.visits, c.doctors),
    "q04_doctor_ranking": lambda c: business.q04_doctor_ranking(_doctor_totals(c)),
    "q05_rolling_3m": lambda c: business.q05_rolling_3m(_monthly_revenue(c)),
    "q06_retention_cohort": lambda c: business.q06_retention_cohort(c.patients, c.appointments),
    "q07_wait_trend": lambda c: business.q07_wait_trend(c.visits),
    "q08_bed_occupancy": lambda c: business.q08_bed_occupancy(c.resources),
    "q09_top_diagnoses": lambda c: business.q09_top_diagnoses(c.treatments),
    "q10_noshow_loss": lambda c: business.q10_noshow_loss(c.visits),
    "q11_multi_diagnosis": lambda c: business.q11_multi_diagnosis(c.treatments),
    "q12_dept_qoq": lambda c: business.q12_dept_qoq(c.visits, c.doctors),
    "q13_age_by_dept": lambda c: business.q13_age_by_dept(c.appointments, c.patients, c.doctors),
    "q14_daily_bookings": lambda c: business.q14_daily_bookings(c.visits, AS_OF),
    "q15_new_vs_return": lambda c: business.q15_new_vs_return(c.appointments),
    "q16_weekday_density": lambda c: business.q16_weekday_density(c.visits),
    "q17_treatment_type": lambda c: business.q17_treatment_type(c.treatments),
    "q18_repeat_noshow": lambda c: business.q18_repeat_noshow(c.appointments),
    "q19_bottleneck": lambda c: business.q19_bottleneck(c.resources, _department_totals(c)),
    "q20_exec_summary": lambda c: business.q20_exec_summary(c.appointments, c.treatments, c.resources),
    "q21_city_volume": lambda c: business.q21_city_volume(c.patients, c.appointments),
    # report extracts
    "sheet_exec_kpis": _exec_kpis,
    "sheet_monthly_kpis": lambda c: reports.sheet_monthly_kpis(views.v_monthly_kpis(c.visits)),
    "sheet_department_kpis": lambda c: reports.sheet_department_kpis(_department_performance(c)),
    "sheet_top_doctors": lambda c: reports.sheet_top_doctors(_doctor_totals(c)),
    "sheet_resource_snapshot": lambda c: reports.sheet_resource_snapshot(c.resources),
    "sheet_kpi_cards": lambda c: reports.sheet_kpi_cards(_exec_kpis(c)),
    "report_rows": lambda c: reports.report_rows(reports.sheet_monthly_kpis(views.v_monthly_kpis(c.visits))),
    "report_rows_exec": _report_rows(_exec_kpis),
    "report_rows_departments": _report_rows(lambda c: reports.sheet_department_kpis(_department_performance(c))),
    "report_rows_doctors": _report_rows(lambda c: reports.sheet_top_doctors(_doctor_totals(c))),
    "report_rows_resources": _report_rows(lambda c: reports.sheet_resource_snapshot(c.resources)),
    # dashboard measures
    "dax_core": lambda c: measures.dax_core(c.appointments),
    "dax_revenue_total": lambda c: measures.dax_revenue_total(c.visits, c.treatments),
    "dax_mtd": lambda c: measures.dax_mtd(c.visits),
    "dax_ytd": lambda c: measures.dax_ytd(c.visits),
    "dax_mom": lambda c: measures.dax_mom(c.visits),
    "dax_rolling_3m": lambda c: measures.dax_rolling_3m(c.visits),
    "dax_resources": lambda c: measures.dax_resources(c.resources),
    "dax_lost_revenue": lambda c: measures.dax_lost_revenue(c.visits),
    "dax_doctor_rank": lambda c: measures.dax_doctor_rank(_doctor_totals(c)),
    "dim_calendar": lambda c: measures.dim_calendar(
        [
            (c.patients, "registration_date"),
            (c.visits, "appointment_date"),
            (c.treatments, "treatment_date"),
            (c.resources, "snapshot_date"),
        ]
    ),
    # dashboard visuals
    "viz_status_breakdown": lambda c: visuals.viz_status_breakdown(c.visits),
    "viz_gender_distribution": lambda c: visuals.viz_gender_distribution(c.patients),
    "viz_age_histogram": lambda c: visuals.viz_age_histogram(c.appointments, c.patients),
    "viz_noshow_heatmap": lambda c: visuals.viz_noshow_heatmap(c.visits, c.doctors),
    "viz_bed_stack": lambda c: visuals.viz_bed_stack(c.resources),
    "viz_dept_revenue": lambda c: visuals.viz_dept_revenue(_department_totals(c)),
    "viz_revenue_drill": lambda c: visuals.viz_revenue_drill(_monthly_revenue(c)),
    "viz_diagnosis_breakdown": lambda c: visuals.viz_diagnosis_breakdown(c.treatments),
    "viz_revenue_vs_loss": lambda c: visuals.viz_revenue_vs_loss(c.visits),
    "viz_top_doctors": lambda c: visuals.viz_top_doctors(_doctor_totals(c)),
    "viz_page1_cards": lambda c: visuals.viz_page1_cards(_department_totals(c), c.appointments, c.patients),
    # model
    "ml_features": lambda c: model.prepared(_risk_features(c)),
    "ml_split": lambda c: model.split_counts(_usable(c)),
    "ml_class_weights": lambda c: model.class_weights(model.split(_usable(c))[0]),
    "ml_confusion": lambda c: model.confusion(_scored(c)),
    "ml_metrics": lambda c: model.evaluate(durable(_scored(c)), "prior_no_show_rate"),
    "ml_boosted_nodes": _fitted("boosted", "nodes"),
    "ml_boosted_scores": _fitted("boosted", "scores"),
    "ml_boosted_importances": _fitted("boosted", "importances"),
    "ml_forest_nodes": _fitted("forest", "nodes"),
    "ml_forest_scores": _fitted("forest", "scores"),
    "ml_forest_importances": _fitted("forest", "importances"),
    "ml_train_rf": _train("Random Forest"),
    "ml_train_gbt": _train("Gradient-boosted trees"),
    # search
    "fuzzy_doctor_name": lambda c: fuzzy.search(c.doctors, "doctor_name", "0042").select(
        "doctor_id", "doctor_name", "similarity"
    ),
    "fuzzy_name_pairs": lambda c: fuzzy.similar_pairs(c.doctors, c.patient_names, "doctor_name", "patient_name"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[StarClinic], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, root: published(build(StarClinic(spark, root)))

    return {name: bind(build) for name, build in BUILDERS.items()}

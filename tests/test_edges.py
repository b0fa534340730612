"""Hand-made tables with expected values worked out by hand."""

import datetime as dt

from pyspark.sql import types as T

from helpers import day, rows

from wardmill.operators import cleaning, constraints, integrity, quality
from wardmill.operators.dedupe import keep_first
from wardmill.plans import business, measures, reports, views, visuals
from wardmill.sources import files, schemas

AS_OF = day("2021-12-31")


def test_idle_doctor_has_zero_rate(make):
    doctors = make.doctors(("D1", "X"), ("D2", "X"))
    visits = make.appointments(("P1", "D1", "2021-01-01", "No-show", 10), ("P2", "D1", "2021-01-02", "Completed", 20))
    got = views.mv_doctor_performance(visits, doctors)
    assert rows(got, "doctor_id", "total_appointments", "no_show_rate_pct", "total_revenue", "unique_patients") == [
        ("D1", 2, 50.0, 20.0, 2),
        ("D2", 0, 0.0, None, 0),
    ]
    totals = views.doctor_totals(visits, doctors)
    assert rows(totals) == rows(got.select(totals.columns))


def test_idle_department_in_bottleneck(make):
    resources = make.resources(("X", 1, 9, 5), ("Y", 2, 8, 0), ("Z", 0, 0, 4))
    totals = views.department_totals(
        make.appointments(("P1", "D1", "2021-01-01", "Completed", 1), ("P1", "D1", "2021-01-02", "Completed", 1)),
        make.doctors(("D1", "X")),
    )
    got = business.q19_bottleneck(resources, totals)
    assert rows(got, "department", "occupancy_pct", "monthly_appointments", "appointments_per_staff", "capacity_status") == [
        ("X", 90.0, 2, 0.4, "🟡 HIGH"),
        ("Y", 80.0, 0, None, "🟡 HIGH"),
        ("Z", None, 0, 0.0, "🟢 OK"),
    ]


def test_zero_capacity(make):
    got = business.q08_bed_occupancy(make.resources(("X", 0, 0, 0), ("Y", 1, 2, 4)))
    assert rows(got, "department", "occupancy_rate_pct", "patients_per_staff") == [("X", None, None), ("Y", 66.67, 0.5)]


def test_department_without_completed_ranks_first(make):
    doctors = make.doctors(("D1", "X"), ("D2", "Y"))
    visits = make.appointments(("P1", "D1", "2021-01-01", "No-show", 10), ("P2", "D2", "2021-01-02", "Completed", 20))
    for performance in (views.department_totals(visits, doctors), views.v_department_performance(visits, doctors)):
        assert rows(business.q01_top_departments(performance)) == [("X", None, 1), ("Y", 20.0, 2)]


def test_fan_out(make):
    visits = make.appointments(
        ("P1", "D1", "2021-01-01", "Completed", 100),
        ("P1", "D2", "2021-01-20", "No-show", 50),
        ("P2", "D1", "2021-01-03", "Completed", 7),
        (None, "D1", "2021-01-03", "Completed", 1),
    )
    care = make.treatments(
        ("P1", "a", "Surgery", 10, "2021-01-05"),
        ("P1", "b", "Surgery", 20, "2021-01-06"),
        ("P1", "c", "Surgery", None, "2021-01-31"),
        ("P1", "c", "Surgery", 99, "2021-02-01"),
        (None, "c", "Surgery", 99, "2021-01-01"),
    )
    doctors = make.doctors(("D1", "X"), ("D2", "Y"))
    got = views.mv_monthly_revenue(visits, care, doctors)
    assert rows(got, "department", "total_appointments", "appointment_revenue", "treatment_revenue", "total_revenue") == [
        ("X", 5, 308.0, 30.0, 338.0),
        ("Y", 3, None, 30.0, 30.0),
    ]
    once = views.mv_monthly_revenue_dedup(visits, doctors)
    assert rows(once, "department", "total_appointments", "appointment_revenue") == [("X", 3, 108.0), ("Y", 1, None)]


def test_month_gap_rows_against_calendar(make):
    visits = make.appointments(
        ("P1", "D1", "2021-01-31", "Completed", 100),
        ("P1", "D1", "2021-02-10", "Completed", 200),
        ("P1", "D1", "2021-05-10", "Completed", 400),
        ("P1", "D1", "2021-05-31", "Cancelled", 1),
    )
    revenue = views.mv_monthly_revenue(visits, make.treatments(), make.doctors(("D1", "X")))
    rolling = rows(business.q05_rolling_3m(revenue), "month", "rolling_3m_revenue")
    assert [r for _, r in rolling] == [100.0, 150.0, 233.33]
    # the last appointment day of May is the 31st; three months back is 28 February, which is left out
    assert [r for _, _, r in rows(measures.dax_rolling_3m(visits))] == [100.0, 300.0, 400.0]
    assert [(r[1], r[3]) for r in rows(measures.dax_mom(visits))] == [(100.0, 0.0), (200.0, 100.0), (400.0, 0.0)]


def test_rolling_boundary_day_is_excluded(make):
    visits = make.appointments(
        ("P1", "D1", "2021-02-28", "Completed", 5),
        ("P1", "D1", "2021-03-01", "Completed", 7),
        ("P1", "D1", "2021-05-28", "Completed", 11),
    )
    assert [r[2] for r in rows(measures.dax_rolling_3m(visits))] == [5.0, 12.0, 18.0]


def test_same_day_rows_are_not_history(make):
    visits = make.appointments(
        ("P1", "D1", "2021-01-05", "Cancelled", 1),
        ("P1", "D1", "2021-01-07", "No-show", 1),
        ("P1", "D1", "2021-01-07", "Completed", 1),
        ("P1", "D1", "2021-01-09", "Completed", 1),
        ("P9", "D1", "2021-01-09", "Completed", 1),
        (None, "D1", "2021-01-09", "Completed", 1),
    )
    patients = make.patients({"id": "P1", "registered": "2021-01-06"})
    got = views.v_no_show_risk_features(visits, patients, make.doctors(("D1", "X")))
    columns = ["appointment_id", "days_since_registration", "prior_no_shows", "prior_total_appointments", "no_show"]
    assert rows(got, *columns) == [("A002", 1, 0, 1, 1), ("A003", 1, 0, 1, 0), ("A004", 3, 1, 3, 0)]


def test_first_day_twice_is_new(make):
    visits = make.appointments(
        ("P1", "D1", "2021-01-01", "No-show", 9),
        ("P1", "D1", "2021-01-05", "Completed", 10),
        ("P1", "D1", "2021-01-05", "Completed", None),
        ("P1", "D1", "2021-01-06", "Completed", 30),
        ("P2", "D1", "2021-01-06", "Completed", 5),
    )
    assert rows(business.q15_new_vs_return(visits)) == [("New Patient", 3, 15.0, 7.5), ("Return Patient", 1, 30.0, 30.0)]


def test_quarter_numbers(make):
    patients = make.patients({"id": "P1", "registered": "2020-02-10"})
    visits = make.appointments(
        ("P1", "D1", "2020-01-02", "Completed", 1),
        ("P1", "D1", "2020-04-01", "Completed", 1),
        ("P1", "D1", "2021-09-30", "Completed", 1),
        ("P1", "D1", "2021-09-01", "Completed", 1),
        ("P1", "D1", "2019-12-31", "Completed", 1),
    )
    got = rows(business.q06_retention_cohort(patients, visits), "activity_quarter", "quarters_since_reg", "active_patients")
    assert got == [(day("2020-01-01"), 1, 1), (day("2020-04-01"), 2, 1), (day("2021-07-01"), 7, 1)]


def test_age_buckets(make):
    ages = {"P1": 1, "P2": 9, "P3": 10, "P4": 99, "P5": 100, "P6": 120, "P7": None}
    patients = make.patients(*[{"id": k, "age": v} for k, v in ages.items()])
    visits = make.appointments(*[(k, "D1", "2021-01-01", "Completed", 1) for k in ages for _ in range(2)])
    got = business.q13_age_by_dept(visits, patients, make.doctors(("D1", "X")))
    assert rows(got, "age_bucket_start", "age_bucket_end", "patient_count") == [
        (0, 10, 2), (10, 20, 1), (100, 110, 2), (90, 100, 1),
    ]


def test_patient_checks_and_cleaning(make, spark):
    ages = [0, 1, 9, 10, 99, 100, 120, 121, -3, None]
    patients = make.patients(
        *[{"id": f"P{i:02d}", "age": a} for i, a in enumerate(ages)],
        {"id": "P00", "age": 0},
        {"id": None, "age": 50},
        {"id": "P20", "age": 50, "gender": None},
        {"id": "P21", "age": 50, "gender": "X", "registered": "2022-01-01"},
    )
    report = {(r.check_name, r.column_name): (r.issues_found, float(r.pct_affected)) for r in
              quality.check_patients(patients, AS_OF).collect()}
    assert report == {
        ("Null primary key", "patient_id"): (1, 7.143),
        ("Duplicate primary key", "patient_id"): (1, 7.143),
        ("Null value", "age"): (1, 7.143),
        ("Out-of-range value", "age"): (4, 28.571),
        ("Invalid category", "gender"): (1, 7.143),
        ("Null value", "gender"): (1, 7.143),
        ("Future date", "registration_date"): (1, 7.143),
    }
    # valid ages before the gender filter: 1 9 10 50 50 99 100 120 -> median 50
    clean = cleaning.clean_patients(patients)
    assert rows(clean, "patient_id", "age") == [
        ("P00", 50.0), ("P01", 1.0), ("P02", 9.0), ("P03", 10.0), ("P04", 99.0), ("P05", 100.0), ("P06", 120.0),
        ("P07", 50.0), ("P08", 50.0), ("P09", 50.0),
    ]
    assert rows(cleaning.clean_patients(clean)) == rows(clean)


def test_ages_as_text(spark):
    from pyspark.sql import types as T

    raw = spark.createDataFrame(
        [("P1", "30", "Male", "A", AS_OF), ("P2", "n/a", "Male", "A", AS_OF), ("P3", "40", "Female", "A", AS_OF)],
        schemas.patients(age=T.StringType()),
    )
    assert rows(cleaning.clean_patients(raw), "patient_id", "age") == [("P1", 30.0), ("P2", 35.0), ("P3", 40.0)]
    found = {r.check_name: r.issues_found for r in quality.check_patients(raw, AS_OF).where("column_name = 'age'").collect()}
    assert found == {"Null value": 0, "Out-of-range value": 0}


def test_several_defects_in_one_row(make):
    visits = make.appointments(
        (None, "D1", "2021-01-01", "BAD", -5, None, "A1"),
        ("P1", "D1", "2021-01-01", "Completed", None, None, "A2"),
        ("P1", "D1", "2021-01-01", "Completed", 5, -1, "A3"),
        ("P1", "D1", "2021-01-01", "Completed", 5, 5, "A4"),
        ("P1", "D1", "2021-01-01", "Completed", 5, 5, "A4"),
    )
    found = [(r.check_name, r.issues_found) for r in quality.check_appointments(visits).collect()]
    assert sorted(found) == [
        ("Duplicate primary key", 1), ("Invalid category", 1), ("Negative value", 1), ("Null foreign key", 1),
        ("Null value", 1), ("Null waiting time on completed record", 1),
    ]
    assert rows(cleaning.clean_appointments(visits), "appointment_id") == [("A2",), ("A4",)]


def test_treatment_cleaning(make):
    care = make.treatments(
        ("P1", None, "Surgery", 1, "2021-01-01"),
        ("P1", "x", "Surgery", -1, "2021-01-01"),
        ("P1", "x", "Surgery", 1, "2022-01-01"),
        ("P1", "x", "Surgery", None, "2021-12-31"),
    )
    clean = cleaning.clean_treatments(care, AS_OF)
    assert rows(clean, "treatment_id", "diagnosis") == [("T001", "Unspecified"), ("T004", "x")]
    # once filled, the missing diagnosis counts like any other
    assert rows(business.q09_top_diagnoses(clean), "diagnosis", "total_cases") == [("Unspecified", 1), ("x", 1)]
    assert rows(business.q09_top_diagnoses(care), "diagnosis", "total_cases") == [("x", 3)]


def test_keep_first_by_sequence(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "c"), (2, 5, "a"), (None, 1, "n"), (None, 2, "m")],
                               "k int, ingest_seq int, payload string")
    assert rows(keep_first(df, ["k"], ["ingest_seq"]), "k", "payload") == [(1, "c"), (2, "a"), (None, "n")]
    assert keep_first(df, ["k"]).columns == df.columns


def test_orphans(make):
    visits = make.appointments(
        ("P1", "D1", "2021-01-01", "Completed", 1), ("P9", "D1", "2021-01-01", "Completed", 1),
        ("P1", "D9", "2021-01-01", "Completed", 1), (None, "D1", "2021-01-01", "Completed", 1),
    )
    care = make.treatments(("P8", "x", "Surgery", 1, "2021-01-01"))
    patients, doctors = make.patients({"id": "P1"}), make.doctors(("D1", "X"))
    assert rows(integrity.with_known(visits, patients, "patient_id"), "appointment_id") == [("A001",), ("A003",)]
    assert rows(integrity.orphan_report(patients, doctors, visits, care)) == [
        ("appointments", "A002", "patient_id", "P9"),
        ("appointments", "A003", "doctor_id", "D9"),
        ("treatments", "T001", "patient_id", "P8"),
    ]


def test_constraints_let_null_pass(make):
    patients = make.patients({"id": "P1", "age": None}, {"id": "P1", "age": 0}, {"id": "PATIENT-IS-TOO-LONG"})
    broken = {(r.column_name, r.rule): r.violations for r in
              constraints.constraint_report({"patients": patients}, AS_OF).collect() if r.violations}
    assert broken == {("patient_id", "unique"): 1, ("patient_id", "length"): 1, ("age", "check"): 1}


def test_quality_report_keeps_its_own_rules(make):
    report = quality.check_patients(make.patients({"id": "P1"}), AS_OF)
    found = constraints.constraint_report({"quality_report": report}, AS_OF)
    assert found.where("violations > 0").count() == 0


def test_ties_at_the_limit(make):
    visits = make.appointments(*[(f"P{i}", "D1", f"2021-01-{d:02d}", "No-show", 1) for i in range(9, 0, -1) for d in (1, 2, 3)])
    got = business.q18_repeat_noshow(visits, k=2)
    assert rows(got, "patient_id", "no_show_count", "last_no_show_date") == [("P1", 3, day("2021-01-03")), ("P2", 3, day("2021-01-03"))]


def test_city_mean_age_is_weighted(make):
    patients = make.patients({"id": "P1", "age": 10}, {"id": "P2", "age": 40}, {"id": "P3", "age": None, "city": "B"})
    visits = make.appointments(*[("P1", "D1", "2021-01-01", "Completed", 1)] * 3)
    assert rows(business.q21_city_volume(patients, visits)) == [("A", 2, 3, 3.0, 17.5), ("B", 1, 0, None, None)]


def test_multi_diagnosis_list(make):
    care = make.treatments(*[("P1", d, "Surgery", 1, "2021-01-01") for d in ["c", "a", "b", "a", None]],
                           *[("P2", d, "Surgery", 1, "2021-01-01") for d in ["c", "a"]])
    assert rows(business.q11_multi_diagnosis(care)) == [("P1", 3, 4, 4.0, "a, b, c")]


def test_empty_tables(make):
    p, d, a, t = make.patients(), make.doctors(), make.appointments(), make.treatments()
    report = quality.quality_report(p, a, t, AS_OF).collect()
    assert len(report) == 17 and all(r.issues_found == 0 and r.pct_affected == 0 for r in report)
    assert cleaning.clean_patients(p).count() == 0
    assert rows(business.q20_exec_summary(a, t, make.resources()), "total_patients", "overall_no_show_rate") == [(0, None)]
    assert rows(measures.dax_core(a), "total_appointments", "no_show_rate_pct", "avg_waiting_time") == [(0, 0.0, None)]
    for df in [
        views.v_monthly_kpis(a), views.v_department_performance(a, d), views.mv_monthly_revenue(a, t, d),
        views.v_no_show_risk_features(a, p, d), business.q17_treatment_type(t), business.q21_city_volume(p, a),
        visuals.viz_noshow_heatmap(a, d),
    ]:
        assert df.count() == 0


def test_status_counts_add_up(clinic):
    by_status = sum(r.total for r in visuals.viz_status_breakdown(clinic.visits).collect())
    kpis = views.v_monthly_kpis(clinic.visits).agg({"total_appointments": "sum"}).first()[0]
    assert by_status == kpis == clinic.visits.count()


def test_cards_and_sheet(make, spark, tmp_path):
    visits = make.appointments(("P1", "D1", "2021-01-01", "Completed", 1234.5), ("P2", "D1", "2021-01-02", "No-show", 1))
    cards = reports.sheet_kpi_cards(reports.sheet_exec_kpis(visits, AS_OF))
    assert [(r.kpi, r.value) for r in cards.orderBy("position").collect()] == [
        ("Total Patients", "2"), ("Total Appointments", "2"), ("Total No-shows", "1"), ("No-show Rate", "50.0%"),
        ("Total Revenue (Appts)", "$1,234.50"), ("Avg Waiting Time", "10.0 min"), ("Report Date", "2021-12-31"),
    ]
    monthly = reports.sheet_monthly_kpis(views.v_monthly_kpis(visits)).select("month", "completed", "avg_revenue")
    layout = [tuple(r) for r in reports.sheet_layout(monthly, dt.datetime(2021, 12, 31, 2, 0)).collect()]
    assert layout == [
        (1, "🔄 Last updated: 2021-12-31 02:00 UTC", "", ""), (2, "", "", ""),
        (3, "month", "completed", "avg_revenue"), (4, "2021-01-01", "1", "1234.50"),
    ]
    path = reports.write_sheet(monthly, str(tmp_path / "sheet"), dt.datetime(2021, 12, 31, 2, 0))
    assert [r.value for r in spark.read.text(path).collect()][2:] == ["month,completed,avg_revenue", "2021-01-01,1,1234.50"]


def test_report_rows_blank_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(reports.report_rows(df)) == [("1", ""), ("2", "x")]


def test_load_turns_nan_to_null_and_drops_copies(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, float("nan")), (2, 1.5)], "a int, b double")
    got = files.for_load(df, dt.datetime(2021, 1, 1))
    assert rows(got, "a", "b") == [(1, None), (2, 1.5)]
    assert got.columns == ["a", "b", "created_at"]


def test_bad_csv_values_become_null(spark, tmp_path):
    (tmp_path / "p.csv").write_text("patient_id,age,gender,city,registration_date\nP1,abc,Male,A,2021-01-01\nP2,5,,B,bad\n")
    got = files.scan_csv(spark, str(tmp_path / "p.csv"), schemas.patients())
    assert rows(got) == [("P1", None, "Male", "A", day("2021-01-01")), ("P2", 5, None, "B", None)]


def test_csv_dates_with_a_time_and_whole_numbers_with_a_fraction(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "patient_id,age,gender,city,registration_date\n"
        "P1,23.0,Male,A,2021-05-03 00:00:00.000000\nP2,23.5,Male,A,2021-05-03T10:11:12\nP3,7,Male,A,2021-05-03 x\n"
    )
    got = files.scan_csv(spark, str(tmp_path / "p.csv"), schemas.patients())
    assert [(r[1], r[4]) for r in got.orderBy("patient_id").collect()] == [
        (23, day("2021-05-03")), (None, day("2021-05-03")), (7, None)
    ]


def test_first_row_of_the_file_is_kept(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        "patient_id,age,gender,city,registration_date\nP1,50,Male,A,2021-01-01\nP2,30,Male,B,2021-01-01\n"
        "P1,20,,A,2021-01-01\nP3,40,,B,2021-01-01\nP3,40,Male,B,2021-01-01\n"
    )
    got = files.scan_csv(spark, str(tmp_path / "p.csv"), schemas.patients(age=T.StringType()), position="seq")
    kept = cleaning.clean_patients(got, ["seq"]).drop("seq")
    assert [(r[0], r[1]) for r in kept.orderBy("patient_id").collect()] == [("P1", 50.0), ("P2", 30.0)]
    (tmp_path / "a.csv").write_text(
        "appointment_id,patient_id,doctor_id,appointment_date,appointment_status,waiting_time_minutes,appointment_cost\n"
        "A1,P1,D1,2021-01-01,Completed,5.0,10.00\nA1,,D1,2021-01-01,Completed,5,10.00\n"
    )
    got = files.scan_csv(spark, str(tmp_path / "a.csv"), schemas.appointments(), position="seq")
    assert [tuple(r)[:2] for r in cleaning.clean_appointments(got, ["seq"]).drop("seq").collect()] == [("A1", "P1")]


def test_views_answer_sql(spark, clinic):
    views.register(clinic.patients, clinic.doctors, clinic.appointments, clinic.treatments, clinic.resources)
    by_sql = spark.sql(
        """SELECT department, total_revenue, rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS revenue_rank
           FROM v_department_performance ORDER BY total_revenue DESC NULLS FIRST, department LIMIT 10"""
    )
    by_frames = business.q01_top_departments(views.department_totals(clinic.visits, clinic.doctors))
    assert rows(by_sql) == rows(by_frames)
    assert spark.sql("SELECT count(*) FROM mv_doctor_performance").first()[0] == clinic.doctors.count()


def test_trigram_similarity(spark):
    from wardmill.operators import fuzzy

    df = spark.createDataFrame([("two words",), ("WORD",), ("",), (None,), ("xyz",)], "name string")
    got = fuzzy.search(df, "name", "word", threshold=0.3)
    assert rows(got) == [("WORD", 1.0), ("two words", 0.363636)]

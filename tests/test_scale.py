"""Operators that split work a single task could not hold, against brute force and against the plain form."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

import __spark_entry__ as entry
from helpers import SMALL, rows

from wardmill.operators import integrity, ranking
from wardmill.operators.quantiles import percentile_cont
from wardmill.plans import business, views
from wardmill.sources import schemas


@pytest.fixture(scope="module")
def scores(spark):
    """A third of all rows share one value and one department; some values are missing."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        hot = i % 3 == 0
        value = None if i % 50 == 1 else Decimal("10.00") if hot else Decimal(rng.randrange(0, 4000)) / 100
        data.append((i, "hot" if hot else rng.choice("abc"), value))
    return spark.createDataFrame(data, "id bigint, grp string, value decimal(12,2)").cache()


@pytest.mark.parametrize("within", [None, "grp"])
@pytest.mark.parametrize("dense", [False, True])
def test_rank_matches_plain_window(scores, within, dense):
    groups = Window.partitionBy(*([within] if within else [])).orderBy(F.desc_nulls_first("value"))
    plain = scores.withColumn("r", (F.dense_rank() if dense else F.rank()).over(groups))
    split = ranking.rank_desc(scores, "value", "r", within=within, dense=dense)
    assert split.columns == plain.columns
    assert rows(split, "id", "r") == rows(plain, "id", "r")


@pytest.mark.parametrize("tiles", [1, 4, 7, 1000])
def test_ntile_matches_plain_window(scores, tiles):
    order = [F.asc_nulls_last("value"), F.asc("id")]
    plain = scores.withColumn("t", F.ntile(tiles).over(Window.partitionBy().orderBy(*order)))
    split = ranking.ntile(scores, tiles, order, "t")
    assert rows(split, "id", "t") == rows(plain, "id", "t")


def test_running_totals(scores, spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges
    try:
        got = ranking.running_totals(scores, [F.asc("id")], {"n": F.lit(1), "s": F.col("id")})
        ranges = scores.repartitionByRange(F.asc("id")).select(F.spark_partition_id()).distinct().count()
        assert ranges > 1
        assert rows(got, "id", "n", "s") == sorted(
            ((i, i + 1, i * (i + 1) // 2) for i in range(900)), key=lambda r: tuple((False, str(v)) for v in r)
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("within", [None, "grp"])
def test_rank_over_several_ranges(scores, spark, within):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        test_rank_matches_plain_window(scores, within, False)
        test_rank_matches_plain_window(scores, within, True)
        test_ntile_matches_plain_window(scores, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_percentile(spark, p):
    rng = random.Random(3)
    data = [("hot", Decimal("12345.67"))] * 300
    data += [(g, Decimal(rng.randrange(0, 10**9)) / 100) for g in "ab" for _ in range(150 + ord(g))]
    data += [("neg", Decimal(-rng.randrange(0, 10**7)) / 100) for _ in range(50)]
    data += [("one", Decimal("5.00")), ("two", Decimal("1.00")), ("two", Decimal("2.00")), ("none", None)]
    df = spark.createDataFrame(data, "g string, v decimal(12,2)")
    got = {g: float(v) for g, v in rows(percentile_cont(df, "g", "v", p, "q"))}
    want = {r.g: r.q for r in df.where("v is not null").groupBy("g").agg(F.percentile("v", F.lit(p)).alias("q")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[g] - want[g]) < 1e-4 for g in want)


@pytest.fixture(scope="module")
def skewed(spark):
    """One patient has a third of all visits and treatments, one patient-month most of those."""
    rng = random.Random(11)
    day0 = dt.date(2021, 1, 1)
    visits, care = [], []
    for i in range(1500):
        patient = "HOT" if i % 3 == 0 else f"P{rng.randrange(60)}" if i % 17 else None
        date = day0 + dt.timedelta(days=rng.randrange(28) if i % 2 else rng.randrange(300))
        status = rng.choice(schemas.STATUSES)
        visits.append((f"A{i}", patient, f"D{i % 4 if i % 5 else 0}", date, status, rng.randrange(60), Decimal(rng.randrange(9999)) / 100))
        care.append((f"T{i}", patient, "dx", "Surgery", Decimal(rng.randrange(9999)) / 100, date))
    return (
        spark.createDataFrame(visits, schemas.appointments()).cache(),
        spark.createDataFrame(care, schemas.treatments()).cache(),
        visits,
        care,
    )


def test_monthly_revenue_under_skew(make, skewed):
    a, t, visits, care = skewed
    department = {"D0": "X", "D1": "Y", "D2": "X", "D3": "Z"}
    by_month = defaultdict(list)
    for c in care:
        by_month[(c[1], c[5].replace(day=1))].append(c[4])
    n, apt, trt = Counter(), Counter(), Counter()
    for v in visits:
        month = v[3].replace(day=1)
        costs = by_month.get((v[1], month), []) if v[1] else []
        key = (month, department[v[2]])
        n[key] += max(len(costs), 1)
        trt[key] += sum(costs)
        if v[4] == "Completed":
            apt[key] += v[6] * max(len(costs), 1)
    got = views.mv_monthly_revenue(a, t, make.doctors(*department.items())).collect()
    assert {(r.month, r.department): (r.total_appointments, r.appointment_revenue or 0, r.treatment_revenue or 0) for r in got} == {
        k: (n[k], apt[k], trt[k]) for k in n
    }


def test_history_under_skew(make, skewed):
    a, _, visits, _ = skewed
    patients = make.patients({"id": "HOT"}, *[{"id": f"P{i}"} for i in range(50)])
    got = views.v_no_show_risk_features(a, patients, make.doctors(*[(f"D{i}", "X") for i in range(4)]))
    known = {"HOT", *[f"P{i}" for i in range(50)]}
    want = set()
    for v in visits:
        if v[1] in known and v[4] in ("Completed", "No-show"):
            earlier = [w for w in visits if w[1] == v[1] and w[3] < v[3]]
            want.add((v[0], sum(w[4] == "No-show" for w in earlier), len(earlier), int(v[4] == "No-show")))
    assert set(rows(got, "appointment_id", "prior_no_shows", "prior_total_appointments", "no_show")) == want


def test_plans_have_no_cross_join_and_scan_the_facts_once(spark):
    """With broadcasting switched off, as for tables of any size: no nested loops, no Cartesian products,
    and the fact table is read once even where a plan uses it twice. Exceptions: a count that reads ids
    only, and the two split statistics whose split is pushed into one of the reads."""
    twice = {"viz_page1_cards": 2, "ml_class_weights": 2, "ml_confusion": 2}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")  # the shape of a plan does not depend on them
    try:
        for name, query in entry.queries().items():
            if name.startswith("ml_train"):
                continue
            df = query(spark, SMALL)
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert "NestedLoop" not in plan and "Cartesian" not in plan, name
            assert "EvalPython" not in plan and "InPandas" not in plan, name
            scans = len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", plan))
            assert scans <= twice.get(name, 1), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_hot_keys_are_split_by_the_joins(spark, tmp_path):
    """A patient and a doctor with a third of the appointments: with the skew limits scaled down to this
    table, the joins on them are split."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in limits}
    patients = spark.range(2000).selectExpr("id AS patient_id", "40 AS age", "'Male' AS gender", "'A' AS city", "DATE '2020-01-01' AS registration_date")
    doctors = spark.range(200).selectExpr("id AS doctor_id", "'x' AS doctor_name", "'Male' AS gender", "'S' AS specialty", "'D' AS department")
    visits = spark.range(0, 60000, 1, 8).selectExpr(
        "id AS appointment_id", "IF(id % 3 = 0, 7, id * 31 % 2000) AS patient_id", "IF(id % 3 = 1, 7, id * 17 % 200) AS doctor_id",
        "DATE '2021-01-01' AS appointment_date", "'Completed' AS appointment_status", "5 AS waiting_time_minutes",
        "CAST(id % 977 AS decimal(12,2)) AS appointment_cost",
    )
    for name, df in [("p", patients), ("d", doctors), ("v", visits)]:
        df.write.parquet(str(tmp_path / name))
    p, d, v = (spark.read.parquet(str(tmp_path / n)) for n in "pdv")
    try:
        for k, value in limits.items():
            spark.conf.set(k, value)
        detail = views.v_appointment_detail(v, p, d)
        assert detail.count() == 60000
        detail.collect()
        plan = detail._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall(r"SortMergeJoin\(skew=true\)", plan)) == 2
        kept = integrity.with_known(v, p, "patient_id")
        kept.collect()
        plan = kept._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skew=true" in plan
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def test_scan_is_pruned_and_filter_pushed(spark, clinic):
    plan = business.q09_top_diagnoses(clinic.treatments)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderdate" not in plan and "o_custkey" not in plan
    spark.conf.set("spark.sql.ansi.enabled", "true")
    plan = clinic.doctors.where("doctor_id < 3")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(s_suppkey,3\)", plan)


def test_duplicates_shrink_before_the_shuffle(clinic):
    plan = clinic.visits._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(appointment_id")

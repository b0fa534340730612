"""Fuzzy pairs, date forms, numeric rules, numbered lines and joint ranks against brute force."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from helpers import rows

from wardmill.operators import constraints, fuzzy, ranking
from wardmill.plans import reports
from wardmill.sources import files, schemas


def grams(text):
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return {f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)}


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75, 1.0])
def test_fuzzy_pairs_equal_brute_force(spark, threshold):
    rnd = random.Random(11)
    part = ["an", "ber", "ka", "ro", "li", "Smith", "dr", "é"]
    name = lambda: " ".join("".join(rnd.choice(part) for _ in range(rnd.randrange(1, 4))) for _ in range(rnd.randrange(1, 3)))
    left = [name() for _ in range(80)] + ["Smith"] * 40 + [None, "", "--", "a"]  # a very common name
    right = [name() for _ in range(90)] + ["Smith"] * 40 + [None, " ", "A"]
    got = fuzzy.similar_pairs(
        spark.createDataFrame([(x,) for x in left], "a string"), spark.createDataFrame([(x,) for x in right], "b string"), "a", "b", threshold
    )
    want = []
    for a in {x for x in left if x}:
        for b in {x for x in right if x}:
            x, y = grams(a), grams(b)
            if x and y and len(x & y) / len(x | y) >= threshold:
                want.append((a, b, round(len(x & y) / len(x | y), 6), left.count(a), right.count(b)))
    assert sorted(map(tuple, got.collect())) == sorted(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_fuzzy_pairs_of_common_trigrams_meet_on_triples(spark):
    """Numbered names share their trigrams with a large part of all names: they meet on triples."""
    left = [f"Supplier#{7 * k:09d}" for k in range(200)] + ["ab", "c d", "xyz" * 20]
    right = [f"Customer#{k:09d}" for k in range(2000)] + ["ab", "d", "xyz" * 21, " ".join(f"w{k}" for k in range(40))]
    df = fuzzy.similar_pairs(
        spark.createDataFrame([(x,) for x in left], "a string"), spark.createDataFrame([(x,) for x in right], "b string"), "a", "b", 0.3
    )
    sets = {x: grams(x) for x in left + right}
    share = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    want = {(a, b) for a in left for b in right if share(a, b) >= 0.3}
    assert {(r.left_text, r.right_text) for r in df.collect()} == want and ("ab", "ab") in want and len(want) > 10
    common = spark.createDataFrame([(x,) for x in left[:200]], "a string"), spark.createDataFrame([(x,) for x in right[:2000]], "b string")
    logical = fuzzy.similar_pairs(*common, "a", "b", 0.3)._jdf.queryExecution().optimizedPlan().toString()
    assert logical.count("xxhash64") >= 2 and "Union" not in logical  # no set here needs single trigrams


def test_fuzzy_pairs_of_nothing(spark):
    none, some = spark.createDataFrame([], "a string"), spark.createDataFrame([("x",)], "a string")
    assert fuzzy.similar_pairs(none, some, "a", "a").count() == 0
    with pytest.raises(ValueError):
        fuzzy.similar_pairs(none, some, "a", "a", 0)


def written(tmp_path, lines):
    path = tmp_path / "p.csv"
    path.write_text("patient_id,age,gender,city,registration_date\n" + "\n".join(f"P{k},40,Male,A,{d}" for k, d in enumerate(lines)))
    return str(path)


@pytest.mark.parametrize(
    "lines, form",
    [
        (["31/01/2024", "05/02/2024"], "dd/MM/yyyy"), (["01/31/2024", "02/05/2024"], "MM/dd/yyyy"),
        (["2024-01-31", "2024-02-05 10:11:12"], "yyyy-MM-dd"), (["31.01.2024", "", "nonsense"], "dd.MM.yyyy"),
        (["05/05/2024", "06/06/2024"], "dd/MM/yyyy"), ([], "yyyy-MM-dd"), (["?"], "yyyy-MM-dd"),
        (["31/01/2024", "02/03/2024", "13/13/2024"], "dd/MM/yyyy"),
    ],
)
def test_date_forms_by_vote(spark, tmp_path, lines, form):
    path = written(tmp_path, lines)
    assert files.date_forms(spark, path, schemas.patients()) == {"registration_date": form}


def test_day_first_dates_load_and_rejects_are_counted(spark, tmp_path):
    path = written(tmp_path, ["31/01/2024", "02/03/2024", "99/99/9999", ""])
    forms = files.date_forms(spark, path, schemas.patients())
    got = files.scan_csv(spark, path, schemas.patients(), forms)
    assert [str(r.registration_date) for r in got.orderBy("patient_id").collect()] == ["2024-01-31", "2024-03-02", "None", "None"]
    assert ("registration_date", 3, 1) in rows(files.rejects(spark, path, schemas.patients(), forms))


def test_ambiguous_dates_are_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="registration_date"):
        files.date_forms(spark, written(tmp_path, ["01/02/2024", "03/04/2024"]), schemas.patients())


def test_numeric_rules_judge_the_text(spark):
    values = ["1", "9999999999.99", "9999999999.994", "9999999999.995", "10000000000", "-10000000000", "1.005", "1e3", "abc", "", None, "0001.10", " 5 "]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select("v", constraints.fits_numeric(F.col("v"), 12, 2).alias("fits"), constraints.keeps_scale(F.col("v"), 2).alias("keeps")).collect()
    assert {r.v for r in got if not r.fits} == {"9999999999.995", "10000000000", "-10000000000", "abc", ""}
    assert {r.v for r in got if not r.keeps} == {"9999999999.994", "9999999999.995", "1.005"}


def test_numbered_rows_over_many_tasks(spark):
    df = spark.range(5000).selectExpr("id", "(id * 7919) % 5000 AS k").repartition(13).orderBy("k")
    got = reports.numbered_rows(df).collect()
    assert sorted((r.line, r.k) for r in got) == [(k + 1, k) for k in range(5000)]
    assert reports.numbered_rows(df.where("false")).count() == 0
    layout = reports.sheet_layout(df)
    assert [r.c2 for r in layout.limit(3).collect()] == ["k", "0", "1"] and layout.count() == 5001


def test_joint_ranks_match_plain_windows(spark):
    rnd = random.Random(12)
    data = []
    for k in range(900):
        value = None if k % 50 == 1 else Decimal("10.00") if k % 3 == 0 else Decimal(rnd.randrange(0, 4000)) / 100
        data.append((k, "hot" if k % 3 == 0 else rnd.choice(["a", "b", None]), value, None if k % 40 == 3 else Decimal(rnd.randrange(30))))
    df = spark.createDataFrame(data, "id bigint, grp string, v decimal(12,2), w decimal(5,2)").cache()
    high, low = F.desc_nulls_first("v"), [F.asc_nulls_last("w"), F.asc("id")]
    plain = df.select(
        "*", F.rank().over(Window.partitionBy("grp").orderBy(high)).alias("a"), F.dense_rank().over(Window.partitionBy().orderBy(high)).alias("b"),
        F.ntile(4).over(Window.partitionBy().orderBy(*low)).alias("c"), F.rank().over(Window.partitionBy().orderBy(F.desc_nulls_first("w"))).alias("d"),
        F.ntile(1000).over(Window.partitionBy().orderBy(*low)).alias("e"),
    )
    spec = {
        "a": ranking.Rank("v", within="grp"), "b": ranking.Rank("v", dense=True), "c": ranking.Tile("w", 4), "d": ranking.Rank("w"),
        "e": ranking.Tile("w", 1000),
    }
    got = ranking.several(df, "id", spec)
    assert got.columns == plain.columns
    assert rows(got, "id", "a", "b", "c", "d", "e") == rows(plain, "id", "a", "b", "c", "d", "e")


def test_dates_are_read_as_the_parser_reads_them(spark):
    """The parser is asked only about texts that begin like the form; results are those of asking it about all."""
    days = ["2020-02-29", "2021-02-29", "0000-01-01", "0001-01-01", "9999-12-31", "+12020-01-05", "-2020-01-05", "2020-1-5",
            "2020-01-05 07:08:09", "2020-01-05T07:08:09.123456", "2020-01-05 7", " 2020-01-05", "2020-01-05 ", "2020-01-05\n", "12020-01-05",
            "2020-13-05", "05/06/2020", "13/06/2020", "06/13/2020", "31/04/2020", "05.06.2020", "05.06.2020 01:02:03", "05x06x2020", "05-06-2020",
            "05-06-2020T01:02:03", "06-13-2020", "05/06/20", "5/6/2020", "2020/02/30", "2020/02/28", "2020/02-28", "", "x", "٠٥/٠٦/٢٠٢٠", None]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    for form in files.DATE_FORMS:
        plain = F.coalesce(*[F.try_to_timestamp("d", F.lit(t.format(form))) for t in files._TIMES])
        got = df.select("d", files._as_date(F.col("d"), form).alias("got"), plain.alias("want")).selectExpr("d", "string(got)", "string(want)").collect()
        assert [(r.d, r.got) for r in got] == [(r.d, r.want) for r in got]
        assert sum(r.got is not None for r in got) >= 1
    plan = df.select(files._as_date(F.col("d"), "dd/MM/yyyy"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and "CASE WHEN" in plan  # a failed parse costs many times a match

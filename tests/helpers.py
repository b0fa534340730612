"""Helpers of the tests: small tables by hand and results as sorted rows."""

import datetime as dt
from decimal import Decimal

from wardmill.sources import schemas

SMALL = "/root/testdata/sf0.001"


def day(text):
    return dt.date.fromisoformat(text)


def money(x):
    return None if x is None else Decimal(str(x))


class Maker:
    """Small tables by hand; every column not given has a plain default."""

    def __init__(self, spark):
        self.spark = spark

    def patients(self, *rows):
        data = [
            (r["id"], r.get("age", 40), r.get("gender", "Male"), r.get("city", "A"), day(r.get("registered", "2020-01-01")))
            for r in rows
        ]
        return self.spark.createDataFrame(data, schemas.patients())

    def doctors(self, *rows):
        data = [(i, f"Dr. {i}", "Male", "S", dep) for i, dep in rows]
        return self.spark.createDataFrame(data, schemas.doctors())

    def appointments(self, *rows):
        """(patient, doctor, date, status, cost[, wait[, id]])"""
        data = []
        for n, r in enumerate(rows, start=1):
            patient, doctor, date, status, cost, *more = r
            wait = more[0] if more else 10
            key = more[1] if len(more) > 1 else f"A{n:03d}"
            data.append((key, patient, doctor, day(date), status, wait, money(cost)))
        return self.spark.createDataFrame(data, schemas.appointments())

    def treatments(self, *rows):
        """(patient, diagnosis, type, cost, date[, id])"""
        data = [
            (r[5] if len(r) > 5 else f"T{n:03d}", r[0], r[1], r[2], money(r[3]), day(r[4]))
            for n, r in enumerate(rows, start=1)
        ]
        return self.spark.createDataFrame(data, schemas.treatments())

    def resources(self, *rows):
        """(department, available, occupied, staff)"""
        from wardmill.sources.files import with_total_beds

        data = [(d, a, o, s, Decimal("0.50"), day("2021-01-01")) for d, a, o, s in rows]
        return with_total_beds(self.spark.createDataFrame(data, schemas.resources()))


def rows(df, *columns):
    """Sorted tuples of the named columns (all by default), decimals as floats."""
    picked = df.select(*columns) if columns else df
    out = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in picked.collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))

"""The clinic tables as views over a given star schema (orders and their lines).

customer -> patients, supplier -> doctors, lineitem -> appointments, orders -> treatments,
nation/region -> departments and their resources. Line keys repeat with different payloads, so the
raw appointments contain real duplicates; the clean view keeps the first of each in payload order.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardmill.operators import defects
from wardmill.operators.dedupe import keep_first
from wardmill.sources import schemas
from wardmill.sources.files import with_total_beds

AS_OF = dt.date(2001, 11, 5)
MONEY = "decimal(12,2)"
VISIT_ORDER = [
    "appointment_date", "doctor_id", "appointment_cost", "waiting_time_minutes", "appointment_status",
]


# Columns used and their stored types. Declared, so that opening a table reads no footers.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


class StarClinic:
    """Lazy frames; nothing is read until a plan that uses them runs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def departments(self) -> DataFrame:
        nation, region = self._read("nation"), self._read("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("k"),
            F.col("n_name").alias("department"),
            F.col("r_name").alias("specialty"),
        )

    @cached_property
    def patients(self) -> DataFrame:
        customer, nation = self._read("customer"), self._read("nation")
        k = F.col("c_custkey")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
            k.alias("patient_id"),
            (F.pmod(k * 7919, F.lit(100)) + 1).cast("int").alias("age"),
            F.when(F.pmod(k, F.lit(25)) < 12, "Male").otherwise("Female").alias("gender"),
            F.col("n_name").alias("city"),
            F.date_add(F.lit(dt.date(1994, 6, 1)), F.pmod(k * 37, F.lit(1461)).cast("int")).alias(
                "registration_date"
            ),
        )

    @cached_property
    def patient_names(self) -> DataFrame:
        return self._read("customer").select(F.col("c_custkey").alias("patient_id"), F.col("c_name").alias("patient_name"))

    @cached_property
    def doctors(self) -> DataFrame:
        supplier, dep = self._read("supplier"), self.departments
        return supplier.join(dep, supplier.s_nationkey == dep.k).select(
            F.col("s_suppkey").alias("doctor_id"),
            F.col("s_name").alias("doctor_name"),
            F.when(F.pmod(F.col("s_suppkey"), F.lit(2)) == 0, "Male").otherwise("Female").alias("gender"),
            "specialty",
            "department",
        )

    @cached_property
    def _lines(self) -> DataFrame:
        returned, closed = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
        return self._read("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("appointment_id"),
            F.col("l_suppkey").alias("doctor_id"),
            F.to_date("l_shipdate").alias("appointment_date"),
            F.when(~returned, "Completed")
            .when(closed, "No-show")
            .when(F.col("l_linenumber") % 2 == 1, "Cancelled")
            .otherwise("Rescheduled")
            .alias("appointment_status"),
            F.col("l_quantity").cast("int").alias("waiting_time_minutes"),
            F.col("l_extendedprice").cast(MONEY).alias("appointment_cost"),
        )

    def _with_patient(self, lines: DataFrame) -> DataFrame:
        orders = self._read("orders").select("o_orderkey", F.col("o_custkey").alias("patient_id"))
        return lines.join(orders, F.expr("appointment_id div 10") == orders.o_orderkey, "left").select(
            *schemas.appointments().fieldNames()
        )

    @cached_property
    def visits(self) -> DataFrame:
        """Appointments without ``patient_id``: plans that do not use the patient skip the join."""
        return keep_first(self._lines.where("appointment_id IS NOT NULL"), ["appointment_id"], VISIT_ORDER)

    @cached_property
    def appointments(self) -> DataFrame:
        return self._with_patient(self.visits)

    @cached_property
    def treatments(self) -> DataFrame:
        k = F.col("o_orderkey")
        kinds = F.array(*[F.lit(t) for t in schemas.TREATMENT_TYPES])
        code = F.lpad(F.pmod(k, F.lit(20)).cast("string"), 2, "0")
        return self._read("orders").select(
            k.alias("treatment_id"),
            F.col("o_custkey").alias("patient_id"),
            F.when(F.pmod(k, F.lit(167)) != 0, F.concat(F.lit("DX"), code)).alias("diagnosis"),
            F.get(kinds, F.pmod(k, F.lit(8)).cast("int")).alias("treatment_type"),
            F.col("o_totalprice").cast(MONEY).alias("treatment_cost"),
            F.to_date("o_orderdate").alias("treatment_date"),
        )

    @cached_property
    def resources(self) -> DataFrame:
        k = F.col("k")
        sized = self.departments.select(
            "department", "k", (F.lit(20) + k * 37 % 81).alias("beds")
        ).withColumn("occupied_beds", F.expr("(beds * (40 + k * 53 % 56)) div 100").cast("int"))
        return with_total_beds(
            sized.select(
                "department",
                (F.col("beds") - F.col("occupied_beds")).alias("available_beds"),
                "occupied_beds",
                (F.lit(10) + k * 17 % 51).alias("staff_count"),
                ((F.lit(50) + k * 29 % 49).cast("decimal(4,0)") / 100).cast("decimal(4,2)").alias(
                    "equipment_utilization"
                ),
                F.lit(AS_OF).alias("snapshot_date"),
            )
        )

    # Raw tables: the same rows with defects put in by rule.

    @cached_property
    def raw_patients(self) -> DataFrame:
        return defects.inject(self.patients, defects.patient_rules(), duplicate="patient_id % 200 = 4")

    @cached_property
    def raw_appointments(self) -> DataFrame:
        return defects.inject(self._with_patient(self._lines), defects.appointment_rules())

    @cached_property
    def raw_treatments(self) -> DataFrame:
        return defects.inject(
            self.treatments, defects.treatment_rules(AS_OF), duplicate="treatment_id % 300 = 13"
        )

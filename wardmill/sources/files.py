"""CSV and Parquet sources and sinks."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


#: The forms in which a date column may be written.
DATE_FORMS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy/MM/dd", "dd.MM.yyyy", "dd-MM-yyyy", "MM-dd-yyyy"]
_TIMES = ["{}[ HH:mm:ss[.SSSSSS]]", "{}'T'HH:mm:ss[.SSSSSS]"]


def _as_date(text: Column, date_format: str) -> Column:
    """The timestamp that a text holds in one form, with or without a time of day.

    A parser that fails costs many times one that succeeds, so it is asked only about texts that begin like the form.
    A date of the usual width and nothing else needs no parser: it is cast.
    """
    parsed = F.coalesce(*[F.try_to_timestamp(text, F.lit(t.format(date_format))) for t in _TIMES])
    if not re.fullmatch(r"(yyyy([-/.])MM\2dd)|(dd([-/.])MM\4yyyy)|(MM([-/.])dd\6yyyy)", date_format):
        return parsed
    pieces = [F.substring(text, date_format.index(p) + 1, len(p)) for p in ("yyyy", "MM", "dd")]
    plain, begins = (
        reduce(lambda f, r: f.replace(*r), rules, date_format.replace(".", "[.]"))
        for rules in (
            [("yyyy", "(?!0000)[0-9]{4}"), ("MM", "[0-9]{2}"), ("dd", "[0-9]{2}")],
            [("yyyy", "[+-]?[0-9]{4,}"), ("MM", "[0-9]{2}"), ("dd", "[0-9]{2}")],
        )
    )
    cast = F.concat_ws("-", *pieces).try_cast("date").cast("timestamp")
    return F.when(text.rlike(f"\\A{plain}\\z"), cast).when(text.rlike(f"\\A{begins}"), parsed)


def _parsed(field: T.StructField, date_format: str) -> Column:
    """The text of a field as its type. A date may have a time of day, which is left out; a whole number may be
    written with a fraction of zeros."""
    text, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return _as_date(text, date_format).cast(kind)
    typed = text.try_cast(kind)
    if isinstance(kind, T.IntegralType):
        number = text.try_cast("decimal(38,6)")
        typed = F.coalesce(typed, F.when(number == F.floor(number), number).try_cast(kind))
    return typed


def _text(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return spark.read.schema(as_text).csv(path, header=True, mode="PERMISSIVE")


def date_forms(spark: SparkSession, path: str, schema: T.StructType, forms: list[str] | None = None) -> dict[str, str]:
    """For every date column of a CSV file the form that its values are written in, by a vote of all rows.

    One pass counts for each column and form the values that it reads, and for each two forms the values that
    they read as different dates; what the driver gets depends on columns and forms only. The form that reads most
    values wins. Two forms that read equally many but not the same dates make the column ambiguous: an error, as
    any choice could be wrong. A column without a value, or that no form reads, takes the first form.
    """
    forms = forms or DATE_FORMS
    columns = [f.name for f in schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType))]
    if not columns:
        return {}
    read = _text(spark, path, schema).select(
        *[_as_date(F.col(f"`{c}`"), form).alias(f"d{i}_{k}") for i, c in enumerate(columns) for k, form in enumerate(forms)]
    )
    pairs = [(j, k) for j in range(len(forms)) for k in range(j + 1, len(forms))]
    votes = read.agg(
        *[F.count(f"d{i}_{k}").alias(f"n{i}_{k}") for i in range(len(columns)) for k in range(len(forms))],
        *[F.count_if(F.col(f"d{i}_{j}") != F.col(f"d{i}_{k}")).alias(f"x{i}_{j}_{k}") for i in range(len(columns)) for j, k in pairs],
    ).first()
    out = {}
    for i, column in enumerate(columns):
        best = max(votes[f"n{i}_{k}"] for k in range(len(forms)))
        tied = [k for k in range(len(forms)) if votes[f"n{i}_{k}"] == best]
        apart = [(forms[j], forms[k]) for j, k in pairs if j in tied and k in tied and votes[f"x{i}_{j}_{k}"]]
        if best and apart:
            raise ValueError(f"{column}: the dates may be {apart[0][0]} or {apart[0][1]}")
        out[column] = forms[tied[0]]
    return out


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date_format: str | dict[str, str] = "yyyy-MM-dd",
    position: str | None = None,
) -> DataFrame:
    """Typed CSV scan: values that do not parse become NULL, and no pass is spent on inference. ``date_format`` is
    one form for all dates or one by column, as ``date_forms`` finds them. ``position`` names a column for the place
    of a row: file, block of the file, row in the block."""
    form = date_format if isinstance(date_format, dict) else {f.name: date_format for f in schema.fields}
    columns = [_parsed(f, form.get(f.name, DATE_FORMS[0])).alias(f.name) for f in schema.fields]
    if position:
        place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
        columns.append(place.alias(position))
    return _text(spark, path, schema).select(*columns)


def rejects(spark: SparkSession, path: str, schema: T.StructType, date_format: str | dict[str, str] = "yyyy-MM-dd") -> DataFrame:
    """(column_name, filled, rejected): for each typed column the values that are there and those that the scan
    turns into NULL. One pass over the file."""
    form = date_format if isinstance(date_format, dict) else {f.name: date_format for f in schema.fields}
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    counts = []
    for f in typed:
        there = F.trim(f"`{f.name}`") != ""
        lost = there & _parsed(f, form.get(f.name, DATE_FORMS[0])).isNull()
        counts.append(F.struct(F.lit(f.name).alias("column_name"), F.count_if(there).alias("filled"), F.count_if(lost).alias("rejected")))
    return _text(spark, path, schema).agg(F.array(*counts).alias("c")).select(F.inline("c"))


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, header=True, dateFormat="yyyy-MM-dd")
    return path


def write_table(df: DataFrame, path: str) -> str:
    """Replace a stored table: what truncate-and-append does in two steps."""
    df.write.mode("overwrite").parquet(path)
    return path


def for_load(df: DataFrame, loaded_at=None) -> DataFrame:
    """Rows ready to be stored: identical rows once, NaN as NULL, optionally a load timestamp."""
    clean = df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    ).dropDuplicates()
    return clean if loaded_at is None else clean.withColumn("created_at", F.lit(loaded_at).cast("timestamp"))


def with_total_beds(resources: DataFrame) -> DataFrame:
    """The derived column is never taken from the input."""
    return resources.drop("total_beds").withColumn(
        "total_beds", F.col("available_beds") + F.col("occupied_beds")
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counted[0]
    for one in counted[1:]:
        out = out.unionByName(one)
    return out

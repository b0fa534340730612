"""Exact global ranks without a window that puts the whole table into one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardmill.session import durable


def running_totals(
    df: DataFrame, order: list[Column], sums: dict[str, Column], rows: str | None = None
) -> DataFrame:
    """Add ``name = running sum of expression`` in global order, including the current row; ``rows`` names
    a column for the number of all rows.

    Rows are range-partitioned by the order, summed inside each range, and shifted by the totals of
    the ranges before it. ``order`` must tell all rows apart. The ranged rows are stored, because
    range bounds are sampled and the two readers must see the same ones.
    """
    ranged = durable(
        df.select("*", *[e.alias(f"_add_{n}") for n, e in sums.items()])
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id())
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # one row per range: never more than there are shuffle partitions
    ranges = ranged.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_add_{n}").alias(f"_all_{n}") for n in sums]
    )
    shifts = ranges.select(
        "_range",
        F.sum("_rows").over(every).alias("_rows"),
        *[F.coalesce(F.sum(f"_all_{n}").over(before), F.lit(0)).alias(f"_shift_{n}") for n in sums],
    )
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(shifts), "_range").select(
        *df.columns,
        *[(F.sum(f"_add_{n}").over(inside) + F.col(f"_shift_{n}")).alias(n) for n in sums],
        *([F.col("_rows").alias(rows)] if rows else []),
    )


def rank_desc(df: DataFrame, value: str, out: str, within: str | None = None, dense: bool = False) -> DataFrame:
    """RANK (or DENSE_RANK) by value, highest first and NULL highest of all.

    The values are counted first, which removes ties and hot values, and the positions of the distinct
    values are then joined back. ``df`` is read twice.
    """
    groups = [within] if within else []
    values = df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    step = F.lit(1).cast("bigint") if dense else F.col("_n")
    order = [*[F.asc_nulls_first(g) for g in groups], F.desc_nulls_first(value)]
    placed = running_totals(values, order, {"_upto": step}).withColumn("_above", F.col("_upto") - step)
    if within:
        heads = placed.groupBy(within).agg(F.min("_above").alias("_head"))
        placed = placed.join(heads, within).withColumn("_above", F.col("_above") - F.col("_head"))
    ranks = placed.select(*[F.col(c).alias(f"_{c}") for c in [*groups, value]], (F.col("_above") + 1).alias(out))
    condition = F.lit(True)
    for c in [*groups, value]:
        condition = condition & df[c].eqNullSafe(ranks[f"_{c}"])
    return df.join(ranks, condition).select(*df.columns, out)


def ntile(df: DataFrame, tiles: int, order: list[Column], out: str) -> DataFrame:
    """NTILE over the whole table; ``order`` must tell all rows apart."""
    placed = running_totals(df, order, {"_pos": F.lit(1).cast("bigint")}, rows="_size")
    short, longer, position = F.floor(F.col("_size") / tiles), F.col("_size") % tiles, F.col("_pos")
    edge = longer * (short + 1)
    tile = F.when(position <= edge, F.ceil(position / (short + 1))).otherwise(
        longer + F.ceil((position - edge) / F.nullif(short, F.lit(0)))
    )
    return placed.withColumn(out, tile.cast("int")).select(*df.columns, out)


@dataclass
class Rank:
    """RANK (or DENSE_RANK) by a number, highest first and NULL highest of all, over all rows or ``within`` a column."""

    value: str
    within: str | None = None
    dense: bool = False


@dataclass
class Tile:
    """NTILE over all rows by a number, lowest first and NULL last, ties by the id."""

    value: str
    tiles: int


def several(df: DataFrame, id_column: str, wanted: dict[str, Rank | Tile]) -> DataFrame:
    """Add all ranks in ``wanted`` (by name) from one stored order.

    Every rank brings rows of one common order to a table: (which, group, missing, key, id), where a Rank counts
    equal values first, which removes ties and hot values, and a Tile brings each row. That table is range-partitioned
    and stored once; places, heads of groups and sizes come from its running totals, and each rank is joined back.
    ``id_column`` is unique and not null. ``df`` is read once for each rank and again for the result: pass a stored table.
    """
    number = "decimal(38,6)"
    parts = []
    for which, (name, spec) in enumerate(wanted.items()):
        tile = isinstance(spec, Tile)
        group = F.lit(None) if tile or spec.within is None else F.col(spec.within)
        key = F.col(spec.value).cast(number)
        brought = df.select(
            F.lit(which).alias("which"), group.cast("string").alias("group"),
            (key.isNull() if tile else key.isNotNull()).alias("missing"),
            (key if tile else -key).alias("key"), (F.col(id_column) if tile else F.lit(None)).cast("string").alias("id"),
        )
        sides = ["which", "group", "missing", "key", "id"]
        parts.append(brought.withColumn("n", F.lit(1).cast("bigint")) if tile else brought.groupBy(*sides).agg(F.count("*").alias("n")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    id_type = df.schema[id_column].dataType
    order = [
        F.asc("which"), F.asc_nulls_first("group"), F.asc("missing"), F.asc_nulls_first("key"),
        F.asc_nulls_first(F.col("id").cast(id_type)),
    ]
    placed = running_totals(rows, order, {"upto": F.col("n"), "steps": F.lit(1).cast("bigint")})
    placed = placed.withColumn("above", F.col("upto") - F.col("n")).withColumn("lower", F.col("steps") - 1)
    out = df
    for which, (name, spec) in enumerate(wanted.items()):
        own = placed.where(F.col("which") == which)
        if isinstance(spec, Tile):
            # the order of this rank is one group: its head and size come from the ends
            size = own.groupBy("which").agg(F.min("above").alias("head"), F.count("*").alias("size"))
            found = own.join(F.broadcast(size), "which")  # one row
            at = F.col("above") - F.col("head") + 1
            short, longer = F.floor(F.col("size") / spec.tiles), F.col("size") % spec.tiles
            edge = longer * (short + 1)
            tile = F.when(at <= edge, F.ceil(at / (short + 1))).otherwise(longer + F.ceil((at - edge) / F.nullif(short, F.lit(0))))
            found = found.select(F.col("id").cast(id_type).alias("_id"), tile.cast("int").alias(name))
            out = out.join(found, F.col(id_column) == F.col("_id")).drop("_id")
        else:
            place = "lower" if spec.dense else "above"
            heads = own.groupBy("group").agg(F.min(place).alias("head"))
            heads = heads.withColumnRenamed("group", "_g")
            found = own.join(heads, F.col("group").eqNullSafe(F.col("_g")))
            found = found.select(
                F.col("group").alias("_group"), F.col("key").alias("_key"), (F.col(place) - F.col("head") + 1).alias(name)
            )
            same = (-F.col(spec.value).cast(number)).eqNullSafe(F.col("_key"))
            if spec.within is not None:
                same &= F.col(spec.within).cast("string").eqNullSafe(F.col("_group"))
            out = out.join(found, same).drop("_group", "_key")
    return out.select(*df.columns, *wanted)

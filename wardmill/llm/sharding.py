"""Sharding by fixed virtual slots.

A record's key hashes into one of ``SLOTS`` slots for good. Bytes and rows are added up by slot, and a small
versioned table says which shard holds which slot. Rebalancing writes the next version of that table and
moves whole slots; records are never hashed anew.

The table has ``SLOTS`` rows whatever the data, so it may pass through the driver and be broadcast.
"""

from __future__ import annotations

import heapq
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardmill.llm.common import stored

SLOTS = 4096
#: Bytes that a record costs besides its text.
OVERHEAD = 16
#: A shard is left alone while its bytes exceed the mean by less than this share.
TOLERANCE = 0.01
#: The same for a new table, all of whose records are placed anyway.
EVEN = 0.002


def slotted(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, vslot): size in bytes, the slot by a hash of the id and the text's checksum.

    A null text has no bytes and the checksum of none. Rows with one id, or none, spread over the slots by their
    texts; rows repeated in full share a slot. Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.crc32(text)), F.lit(SLOTS)).cast("int").alias("vslot"),
    )


def loads(records: DataFrame) -> list[tuple[int, int]]:
    """(bytes, rows) of every slot."""
    found = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    out = [(0, 0)] * SLOTS
    for r in found:
        out[r["vslot"]] = (r["bytes"], r["rows"])
    return out


def assign(weights: list[int], shards: int) -> list[int]:
    """A shard for every slot, from nothing: the heaviest slot first, to the lightest shard."""
    heap = [(0, 0, s) for s in range(shards)]
    out = [0] * len(weights)
    for slot in sorted(range(len(weights)), key=lambda s: (-weights[s], s)):
        total, held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (total + weights[slot], held + 1, shard))
    return out


def rebalance(owner: list[int], weights: list[int], shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """An edited map: slots of shards that are gone, and as few others as needed, move to the lightest shard."""
    out, total = list(owner), [0] * shards
    homeless = [s for s, shard in enumerate(out) if shard >= shards]
    held: list[list[int]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(out):
        if shard < shards:
            total[shard] += weights[slot]
            held[shard].append(slot)
    for slot in sorted(homeless, key=lambda s: (-weights[s], s)):
        shard = min(range(shards), key=lambda s: (total[s], len(held[s]), s))
        out[slot] = shard
        total[shard] += weights[slot]
        held[shard].append(slot)
    mean = sum(weights) / shards
    for _ in range(2 * len(out)):
        heavy, light = max(range(shards), key=lambda s: (total[s], s)), min(range(shards), key=lambda s: (total[s], s))
        gap = total[heavy] - total[light]
        if total[heavy] <= mean * (1 + tolerance):
            break
        fitting = [s for s in held[heavy] if 0 < weights[s] < gap]
        if not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(gap / 2 - weights[s]), s))
        held[heavy].remove(slot)
        held[light].append(slot)
        out[slot] = light
        total[heavy] -= weights[slot]
        total[light] += weights[slot]
    return out


def save_map(spark: SparkSession, path: str, version: int, owner: list[int], load: list[tuple[int, int]]) -> DataFrame:
    """Write a version of the map: vslot, shard, bytes, rows, and how many rows of its shard lie before it."""
    before, first = {}, []
    for slot, shard in enumerate(owner):
        first.append(before.get(shard, 0))
        before[shard] = first[-1] + load[slot][1]
    rows = [{"shard": s, "bytes": b, "rows": r, "first": f} for s, (b, r), f in zip(owner, load, first)]
    column = F.from_json(F.lit(json.dumps(rows)), "array<struct<shard: int, bytes: long, rows: long, first: long>>")
    frame = spark.range(1).select(F.posexplode(column).alias("vslot", "m")).select("vslot", "m.*")
    frame.coalesce(1).write.parquet(f"{path.rstrip('/')}/version={version}")
    return load_map(spark, path, version)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of the map, the latest by default."""
    every = spark.read.parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def has_map(spark: SparkSession, path: str) -> bool:
    """Whether the folder has a version of the map."""
    try:
        return not spark.read.parquet(path).isEmpty()
    except AnalysisException:  # no such folder, or nothing in it
        return False


def read_map(table: DataFrame) -> tuple[list[int], int]:
    """The shard of every slot and the version, for editing."""
    rows = table.select("vslot", "shard", "version").orderBy("vslot").collect()
    return [r["shard"] for r in rows], rows[0]["version"]


def place(records: DataFrame, table: DataFrame) -> DataFrame:
    """The records with shard, slot (the record's place in its shard, from 0 without gaps) and map_version."""
    order = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    joined = records.withColumn("n", F.row_number().over(order)).join(F.broadcast(table), "vslot")
    return joined.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("n") - 1).alias("slot"), "vslot",
        F.col("version").alias("map_version"),
    )


def shard(docs: DataFrame, shards: int, path: str) -> DataFrame:
    """Every row of ``docs`` with its shard, by a map whose shards have nearly equal bytes.

    A folder without a map gets version 1, slots dealt in turn. The latest version is then edited to the bytes that
    the slots hold now and to ``shards``, and stored as the next one, so that later tables move few slots. An
    empty table gives no rows and a map of empty slots. A record larger than a shard's mean stays whole, and so
    do rows repeated in full.
    """
    spark = docs.sparkSession
    records = stored(slotted(docs))
    load = loads(records)
    if not has_map(spark, path):
        save_map(spark, path, 1, [slot % shards for slot in range(SLOTS)], load)
    owner, version = read_map(load_map(spark, path))
    owner = rebalance(owner, [b for b, _ in load], shards, EVEN)
    return place(records, save_map(spark, path, version + 1, owner, load))

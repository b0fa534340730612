"""WARC archives: writing, and reading with boundary-chain verification.

``write`` makes a folder of uncompressed WARC/1.1 files, one record for each page. Pages with equal payloads
share one response record; the others revisit it and carry the HTTP head alone.

``read`` does not trust the record magic, which a payload may hold as well. Tasks read a split of a file in
pieces that begin at a magic, and emit each as a candidate with the place where its record ends - where the
next must begin. Within a split a candidate's chain is followed to where it leaves the split; pointer
jumping over the splits then finds, from the start of every file, where the true chain enters each split.
Only candidates on that chain are records. A record that magic in its payload has cut into several
candidates is put together again from the pieces that it spans.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardmill.llm.common import in_batches, stored

MAGIC = "WARC/1.1\r\n"
#: Payloads of at least so many bytes are deduplicated.
LEAST = 0
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_URN = "urn:wardmill:page:"


def _digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bytes as four groups of 40 bits, eight characters each."""
    hexed = F.sha1(payload)
    out = []
    for k in range(4):
        bits = F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            out.append(F.substring(F.lit(_BASE32), (F.shiftright(bits, shift).bitwiseAND(31) + 1).cast("int"), F.lit(1)))
    return F.concat(*out)


def _head(url: Column) -> Column:
    """A value that fits on a header line: line breaks become blanks."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ")


def archived(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, payload_digest, refers_to): refers_to is null for a response.

    Of pages with equal payloads the one with the largest page_id is the response. A null html is an empty
    payload. Pages without an id are responses of their own and refer to none.
    """
    given = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    key = F.sha2("payload", 256)
    wide = F.octet_length("payload") >= least
    keyed = given.where(wide & F.col("page_id").isNotNull()).select("page_id", key.alias("key"))
    latest = stored(
        keyed.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low")).where("low < refers_to")
    )
    # Read back, the table of revisits has a known size: Spark sends it to the pages if it is small.
    revisits = stored(
        keyed.join(latest.select("key", "refers_to"), "key").where("page_id <> refers_to").select(F.col("page_id").alias("revisit"), "key", "refers_to").distinct()
    )
    joined = given.withColumn("own", key).join(revisits, (F.col("page_id") == F.col("revisit")) & (F.col("own") == F.col("key")), "left")
    return joined.select("page_id", "url", "payload", _digest(F.col("payload")).alias("payload_digest"), "refers_to")


def write(pages: DataFrame, path: str, least: int = LEAST) -> str:
    """Write one record for every page into a new folder of WARC files.

    Every file is written by one task in one go and appears when it is whole, so a lost executor costs a
    repeated task and nothing else.
    """
    given = archived(pages, least)
    revisit = F.col("refers_to").isNotNull()
    size = F.octet_length("payload")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"\r\nWARC-Record-ID: <{_URN}"), name,
        F.lit(">\r\nWARC-Target-URI: "), _head(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.when(
            revisit,
            F.concat(
                F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <" + _URN),
                F.col("refers_to").cast("string"), F.lit(">"),
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"), block,
    )
    given.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "none").text(path)
    return path


def _parse(piece: bytes) -> dict | None:
    """Fields of the record that a piece begins, without its magic; None if it begins none."""
    cut = piece.find(b"\r\n\r\n")
    if cut < 0:
        return None
    fields = {}
    for line in piece[:cut].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields:
        return None
    fields["body"] = cut + 4
    fields["end"] = cut + 4 + int(length)
    return fields


def _number(value: bytes | None) -> int | None:
    text = (value or b"").strip(b"<>").rpartition(b":")[2]
    return int(text) if text.isdigit() else None


def _payload(block: bytes, kind: str) -> tuple[int, str] | None:
    """Size and digest of the payload of a whole block; those of a revisit are told by its HTTP head."""
    head, found, body = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        for line in head.split(b"\r\n"):
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                return int(value), ""
    body = body if found else block
    return len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()


_CANDIDATE = (
    "file string, block long, at long, past long, leaves long, total long, page_id long, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, whole boolean"
)
_NAMES = [c.split()[0] for c in _CANDIDATE.split(", ")]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The candidates of each split, in order; places are counted from the first piece of the split."""
    now, at, rows = None, 0, []

    def flush() -> Iterator[pa.RecordBatch]:
        if not rows:
            return
        leaves = _leaves([r[0] for r in rows], [r[1] for r in rows], at)
        columns = [[now[0]] * len(rows), [now[1]] * len(rows), [r[0] for r in rows], [r[1] for r in rows], leaves, [at] * len(rows)]
        columns += [[r[k] for r in rows] for k in range(2, 8)]
        kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_NAMES)

    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        for k in range(batch.num_rows):
            if (files[k], blocks[k]) != now:
                yield from flush()
                now, at, rows = (files[k], blocks[k]), 0, []
            piece = batch.column("piece")[k].as_py()
            size = len(piece) + len(MAGIC)
            found = _parse(piece)
            if found is None:
                rows.append((at, -1, None, None, None, None, None, False))
            else:
                kind = found[b"warc-type"].decode("utf-8", "replace")
                whole = found["end"] <= len(piece)
                payload = _payload(piece[found["body"] : found["end"]], kind) if whole else (None, None)
                told = found.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode("utf-8", "replace")
                rows.append(
                    (at, at + len(MAGIC) + found["end"] + 4, _number(found.get(b"warc-record-id")), kind,
                     _number(found.get(b"warc-refers-to")), payload[0], (payload[1] or told) if whole else None, whole)
                )
            at += size
    yield from flush()


def _leaves(at: list[int], past: list[int], total: int) -> list[int]:
    """Where the chain of each candidate leaves the split; -1 if it breaks off."""
    place = {a: k for k, a in enumerate(at)}
    out = [-1] * len(at)
    for k in range(len(at) - 1, -1, -1):
        if past[k] >= total:
            out[k] = past[k]
        elif past[k] > at[k]:
            out[k] = out[place[past[k]]] if past[k] in place else -1
    return out


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files cut before each magic: file, start of the split, bytes behind the magic.

    The text before the first magic of a file, which is empty in an archive that begins with a record, is a
    piece as well; it gets the place just before."""
    read = spark.read.option("lineSep", MAGIC).text(path)
    return read.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("piece")
    )


def _follow(rows: pa.Table) -> pa.Table:
    """The candidates of one split on the chain that enters it."""
    at, past = rows.column("at").to_pylist(), rows.column("past").to_pylist()
    place = {a: k for k, a in enumerate(at)}
    keep, here = [], rows.column("enters")[0].as_py()
    while here in place:  # every step leads further on
        keep.append(place[here])
        here = past[place[here]]
    return rows.take(pa.array(keep, pa.int64()))


def read(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, page_id, record_type, refers_to, payload_bytes, payload_digest) of every record in a folder.

    A chain that breaks off - a damaged length, bytes between records - ends the file: what cannot be reached
    from its start is no record. A file without a record at its start gives none. The digest of a response is
    taken from its payload; a revisit tells its own and the size in its head.
    """
    candidates = stored(_pieces(spark, path).transform(in_batches, _candidates, _CANDIDATE))
    # The pieces of a file's splits tile it: a split begins where those before it end.
    sizes = candidates.groupBy("file", "block").agg(F.max("total").alias("size"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = stored(sizes.withColumn("base", F.coalesce(F.sum("size").over(order), F.lit(0)) - len(MAGIC)))
    places = candidates.join(splits, ["file", "block"]).withColumn("start", F.col("base") + F.col("at"))
    entries = _entries(places, splits)

    wanted = [c for c in _NAMES if c not in ("leaves", "total")]
    placed = candidates.select(*wanted).join(entries, ["file", "block"]).select(*wanted, "base", "enters")
    found = placed.groupBy("file", "block").applyInArrow(_follow, placed.schema)
    records = stored(
        found.select("*", (F.col("base") + F.col("at")).alias("start"), (F.col("base") + F.col("past")).alias("stop"))
    )
    names = ["file", F.col("start").alias("at"), "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    out = records.where("whole").select(*names)
    torn = records.where("not whole").select("file", "start", "stop")
    return out if torn.isEmpty() else out.union(_mended(spark, path, places, records).select(*names))


def _entries(places: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, block, base, enters): where the chain from the start of the file enters each split."""
    jumps = places.where("leaves >= 0").select("file", F.col("start").alias("here"), (F.col("base") + F.col("leaves")).alias("there"))
    heads = splits.select("file").distinct().withColumn("here", F.lit(0).cast("long"))
    # Only candidates at which a chain enters a split matter: starts of files, and targets of jumps.
    targets = jumps.select("file", F.col("there").alias("here")).union(heads).distinct()
    jumps = stored(jumps.join(targets, ["file", "here"]))
    reached, count = stored(heads), 0
    while (now := reached.count()) != count:
        count = now
        step = reached.join(jumps, ["file", "here"]).select("file", F.col("there").alias("here"))
        reached = stored(reached.union(step).distinct())
        onward = jumps.select("file", F.col("here").alias("there"), F.col("there").alias("next"))
        jumps = stored(jumps.join(onward, ["file", "there"], "left").select("file", "here", F.coalesce("next", "there").alias("there")))
    met = places.select("file", "block", "base", "at", F.col("start").alias("here")).join(reached, ["file", "here"])
    return stored(met.groupBy("file", "block", "base").agg(F.min("at").alias("enters")))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the place that they have as candidates."""
    now, at = None, 0
    for batch in batches:
        places = []
        for file, block, size in zip(
            batch.column("file").to_pylist(), batch.column("block").to_pylist(), pa.compute.binary_length(batch.column("piece")).to_pylist()
        ):
            if (file, block) != now:
                now, at = (file, block), 0
            places.append(at)
            at += size + len(MAGIC)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64())], names=["file", "block", "piece", "at"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, digest = [], []
        for parts, kind in zip(batch.column("parts").to_pylist(), batch.column("record_type").to_pylist()):
            whole = MAGIC.encode().join(p["piece"] for p in parts)
            found = _parse(whole)
            cut = whole[found["body"] : found["end"]]
            payload = _payload(cut, kind) if len(cut) == found["end"] - found["body"] else (None, None)
            size.append(payload[0])
            digest.append(payload[1] or found.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode() if payload[0] is not None else None)
        kept = [batch.column(c) for c in ("file", "start", "page_id", "record_type", "refers_to")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(size, pa.int64()), pa.array(digest, pa.string())],
            names=["file", "start", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"],
        )


def _mended(spark: SparkSession, path: str, places: DataFrame, records: DataFrame) -> DataFrame:
    """Records whose block goes on behind a magic, from the pieces between their start and their end."""
    marks = records.select("file", "start", F.struct("start", "stop", "whole", "page_id", "record_type", "refers_to").alias("record"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owned = places.select("file", "block", "at", "start").join(marks, ["file", "start"], "left")
    owned = owned.withColumn("record", F.last("record", ignorenulls=True).over(before))
    owned = stored(owned.where("not record.whole and start < record.stop").select("file", "block", "at", F.col("start").alias("place"), "record"))
    pieces = _pieces(spark, path).transform(in_batches, _numbered, "file string, block long, piece binary, at long")
    parts = pieces.join(owned, ["file", "block", "at"]).groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("place", "piece"))).alias("parts")
    )
    return parts.select("file", "record.*", "parts").transform(
            in_batches,
        _joined,
        "file string, start long, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string",
    )

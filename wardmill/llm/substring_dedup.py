"""Substring dedup over windows of words, dealt by minimizer.

A window of ``K`` words is repeated when the same words, told by a hash of 64 bits, also begin in a document with a
smaller doc_id; every word inside a repeated window goes.

Consecutive windows that share their minimizer (the smallest hash among their ``M``-word grams) are one run, and
equal windows have equal minimizers, so the minimizer says in which bucket windows meet. A slice of the input sends
each bucket one row, with the runs as packed arrays; a window that a smaller document of the same slice already
has is decided there and not sent, so a passage that a third of all documents hold arrives once a slice.
Minimizers that a sample of the documents shows to be frequent do not deal their runs: each window goes by its own
hash, so a hot phrase with ever different words around it spreads over all buckets. The sample decides
where windows meet, never whether. In a bucket every window learns the coordinates of its first source.
Windows that advance in step with their source compact into long spans in a window function, and the coordinates
hold a span together: a span ends where its source branches off.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardmill.llm import words
from wardmill.llm.common import in_batches, stored

K = 13
M = 5
#: Buckets for each shuffle partition; a task holds one at a time.
BUCKETS = 16
#: One document in so many is read for frequent minimizers.
SAMPLE = 32
_U = np.uint64
_SPAN = "doc_id long, th long, at long, size long, source long, source_at long"
_PIECE = "bucket long, ids binary, ths binary, doc binary, at binary, size binary, windows binary"


def _texts(batch: pa.RecordBatch):
    """(ids, hashes of the texts, bytes, bounds) of the slices of a batch."""
    ids, ths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
    for lo, hi, data, bounds in words.slices(batch.column("text")):
        yield ids[lo:hi], ths[lo:hi], data, bounds


def _runs(doc, th, at, source, source_at) -> list[np.ndarray]:
    """Windows in order of (doc, th, at) to (doc, th, first, number, source, source's first) runs in step."""
    if not len(doc):
        return [np.empty(0, np.int64)] * 6
    cut = np.ones(len(doc), bool)
    cut[1:] = (
        (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (at[1:] != at[:-1] + 1) | (source[1:] != source[:-1])
        | (source_at[1:] != source_at[:-1] + 1)
    )
    first = np.flatnonzero(cut)
    return [doc[first], th[first], at[first], np.diff(np.append(first, len(doc))), source[first], source_at[first]]


def _batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    names = ["doc_id", "th", "at", "size", "source", "source_at"]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)


def _windows(ids: np.ndarray, data: np.ndarray, bounds: np.ndarray):
    """Of a slice: word hashes, and of every window its first word, hash, row, place, and the first equal window."""
    start, end, row = words.spans(data, bounds, words.SPACES)
    word = words.span_hashes(data, start, end)
    gram = words.grams(word, K)
    if not len(gram):
        return None
    at = np.arange(len(start)) - np.searchsorted(row, np.arange(len(bounds) - 1), "left")[row]
    index = np.flatnonzero(row[: len(gram)] == row[K - 1 :])
    gram, row, at = gram[index], row[index], at[index]
    order = np.lexsort((at, ids[row], gram))
    new = np.ones(len(order), bool)
    new[1:] = gram[order][1:] != gram[order][:-1]
    first = np.empty(len(order), np.int64)
    first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    return word, index, gram, row, at, first


def _minimizers(word: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For each window the place of its smallest gram among all grams of the slice, and that gram's hash."""
    small = words.grams(word, M)
    view = np.lib.stride_tricks.sliding_window_view(small, K - M + 1)
    place = np.empty(len(view), np.int64)
    for k in range(0, len(view), 1 << 16):
        place[k : k + (1 << 16)] = np.argmin(view[k : k + (1 << 16)], axis=1)
    place = (place + np.arange(len(view)))[index]
    return place, small[place]


@words.frugal
def _local_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, ths, data, bounds in _texts(batch):
            found = _windows(ids, data, bounds)
            if found is not None:
                _, _, _, row, at, first = found
                hit = np.flatnonzero(ids[row[first]] < ids[row])
                yield _batch(_runs(ids[row[hit]], ths[row[hit]], at[hit], ids[row[first[hit]]], at[first[hit]]))


def _cut(place: np.ndarray, index: np.ndarray, alone: np.ndarray) -> np.ndarray:
    """Where a run begins: another minimizer, a gap, or a window that stands alone."""
    cut = np.ones(len(place), bool)
    cut[1:] = (place[1:] != place[:-1]) | (index[1:] != index[:-1] + 1) | alone[1:]
    return cut


@words.frugal
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(minimizer, n): the windows that a minimizer would bring to its bucket, slice by slice."""
    for batch in batches:
        for ids, _, data, bounds in _texts(batch):
            found = _windows(ids, data, bounds)
            if found is not None:
                word, index, _, row, _, first = found
                send = np.flatnonzero(ids[row[first]] == ids[row])
                value, n = np.unique(_minimizers(word, index[send])[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([words.signed(value), pa.array(n)], names=["minimizer", "n"])


def _pieces(buckets: int, hot: np.ndarray) -> Callable:
    @words.frugal
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, ths, data, bounds in _texts(batch):
                found = _windows(ids, data, bounds)
                if found is None:
                    continue
                word, index, gram, row, at, first = found
                # Decided here: windows that a smaller document of the slice has. Of equal rows one speaks for all.
                send = np.flatnonzero(ids[row[first]] == ids[row])
                if not len(send):
                    continue
                index, gram, row, at = index[send], gram[send], row[send], at[send]
                place, smallest = _minimizers(word, index)
                alone = np.isin(smallest, hot)
                begin = np.flatnonzero(_cut(place, index, alone | np.append(False, alone[:-1])))
                size = np.diff(np.append(begin, len(index)))
                bucket = (words.mix(np.where(alone, gram, smallest)[begin]) % _U(buckets)).astype(np.int64)
                order = np.lexsort((begin, bucket))
                yield _packed(bucket[order], ids, ths, row[begin[order]], at[begin[order]], size[order], begin[order], gram)

    return emit


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in two bytes each if all fit, else in four."""
    return x.astype(np.uint16 if x.max(initial=0) < 1 << 16 else np.uint32)


def _widened(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 * n else np.uint32)


def _packed(bucket, ids, ths, row, at, size, begin, gram) -> pa.RecordBatch:
    """One row for each bucket; the runs are in order of their bucket."""
    edge = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    window = np.append(0, np.cumsum(size))
    values = gram[np.repeat(begin - window[:-1], size) + np.arange(window[-1])]
    columns: list[list[bytes]] = [[] for _ in range(6)]
    for lo, hi in zip(edge[:-1], edge[1:]):
        held, doc = np.unique(row[lo:hi], return_inverse=True)
        parts = (
            ids[held], ths[held], _narrow(doc), _narrow(at[lo:hi]), size[lo:hi].astype(np.uint8), values[window[lo] : window[hi]]
        )
        for column, part in zip(columns, parts):
            column.append(part.tobytes())
    arrays = [pa.array(bucket[edge[:-1]]), *[pa.array(c, pa.binary()) for c in columns]]
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "ids", "ths", "doc", "at", "size", "windows"])


def _opened(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """(doc, th, at, hash) of all windows in the rows of a bucket."""
    out = []
    for r in rows:
        size = np.frombuffer(r["size"], np.uint8).astype(np.int64)
        run = np.repeat(np.arange(len(size)), size)
        doc = _widened(r["doc"], len(size))[run]
        step = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        at = _widened(r["at"], len(size))[run].astype(np.int64) + step
        out.append((np.frombuffer(r["ids"], np.int64)[doc], np.frombuffer(r["ths"], np.int64)[doc], at, np.frombuffer(r["windows"], _U)))
    return tuple(np.concatenate(c) for c in zip(*out))


@words.frugal
def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of their bucket to repeated windows, as runs in step with their source."""
    def judged(rows: list[dict]) -> pa.RecordBatch:
        doc, th, at, value = _opened(rows)
        order = np.lexsort((at, doc, value))
        new = np.ones(len(order), bool)
        new[1:] = value[order][1:] != value[order][:-1]
        first = np.empty(len(order), np.int64)
        first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        hit = np.flatnonzero(doc[first] < doc)
        hit = hit[np.lexsort((at[hit], th[hit], doc[hit]))]
        return _batch(_runs(doc[hit], th[hit], at[hit], doc[first[hit]], at[first[hit]]))

    held, bucket = [], None
    for batch in batches:
        for r in batch.to_pylist():
            if held and r["bucket"] != bucket:
                yield judged(held)
                held = []
            bucket = r["bucket"]
            held.append(r)
    if held:
        yield judged(held)


def _frequent(given: DataFrame, buckets: int) -> np.ndarray:
    """Minimizers whose windows alone would fill a bucket, by a sample of the documents. There are at most as many
    as buckets, so the driver gets a list that grows with the partitions and not with the texts."""
    sample = given.where(F.pmod(F.xxhash64("doc_id", "th"), F.lit(SAMPLE)) == 0)
    counts = sample.transform(in_batches, _counted, "minimizer long, n long").groupBy("minimizer").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(F.spark_partition_id())
    share = counts.withColumn("all", F.sum("n").over(whole))  # of a partition: about 1 / partitions of everything
    # A bucket's fill is 1 / BUCKETS of a partition's; a minimizer of less than that cannot crowd a task.
    frequent = share.where((F.col("n") * BUCKETS >= F.col("all")) & (F.col("n") >= 8)).select("minimizer")
    return np.array([r[0] for r in frequent.limit(buckets).collect()], np.int64).view(_U)


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): ``th`` tells rows that share an id but not their text apart. It is a hash of the text for
    such ids and 0 for all others, which costs nothing where it travels. The ids in question are a stored table, which
    Spark broadcasts or shuffles by its measured size."""
    text = F.col("text").cast("string")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    unlike = given.where("doc_id is not null").groupBy("doc_id").agg(F.min("th").alias("a"), F.max("th").alias("b"))
    unlike = stored(unlike.where("a <> b").select("doc_id", F.lit(True).alias("unlike")))
    own = F.when(F.col("unlike"), F.col("th")).otherwise(F.lit(0).cast("long"))
    return given.join(unlike, "doc_id", "left").select("doc_id", own.alias("th"), "text")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, first_word, n_words, source, source_word): long spans that a smaller document also has.

    Every repeated window is in one span. Rows with a null doc_id or text, and texts of fewer than K words,
    have no windows. Rows that share an id but not their text are judged each (``th``, see ``identified``).
    """
    return _spans_of(identified(docs))


def _spans_of(rows: DataFrame) -> DataFrame:
    spark: SparkSession = rows.sparkSession
    given = rows.where("doc_id is not null and text is not null")
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = given.transform(in_batches, _local_spans, _SPAN)
    pieces = given.transform(in_batches, _pieces(buckets, _frequent(given, buckets)), _PIECE)
    met = pieces.repartition("bucket").sortWithinPartitions("bucket").transform(in_batches, _met, _SPAN)

    # Compact: pieces that touch and keep the distance to their source are one span.
    in_step = Window.partitionBy("doc_id", "th", "source", "step").orderBy("at", "size")
    parts = local.union(met).withColumn("step", F.col("at") - F.col("source_at"))
    reach = F.max(F.col("at") + F.col("size")).over(in_step.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("new", (F.col("at") > F.coalesce(reach, F.lit(-1))).cast("int"))
    parts = parts.withColumn("span", F.sum("new").over(in_step))
    spans = parts.groupBy("doc_id", "th", "source", "step", "span").agg(
        F.min("at").alias("first_word"), F.max(F.col("at") + F.col("size")).alias("past"), F.min("source_at").alias("source_word")
    )
    return spans.select(
        "doc_id", "th", "first_word", (F.col("past") - F.col("first_word") + K - 1).alias("n_words"), "source", "source_word"
    )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        spans = batch.column("spans").to_pylist()
        total, gone, out = [], [], []
        for text, cut in zip(texts, spans):
            held = (text or b"").split()
            total.append(len(held))
            if cut:
                keep = np.ones(len(held), bool)
                for span in cut:
                    keep[span["at"] : span["past"]] = False
                held = [held[k] for k in np.flatnonzero(keep)]
            gone.append(total[-1] - len(held))
            out.append(b" ".join(held))
        columns = [batch.column("doc_id"), pa.array(total), pa.array(gone), pa.array(out, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of ``docs``; the kept words joined by one space.

    Null and empty texts have no words and an empty kept_text. Rows with a null doc_id lose nothing. Rows
    repeated in full lose the same words, as an id is no smaller than itself; rows that share an id but not
    their text are judged each on its own. Columns but doc_id and text are ignored.
    """
    past = F.col("first_word") + F.col("n_words")
    given = identified(docs)
    spans = _spans_of(given).groupBy("doc_id", "th").agg(F.collect_set(F.struct(F.col("first_word").alias("at"), past.alias("past"))).alias("spans"))
    return given.join(spans, ["doc_id", "th"], "left").select("doc_id", "text", "spans").transform(
        in_batches, words.frugal(_removed), "doc_id long, n_words long, n_removed long, kept_text string"
    )

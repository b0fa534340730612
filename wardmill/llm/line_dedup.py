"""Line dedup by winnowing over line hashes.

A run of ``RUN`` consecutive lines (blank lines do not count and stay) that also occurs earlier - in a
document with a smaller doc_id, or higher up in the same one - is deleted. Of every ``RUN`` lines the one
with the smallest hash is a fingerprint, so two equal runs have a fingerprint at the same place. Positions
of fingerprints that occur once are dropped; the others are joined with the first position that has the
same lines around it, extended to both sides within the run. What is deleted is the union of the runs, so
longer matches go as a whole.

No positions are paired with each other: each is compared with the first position of its kind, which a
partial aggregate finds, so a line that a third of all documents hold costs one row for each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardmill.llm import words
from wardmill.llm.common import id_of, in_batches, stored

RUN = 3


def _full_lines(data: np.ndarray, bounds: np.ndarray):
    """Start, end and row of the lines that are not blank, and whether each line of all is."""
    start, end, row = words.lines(data, bounds)
    word, _, _ = words.spans(data, bounds, words.SPACES)
    full = np.searchsorted(word, end, "left") > np.searchsorted(word, start, "left")
    return start, end, row, full


def _fingerprints(run: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in words.slices(batch.column("text")):
                start, end, row, full = _full_lines(data, bounds)
                row = row[full]
                line = words.span_hashes(data, start[full], end[full])
                if len(line) < run:
                    continue
                low = np.lib.stride_tricks.sliding_window_view(line, run).argmin(axis=1) + np.arange(len(line) - run + 1)
                pick = np.unique(low[row[: len(low)] == row[run - 1 :]])
                first = np.searchsorted(row, row[pick], "left")
                past = np.searchsorted(row, row[pick], "right")
                before, after = np.minimum(pick - first, run - 1), np.minimum(past - pick - 1, run - 1)
                size = before + after + 1
                place = np.repeat(pick - before - (np.cumsum(size) - size), size)
                place += np.arange(len(place))
                owner = pa.array(row[pick] + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(owner),
                        batch.column("th").take(owner),
                        pa.array((pick - first).astype(np.int32)),
                        words.signed(line[pick]),
                        pa.array(before.astype(np.int32)),
                        words.lists(line[place].view(np.int64), size),
                    ],
                    names=["id", "th", "at", "print", "before", "around"],
                )

    return emit


def repeated_runs(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(id, th, runs): for each document with deletions the first and last line, not counting blank ones, of
    the runs that occur earlier. ``id`` and ``th`` are the id and the hash of the text of a row."""
    given = docs.select(id_of().alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    prints = given.where(F.col("text").isNotNull()).transform(
            in_batches,
        words.frugal(_fingerprints(run)), "id long, th long, at int, print long, before int, around array<long>"
    )
    prints = stored(prints)
    place = F.struct("id", "th", "at")
    shared = stored(
        prints.groupBy("print").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high").select("print")
    )
    # Every window of a run's length around a fingerprint: ``back`` lines before it, the rest behind.
    offsets = F.sequence(F.lit(0), F.lit(run - 1))
    around = prints.join(shared, "print").select(
        "id", "th", "at", "before", "around", F.explode(F.filter(offsets, lambda b: (b <= F.col("before")) & (F.size("around") >= F.col("before") - b + run))).alias("back")
    )
    windows = stored(
        around.select(
            "id", "th", (F.col("at") - F.col("back")).alias("first"),
            F.slice("around", F.col("before") - F.col("back") + 1, run).alias("lines"),
        )
    )
    place = F.struct("id", "th", "first")
    earliest = stored(
        windows.groupBy("lines").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low < high").select("lines", "low")
    )
    later = windows.join(earliest, "lines").where(F.struct("id", "th", "first") > F.col("low"))
    return later.groupBy("id", "th").agg(F.collect_set("first").alias("runs"))


def _deleted(run: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, runs = batch.column("text"), batch.column("runs").to_pylist()
            for lo, hi, data, bounds in words.slices(texts):
                start, end, row, full = _full_lines(data, bounds)
                number = np.cumsum(full) - 1
                first_line = np.searchsorted(row, np.arange(hi - lo + 1), "left")
                total, gone, out = [], [], []
                for k in range(hi - lo):
                    a, b = first_line[k], first_line[k + 1]
                    here = full[a:b]
                    total.append(int(here.sum()))
                    if not runs[lo + k]:
                        gone.append(0)
                        out.append(data[bounds[k] : bounds[k + 1]].tobytes())
                        continue
                    base = int(number[a]) + (0 if full[a] else 1)
                    cut = np.zeros(total[-1], bool)
                    for f in runs[lo + k]:
                        cut[f : f + run] = True
                    keep = np.ones(b - a, bool)
                    keep[here] = ~cut[number[a:b][here] - base]
                    gone.append(int(cut.sum()))
                    out.append(b"\n".join(data[s:e].tobytes() for s, e in zip(start[a:b][keep], end[a:b][keep])))
                columns = [batch.column("row").slice(lo, hi - lo), pa.array(total, pa.int64()), pa.array(gone, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(out, pa.binary()).cast(pa.string())], names=["row", "n_lines", "n_removed", "kept_text"]
                )

    return emit


def without_repeats(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(row, n_lines, n_removed, kept_text) for every row of ``docs``: ``row`` holds its columns but the text,
    ``n_lines`` its lines that are not blank, ``kept_text`` the lines that stay, joined by line feeds.

    A null text has no lines and an empty kept_text. A text of fewer than ``run`` lines loses none. A row with
    a null doc_id comes after all others. Rows repeated in full count as one document and lose the same
    lines. Documents with one id but different texts are in order of a hash of the text. Further columns,
    whatever their names, are passed through.
    """
    found = repeated_runs(docs, run).withColumnsRenamed({"id": "run_id", "th": "run_th"})
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "text"]
    given = docs.select(
        F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"), id_of().alias("id"), F.xxhash64("text").alias("th")
    )
    joined = given.join(found, (F.col("id") == F.col("run_id")) & (F.col("th") == F.col("run_th")), "left")
    joined = joined.select("row", "text", "runs")
    schema = joined.select(
        "row", F.lit(0).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_text")
    ).schema
    return joined.transform(in_batches, words.frugal(_deleted(run)), schema)

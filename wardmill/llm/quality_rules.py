"""Quality rules: a decision list learned from labelled statistics and applied as a Spark expression.

``statistics`` measures every whole text. ``learn`` grows and prunes threshold conjunctions by sequential
covering: each round grows one conjunction that separates low-quality documents on a grow set, prunes it
from the end on a prune set, and takes the documents it covers out of play, until no rule is precise
enough. ``verdict`` writes the list as one ``CASE WHEN``: the first rule that fires decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardmill.llm import words
from wardmill.llm.common import in_batches, stored

REPEAT_WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes", "n_stops", "n_upper"]
#: What a condition may test; ratios, so that a rule means the same for texts of any length.
FEATURES = {
    "words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_words, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "stops": "n_stops / greatest(n_words, 1)",
    "upper": "n_upper / greatest(word_chars, 1)",
    "bytes_a_word": "n_bytes / greatest(n_words, 1)",
}
#: Labelled documents that a list is learned from: the first by hash of the id.
SAMPLE = 20_000


def _text_statistics(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(bounds) - 1
    start, end, row = words.spans(data, bounds, words.SPACES)
    count = words.counts(row, rows)

    def by_row(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    # Code points of words: bytes that continue none, and are no separators.
    chars = by_row(((data & 0xC0) != 0x80) & ~words.SPACES[data])
    hashes = words.span_hashes(data, start, end)

    # Words in windows of three that the text holds twice or more.
    gram = words.grams(hashes, REPEAT_WINDOW)
    hit = np.zeros(len(start), bool)
    if len(gram):
        own = row[: len(gram)]
        whole = np.flatnonzero(own == row[REPEAT_WINDOW - 1 :])
        hit[whole[_repeated(gram[whole], own[whole])[0]]] = True
    repeat = words.counts(row[words.covered(hit, REPEAT_WINDOW, len(start))], rows)

    # Lines with a word that equal an earlier line of the text.
    line_start, line_end, line_row = words.lines(data, bounds)
    keep = np.flatnonzero(np.searchsorted(start, line_end, "left") > np.searchsorted(start, line_start, "left"))
    line = words.span_hashes(data, line_start[keep], line_end[keep])
    later = _repeated(line, line_row[keep])[1]
    dup = words.counts(line_row[keep][later], rows)

    short = (end - start <= 3) & (data[np.minimum(start, max(len(data) - 1, 0))] >= 97) if len(data) else start > 0
    return {
        "n_words": count,
        "word_chars": chars,
        "n_symbols": by_row(_SYMBOL[data]),
        "n_dup_lines": dup,
        "n_repeat_words": repeat,
        "n_bytes": np.diff(bounds).astype(np.int64),
        "n_stops": words.counts(row[short], rows),
        "n_upper": by_row((data >= 65) & (data <= 90)),
    }


def _repeated(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of (key, row) pairs found twice or more, and of those that are not the first of theirs."""
    order = np.lexsort((key, row))
    same = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    later = np.concatenate([[False], same]) if len(order) else np.empty(0, bool)
    any_ = later.copy()
    any_[:-1] |= later[1:]
    return order[any_], order[later]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, bounds in words.slices(batch.column("text")):
            found = _text_statistics(data, bounds)
            columns = [batch.column("doc_id").slice(lo, hi - lo), *(pa.array(found[c]) for c in STATISTICS)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *STATISTICS])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text; a null text has no words, lines or symbols.

    Only the columns doc_id and text are read; a null doc_id stays null, repeated rows are measured each.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.transform(in_batches, _measure, "doc_id long, " + ", ".join(f"{c} long" for c in STATISTICS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Documents that meet all (feature, '<' or '>=', threshold) conditions are rejected."""

    conditions: tuple[tuple[str, str, float], ...]
    precision: float
    support: int

    def covers(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, sign, at in self.conditions:
            out &= x[name] < at if sign == "<" else x[name] >= at
        return out

    def expression(self) -> Column:
        out = F.lit(True)
        for name, sign, at in self.conditions:
            value = F.expr(FEATURES[name])
            out = out & (value < at if sign == "<" else value >= at)
        return out


def _gain(p: np.ndarray, n: np.ndarray, p0: float, n0: float) -> np.ndarray:
    """Information gain of a narrower rule, weighted by the bad documents that it keeps."""
    return p * (np.log2((p + 1e-9) / (p + n + 1e-9)) - np.log2((p0 + 1e-9) / (p0 + n0 + 1e-9)))


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int = 4) -> list[tuple[str, str, float]]:
    here, conditions = np.ones(len(bad), bool), []
    for _ in range(most):
        p0, n0 = float(bad[here].sum()), float((~bad[here]).sum())
        if n0 == 0 or p0 == 0:
            break
        best = (1e-6, None)
        for name, value in x.items():
            v, b = value[here], bad[here]
            cuts = np.unique(np.quantile(v, np.linspace(0.005, 0.995, 100)))
            order = np.argsort(v, kind="stable")
            below = np.searchsorted(v[order], cuts, "left")
            p_below = np.concatenate([[0], np.cumsum(b[order])])[below].astype(float)
            n_below = below - p_below
            for sign, p, n in (("<", p_below, n_below), (">=", p0 - p_below, n0 - n_below)):
                gain = _gain(p, n, p0, n0)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), (name, sign, float(cuts[k])))
        if best[1] is None:
            break
        conditions.append(best[1])
        name, sign, at = best[1]
        here &= x[name] < at if sign == "<" else x[name] >= at
    return conditions


def _prune(conditions: list, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule | None:
    """The prefix of the conditions with the best (p - n) / (p + n) on the prune set."""
    best, chosen = -2.0, None
    for k in range(1, len(conditions) + 1):
        rule = Rule(tuple(conditions[:k]), 0.0, 0)
        hit = rule.covers(x)
        p, n = int(bad[hit].sum()), int((~bad[hit]).sum())
        value = (p - n) / (p + n) if p + n else -2.0
        if value > best + 1e-12:
            best, chosen = value, Rule(rule.conditions, p / (p + n), p + n)
    return chosen


def learn(x: dict[str, np.ndarray], bad: np.ndarray, least_precision: float = 0.9, most_rules: int = 12, seed: int = 7) -> list[Rule]:
    """Ordered rules that reject; no rule where there are too few labels to grow and prune one."""
    side = np.random.default_rng(seed).random(len(bad)) < 2 / 3
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < most_rules:
        grow, prune = left & side, left & ~side
        if bad[grow].sum() < 5 or bad[prune].sum() < 3:
            break
        conditions = _grow({k: v[grow] for k, v in x.items()}, bad[grow])
        rule = _prune(conditions, {k: v[prune] for k, v in x.items()}, bad[prune]) if conditions else None
        if rule is None or rule.precision < least_precision or rule.support < 3:
            break
        rules.append(rule)
        left &= ~rule.covers(x)
    return rules


def learn_from(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Rules for quality 0, from at most ``sample`` labelled documents, the first by hash of the id.

    Labels with a null doc_id or quality are left out; a quality other than 0 counts as good. A doc_id that has
    several labels counts once for each, one that has several rows once, with its smallest statistics, so the driver
    gets ``sample`` rows at most. An empty label table gives no rules.
    """
    wanted = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    wanted = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    wanted = wanted.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    values = F.struct(*[F.expr(e).cast("double").alias(n) for n, e in FEATURES.items()])
    found = measured.where(~base_failed()).join(wanted, "doc_id").groupBy("doc_id", "quality").agg(F.min(values).alias("x"))
    rows = found.select("quality", "x.*").toPandas().sort_values(["quality", *FEATURES], kind="stable")
    x = {n: rows[n].to_numpy(float) for n in FEATURES}
    return learn(x, rows["quality"].to_numpy() == 0)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that fires, from 1; 0 if none does."""
    out = F
    for k, rule in enumerate(rules, 1):
        out = out.when(rule.expression(), F.lit(k))
    return out.otherwise(F.lit(0)) if rules else F.lit(0)


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, the statistics, base_failed, rule (0: none) and kept for every row of ``docs``.

    Null and empty texts fail the base rule (no words). Other columns of either table are ignored.
    """
    measured = stored(statistics(docs))
    rules = learn_from(measured, labels, sample)
    out = measured.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))

"""License scan with ordered signature rules.

Every rule is gated by a keyword that all of its matches hold: its expression runs only over texts in which
a run of ASCII letters and digits begins with the keyword, as `gplv3` does, or, where the rule itself begins
with the keyword and asks for nothing before it, texts that hold it anywhere. Detections are intervals of the lower-cased text. Of two detections where one lies
inside the other, or that cover the same interval, only the one of the better rule stays: first by
priority, then by length, then by place and name.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardmill.llm.common import in_batches
from wardmill.llm import license_rules, words

_DETECTION = pa.struct(
    [("label", pa.string()), ("rule", pa.string()), ("start", pa.int64()), ("past", pa.int64()), ("confidence", pa.float64())]
)
_SCHEMA = (
    "doc_id long, n_words long, base array<struct<label: string, word: long>>, "
    "detections array<struct<label: string, rule: string, start: long, past: long, confidence: double>>"
)


def _hash(text: str) -> int:
    data = np.frombuffer(text.encode(), np.uint8)
    return words.span_hashes(data, np.array([0]), np.array([len(data)]))[0]


class Scanner:
    def __init__(self):
        self.rules = license_rules.build()
        keys = {w for phrase in license_rules.BASE for w in phrase}
        hashes = {_hash(k): k for k in keys}
        self.keys = np.array(sorted(hashes), np.uint64)
        self.names = [hashes[k] for k in self.keys.tolist()]
        self.number = {n: k for k, n in enumerate(self.names)}
        self.by_keyword: dict[str, list[license_rules.Rule]] = {}
        for r in self.rules:
            self.by_keyword.setdefault(r.keyword, []).append(r)
        self.anywhere = sorted({r.keyword for r in self.rules if r.pattern.pattern.startswith(r.keyword)})
        self.leading = sorted(set(self.by_keyword) - set(self.anywhere))
        self.first_two = np.zeros(1 << 16, bool)
        self.first_two[[k.encode()[0] << 8 | k.encode()[1] for k in self.leading]] = True

    def gated(self, low: np.ndarray, bounds: np.ndarray) -> dict[int, set[str]]:
        """The keywords whose rules may match, by row of the lower-cased texts."""
        found: dict[int, set[str]] = {}
        raw = low.tobytes()
        for keyword in self.anywhere:
            at = raw.find(keyword.encode())
            while at >= 0:
                row = int(np.searchsorted(bounds, at, "right")) - 1
                found.setdefault(row, set()).add(keyword)
                at = raw.find(keyword.encode(), int(bounds[row + 1]))
        begins = ~words.PUNCTUATION[low] & (low < 128)
        begins[1:] &= ~begins[:-1]
        edge = bounds[1:-1]
        edge = edge[edge < len(low)]
        begins[edge] = True
        start = np.flatnonzero(begins[:-1])
        two = low[start].astype(np.int64) << 8 | low[start + 1]
        start, two = start[self.first_two[two]], two[self.first_two[two]]
        for keyword in self.leading:
            name = np.frombuffer(keyword.encode(), np.uint8)
            at = start[(two == (int(name[0]) << 8 | int(name[1]))) & (start + len(name) <= len(low))]
            for k in range(2, len(name)):
                at = at[low[at + k] == name[k]]
            for row in np.unique(np.searchsorted(bounds, at, "right") - 1).tolist():
                found.setdefault(row, set()).add(keyword)
        return found

    def phrase_words(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the word of a base phrase that each word is, -1 for other words."""
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)

    def detections(self, text: str, held: set[str]) -> list[dict]:
        found = []
        for keyword in sorted(held):
            for rule in self.by_keyword.get(keyword, ()):
                for m in rule.pattern.finditer(text):
                    found.append((rule.priority, -(m.end() - m.start()), m.start(), rule.name, m.end(), rule))
        found.sort(key=lambda d: d[:4])
        # No kept interval lies in another, so starts and ends ascend together.
        starts: list[int] = []
        kept: list[dict] = []
        for _, _, start, name, past, rule in found:
            k = bisect.bisect_right(starts, start)
            inside = k > 0 and past <= kept[k - 1]["past"]
            j = bisect.bisect_left(starts, start)
            around = j < len(kept) and kept[j]["past"] <= past
            if not inside and not around:
                starts.insert(k, start)
                kept.insert(k, {"label": rule.label, "rule": name, "start": start, "past": past, "confidence": rule.confidence})
        return kept


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scanner = Scanner()
    phrases = [([scanner.number[w] for w in p], label) for p, label in license_rules.BASE.items()]
    for batch in batches:
        for lo, hi, data, bounds in words.slices(batch.column("text")):
            low = words.LOWER[data]
            start, end, row = words.spans(low, bounds, words.PUNCTUATION)
            key = scanner.phrase_words(words.span_hashes(low, start, end))
            for k in np.flatnonzero(key >= 0):  # a hash is no proof
                if low[start[k] : end[k]].tobytes() != scanner.names[key[k]].encode():
                    key[k] = -1
            begin = np.searchsorted(row, np.arange(hi - lo), "left")
            base: list[list[dict]] = [[] for _ in range(hi - lo)]
            found: list[list[dict]] = [[] for _ in range(hi - lo)]
            for phrase, label in phrases:
                n = len(phrase)
                if len(key) < n:
                    continue
                hit = row[: len(key) - n + 1] == row[n - 1 :]
                for k, word in enumerate(phrase):
                    hit &= key[k : len(key) - n + 1 + k] == word
                for at in np.flatnonzero(hit):
                    base[row[at]].append({"label": label, "word": int(at - begin[row[at]])})
            for r, held in scanner.gated(low, bounds).items():
                text = low[bounds[r] : bounds[r + 1]].tobytes().decode("utf-8", "replace")
                found[r] = scanner.detections(text, held)
            places = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array(words.counts(row, hi - lo)),
                    pa.array(base, places),
                    pa.array(found, pa.list_(_DETECTION)),
                ],
                names=["doc_id", "n_words", "base", "detections"],
            )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, base, detections) for every row of ``docs``.

    ``base`` holds each place of a base phrase (label and number of its first word), ``detections`` what the
    rules find, with the interval of characters. A null text is empty: no words, no places. Repeated rows are
    scanned each; columns but doc_id and text are not read.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.transform(in_batches, _scan, _SCHEMA)

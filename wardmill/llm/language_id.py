"""Language identification: a bidirectional gated recurrent network over bytes.

The network reads every run of bytes between white space (cut after ``CUT`` bytes) from both ends and gives
every byte position a probability for each language; a document's probabilities are the mean over all of
its positions. The state starts anew at each run, so equal runs have equal labels: a task computes a run
once and counts it as often as it occurs, which reads whole texts at the cost of their distinct words.
The network is trained in numpy by backpropagation through time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from wardmill.llm.common import in_batches, stored
from wardmill.llm.words import frugal, slices
from wardmill.operators import stratified

UNKNOWN = "und"
CUT = 32
HIDDEN = 16
#: Labelled documents of each language that are read for training, and runs of each.
SAMPLE, SAMPLE_WORDS = 500, 60
#: Labels that are learned.
LANGUAGES = 256
#: Runs whose labels a task keeps; beyond that it starts anew.
KEEP = 150_000
#: Bytes of text whose distinct runs are labelled together.
PART = 1 << 20


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Direction:
    """Parameters of one reading direction: input rows by byte, recurrent matrix, biases (gates z, r, n)."""

    w: np.ndarray
    u: np.ndarray
    b: np.ndarray

    @classmethod
    def new(cls, rng, hidden: int) -> "Direction":
        w = rng.normal(0, 0.3, (256, 3 * hidden))
        u = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        return cls(w.astype(np.float32), u.astype(np.float32), np.zeros(3 * hidden, np.float32))

    def forward(self, x: np.ndarray, keep: bool = False):
        """States (T, rows, hidden) for bytes (rows, T)."""
        k = self.u.shape[0]
        h = np.zeros((len(x), k), np.float32)
        states, trace = np.empty((x.shape[1], len(x), k), np.float32), []
        for t in range(x.shape[1]):
            a, g = self.w[x[:, t]] + self.b, h @ self.u
            zr = _sigmoid(a[:, : 2 * k] + g[:, : 2 * k])
            z, r = zr[:, :k], zr[:, k:]
            n = np.tanh(a[:, 2 * k :] + r * g[:, 2 * k :])
            if keep:
                trace.append((h, z, r, n, g[:, 2 * k :]))
            h = n + z * (h - n)
            states[t] = h
        return (states, trace) if keep else states

    def backward(self, x: np.ndarray, trace: list, grad: np.ndarray) -> list[np.ndarray]:
        """Gradients of (w, u, b) through time, from the gradients of the states."""
        k = self.u.shape[0]
        dw, du, db = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.b)
        carry = np.zeros_like(grad[0])
        for t in range(x.shape[1] - 1, -1, -1):
            h, z, r, n, g = trace[t]
            d = grad[t] + carry
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * g * r * (1 - r)
            da = np.concatenate([dz, dr, dn], axis=1)
            dg = np.concatenate([dz, dr, dn * r], axis=1)
            np.add.at(dw, x[:, t], da)
            du += h.T @ dg
            db += da.sum(axis=0)
            carry = d * z + dg @ self.u.T
        return [dw, du, db]


@dataclass
class Network:
    languages: list[str]
    left: Direction
    right: Direction
    v: np.ndarray
    c: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.left.w, self.left.u, self.left.b, self.right.w, self.right.u, self.right.b, self.v, self.c]

    def _output(self, states: np.ndarray) -> np.ndarray:
        score = states @ self.v + self.c
        score = np.exp(score - score.max(axis=-1, keepdims=True))
        return score / score.sum(axis=-1, keepdims=True)

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (T, rows, languages) of every position of equally long runs (rows, T)."""
        ahead, back = self.left.forward(x), self.right.forward(x[:, ::-1])[::-1]
        return self._output(np.concatenate([ahead, back], axis=2))

    def gradients(self, x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over all positions."""
        (ahead, one), (back, two) = self.left.forward(x, True), self.right.forward(x[:, ::-1], True)
        states = np.concatenate([ahead, back[::-1]], axis=2)
        d = self._output(states)
        d[:, np.arange(len(label)), label] -= 1
        d /= np.float32(d.shape[0] * d.shape[1])
        flat, wide = d.reshape(-1, d.shape[2]), states.reshape(-1, states.shape[2])
        ds = d @ self.v.T
        k = ahead.shape[2]
        return [
            *self.left.backward(x, one, ds[:, :, :k]),
            *self.right.backward(x[:, ::-1], two, ds[::-1, :, k:]),
            wide.T @ flat,
            flat.sum(axis=0),
        ]

    def label_positions(self, text: str) -> list[tuple[int, int, str]]:
        """(first byte, past it, language) of the runs of equally labelled bytes of a text."""
        data, out, at = text.encode(), [], 0
        for run in _runs(data):
            at = data.index(run, at)
            best = self.positions(np.frombuffer(run, np.uint8)[None, :])[:, 0].argmax(axis=1)
            for p, k in enumerate(best):
                name = self.languages[k]
                if out and out[-1][1] == at + p and out[-1][2] == name:
                    out[-1] = (out[-1][0], at + p + 1, name)
                else:
                    out.append((at + p, at + p + 1, name))
            at += len(run)
        return out


def _runs(data: bytes) -> list[bytes]:
    return [r if len(r) <= CUT else r[k : k + CUT] for r in data.split() for k in range(0, len(r), CUT)]


def train(samples: list[tuple[bytes, str]], hidden: int = HIDDEN, steps: int = 700, rows: int = 256, seed: int = 5) -> Network:
    """Fit the network to (run, language) samples, every language weighing the same, by Adam."""
    languages = sorted({name for _, name in samples})
    rng = np.random.default_rng(seed)
    net = Network(
        languages, Direction.new(rng, hidden), Direction.new(rng, hidden),
        rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32),
    )
    number = {name: k for k, name in enumerate(languages)}
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for run, name in samples:
        by_length.setdefault(len(run), []).append((run, number[name]))
    share = Counter(name for _, name in samples)
    weight = np.array([1 / share[name] for name in languages])
    buckets = []
    for size, held in sorted(by_length.items()):
        label = np.array([k for _, k in held])
        data = np.frombuffer(b"".join(r for r, _ in held), np.uint8).reshape(-1, size)
        buckets.append((data, label, weight[label] / weight[label].sum(), weight[label].sum() * size))
    chance = np.array([b[3] for b in buckets]) / sum(b[3] for b in buckets)
    params = net.parameters()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        data, label, p, _ = buckets[rng.choice(len(buckets), p=chance)]
        pick = rng.choice(len(data), rows, p=p)
        rate = 0.02 * (1 - step / (steps + 1)) + 1e-4
        for q, g, a, b in zip(params, net.gradients(data[pick], label[pick]), first, second):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            q -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return net


class _Pool:
    """Sums of position probabilities by run, computed when a run is first met."""

    def __init__(self, net: Network):
        self.net, self.place = net, {}
        self.sums = np.empty((0, len(net.languages)), np.float32)

    def learn(self, runs: set[bytes]) -> None:
        if len(self.place) > KEEP:
            self.place, self.sums = {}, self.sums[:0]
        by_length: dict[int, list[bytes]] = {}
        for run in runs:
            if run not in self.place:
                by_length.setdefault(len(run), []).append(run)
        parts = [self.sums]
        for size, held in by_length.items():
            for k in range(0, len(held), 4096):
                some = held[k : k + 4096]
                self.place.update(zip(some, range(len(self.place), len(self.place) + len(some))))
                x = np.frombuffer(b"".join(some), np.uint8).reshape(-1, size)
                parts.append(self.net.positions(x).sum(axis=0))
        self.sums = np.concatenate(parts)

    def document(self, found: Counter) -> np.ndarray:
        at = np.fromiter(map(self.place.__getitem__, found), np.int64, len(found))
        times = np.fromiter(found.values(), np.float64, len(found))
        total = times @ self.sums[at]
        return total / total.sum()


def _predict(net: Network, inside: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = _Pool(net)
        for batch in batches:
            texts = batch.column("text") if inside is None else pc.struct_field(batch.column("row"), [inside])
            for lo, hi, _, _ in slices(texts, PART):
                counted = []
                for text in texts.slice(lo, hi - lo).to_pylist():
                    lettered = any(map(str.isalpha, text or ""))
                    counted.append(Counter(_runs(text.encode())) if lettered else None)
                pool.learn({run for found in counted if found for run in found})
                name, score = [], []
                for found in counted:
                    p = pool.document(found) if found else None
                    k = 0 if p is None else int(p.argmax())
                    name.append(UNKNOWN if p is None else net.languages[k])
                    score.append(0.0 if p is None else min(1.0, float(p[k])))
                columns = [batch.column("row").slice(lo, hi - lo), pa.array(name), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "lang_pred", "score"])

    return run


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id is learned from as little."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


def _spread(most: int):
    """At most ``most`` different runs of each text, evenly spread over all of its runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = []
            for text in batch.column("text"):
                runs = _runs(text.as_py().encode())
                picked.append(list(dict.fromkeys(runs[i * len(runs) // most] for i in range(most))) if runs else [])
            columns = [batch.column("digest"), batch.column("lang"), pa.array(picked, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "lang", "w"])

    return run


def learn_from(docs: DataFrame, sample: int = SAMPLE, sample_words: int = SAMPLE_WORDS) -> Network | None:
    """A network from at most ``sample`` texts of each of the ``LANGUAGES`` most frequent labels (the first by a hash
    of id and text), each giving ``sample_words`` runs spread evenly over the whole text. Repeated rows are one
    text. None if no document can be learned from. The driver gets LANGUAGES * sample * sample_words runs at most.
    """
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    digest = F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("text").cast("string")))
    usable = usable.select(F.col("lang").cast("string").alias("lang"), digest.alias("digest"), F.col("text").cast("string").alias("text"))
    known = stored(usable.select("lang", "digest").distinct())
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return None
    cuts = stratified.cuts_of(known, "lang", F.col("digest"), {r["lang"]: min(r["n"], sample) for r in sizes})
    chosen = usable.where(stratified.chosen("lang", F.col("digest"), cuts))
    held = chosen.transform(in_batches, frugal(_spread(sample_words)), "digest string, lang string, w array<binary>")
    rows = held.groupBy("digest", "lang").agg(F.min("w").alias("w")).collect()
    samples = [(bytes(run), r["lang"]) for r in sorted(rows, key=lambda r: (r["digest"], r["lang"])) for run in r["w"]]
    return train(samples) if samples else None


def predict(docs: DataFrame, net: Network | None, through: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score) for every row of ``docs``, from the whole text alone; ``row`` holds the columns
    named in ``through`` (doc_id by default).

    A null text, an empty one and one without a letter is ``und`` with score 0, as is every text if there is
    no network. Repeated rows are labelled each. Further columns, whatever their names, are not looked at.
    """
    names = through or ["doc_id"]
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    # A text that passes through is sent to the tasks once.
    inside = next((k for k, c in enumerate(names) if c.lower() == "text" and docs.schema[c].dataType == T.StringType()), None)
    given = docs.select(row, *[F.col("text").cast("string").alias("text")] * (inside is None))
    out = given.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return out if net is None else given.transform(in_batches, frugal(_predict(net, inside)), out.schema)

"""Byte-level BPE: encoding with a rank queue over a hierarchical bitmap, and decoding.

A text is cut by the tokenizer's pattern; every match is merged on its own, always the pair of the lowest
rank first, the leftmost of equals. The queue has one bucket of linked-list positions for each merge rank
and three levels of bitmaps over the buckets: find-first-set on each level gives the next rank in constant
time however long the match is, and entries whose pair has changed meanwhile are skipped when met.

``merge`` runs one match. ``merge_all`` runs many matches through one queue: matches do not touch each
other, so the queue may serve them all rank by rank, a bucket at a time in numpy. A bucket may hold
several places of one match; only its leftmost is merged before the queue is asked again.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from wardmill.llm.common import in_batches
from wardmill.llm.words import frugal, lists, slices, span_hashes

#: Matches longer than this are merged alone.
LONG = 256
#: Matches whose ids a task keeps; beyond that it starts anew.
KEEP = 200_000
#: Bytes of text that are cut and encoded together.
PART = 1 << 20


class RankQueue:
    """Buckets of positions by rank; ``first`` finds the lowest rank that has any."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // 64 + 1)
        self.mid = [0] * (ranks // 4096 + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}

    def add(self, rank: int, position) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
            self.top |= 1 << (rank >> 12)
        else:
            bucket.append(position)

    def first(self) -> int:
        if not self.top:
            return -1
        a = (self.top & -self.top).bit_length() - 1
        b = (a << 6) + (self.mid[a] & -self.mid[a]).bit_length() - 1
        return (b << 6) + (self.low[b] & -self.low[b]).bit_length() - 1

    def take(self, rank: int) -> list:
        """Empty a bucket."""
        self.low[rank >> 6] &= ~(1 << (rank & 63))
        if not self.low[rank >> 6]:
            self.mid[rank >> 12] &= ~(1 << ((rank >> 6) & 63))
            if not self.mid[rank >> 12]:
                self.top &= ~(1 << (rank >> 12))
        return self.buckets.pop(rank)


class Vocabulary:
    """Ranks of byte strings, as a file of base64 and rank lines gives them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes_of = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a * self.size + b] = rank
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of ids, -1 where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def merge(self, match: bytes) -> list[int]:
        """Ids of one match."""
        whole = self.ranks.get(match)
        if whole is not None:
            return [whole]
        ids = self.single[np.frombuffer(match, np.uint8)].tolist()
        n, pairs, width = len(ids), self.pairs, self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = RankQueue(width)
        for k in range(n - 1):
            rank = pairs.get(ids[k] * width + ids[k + 1])
            if rank is not None:
                queue.add(rank, k)
        pending: dict[int, int] = {}  # place in a bucket that a lower rank interrupted
        while (rank := queue.first()) >= 0:
            bucket = queue.buckets[rank]
            k = pending.get(rank, 0)
            if k == 0:
                bucket.sort()
            done = len(bucket)
            while k < done:
                p = bucket[k]
                k += 1
                q = after[p]
                if ids[p] < 0 or q >= n or pairs.get(ids[p] * width + ids[q]) != rank:
                    continue  # stale
                ids[p], ids[q] = rank, -1
                r = after[p] = after[q]
                if r < n:
                    before[r] = p
                fresh = []
                if r < n:
                    fresh.append((pairs.get(rank * width + ids[r]), p))
                if before[p] >= 0:
                    fresh.append((pairs.get(ids[before[p]] * width + rank), before[p]))
                for other, place in fresh:
                    if other is not None and other != rank:
                        pending.pop(other, None) if other not in queue.buckets else None
                        if pending.get(other):
                            del queue.buckets[other][: pending.pop(other)]
                        queue.add(other, place)
                    elif other is not None:  # the same bucket, right of here or left of here
                        del bucket[:k]
                        bucket.append(place)
                        bucket.sort()
                        k, done = 0, len(bucket)
                if any(o is not None and o < rank for o, _ in fresh):
                    break
            if k >= len(bucket):
                queue.take(rank)
                pending.pop(rank, None)
            else:
                pending[rank] = k
        return [i for i in ids if i >= 0]

    def merge_all(self, matches: list[bytes]) -> list[np.ndarray]:
        """Ids of every match."""
        size = np.array([len(m) for m in matches])
        data = np.frombuffer(b"".join(matches), np.uint8)
        end = np.cumsum(size)
        owner = np.repeat(np.arange(len(matches)), size)
        n = len(data)
        ids = np.append(self.single[data], -1)
        after = np.append(np.arange(1, n + 1), n)
        before = np.arange(-1, n)
        edge = np.zeros(n + 1, bool)  # the first byte of a match, and the end of all
        edge[0] = True
        edge[end] = True
        pair = np.full(n + 1, -1)  # rank of the pair that begins at a place
        queue = RankQueue(self.size)

        def offer(place: np.ndarray) -> None:
            """Note the pairs that begin at the places and put them into their buckets."""
            right = after[place]
            rank = np.where(edge[right], -1, self.rank_of(ids[place], ids[right]))
            pair[place] = rank
            place, rank = place[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            place, rank = place[order], rank[order]
            cut = (np.flatnonzero(rank[1:] != rank[:-1]) + 1).tolist()
            for lo, hi in zip([0, *cut], [*cut, len(rank)]):
                if hi > lo:
                    queue.add(int(rank[lo]), place[lo:hi])

        offer(np.arange(n))
        while (rank := queue.first()) >= 0:
            parts = queue.take(rank)
            place = parts[0]
            if len(parts) > 1:
                place = np.sort(np.concatenate(parts))
                place = place[np.append(True, place[1:] != place[:-1])]
            place = place[pair[place] == rank]  # others are stale
            if not len(place):
                continue
            if len(place) > 1:
                own = owner[place]
                leftmost = np.append(True, own[1:] != own[:-1])
                if not leftmost.all():
                    queue.add(rank, place[~leftmost])
                    place = place[leftmost]
            right = after[place]
            ids[place], ids[right], pair[right] = rank, -1, -1
            after[place] = after[right]
            before[after[right]] = place  # the entry past the end is never followed
            left = place[~edge[place]]
            offer(np.concatenate([place, before[left]]))
        kept = ids[:n] >= 0
        number = np.add.reduceat(kept, np.append(0, end[:-1])) if len(matches) else size
        out, cut = ids[:n][kept].astype(np.int32), np.cumsum(number).tolist()
        return [out[a:b] for a, b in zip([0, *cut], cut)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


class _Encoder:
    """Ids of matches, kept from one part to the next."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary, self.cut = vocabulary(path), cut_by(pattern)
        self.known: dict[bytes, bytes] = {}

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and their number by text.

        Equal matches of the part are found by a hash and then compared byte by byte."""
        data, start, end, row = self.cut(texts)
        if not len(start):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        raw = np.frombuffer(data, np.uint8)
        _, first, which = np.unique(span_hashes(raw, start, end), return_index=True, return_inverse=True)
        if not _same(raw, start, end, first[which]):
            first, which = np.arange(len(start)), np.arange(len(start))
        ids = self._ids([data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())])
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, begin = np.frombuffer(b"".join(ids), np.int32), np.cumsum(size) - size
        number = size[which]
        place = np.repeat(begin[which] - (np.cumsum(number) - number), number)
        place += np.arange(len(place))
        return flat[place], np.bincount(row, number, len(texts)).astype(np.int64)

    def _ids(self, matches: list[bytes]) -> list[bytes]:
        if len(self.known) > KEEP:
            self.known = {}
        known, ranks, queue = self.known, self.vocabulary.ranks, []
        for m in matches:
            if m not in known:
                whole = ranks.get(m)
                if whole is not None:
                    known[m] = np.int32(whole).tobytes()
                elif len(m) > LONG:
                    known[m] = np.array(self.vocabulary.merge(m), np.int32).tobytes()
                else:
                    queue.append(m)
        if queue:
            known.update(zip(queue, map(np.ndarray.tobytes, self.vocabulary.merge_all(queue))))
        return [known[m] for m in matches]


def _same(data: np.ndarray, start: np.ndarray, end: np.ndarray, like: np.ndarray) -> bool:
    """Whether every span has the bytes of the span that it is taken for."""
    size = end - start
    if not np.array_equal(size, size[like]):
        return False
    for lo in range(0, len(start), 1 << 17):
        part, n = slice(lo, lo + (1 << 17)), size[lo : lo + (1 << 17)]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        if (data[np.repeat(start[part], n) + place] != data[np.repeat(start[like[part]], n) + place]).any():
            return False
    return True


#: Fixed by the tokenizer: the pattern that ``Cutter`` follows by character classes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.cache
def _classes() -> np.ndarray:
    """0 other, 1 letter, 2 number, 3 white space, for every code point."""
    out = np.zeros(0x110000, np.uint8)
    for at in range(0, 0x110000, 0x800):
        if at == 0xD800:  # no characters
            continue
        part = "".join(map(chr, range(at, at + 0x800)))
        for kind, expression in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
            for m in regex.finditer(expression, part):
                out[at + m.start() : at + m.end()] = kind
    return out


def cut_classes(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The matches of ``PATTERN`` in every text, from the classes of the characters in numpy: the bytes of the
    texts with one byte between two, and start, end and text of every match in them."""
    joined = "\0".join(texts)
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    gap = (np.cumsum(length + 1) - 1)[:-1]  # the characters between texts
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(code)
    data = joined.encode()
    if not n:
        return data, *[np.empty(0, np.int64)] * 3
    kind = _classes()[code]
    kind[gap] = 4
    start = np.ones(n, bool)
    start[1:] = kind[1:] != kind[:-1]
    start[gap] = True
    # The last of a run of white space before a word: a blank joins the word, another stands alone.
    space = kind == 3
    last = np.flatnonzero(space[:-1] & ~space[1:])
    last = last[kind[last + 1] != 4]
    start[last] = True
    start[last[code[last] == 32] + 1] = False
    # Contractions: an apostrophe that begins a match, with the right letters behind it.
    quote = np.flatnonzero(code == 39)
    quote = quote[start[quote] & (quote + 1 < n)]
    quote = quote[kind[quote + 1] == 1]
    if len(quote):
        one = code[quote + 1]
        two = np.where(quote + 2 < n, code[np.minimum(quote + 2, n - 1)], 0)
        pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        alone = np.isin(one, [115, 116, 109, 100])
        for which, size in ((alone, 2), (pair & ~alone, 3)):
            at = quote[which]
            start[at + 1] = False
            past = at + size
            past = past[past < n]
            start[past] |= kind[past] == 1
    at = np.flatnonzero(start)
    match = np.flatnonzero(kind[at] != 4)
    row = np.searchsorted(gap, at[match], "right")
    if len(data) != n:  # places of bytes, not of characters
        head = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        at = head[at]
    return data, at[match], np.append(at, len(data))[match + 1], row


def cut_by(pattern: str):
    """A function from texts to the matches of the pattern, in the form of ``cut_classes``."""
    if pattern == PATTERN:
        return cut_classes
    find = regex.compile(pattern).findall

    def cut(texts: list[str]):
        found = [[m.encode() for m in find(t)] for t in texts]
        end = np.cumsum([len(m) for matches in found for m in matches], dtype=np.int64)
        row = np.repeat(np.arange(len(found)), [len(matches) for matches in found])
        size = np.diff(np.append(0, end))
        return b"".join(m for matches in found for m in matches), end - size, end, row

    return cut


def _encode(path: str, pattern: str, decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, names = _Encoder(path, pattern), ["doc_id", "ids", *["decoded"] * decoded]
        for batch in batches:
            for lo, hi, _, _ in slices(batch.column("text"), PART):
                ids, number = encoder.texts([t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()])
                out = [batch.column("doc_id").slice(lo, hi - lo), lists(ids, number)]
                if decoded:
                    out.append(_bytes(encoder.vocabulary, out[1]))
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def _bytes(known: Vocabulary, ids: pa.ListArray) -> pa.Array:
    """The bytes that each list of ids stands for."""
    bounds = (np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]).tolist()
    flat, token = ids.values.to_numpy(zero_copy_only=False), known.bytes_of
    return pa.array([b"".join(map(token.__getitem__, flat[a:b].tolist())) for a, b in zip(bounds, bounds[1:])], pa.binary())


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = _bytes(vocabulary(path), part.column("ids"))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str = PATTERN, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) for every row of ``docs``: the ids of its whole text, without special tokens. With
    ``decoded`` the bytes that those ids stand for as well, decoded by the same task.

    A null text is empty and has no ids. Repeated rows are encoded each; columns but doc_id and text are not
    read. ``path`` must be readable where tasks run.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return given.transform(in_batches, frugal(_encode(path, pattern, decoded)), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded) with the bytes that the ids stand for; a null list of ids gives no bytes."""
    given = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return given.transform(in_batches, frugal(_decode(path)), "doc_id long, ids array<int>, decoded binary")

"""Every operator against a brute-force version, on odd rows and on an empty table."""

import base64
import collections
import hashlib
import re
import zlib

import public_tokenizers
import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from wardmill.llm import (
    byte_bpe, decontamination, language_id, license_rules, license_scan, line_dedup, near_duplicates, quality_rules,
    sharding, substring_dedup, warc, words,
)
from wardmill.session import scratch_path

SPACED, PUNCTUATED = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOW = {c: c + 32 for c in range(65, 91)}
LAST = 2**63 - 1


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def given_rows(odd):
    return [(r["doc_id"], r["text"]) for r in odd.collect()]


def same(found, expected):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected, key=key)


def test_line_dedup(odd, nothing):
    rows = given_rows(odd)
    full = {k: [x for x in (t or "").split("\n") if re.search(SPACED, x)] for k, (_, t) in enumerate(rows)}
    # Copies of a row are one document; a null id comes last.
    order = sorted({(LAST if d is None else d, t or "", tuple(full[k])) for k, (d, t) in enumerate(rows)})
    first = {}
    for d, t, lines in order:
        for k in range(len(lines) - 2):
            first.setdefault(lines[k : k + 3], (d, t, k))
    expected = []
    for k, (d, t) in enumerate(rows):
        gone = set()
        for i in range(len(full[k]) - 2):
            if first[tuple(full[k][i : i + 3])] < (LAST if d is None else d, t or "", i):
                gone |= {i, i + 1, i + 2}
        kept, n = [], -1
        for x in (t or "").split("\n"):
            n += bool(re.search(SPACED, x))
            if not (re.search(SPACED, x) and n in gone):
                kept.append(x)
        expected.append((d, len(full[k]), len(gone), "\n".join(kept)))
    out = line_dedup.without_repeats(odd).select("row.doc_id", "n_lines", "n_removed", "kept_text")
    same(out.collect(), expected)
    assert line_dedup.without_repeats(nothing).count() == 0
    assert line_dedup.without_repeats(odd).select("row.*").columns == [c for c in odd.columns if c != "text"]


def test_quality_statistics(odd, nothing, spark):
    expected = []
    for d, t in given_rows(odd):
        w = re.findall(SPACED, t or "")
        g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        times, covered, seen, dup = collections.Counter(g), set(), set(), 0
        for i, x in enumerate(g):
            covered |= {i, i + 1, i + 2} if times[x] > 1 else set()
        for line in (t or "").split("\n"):
            dup += bool(re.search(SPACED, line)) and line in seen
            seen.add(line)
        symbols = sum((t or "").count(x) for x in "#*$%&|<>")
        expected.append((d, len(w), sum(map(len, w)), symbols, dup, len(covered)))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    same(quality_rules.statistics(odd).select(*names).collect(), expected)
    labels = spark.createDataFrame([(1, 0, 1), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, kept int")
    assert quality_rules.judge(odd, labels).where("kept and base_failed").count() == 0
    assert quality_rules.judge(nothing, labels.where("false")).count() == 0


def test_rules_are_learned_and_written_as_an_expression(spark):
    import numpy as np

    rnd = np.random.default_rng(1)
    x = {n: rnd.random(3000) for n in quality_rules.FEATURES}
    bad = (x["symbols"] > 0.7) & (x["stops"] < 0.4)
    rules = quality_rules.learn(x, bad)
    hit = np.any([r.covers(x) for r in rules], axis=0)
    assert rules and (hit == bad).mean() > 0.97
    assert "CASE WHEN" in str(quality_rules.verdict(rules))


def test_substring_dedup(odd, nothing):
    rows, first = given_rows(odd), {}
    split = [re.findall(SPACED, t or "") for _, t in rows]
    for (d, _), w in zip(rows, split):
        for i in range(len(w) - 12 if d is not None else 0):
            k = tuple(w[i : i + 13])
            first[k] = min(d, first.get(k, d))
    expected = []
    for (d, _), w in zip(rows, split):
        gone = set()
        for i in range(len(w) - 12 if d is not None else 0):
            if first[tuple(w[i : i + 13])] < d:
                gone |= set(range(i, i + 13))
        expected.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    same(substring_dedup.without_repeats(odd).collect(), expected)
    assert substring_dedup.without_repeats(nothing).count() == 0
    spans = {r["doc_id"]: r for r in substring_dedup.repeated_spans(odd).where("doc_id between 100 and 102").collect()}
    assert {(d, r["first_word"], r["n_words"]) for d, r in spans.items()} >= {(100, 0, 60), (101, 0, 60), (102, 0, 60)}


def test_sharding(odd, nothing, spark):
    placed = sharding.shard(odd, 5, scratch_path(spark, "map")).collect()
    same(
        [(r["doc_id"], r["size"], r["text_crc32"]) for r in placed],
        [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in given_rows(odd)],
    )
    for s in range(5):
        places = sorted(r["slot"] for r in placed if r["shard"] == s)
        assert places == list(range(len(places)))
    assert sharding.shard(nothing, 5, scratch_path(spark, "map")).count() == 0


def test_rebalancing_moves_few_slots_and_keeps_versions(spark):
    weights = [(k * 37) % 101 + 1 for k in range(sharding.SLOTS)]
    owner = sharding.assign(weights, 10)
    grown = sharding.rebalance(owner, weights, 11)
    total = [sum(w for w, s in zip(weights, grown) if s == k) for k in range(11)]
    assert max(total) <= 1.02 * sum(weights) / 11
    assert sum(a != b for a, b in zip(owner, grown)) < 0.12 * len(owner)
    path, load = scratch_path(spark, "map"), [(w, 1) for w in weights]
    sharding.save_map(spark, path, 1, owner, load)
    sharding.save_map(spark, path, 2, grown, load)
    assert sharding.read_map(sharding.load_map(spark, path)) == (grown, 2)
    assert sharding.read_map(sharding.load_map(spark, path, 1)) == (owner, 1)


PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = byte_bpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(odd, nothing, reference):
    expected = [(d, reference.encode_ordinary(t or ""), bytearray((t or "").encode())) for d, t in given_rows(odd)]
    same(byte_bpe.encode(odd, PATH, decoded=True).collect(), expected)
    same(byte_bpe.decode(byte_bpe.encode(odd, PATH), PATH).collect(), expected)
    assert byte_bpe.decode(byte_bpe.encode(nothing, PATH), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sltrevmd  \n\t1٣é中😀.-!　 ")), max_size=4))
def test_cutting_follows_the_pattern(texts):
    import regex

    data, start, end, row = byte_bpe.cut_classes(texts)
    found = [(k, data[a:b].decode()) for k, a, b in zip(row.tolist(), start.tolist(), end.tolist())]
    assert found == [(k, m) for k, t in enumerate(texts) for m in regex.findall(byte_bpe.PATTERN, t)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aberthn =", min_size=1, max_size=300), min_size=1, max_size=5))
def test_merging_alone_and_together(matches):
    known = byte_bpe.vocabulary(PATH)
    raw = [m.encode() for m in matches]
    ids = [known.merge(m) for m in raw]
    whole = [[known.ranks[m]] if m in known.ranks else i.tolist() for m, i in zip(raw, known.merge_all(raw))]
    assert ids == whole
    assert [b"".join(known.bytes_of[i] for i in x) for x in ids] == raw


def test_near_duplicates(odd, nothing):
    rows, sets = given_rows(odd), {}
    for d, t in rows:
        w = re.findall(SPACED, (t or "").translate(LOW))
        sets[d, t] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    keys = [k for k in sets if k[0] is not None]
    label = {k: k[0] for k in keys}
    for _ in range(8):
        for a in keys:
            for b in keys:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                    label[a] = min(label[a], label[b])
    expected = [
        (d, len(sets[d, t]), label.get((d, t)), d is None or label[d, t] == d) for d, t in rows
    ]
    same(near_duplicates.near_duplicates(odd).collect(), expected)
    assert near_duplicates.near_duplicates(nothing).count() == 0


def test_near_duplicates_through_a_hub_with_a_middle_id(spark):
    import random

    rnd = random.Random(3)
    hub = [f"w{k}" for k in range(300)]
    rows = []
    for d in range(500):
        text = list(hub)
        for at in rnd.sample(range(0, 300, 6), 0 if d == 250 else rnd.choice([7, 8])):
            text[at] = f"c{d}x{at}"
        rows.append((d, " ".join(text)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(296)} for _, t in rows]
    assert all(100 * len(s & sets[250]) >= 75 * len(s | sets[250]) for s in sets)
    out = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["component_id"], r["kept"]) for r in out if r["doc_id"]} == {(0, False)}


def test_candidates_across_components_are_all_that_can_be_links(monkeypatch):
    import numpy as np
    import pyarrow as pa

    rnd = np.random.default_rng(2)
    base = rnd.integers(1, 2**62, 400)
    sets = [np.unique(np.concatenate([rnd.choice(base, rnd.integers(250, 400), replace=False), rnd.integers(1, 2**62, 20)])) for _ in range(60)]
    lists = pa.array(sets, pa.list_(pa.int64()))
    made = pa.Table.from_batches(near_duplicates._sketches(iter([pa.record_batch([pa.array(range(60)), lists], names=["node", "shingles"])])))
    # One bucket of two blocks and another of one, in batches that cut groups.
    rows = [(1, i, j, -1 if i == j else d % 2, d) for i, j in ((0, 0), (0, 1), (1, 1)) for d in range(60) if d % 2 in (i, j)]
    rows += [(2, 0, 0, -1, d) for d in range(0, 60, 3)]
    columns = [list(c) for c in zip(*rows)]
    at = columns[4]
    table = pa.table(
        [*columns, [d % 7 for d in at], made["n"].take(pa.array(at)), made["sketch"].take(pa.array(at))],
        names=["bucket", "i", "j", "side", "node", "component", "n", "sketch"],
    )
    monkeypatch.setattr(near_duplicates, "PAIRS", 50)
    out = [near_duplicates._compared(iter(table.to_batches(max_chunksize=k))) for k in (17, 1000)]
    found = [{p for b in batches for p in zip(b["a"].to_pylist(), b["b"].to_pylist())} for batches in out]
    held = [set(s.tolist()) for s in sets]
    links = {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 7 != b % 7 and 100 * len(held[a] & held[b]) >= 75 * len(held[a] | held[b])}
    every = {(a, b) for a in range(60) for b in range(a + 1, 60) if a % 7 != b % 7}
    assert links and links <= found[0] == found[1] < every


def test_license_scan(odd, nothing):
    expected = []
    for d, t in given_rows(odd):
        w = re.findall(PUNCTUATED, (t or "").translate(LOW))
        places = sorted(
            (i, label) for p, label in license_rules.BASE.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p
        )
        expected.append((d, len(w), places))
    out = [(r["doc_id"], r["n_words"], sorted((b["word"], b["label"]) for b in r["base"])) for r in license_scan.scan(odd).collect()]
    same(out, expected)
    assert license_scan.scan(nothing).count() == 0


def test_license_rules_suppress_what_a_better_rule_covers():
    scanner = license_scan.Scanner()
    text = "spdx-license-identifier: gpl-2.0-only. licensed under the gnu general public license, version 3. mit license"
    found = scanner.detections(text, {"spdx", "gnu", "gpl", "mit"})
    assert [d["label"] for d in found] == ["gpl-2.0", "gpl-3.0", "mit"]
    assert len(scanner.rules) > 300


def test_license_gate_loses_no_detection(spark):
    texts = ["Released under the GPLv3.", "gpl3", "licensed under LGPLv2.1 or later", "AGPLv3", "WTFPLv2", "CC0v1", "cc01.0"]
    texts += ["“GPL v2”", "the\u00a0gnu\u00a0general public license", "(apache license 2)", "x", "gp", "l", "gpl", "", None]
    texts += ["Permission is hereby granted, free of charge, to any person obtaining a copy", "unaltered source versions must be plainly marked as such"]
    texts += ["proprietary and confidentiality", "xspdx-license-identifier: mit", "procreative commons attribution 4.0", "é©copyright (c)  2020"]
    texts += ["commit licenses permit", "MIT License", "mit/x11 license", "1gplv3", "é gplv3", "end gpl", "v3 mi", "t license"]
    scanner = license_scan.Scanner()
    everything = set(scanner.by_keyword)
    expected = [scanner.detections((t or "").translate(LOW), everything) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: [d.asDict() for d in r["detections"]] for r in license_scan.scan(docs.coalesce(1)).collect()}
    assert found == dict(enumerate(expected))
    assert [[d["label"] for d in found[k]] for k in range(5)] == [["gpl-3.0"], ["gpl-3.0"], ["lgpl-2.1"], ["agpl-3.0"], ["wtfpl-2.0"]]
    assert all(r.keyword in r.pattern.pattern for r in scanner.rules)


def test_decontamination(odd, nothing, spark):
    texts = [t for _, t in sorted(given_rows(odd), key=lambda r: str(r)) if t and len(t.split()) > 30][:3]
    items = [(1, " ".join(texts[0].split()[3:30])), (2, "never seen " * 20), (10, texts[1]), (3, "apache License"), (4, None), (None, "one"), (5, "")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    window = collections.defaultdict(set)
    for i, t in items:
        w = re.findall(PUNCTUATED, (t or "").translate(LOW))
        for k in range(max(1, len(w) - 12) if w else 0):
            window[tuple(w[k : k + 13])].add(i)
    expected = []
    for d, t in given_rows(odd):
        w, hit, named = re.findall(PUNCTUATED, (t or "").translate(LOW)), set(), set()
        for size in {len(k) for k in window}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in window:
                    named |= {str(i) for i in window[tuple(w[k : k + size])] if i is not None}
                    hit |= set(range(k, k + size))
        expected.append((d, len(w), len(hit), sorted(named), bool(hit) and 20 * len(hit) >= len(w)))
    same(decontamination.contamination(odd, benchmark).collect(), expected)
    same(decontamination.contamination(odd, benchmark, block=20).collect(), expected)
    assert decontamination.contamination(nothing, benchmark).count() == 0
    assert decontamination.contamination(odd, benchmark.where("false")).where("n_hit > 0").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x x x x x alpha"), (2, "beta alpha")], "doc_id long, text string")
    tokens = decontamination.tokenized(docs)
    terms = spark.createDataFrame([("alpha",), ("beta",)], "term string")
    found = decontamination.near(decontamination.postings(tokens, terms), "alpha", "beta", 3).select("id", "at", "other_at")
    same(found.collect(), [(1, 0, 3), (2, 1, 0)])


def test_warc_rejects_magic_in_payloads(spark):
    evil = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nWARC/1.1\r\nzz"
    rows = [(k, "u", f"page {k % 7} " * k) for k in range(60)] + [(100 + k, "a\r\nb", evil + str(k % 2)) for k in range(6)]
    rows += [(200, None, None), (201, "é", ""), (202, "é", "é" * 90000 + evil + "é" * 90000), (203, "b", "WARC/1.1\r\n" * 2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        path = warc.write(pages.repartition(2), scratch_path(spark, "warc"))
        out = warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    latest = {}
    for k, _, html in rows:
        latest[html or ""] = max(k, latest.get(html or "", k))
    expected = []
    for k, _, html in rows:
        body, last = (html or "").encode(), latest[html or ""]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        expected.append((k, len(body), digest, "response" if last == k else "revisit", None if last == k else last))
    same(out, expected)


def test_language_id(odd, nothing):
    samples = [(w.encode(), "en") for w in "thing with that there shall when throw".split()] * 30
    samples += [(w.encode(), "fr") for w in "eau çois été queaux leçon naïve".split()] * 30
    net = language_id.train(samples, steps=150)
    assert [net.languages[int(net.positions(__import__("numpy").frombuffer(w, "u1")[None])[:, 0].mean(0).argmax())] for w, _ in samples[:1] + samples[-1:]] == ["en", "fr"]
    found = {(r["row"]["doc_id"], r["lang_pred"], 0 <= r["score"] <= 1) for r in language_id.predict(odd, net).collect()}
    assert all(ok for _, _, ok in found)
    assert {d for d, name, _ in found if name == "und"} == {400, 401, 402, 404, None}
    assert language_id.predict(nothing, net).count() == 0
    assert language_id.learn_from(nothing) is None
    assert language_id.predict(odd, None).where("lang_pred <> 'und'").count() == 0


def test_training_takes_few_runs_of_a_text_without_blanks(spark, monkeypatch):
    rows = [(k, "".join(chr(97 + (i * 7 + k) % 26) * (i % 9) for i in range(20000)), "en") for k in range(8)]
    rows += [(100 + k, f" eau çois  été queaux{k} leçon", "fr") for k in range(8)]
    taken = []
    monkeypatch.setattr(language_id, "train", lambda samples: taken.append(samples))
    language_id.learn_from(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    count = collections.Counter(name for _, name in taken[0])
    assert 60 < count["en"] <= 8 * 60
    assert {"eau".encode(), "çois".encode(), "été".encode(), "leçon".encode()} < {run for run, name in taken[0] if name == "fr"}


def test_gradients_through_time():
    import numpy as np

    net = language_id.train([(b"ab", "x"), (b"cd", "y")], hidden=3, steps=1, rows=2)
    for p in net.parameters():
        p += np.random.default_rng(0).normal(0, 0.3, p.shape).astype(p.dtype)
    x, label = np.array([[97, 98, 99], [99, 100, 97]], np.uint8), np.array([0, 1])

    def loss():
        p = net.positions(x)
        return -np.log(p[:, np.arange(2), label]).mean()

    grads = net.gradients(x, label)
    for p, g in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = p[at]
        p[at] = kept + 1e-2
        up = loss()
        p[at] = kept - 1e-2
        down = loss()
        p[at] = kept
        assert abs((up - down) / 2e-2 - g[at]) < 2e-3 + 0.05 * abs(g[at])


def test_substring_dedup_with_a_phrase_in_every_text(spark, monkeypatch):
    """One phrase with the smallest hash in all documents, different words around it: no window repeats. The phrase
    deals its windows by their own hashes, and planted copies are still found."""
    best = None
    for k in range(2000):
        phrase = [f"p{k}x{j}" for j in range(substring_dedup.M)]
        data = np.frombuffer(" ".join(phrase).encode(), np.uint8)
        start, end, _ = words.spans(data, np.array([0, len(data)]), words.SPACES)
        value = int(words.grams(words.span_hashes(data, start, end), substring_dedup.M)[0])
        best = min(best or (value, phrase), (value, phrase))
    phrase = " ".join(best[1])
    rows = [(k, f"a{k} b{k} c{k} d{k} {phrase} e{k} f{k} g{k} h{k}") for k in range(20000)]
    rows += [(50000 + k, rows[k * 100][1]) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    monkeypatch.setattr(substring_dedup, "SAMPLE", 4)
    text = docs.selectExpr("doc_id", "xxhash64(text) AS th", "text")
    assert best[0] in substring_dedup._frequent(text, 128).tolist()
    out = substring_dedup.without_repeats(docs)
    assert {(r["doc_id"], r["n_removed"]) for r in out.where("n_removed > 0").collect()} == {(50000 + k, 13) for k in range(100)}
    assert out.count() == len(rows)


def test_substring_dedup_judges_rows_of_one_id_each(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (2, b), (None, a), (3, f"x {b} y")], "doc_id long, text string")
    found = {(r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.without_repeats(docs).collect()}
    assert found == {(1, 30, 0), (2, 30, 30), (2, 30, 0), (None, 30, 0), (3, 32, 30)}


def test_repeated_rows_of_near_duplicates_are_one_pair(spark):
    a = " ".join(f"w{k}" for k in range(80))
    docs = spark.createDataFrame([(1, a)] * 200 + [(2, a + " more")] * 200, "doc_id long, text string").repartition(4)
    given = docs.select("doc_id", "text")
    pairs = spark.createDataFrame([(1, 2, 1)], "a long, b long, hits long")
    sets = near_duplicates._linked  # the whole path, whose links are one pair
    found = near_duplicates.near_duplicates(docs)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in found.collect()} == {(1, 1, True), (2, 1, False)}
    assert found.count() == 400
    tables = spark.createDataFrame([(1, 5), (2, 5)], "node long, bucket long")
    assert sets(given, tables, pairs).collect() == near_duplicates.components(pairs).collect()


def test_rows_without_id_spread_over_the_shards(spark):
    rows = [(None, f"text {k} " + "x" * (k % 50)) for k in range(6000)] + [(k, "y" * 30) for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = scratch_path(spark, "map")
    placed = sharding.shard(docs, 10, path)
    size = collections.Counter()
    for r in placed.collect():
        size[r["shard"]] += r["size"]
    mean = sum(size.values()) / 10
    assert len(size) == 10 and max(abs(v - mean) for v in size.values()) < 0.02 * mean
    # The next table edits the stored map and moves few slots.
    before = sharding.read_map(sharding.load_map(spark, path, 2))[0]
    sharding.shard(docs.where("doc_id is null or doc_id > 100"), 10, path).count()
    after, version = sharding.read_map(sharding.load_map(spark, path))
    assert version == 3 and sum(x != y for x, y in zip(before, after)) < 0.1 * len(after)


def test_labels_of_one_id_and_repeated_rows_are_learned_once(spark):
    docs = spark.createDataFrame([(1, "word " * 80)] * 50 + [(2, "# $ " * 80)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)] * 30 + [(2, 0, 0), (2, 0, 0), (None, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert quality_rules.learn_from(quality_rules.statistics(docs), labels) == []
    assert quality_rules.judge(docs, labels).count() == 51


def test_language_of_held_out_documents(spark):
    """Accuracy on documents that the network never saw, and that neither lang, source nor id are inputs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = language_id.learn_from(docs)
    apart = docs.where(language_id.held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found = language_id.predict(apart, net, through=["doc_id", "lang"]).select("row.*", "lang_pred").collect()
    assert len(found) > 100 and sum(r["lang"] == r["lang_pred"] for r in found) >= 0.9 * len(found)
    hidden = docs.withColumns({"lang": F.lit("fr"), "source": F.lit("x"), "doc_id": F.col("doc_id") + 10**9}).where(F.col("text").isNotNull())
    again = {r["text"]: r["lang_pred"] for r in language_id.predict(hidden, net, through=["text"]).select("row.text", "lang_pred").collect()}
    first = {r["text"]: r["lang_pred"] for r in language_id.predict(docs, net, through=["text"]).select("row.text", "lang_pred").collect()}
    assert all(first[t] == p for t, p in again.items())


def test_repeated_sampled_rows_reach_the_driver_once(spark):
    rows = [(1, "the cat sat there", "en")] * 3000 + [(4, "der hund sitzt da", "de")] + [(k, "le chat est la", "fr") for k in (5, 6, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language_id.learn_from(docs, sample=2, sample_words=4)
    assert set(net.languages) <= {"en", "de", "fr"} and len(net.languages) >= 2

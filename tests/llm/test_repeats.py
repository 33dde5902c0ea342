"""Both repeat operators against brute force, whole and with groups so small that they are split."""

import hashlib
import random

import numpy as np
import pytest
from pyspark import cloudpickle

from voltaria.llm import repeats, substrings, suffixes


def brute_words(rows, window):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - window + 1):
            g = tuple(w[s : s + window])
            first[g] = min(first.get(g, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = {s + j for s in range(len(w) - window + 1) if first[tuple(w[s : s + window])] < d for j in range(window)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def brute_bytes(rows, window):
    seen, out = set(), []
    for d, t in sorted(rows, key=lambda r: r[0]):
        t = (t or "").encode()
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - window + 1):
            g = t[s : s + window]
            if g in seen:
                gone[s : s + window] = True
            else:
                seen.add(g)
        kept = bytes(b for b, x in zip(t, gone, strict=True) if not x)
        runs = int(np.sum(gone & ~np.concatenate([[False], gone[:-1]])))
        out.append((d, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed, n=60):
    """Copies, near copies, passages that many share, words and lines over and over, odd texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcdéñ", k=r.randint(1, 7))) for _ in range(400)]
    passage = [r.choices(vocabulary, k=r.choice([12, 21, 30, 60])) for _ in range(6)]
    rows = [(900, None), (901, ""), (902, " \n "), (903, "word"), (904, "tick " * 300), (905, "tick " * 300 + "tock"), (906, "ab" * 400)]
    texts = []
    for d in range(n):
        w = r.choices(vocabulary, k=r.randint(5, 200))
        if r.random() < 0.6:
            at = r.randrange(len(w))
            w[at:at] = r.choice(passage)
        if texts and r.random() < 0.4:
            w = r.choice(texts)[:]
            for _ in range(r.choice([0, 0, 1, 3])):
                w[r.randrange(len(w))] = r.choice(vocabulary)
        texts.append(w)
        rows.append((r.choice([d, d, d + 1000]), (" " if r.random() < 0.8 else "\n").join(w)))
    ids = set()
    return [x for x in rows if not (x[0] in ids or ids.add(x[0]))]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, run string, block int").repartition(3)


def run_words(spark, rows, window):
    got = substrings.dedup_substrings(frame(spark, rows), window, ("run",)).collect()
    assert all(r.run == "x" for r in got)
    return sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got)


def run_bytes(spark, rows, window):
    got = suffixes.dedup_bytes(frame(spark, rows), window).collect()
    return sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got)


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, seed):
    rows = corpus(seed)
    assert run_words(spark, rows, 20) == brute_words(rows, 20)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, seed):
    rows = corpus(seed)
    assert run_bytes(spark, rows, 40) == brute_bytes(rows, 40)


def test_split_groups_and_small_blocks(spark, monkeypatch):
    """Parts of groups, of blocks, of ranked runs and of long texts change nothing. """
    rows = corpus(3, 90)
    for name, value in {"GROUP": 4, "BLOCK": 3000, "RANKED": 500, "SLICE": 64}.items():
        monkeypatch.setattr(repeats, name, value)
    cloudpickle.register_pickle_by_value(repeats)  # workers get the module with these limits
    try:
        assert run_words(spark, rows, 20) == brute_words(rows, 20)
        assert run_bytes(spark, rows, 40) == brute_bytes(rows, 40)
    finally:
        cloudpickle.unregister_pickle_by_value(repeats)


def test_registered_queries_on_the_small_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in substrings.op2_substring_dedup(spark, d).collect())
    assert got == brute_words(rows, 50)
    got = sorted(tuple(r) for r in suffixes.op7_suffix_dedup(spark, d).collect())
    assert got == brute_bytes(rows, 100)


def test_empty_tables_and_documents_as_they_came(spark):
    none = frame(spark, [(1, "x")]).limit(0)
    assert substrings.dedup_substrings(none).count() == 0 and suffixes.dedup_bytes(none).count() == 0
    rows = [(1, "é" * 200), (2, "x" + "é" * 150 + "y"), (None, "é" * 90)]
    out = {r.doc_id: r for r in suffixes.dedup_documents(spark.createDataFrame([(d, t, len(t), "s") for d, t in rows], "doc_id long, text string, n_chars long, source string"), 100).collect()}
    cut = {r.doc_id: r.text for r in suffixes.dedup_documents(spark.createDataFrame([(1, "é" * 60), (2, "ĩ" + "é" * 50), (3, "ĩ" + "é" * 50 + "ñ")], "doc_id long, text string")).collect()}
    assert cut == {1: "é", 2: "", 3: ""}  # a removed span cuts ĩ and ñ in two
    assert out[2].text == "xy" and out[2].n_chars == 2 and out[None].text == "" and out[1].source == "s"


def test_anchors_depend_on_the_window_alone():
    r = np.random.default_rng(5)
    e = r.integers(0, 2**63, 500, dtype=np.uint64)
    e = np.concatenate([e, e[100:300], e[:50]])
    h, first, last = repeats.anchors(e, 50, 20)
    assert first[0] == 0 and last[-1] == len(e) - 50 and (first[1:] == last[:-1] + 1).all()
    at = {s: k for k, (a, b) in enumerate(zip(first, last, strict=True)) for s in range(a, b + 1)}
    for s in range(100, 250):
        assert h[at[s]] == h[at[s + 400]]
    plain = repeats.mixed(np.array([sum(int(x) * pow(int(repeats._BASE), 19 - j, 2**64) for j, x in enumerate(e[k : k + 20])) % 2**64 for k in range(40)], np.uint64))
    assert (repeats.mixed(repeats.gram_hashes(e[:59], 20)) == plain).all()

"""Near-duplicate components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from voltaria.llm import components, neardup


def sets(text, size):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows, size, percent):
    s = {d: sets(t, size) for d, t in rows}
    root = {d: d for d in s}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(s)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if s[a] and s[b] and min(len(s[a]), len(s[b])) * 100 >= percent * max(len(s[a]), len(s[b])):
                n = len(s[a] & s[b])
                if 100 * n >= percent * (len(s[a]) + len(s[b]) - n):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return sorted((d, len(s[d]), find(d), find(d) == d) for d in ids)


def corpus(seed, n=120):
    r = random.Random(seed)
    vocabulary = ["".join(r.choices("abcDEé", k=r.randint(2, 6))) for _ in range(500)]
    rows = [(500, None), (501, ""), (502, " \t"), (503, "One"), (504, "one"), (505, "one two"), (506, "One two"), (507, "one two two")]
    base = [r.choices(vocabulary, k=r.randint(30, 150)) for _ in range(12)]
    for d in range(n):
        w = r.choice(base)[:] if r.random() < 0.8 else r.choices(vocabulary, k=r.randint(1, 80))
        for _ in range(r.choice([0, 0, 1, 2, 3, 5, 8])):
            w[r.randrange(len(w))] = r.choice(vocabulary)
        rows.append((d, r.choice([" ", "\n"]).join(w)))
    return rows


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_components_are_those_of_all_pairs(spark, seed, size, percent):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, n int, component long").repartition(3)
    assert sorted(tuple(r) for r in neardup.near_duplicates(docs, size, percent).collect()) == brute(rows, size, percent)


def test_parts_of_regions_change_nothing(spark, monkeypatch):
    rows = corpus(3)
    monkeypatch.setattr(neardup, "PART", 150)
    monkeypatch.setattr(neardup, "HUB", 2)
    cloudpickle.register_pickle_by_value(neardup)
    try:
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert sorted(tuple(r) for r in neardup.near_duplicates(docs, 3, 85).collect()) == brute(rows, 3, 85)
    finally:
        cloudpickle.unregister_pickle_by_value(neardup)


def test_one_of_each_stays_as_it_came(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(3, text, "a"), (1, text.upper(), "b"), (9, None, "c"), (8, "", "d"), (None, text, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {(r.doc_id, r.text, r.kept) for r in neardup.keep_one(docs).collect()}
    assert got == {rows[1], rows[2], rows[3], rows[4]}
    assert neardup.keep_one(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(500, 500)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)}


def test_depth_keeps_misses_rare():
    for t in (0.8, 0.85):
        d = neardup.depth_for(t)
        assert (1 - t**d) ** neardup.TREES <= neardup.MISS < (1 - t ** (d + 1)) ** neardup.TREES


def test_signatures_estimate_the_jaccard():
    r = np.random.default_rng(1)
    x = np.unique(r.integers(0, 2**63, 1000, dtype=np.uint64))
    a, b = neardup.signature(x[:900]), neardup.signature(x[100:])
    assert abs((a == b).mean() - 0.8) < 0.12


def test_long_unrelated_texts_share_no_values(spark):
    """Hashes of the least values tell long sets apart: unrelated ones agree on about one byte in 256."""
    memo = neardup.WordHashes()
    r = np.random.default_rng(5)
    made = spark.createDataFrame([(k, " ".join(f"w{x}" for x in r.integers(0, 10**6, 5000)), k) for k in range(12)], "doc_id long, text string, other int")
    rows = neardup.sketches(made, 5, 4).collect()
    bytes_ = [np.frombuffer(x.agree, np.uint8) for x in rows]
    assert max((bytes_[i] == bytes_[j]).mean() for i in range(12) for j in range(i)) < 0.05
    assert len(memo) == 0 and neardup.near_duplicates(made).filter("NOT kept").count() == 0


def test_neighbours_of_the_sorted_orders_find_nearly_all_links(spark):
    """Chains of copies that each differ by a word: the candidates alone unite them, before regions are compared."""
    r = np.random.default_rng(6)
    docs = []
    for g in range(20):
        base = [f"g{g}w{x}" for x in r.integers(0, 10**6, 120)]
        for k in range(30):
            w = list(base)
            for _ in range(int(r.integers(0, 3))):
                w[int(r.integers(0, 120))] = f"x{g}y{k}"
            docs.append((1000 * g + k, " ".join(w)))
    made = spark.createDataFrame(docs, "doc_id long, text string")
    s = neardup.sketches(made, 5, 4).select(F.col("doc_id").alias("doc"), F.posexplode("keys").alias("tree", "key"), "agree")
    s = s.select("doc", "tree", F.substr("agree", F.col("tree") * neardup.MAX_DEPTH + 1, F.lit(neardup.MAX_DEPTH)).alias("values"))
    pairs = neardup._neighbours(s, 4).distinct().collect()
    assert all(a > b and a // 1000 == b // 1000 for a, b in pairs) and len(pairs) < 20 * 30 * 29 // 2
    met = {x for p in pairs for x in p}
    assert len(met) >= 0.95 * len(docs)

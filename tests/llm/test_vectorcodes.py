"""Codes, errors and codebooks against a plain version; the pruned search against looking at every entry."""

import hashlib
import math

import numpy as np
import pytest

from voltaria.llm import vectorcodes as vc


def plain(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label) -> {(vec_id, code, error, label_error)} sorted, digest."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], None
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    step = width // parts
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    seeds = sorted(kept, key=lambda r: ((r[0] is None, r[0] or 0), r[1]))[:entries]
    books = [[r[1][p * step : (p + 1) * step] for r in seeds] for p in range(parts)]

    def assign(v):
        out = []
        for p, b in enumerate(books):
            own = v[p * step : (p + 1) * step]
            d = [sum((x - y) ** 2 for x, y in zip(own, e, strict=True)) for e in b]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = [(v, assign(v)) for _, v, _ in kept]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p * step : (p + 1) * step] for v, a in found if a[p][0] == e]
                if own:
                    books[p][e] = None or [sum(c) // len(own) for c in zip(*own, strict=True)]
    last = [(i, assign(v), lab) for i, v, lab in kept]
    by_label = {}
    for _, a, lab in last:
        by_label[lab] = by_label.get(lab, 0) + sum(d for _, d in a)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    key = lambda r: tuple(map(str, r))
    return sorted(((i, "".join(f"{e:02x}" for e, _ in a), sum(d for _, d in a), by_label[lab]) for i, a, lab in last), key=key), digest


def held(spark, rows, parts=8, entries=16):
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, code string").repartition(3)
    got = vc.compress(df, parts, entries).collect()
    want, digest = plain(rows, parts, entries)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=lambda r: tuple(map(str, r))) == want
    assert {r.codebooks_sha256 for r in got} == ({digest} if got else set())


def test_against_the_plain_version(spark):
    rng = np.random.default_rng(1)
    rows = [(int(k), [float(x) for x in rng.normal(size=16)], None if k % 7 == 0 else int(k % 3)) for k in range(120)]
    rows += [(500, None, 1), (501, [None] + [0.0] * 15, 1), (502, [float("nan")] * 16, 1), (503, [float("inf")] * 16, None), (3, rows[3][1], 2), (3, rows[4][1], 2), (None, rows[5][1], 2)]
    held(spark, rows)
    held(spark, rows, 4, 5)


def test_ties_few_rows_lengths_and_large_components(spark):
    same = [0.5] * 8
    held(spark, [(k, same, 0) for k in range(40)])
    held(spark, [(1, [1.0] * 8, 0), (2, [-1.0] * 8, 0), (3, [0.0] * 8, 0)])
    held(spark, [(1, [1.0, 2.0, 3.0], 0), (2, [4.0] * 11, None), (3, [], None), (4, [0.25] * 8, 1)])
    held(spark, [(k, [float(k % 3) * 200_000.0 + k] * 8, 0) for k in range(30)])
    held(spark, [(1, None, 0)])
    assert vc.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_no_entry_that_is_as_near_is_passed_over():
    rng = np.random.default_rng(2)
    for spread in (3, 50, 4000, 1 << 26):
        book = vc.Codebook(rng.integers(-spread, spread + 1, (64, 4)))
        x = rng.integers(-spread, spread + 1, (3000, 4))
        all_of = ((x[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
        entry, d = book.nearest(x)
        assert (entry == all_of.argmin(axis=1)).all() and (d == all_of.min(axis=1)).all()
        assert book.evaluated < 0.8 * all_of.size


def test_entries_of_two_digits(spark):
    with pytest.raises(ValueError):
        vc.train(spark.createDataFrame([(1, [0.0])], "vec_id long, embedding array<float>"), 8, 257)

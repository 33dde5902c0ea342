"""Exact search against all scores, and archives through a whole round trip."""

import gzip
import hashlib
import math
import random

import numpy as np
import pytest

from voltaria.llm import topk, warc


def brute(rows, queries, k):
    good = lambda x: x is not None and len(x) > 0 and all(v is not None and math.isfinite(v) for v in x)
    ints = [(i, [math.floor(1024 * v) for v in x]) for i, x in rows if good(x) and i is not None]
    out = []
    for q, x in {(i, tuple(x)) for i, x in ints if i in queries}:
        s = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ints if i != q)[:k]  # noqa: B905
        out += [(q, r + 1, i, -v) for r, (v, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize(("n", "block"), [(300, 64), (7, 8192)])
def test_top_k(spark, n, block):
    r = np.random.default_rng(n)
    rows = [(int(k), [float(np.float32(v)) for v in r.normal(0, 0.2, 8)]) for k in range(n)]
    rows += [(k + 1000, rows[k % n][1]) for k in range(30)] + [(5000, None), (5001, []), (5002, [float("nan")] * 8), (5003, [None] * 8), (5004, [0.0] * 8), (5005, [float("inf")] * 8)]
    df = spark.createDataFrame([(i, x, "z") for i, x in rows], "vec_id long, embedding array<float>, x string")
    asked = {0, 3, 5, 1000, 5002, 5004}
    got = topk.top_k(df, df.filter(df.vec_id.isin(list(asked))), 10, block, 2)
    assert sorted(tuple(x) for x in got.collect()) == brute(rows, asked, 10)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_reading_stops_early_and_large_numbers_stay_exact():
    r = np.random.default_rng(0)
    x = np.floor(r.normal(0, 10, (4000, 4))).astype(np.int64)
    x[7] = [900, 900, 900, 900]
    none = np.full(2, topk.NONE)
    lists = topk.Lists(np.arange(4000), x)
    got = lists.best(np.array([1, 7]), np.array([[3, 2, 1, 1], [-1, 0, 0, 0]]), 1, none)
    assert [(v.tolist(), i.tolist()) for v, i in got][0] == ([6300], [7]) and got[1][0][0] == -x[:, 0].min()
    assert lists.entries < 2 * x.size
    # with a bar that nothing reaches, less is read still
    again = topk.Lists(np.arange(4000), x)
    assert not len(again.best(np.array([1]), np.array([[3, 2, 1, 1]]), 1, np.array([10**6]))[0][0]) and again.entries <= x.size // 8
    big = topk.Lists(np.array([1, 2, 3]), np.array([[2**40, 1], [2**40, 0], [1, 1]]))
    score, ids = big.best(np.array([3]), np.array([[2**22, 1]]), 2, none[:1])[0]
    assert (score.tolist(), ids.tolist()) == ([2**62 + 1, 2**62], [1, 2])


@pytest.mark.parametrize("size", [3, 40, 2**27, 2**40])
def test_bounds_hold_for_sums_of_any_size(size):
    """Doubles, 64-bit and Python's integers give what brute force gives, ties included; near neighbours end the reading early."""
    r = np.random.default_rng(size % 97)
    x = r.integers(-size, size + 1, (700, 16))
    q, ids = r.integers(-size, size + 1, (5, 16)), r.permutation(700)
    x[:60] = np.repeat(q, 12, axis=0)
    asked = np.array([0, 1, 2, 3, 9999])
    lists = topk.Lists(ids, x)
    for j, (score, got) in enumerate(lists.best(asked, q, 10, np.full(5, topk.NONE))):
        full = sorted((-sum(int(a) * int(b) for a, b in zip(q[j], v, strict=True)), int(i)) for i, v in zip(ids, x, strict=True) if i != asked[j])[:10]
        assert [(-int(s), int(i)) for s, i in zip(score, got, strict=True)] == full
    assert lists.entries < 0.9 * x.size * len(q) or size == 3


def test_top_k_of_odd_rows(spark):
    """Repeated ids and rows, null ids, unequal lengths, clashing columns, several cells; the share read is told."""
    r = np.random.default_rng(4)
    rows = [(int(k) % 150, [float(v) for v in r.normal(0, 0.2, 4 + int(k) % 3)]) for k in range(200)]
    rows += rows[:20] + [(None, [1.0] * 4)]
    df = spark.createDataFrame([(i, x, 1, 2) for i, x in rows], "vec_id long, embedding array<double>, score int, rank int")
    one = [(i, x) for k, (i, x) in enumerate(rows) if i is not None and i < 40 and [a for a, _ in rows].index(i) == k]
    asked = spark.createDataFrame(one, "vec_id long, embedding array<double>")
    ints = [(i, [math.floor(1024 * v) for v in x]) for i, x in rows if i is not None]
    want = []
    for q, x in one:
        w = [math.floor(1024 * v) for v in x]
        s = sorted((-sum(a * b for a, b in zip(w, y)), i) for i, y in ints if i != q)[:10]  # noqa: B905
        want += [(q, k + 1, i, -v) for k, (v, i) in enumerate(s)]
    got = topk.top_k(df, asked, 10, 32, 7, report=True)
    assert sorted(tuple(x)[:4] for x in got.collect()) == sorted(want)
    assert all(0 < x.entries_read <= x.entries for x in got.collect())


PAGES = [
    (5, "http://a/", "<html>" + "x" * 200), (2, "http://b/", "<html>" + "x" * 200), (9, None, "<html>" + "x" * 200), (7, "http://c/", "short"), (8, "http://d/", "short"),
    (1, "http://e/", None), (3, "http://f/", ""), (4, "http://g/\r\nX: y", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n\r\n\r\r\n\r\n"), (6, "ü", "\r\n\r\n" * 300 + "é" * 90_000),
    (10, "u", "\r\n\r\n"), (11, "u", "twice" * 40), (11, "u", "twice" * 40), (None, "n", "<html>" + "x" * 200), (12, "v", "\r\n\r"),
]


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, type int").repartition(3)
    warc.write_warc(pages, str(tmp_path / "w"))
    records = warc.read_records(spark, str(tmp_path / "w"), blocks=True)
    assert records.count() == 3 * len(PAGES)
    rows = warc.captures(records).collect()
    assert len(rows) == len(PAGES)
    got, page_of = [], {r.capture: (r.fields or {}).get("pageId") for r in rows}
    for r in rows:
        page = page_of[r.capture]
        assert r.request.concurrent_to == r.response.record_id == r.capture == r.metadata.concurrent_to
        if r.response.refers_to:  # to a record that is there, the response with that payload
            assert any(x.response.record_id == r.response.refers_to and x.response.type == "response" and x.response.payload_digest == r.response.payload_digest for x in rows)
        refers = int(page_of[r.response.refers_to]) if r.response.refers_to else None
        got.append((str(page), r.response.payload_bytes, r.response.payload_digest, r.response.type, refers))
        if r.response.type == "response":
            body = bytes(r.response.block).split(b"\r\n\r\n", 1)[1]
            assert (len(body), hashlib.sha256(body).hexdigest()) == got[-1][1:3] and r.response.declared_digest == f"sha256:{got[-1][2]}"
    expected = []
    for p, _, html in PAGES:
        raw = (html or "").encode()
        least = min(q for q, _, h in PAGES if q is not None and (h or "") == (html or ""))
        again = len(raw) >= 100 and (p is None or p > least)
        expected.append((str(p), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", least if again else None))
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_files_are_warc(spark, tmp_path):
    warc.write_warc(spark.createDataFrame(PAGES[:2], "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*")))
    n = 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
        size = int(head.rpartition(b"Content-Length: ")[2])
        assert rest[size : size + 4] == b"\r\n\r\n"
        raw, n = rest[size + 4 :], n + 1
    assert n == 6


def test_no_pages(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), str(tmp_path / "w"))
    assert warc.captures(warc.read_records(spark, str(tmp_path / "w"))).count() == 0


def test_random_payloads_survive(spark, tmp_path):
    r = random.Random(4)
    pages = [(k, "u", "".join(r.choices(["\r", "\n", "\r\n\r\n", "x", "WARC/1.1"], k=r.randint(0, 40)))) for k in range(300)]
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w"), least=10**6)
    rows = warc.captures(warc.read_records(spark, str(tmp_path / "w"))).collect()
    assert {int(x.fields["pageId"]): x.response.payload_digest for x in rows} == {k: hashlib.sha256(h.encode()).hexdigest() for k, _, h in pages}


def test_plain_files_that_are_split_are_read_whole(spark, tmp_path):
    pages = [(k, "u", f"{k} " + "é\r\n\r\nWARC/1.1 " * (k * 37 % 200)) for k in range(120)]
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2), str(tmp_path / "w"), compression="none")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        rows = warc.captures(warc.read_records(spark, str(tmp_path / "w"))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {int(x.fields["pageId"]): x.response.payload_bytes for x in rows} == {k: len(h.encode()) for k, _, h in pages}

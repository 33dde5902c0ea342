"""Vector best-fit against a plain version of both rules, the exact optimum of small cases, and the tokenizers library."""

import zlib
from itertools import product

import numpy as np
import pytest

from voltaria.llm import bestfit, bpe

TEXTS = [None, "", " ", "word " * 700, "x" * 9000, "Ünïcödé ñandú 東京 😀", "<|endoftext|> plain", "many words " * 5000, "same", "same", *(f"text {k} " * (1 + 7 * k % 300) for k in range(150))]


def plain(need, capacity, rule, weights=bestfit.WEIGHTS):
    """Piece by piece over all sequences; ties to the first."""
    bins, of = [], []
    for s in need.tolist():
        best = None
        for b, left in enumerate(bins):
            if all(r >= x for r, x in zip(left, s, strict=True)):
                parts = zip(weights, left, s, capacity, strict=True)
                score = -sum(w * r * x / c**2 for w, r, x, c in parts) if rule == "dot" else sum(w * ((r - x) / c) ** 2 for w, r, x, c in parts)
                if best is None or score < best[0] * (1 - 1e-12 * np.sign(best[0])):
                    best = score, b
        if best is None:
            bins.append(list(capacity))
            best = 0, len(bins) - 1
        bins[best[1]] = [r - x for r, x in zip(bins[best[1]], s, strict=True)]
        of.append(best[1])
    return of


@pytest.mark.parametrize("rule", ["dot", "norm"])
@pytest.mark.parametrize("capacity", [(100, 100, 10_000), (100, 3, 10_000), (100, 8, 2500)])
def test_rules(rule, capacity):
    rng = np.random.default_rng(3)
    need = bestfit.sizes(np.sort(rng.integers(1, 50, 400))[::-1])
    assert bestfit.best_fit(need, capacity, rule).tolist() == plain(need, capacity, rule)


def optimum(lengths, capacity):
    best = len(lengths)
    for of in product(range(len(lengths)), repeat=len(lengths)):
        if len(set(of)) < best and all(sum(1 for x in of if x == b) <= capacity[1] and sum(n for n, x in zip(lengths, of, strict=True) if x == b) <= capacity[0] and sum(n * n for n, x in zip(lengths, of, strict=True) if x == b) <= capacity[2] for b in set(of)):
            best = len(set(of))
    return best


def test_small_cases_are_near_the_optimum_and_never_under_the_bound():
    rng = np.random.default_rng(5)
    for capacity in [(20, 20, 400), (20, 2, 400), (20, 20, 170)]:
        for _ in range(4):
            lengths = np.sort(rng.integers(1, 13, 6))[::-1]
            best, got = optimum(lengths.tolist(), capacity), bestfit.pack(lengths, capacity).max() + 1
            assert bestfit.fewest(bestfit.sizes(lengths), capacity) <= best <= got <= best + 1


def expected():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.rank_path("byte_bpe_50k.json"))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 0] for x in TEXTS]


@pytest.mark.parametrize(("docs_cap", "cost_cap", "group"), [(None, None, 64), (3, None, 8192), (None, 2048 * 2048 // 1, 8192)])
def test_pieces(spark, docs_cap, cost_cap, group):
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(TEXTS)], "doc_id long, text string, grp string")
    rows = bestfit.pack_documents(docs, most_docs=docs_cap, most_cost=cost_cap, group=group).collect()
    want = expected()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for k, ids in enumerate(want):
        parts = sorted(by_doc[k], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids) // 2048)))
        assert all(r.length == 2048 for r in parts[1:]) and 1 <= parts[0].length <= 2048
        assert sum((list(np.frombuffer(bytes(r.ids), "<u4")) for r in parts), []) == ids
        assert [r.start for r in parts] == [0, *np.cumsum([r.length for r in parts])[:-1].tolist()]
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in parts)
    for seq in by_seq.values():
        seq.sort(key=lambda r: r.offset)
        assert [r.offset for r in seq] == [0, *np.cumsum([r.length for r in seq])[:-1].tolist()]
        assert sum(r.length for r in seq) <= 2048 and len(seq) <= (docs_cap or 2048) and sum(r.length**2 for r in seq) <= (cost_cap or 2048**2)
    if group == 8192:
        least = bestfit.fewest(bestfit.sizes(np.array([r.length for r in rows])), (2048, docs_cap or 2048, cost_cap or 2048**2))
        assert len(by_seq) <= 1.05 * least + 1


def test_repeated_rows_nulls_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "same text")] * 500 + [(None, "none"), (None, None)], "doc_id long, text string")
    rows = bestfit.pack_documents(docs.repartition(3), ids=False, group=50).collect()
    assert len(rows) == 502 and sum(r.doc_id is None for r in rows) == 2
    groups = {r.sequence_id >> 40 for r in rows}
    assert len(groups) > 5  # equal rows spread
    assert bestfit.pack_documents(docs.limit(0)).collect() == []


def test_a_piece_that_no_sequence_admits(spark):
    with pytest.raises(ValueError):
        bestfit.pack(np.array([60, 2]), (100, 10, 3000))

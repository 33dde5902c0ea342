"""Packing of whole documents by vector best-fit.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths). Pieces come by
falling size; each goes to an open sequence that all three capacities admit, the one of the largest weighted dot product of the
piece and what the sequence has left, or the one that would be left with the least weighted residual norm; where none admits
it, a sequence is opened. Both rules are tried on each group and the one with fewer sequences stays (the second isn't tried
where the first reaches the lower bound). Only documents longer than a sequence are cut, into full sequences but
for the first piece.

Pieces are dealt to groups of about ``GROUP`` by a hash of what they are and of which of the task's equal pieces they are, so copies spread and a
task that is run again deals alike. A group sees the mix of lengths of the whole corpus, so what is lost against one packing
of all pieces is less than a sequence or so a group.

Edge cases: a null or empty text has one token (the end id); documents with repeated ids are packed row by row; a null doc_id stays
null; a piece that no empty sequence admits (its squared length alone is over the attention capacity) raises an error before anything is packed;
no rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import rank_path
from .common import bounded_batches, table
from .packing import WINDOW, token_ids

#: Pieces of a group, about.
GROUP = 8192
#: The weights of tokens, documents and attention cost in both rules.
WEIGHTS = (1.0, 0.01, 0.01)


def sizes(lengths: np.ndarray) -> np.ndarray:
    """(tokens, documents, attention cost) of pieces."""
    n = lengths.astype(np.int64)
    return np.stack([n, np.ones_like(n), n * n], axis=1)


def fewest(need: np.ndarray, capacity: Sequence[int]) -> int:
    """No packing has fewer sequences: two pieces over half of one capacity never share, and sums must be held."""
    return max(max(int((2 * x > c).sum()), -(-int(x.sum()) // c)) for x, c in zip(need.T, capacity, strict=True))


def best_fit(need: np.ndarray, capacity: Sequence[int], rule: str, weights: Sequence[float] = WEIGHTS) -> np.ndarray:
    """The sequence of each piece. ``need``: rows of (tokens, documents, cost), largest first. rule: "dot" or "norm"; ties go
    to the sequence opened first."""
    scale = np.array(weights, float) / np.square(np.array(capacity, float))
    of = np.zeros(len(need), np.int64)
    least = np.minimum.accumulate(need[::-1], axis=0)[::-1]  # of what is still to come
    left = np.empty((need.shape[1], len(need)), np.int64)  # what open sequences have left; the first ``live`` columns count
    name = np.empty(len(need), np.int64)
    live = opened = 0
    for k, s in enumerate(need):
        if k % 128 == 0:  # sequences that admit no piece to come are put away
            stay = np.flatnonzero((left[:, :live] >= least[k][:, None]).all(axis=0))
            live = len(stay)
            left[:, :live], name[:live] = left[:, stay], name[stay]
        fits = np.flatnonzero(left[0, :live] >= s[0])
        for d in range(1, len(s)):
            fits = fits[left[d, fits] >= s[d]]
        if len(fits):
            room = left[:, fits]
            score = -((s * scale) @ room) if rule == "dot" else scale @ np.square(room - s[:, None])
            at = fits[score.argmin()]
        else:
            at, name[live], left[:, live] = live, opened, capacity
            live, opened = live + 1, opened + 1
        left[:, at] -= s
        of[k] = name[at]
    return of


def pack(lengths: np.ndarray, capacity: Sequence[int], weights: Sequence[float] = WEIGHTS) -> np.ndarray:
    """The sequence of each piece of a group, by the rule that opens fewer. ``lengths`` fall."""
    need = sizes(lengths)
    if len(need) and (need > np.array(capacity)).any():
        raise ValueError("a piece is over the capacity of an empty sequence")
    best = best_fit(need, capacity, "norm", weights)
    if len(need) and best.max() + 1 > fewest(need, capacity):
        other = best_fit(need, capacity, "dot", weights)
        if other.max() < best.max():
            return other
    return best


def pieces(docs: DataFrame, groups: int, window: int = WINDOW, end_id: int = 0, ids: bool = True, ranks: str | None = None, json_path: str | None = None) -> DataFrame:
    """(grp, doc_id, piece, start, length, ids_crc32 and, on demand, ids): every document's pieces, dealt to groups."""
    ranks, json_path = ranks or rank_path(), json_path or rank_path("byte_bpe_50k.json")
    names = ["grp", "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
    kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3, *[pa.binary()] * ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: Counter = Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.append(token_ids(text or "", ranks, json_path), end_id).astype("<u4")
                first = len(own) - window * ((len(own) - 1) // window)  # in 1..window
                for k, at in enumerate([0, *range(first, len(own), window)]):
                    raw = own[at : first if k == 0 else at + window].tobytes()
                    crc = zlib.crc32(raw)
                    what = zlib.crc32(f"{doc_id} {at} {len(raw)} {crc}".encode())
                    met[what] += 1
                    deal = zlib.crc32(f"{what} {met[what]} {doc_id}".encode()) % groups
                    rows.append((deal, doc_id, k, at, len(raw) // 4, crc, *[raw] * ids))
            cols = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "grp long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids)


def pack_documents(docs: DataFrame, window: int = WINDOW, most_docs: int | None = None, most_cost: int | None = None, weights: Sequence[float] = WEIGHTS, end_id: int = 0, ids: bool = True, group: int = GROUP, ranks: str | None = None, json_path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and its ids as little-endian unsigned
    32-bit integers unless ``ids`` is false. Sequences have ``window`` tokens, ``most_docs`` documents and the attention
    cost ``most_cost`` at most; by default the last two never bind, as a piece has a token at least and the cost is
    at most the square of the tokens."""
    capacity = (window, most_docs or window, most_cost or window * window)
    groups = max(1, -(-docs.count() // group))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]

    def run(table: pa.Table) -> pa.Table:
        length = table["length"].to_numpy()
        number = table["grp"][0].as_py() << 40
        # falling lengths; equal ones in an order of their own, so that a group packed again gives the same
        keys = [table[c].to_numpy(zero_copy_only=False) if table[c].null_count == 0 else np.array([-1 if v is None else v for v in table[c].to_pylist()]) for c in ("ids_crc32", "piece", "doc_id")]
        order = np.lexsort((*keys, -length))
        of = pack(length[order], capacity, weights)
        by = np.argsort(of, kind="stable")  # piece by piece, sequence by sequence
        taken, seq = length[order][by], of[by]
        ends = np.cumsum(taken)
        starts = ends - taken
        begins = starts[np.searchsorted(seq, seq)]
        out = table.select(keep).take(pa.array(order[by]))
        return out.append_column("sequence_id", pa.array(number + seq, pa.int64())).append_column("offset", pa.array(starts - begins, pa.int64()))

    kinds = {"piece": "int", "ids": "binary"}
    schema = ", ".join(f"{c} {kinds.get(c, 'long')}" for c in [*keep, "sequence_id", "offset"])
    return pieces(docs, groups, window, end_id, ids, ranks, json_path).groupBy("grp").applyInArrow(run, schema)


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pack_documents(table(spark, sf_dir, "documents"), ids=False)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset"))

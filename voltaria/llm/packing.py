"""Packing of token sequences into windows by non-negative least squares.

Every task encodes its documents, cuts what fills whole windows and keeps the tails. For each bounded set of tails it
takes the histogram of tail lengths over ``BINS`` bins, enumerates the shallow combinations of bins (at most
``DEPTH`` tails) that fill a window, solves for how often to repeat each (non-negative least squares against the
histogram), rounds down and builds those windows. The residual tails are then packed greedily: they are cut to fill
the slack of the windows built, and what is left is laid end to end. The last tokens of a task, fewer than a window,
form sequences whose lengths are powers of two, which need no padding. Nothing is shuffled and no state grows with
the input, so hot sources and long documents only mean more windows.

Edge cases: a null or empty text has one token (the end id); documents with repeated ids are packed row by row;
no rows give no pieces; a document longer than a window is cut, each id in exactly one piece.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode, encoding, rank_path
from .common import bounded_batches, table

WINDOW, BINS, DEPTH, TAILS = 2048, 32, 4, 4096


@functools.lru_cache(2)
def combinations(bins: int = BINS, depth: int = DEPTH) -> np.ndarray:
    """Columns: how many tails of each bin (1..bins) a window gets, for all multisets of at most ``depth`` that sum to ``bins``."""
    found: list[list[int]] = []

    def grow(left: int, most: int, have: list[int]) -> None:
        if not left:
            found.append(have)
        elif len(have) < depth:
            for b in range(min(left, most), 0, -1):
                if b * (depth - len(have)) >= left:
                    grow(left - b, b, [*have, b])

    grow(bins, bins, [])
    return np.array([np.bincount(x, minlength=bins + 1)[1:] for x in found], float).T


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 200) -> np.ndarray:
    """min ||a x - b|| for x >= 0, by active sets: free the steepest variable, solve, step back to the border."""
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        k = int(slope.argmax())
        if slope[k] <= 1e-8 * (1 + np.abs(b).max()):
            break
        free[k] = True
        for _ in range(rounds):
            s = np.zeros_like(x)
            s[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (s[free] > 1e-12).all():
                break
            bad = free & (s <= 1e-12)
            step = np.min(x[bad] / np.maximum(x[bad] - s[bad], 1e-300)) if bad.any() else 1.0
            x = x + min(1.0, step) * (s - x)
            free &= x > 1e-12
            x[~free] = 0
        x = s
    return np.maximum(x, 0)


#: A piece before placing: (row of the document, ids before it in the document, its ids).
Piece = tuple[int, int, np.ndarray]


def plan_windows(tails: list[Piece], window: int = WINDOW) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows built from whole tails by the rounded solution, and the tails not used."""
    width = window // BINS
    stacks: list[list[Piece]] = [[] for _ in range(BINS + 1)]
    for t in tails:
        stacks[-(-len(t[2]) // width)].append(t)
    hist = np.array([len(s) for s in stacks[1:]], float)
    a = combinations()
    times = np.floor(nnls(a, hist) + 1e-6).astype(int)
    built = []
    for k in np.flatnonzero(times):
        need = [(int(b) + 1, int(a[b, k])) for b in np.flatnonzero(a[:, k])]
        for _ in range(times[k]):
            if any(len(stacks[b]) < n for b, n in need):
                break
            built.append([stacks[b].pop() for b, n in need for _ in range(n)])
    return built, [t for s in stacks for t in s]


def fill(built: list[list[Piece]], residual: list[Piece], window: int = WINDOW) -> tuple[list[list[Piece]], list[Piece]]:
    """Greedy rest: residual tails are cut into the windows' slack, then laid end to end; returns full windows and the remainder."""
    full: list[list[Piece]] = []
    queue = residual[::-1]

    def take(n: int) -> list[Piece]:
        got = []
        while n and queue:
            row, at, ids = queue.pop()
            if len(ids) > n:
                queue.append((row, at + n, ids[n:]))
                ids = ids[:n]
            got.append((row, at, ids))
            n -= len(ids)
        return got

    left = sum(len(t[2]) for t in queue)
    built = sorted(built, key=lambda w: -sum(len(p[2]) for p in w))
    while built:
        slack = window - sum(len(p[2]) for p in built[0])
        if slack <= left:
            full.append(built.pop(0) + take(slack))
            left -= slack
        else:  # too little left over: take a built window apart
            more = built.pop()
            queue[:0] = more
            left += sum(len(p[2]) for p in more)
    while left >= window:
        full.append(take(window))
        left -= window
    return full, queue[::-1]


def powers_of_two(rest: list[Piece]) -> list[list[Piece]]:
    """The remainder as sequences whose lengths are powers of two."""
    out, total = [], sum(len(t[2]) for t in rest)
    queue = rest[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        n, seq = total & (1 << bit), []
        while n:
            row, at, ids = queue.pop()
            if len(ids) > n:
                queue.append((row, at + n, ids[n:]))
                ids = ids[:n]
            seq.append((row, at, ids))
            n -= len(ids)
        if seq:
            out.append(seq)
    return out


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
#: A text with this string has an id of its own for it in the JSON form of the vocabulary.
SPECIAL = "<|endoftext|>"


@functools.lru_cache(1)
def _json_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str, ranks: str, special_path: str) -> np.ndarray:
    """The ids that the tokenizers library gives for the JSON file; the rank file holds the same vocabulary and is faster."""
    if SPECIAL in text:
        return np.array(_json_tokenizer(special_path).encode(text, add_special_tokens=False).ids, np.uint32)
    return encode(encoding(ranks), text)


def pack_documents(docs: DataFrame, end_id: int = 1, ranks: str | None = None, json_path: str | None = None) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit integers. Sequence ids: partition << 40 plus a count."""
    ranks, json_path = ranks or rank_path(), json_path or rank_path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 40
        known: list[tuple] = []  # (doc_id, tokens) of the rows that tails refer to
        tails: list[Piece] = []
        out: list[tuple] = []
        held = 0

        def put(seq: list[Piece]) -> None:
            nonlocal number, held
            offset = 0
            for row, at, ids in seq:
                doc_id, n = known[row]
                out.append((doc_id, at, len(ids), ids.tobytes(), n, number, offset))
                offset += len(ids)
                held += 4 * len(ids)
            number += 1

        def flush() -> pa.RecordBatch:
            nonlocal held
            cols = list(zip(*out, strict=True)) or [[] for _ in _NAMES]
            held = 0
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if n == "ids" else pa.int64()) for n, c in zip(_NAMES, cols, strict=True)], names=_NAMES)

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(token_ids(text or "", ranks, json_path), end_id).astype("<u4")
                known.append((doc_id, len(ids)))
                cut = len(ids) // WINDOW * WINDOW
                for at in range(0, cut, WINDOW):
                    put([(len(known) - 1, at, ids[at : at + WINDOW])])
                if cut < len(ids):
                    tails.append((len(known) - 1, cut, ids[cut:].copy()))
                if len(tails) >= TAILS:
                    full, tails = fill(*plan_windows(tails))
                    for seq in full:
                        put(seq)
                    known, tails = [known[t[0]] for t in tails], [(k, t[1], t[2]) for k, t in enumerate(tails)]
                if held > 8 << 20:
                    yield flush()
        full, rest = fill(*plan_windows(tails))
        for seq in full + powers_of_two(rest):
            put(seq)
        yield flush()

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

"""Exact top-k inner products by no-random-access aggregation.

Queries and vectors are dealt over a bounded number of cells: a cell holds a share of the queries in memory and reads a
share of the vectors as a stream, block by block. A block keeps one list per dimension, sorted by value; for a query the
list is read from the end that adds most, an eighth at a time. Every vector has a lower bound (what was seen, and for the
lists that it wasn't met in the least that they hold) and an upper bound (what was seen, and for those lists the value at
the depth read). Reading stops when no outsider can reach the bar, the k-th best score of the query, but for a few
candidates, and the scores of the candidates left are resolved. The bar goes on from block to block; a cell's first block is small,
so that there is a bar early.
A cell's k best per query go on to the last ranking.

Sums are whole numbers: bounds are doubles where all sums stay below 2**53, else 64-bit integers, else Python's own, by the same
steps; scores are integers.

Edge cases: a vector that is null, empty or holds null or non-finite components takes no part, nor does one with a null
id; vectors of another length than the query score the dimensions that they share; ties go to the smaller id; rows that
repeat an id are candidates each, but never of their own query; a query that is repeated with another vector is another
query of the same id and they share the k places; components whose 1024-fold exceeds a long, and scores that do, raise an
error; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import importable, partitions, table

#: The scale of components; vectors in a block, and in a cell's first; queries that read together; queries that a cell holds at most; parts that lists are read in.
SCALE, VECTORS, SEED, AT_ONCE, QUERIES, STEPS = 1024, 8192, 512, 256, 200_000, 8
NONE = np.iinfo(np.int64).min


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the vectors that take part: floor(1024 * component)."""
    x = F.col("embedding").cast("array<double>")
    sound = F.size(x) > 0
    ok = sound & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    part = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return part.filter(ok).select(F.col("vec_id").cast("long"), F.transform(x, lambda v: F.floor(v * SCALE).cast("long")).alias("x"))


class Lists:
    """One block's sorted lists. ``x``: vectors of one length, as rows of integers."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.at = np.argsort(self.x, axis=0, kind="stable")
        self.up = np.take_along_axis(self.x, self.at, axis=0)
        self.place = np.empty_like(self.at)  # of each vector in each list, from the bottom
        np.put_along_axis(self.place, self.at, np.arange(len(ids))[:, None], axis=0)
        self.entries = 0  # read so far, by all queries

    def best(self, asked: np.ndarray, q: np.ndarray, k: int, bars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (a row of ``q``, its id in ``asked``): scores and ids of those of the k best of this block that
        reach its bar (a score that k vectors have already), ties to the smaller id."""
        n, d = self.x.shape
        q, x, up = q[:, :d], self.x, self.up
        most = int(max(-up.min(), up.max(), 1)) * int(np.abs(q).sum(axis=1).max()) * 4
        # whole numbers that a double holds are multiplied as doubles, larger ones as what holds them
        kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object
        if kind is object:
            q, x = q.astype(object), x.astype(object)
        own = {j: np.flatnonzero(self.ids == i) for j, i in enumerate(asked)}
        plus, minus = np.maximum(q, 0).astype(kind), np.minimum(q, 0).astype(kind)
        values, least, top = x.astype(kind), up[0].astype(kind), up[-1].astype(kind)
        out: list = [None] * len(q)
        left, before = np.arange(len(q)), 0
        for step in range(1, STEPS + 1):
            depth = -(-n * step // STEPS)
            p, m = plus[left].T, minus[left].T
            # lists are read from the top for positive weights and from the bottom for negative ones
            high, deep = self.place >= n - depth, self.place < depth
            # what a vector has at most in the lists that it wasn't met in yet
            over, under = (up[n - 1 - depth].astype(kind), up[depth].astype(kind)) if depth < n else (least, top)
            bound = np.where(high, values - over, 0) @ p + np.where(deep, values - under, 0) @ m + (over @ p + under @ m)
            low = np.where(high, values - least, 0) @ p + np.where(deep, values - top, 0) @ m + (least @ p + top @ m)
            self.entries += d * (depth - before) * len(left)
            done = np.zeros(len(left), bool)
            for c, j in enumerate(left):
                bar = bars[j]
                if n >= k:
                    have = low[:, c].copy()
                    have[own[j]] = have.min() - 1
                    bar = max(bar, int(np.partition(have, n - k)[n - k]))
                may = np.flatnonzero(bound[:, c] >= bar)
                may = may[self.ids[may] != asked[j]]
                if depth >= n or len(may) <= max(4 * k, n // 64):
                    score = x[may] @ q[j]
                    first = np.lexsort((self.ids[may], -score))[:k]
                    out[j], done[c] = (score[first], self.ids[may][first]), True
            left, before = left[~done], depth
            if not len(left):
                break
        return out


class _Cell:
    """The queries of a cell and the best that they have met."""

    def __init__(self, k: int) -> None:
        self.k, self.rows, self.block = k, [], []
        self.ready = False
        self.entries = self.total = 0

    def _start(self) -> None:
        self.ids = np.array([i for i, _ in self.rows], np.int64)
        self.q = np.zeros((len(self.rows), max(len(v) for _, v in self.rows)), np.int64)
        for row, (_, v) in zip(self.q, self.rows, strict=True):
            row[: len(v)] = v
        self.bars = np.full(len(self.rows), NONE, np.int64)
        self.best: list = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(self.rows)
        self.ready = True

    def settle(self) -> None:
        """Reads the block that is at hand."""
        if not self.block or not self.rows:
            self.block = []
            return
        if not self.ready:
            self._start()
        by_size: dict[int, list] = {}
        for i, v in self.block:
            by_size.setdefault(len(v), []).append((i, v))
        self.block = []
        for part in by_size.values():
            lists = Lists(np.array([i for i, _ in part], np.int64), np.array([v for _, v in part], np.int64))
            wide = np.zeros((len(self.ids), max(0, lists.x.shape[1] - self.q.shape[1])), np.int64)
            q = np.hstack([self.q, wide]) if wide.shape[1] else self.q
            for at in range(0, len(self.ids), AT_ONCE):
                some = slice(at, at + AT_ONCE)
                for j, (score, ids) in enumerate(lists.best(self.ids[some], q[some], self.k, self.bars[some]), at):
                    score, ids = np.concatenate([self.best[j][0], score]), np.concatenate([self.best[j][1], ids])
                    first = np.lexsort((ids, -score))[: self.k]
                    self.best[j] = score[first], ids[first]
                    if len(first) == self.k:
                        self.bars[j] = score[first[-1]]
            self.entries += lists.entries
            self.total += lists.x.size * len(self.ids)

    def batch(self) -> pa.RecordBatch:
        self.settle()
        found = [(int(i), int(v), int(s)) for i, (score, ids) in zip(self.ids, self.best, strict=True) for s, v in zip(score, ids, strict=True)] if self.ready else []
        cols = list(zip(*found, strict=True)) or [[], [], []]
        share = [pa.array([v] * len(found), pa.int64()) for v in (self.entries, self.total)]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), *share], names=["query_id", "vec_id", "score", "entries_read", "entries"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, per_block: int = VECTORS, per_cell: int = QUERIES, report: bool = False) -> DataFrame:
    """(query_id, rank, vec_id, score). Both tables: (vec_id, embedding).

    With c columns of cells for the queries and r rows of cells for the vectors, queries are sent r times and vectors c
    times; c follows from what a cell may hold, r * c is bounded by the cluster's partitions (four cells each).
    ``report``: two more columns, the list entries that the row's cell read and those that its lists hold.
    """
    spark = vectors.sparkSession
    importable(spark)
    pool, asked = scaled(vectors), scaled(queries).distinct()
    n, m = pool.count(), asked.count()
    c = max(1, -(-m // per_cell))
    r = max(1, min(4 * partitions(spark) // c, -(-n // per_block)))
    # rows are dealt by hash of id and content, so that repeated ids spread too
    deal = lambda parts: F.pmod(F.xxhash64("vec_id", "x"), F.lit(parts)).cast("int")
    all_of = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    q = asked.withColumn("col", deal(c)).withColumn("row", all_of(r)).withColumn("kind", F.lit(0))
    v = pool.withColumn("row", deal(r)).withColumn("col", all_of(c)).withColumn("kind", F.lit(1))
    both = q.select("row", "col", "kind", "vec_id", "x").union(v.select("row", "col", "kind", "vec_id", "x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, cell = None, _Cell(k)
        for batch in batches:
            rows, cols, kinds, ids = (batch.column(i).to_pylist() for i in range(4))
            x = batch.column(4)
            flat, offsets = x.flatten().to_numpy(zero_copy_only=False), np.append(0, np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False)))
            for t, here in enumerate(zip(rows, cols, strict=True)):
                if here != at:
                    if at is not None:
                        yield cell.batch()
                    at, cell = here, _Cell(k)
                (cell.block if kinds[t] else cell.rows).append((ids[t], flat[offsets[t] : offsets[t + 1]]))
                if len(cell.block) >= (per_block if cell.ready else min(per_block, SEED)):
                    cell.settle()
        if at is not None:
            yield cell.batch()

    dealt = both.repartition(min(r * c, 4 * partitions(spark)), "row", "col").sortWithinPartitions("row", "col", "kind")
    found = dealt.mapInArrow(run, "query_id long, vec_id long, score long, entries_read long, entries long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score", *(["entries_read", "entries"] if report else []))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 100 = 0"))


OP8_SQL = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
               WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    e AS (SELECT vec_id, unnest(range(len(x))) AS d, unnest(x) AS x FROM v),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
          FROM e q JOIN e c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
    r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

"""Compression of vectors to short codes: product quantization whose search prunes by norm.

Vectors become integers and are cut into equal parts; each part position has a codebook of a few entries. A round assigns
every part to its nearest entry and moves each entry to the floor of its parts' mean. Entries are kept sorted by norm. A
part starts at the entry of the nearest norm; as the distance of two vectors is at least the difference of their norms,
only entries whose norms lie within the best distance so far of the part's own can be as near, and two binary searches bound
that annulus. Its entries are evaluated exactly, the border included, and the annulus is searched anew whenever the best
distance falls. All distances are integers; norms are roots and only decide, with a margin, what is not looked at.

What reaches the driver are codebooks: entries times parts. Tasks send one row of sums per part and entry.

Edge cases: a vector that is null or holds null or non-finite components is dropped; null labels are one label and a null
vec_id is the last in order; rows that repeat a vec_id are vectors each (the first entries are taken by vec_id, then by
components); with fewer vectors than entries there are fewer entries; vectors of another length than the longest, or whose length
the parts don't divide, are filled up with zeros; components of any size are computed exactly, and errors or sums that a long can't hold raise an
error; no vectors give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, importable, table

#: The scale of components; parts of a vector; entries of a codebook; rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components below this have distances within a long, whatever the usual width.
SMALL = 1 << 27
#: Vectors that are searched at once.
AT_ONCE = 8192


def integers(column: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of an Arrow column of lists that are sound, and their floor(scale * component), as 64-bit or Python integers."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    flat = column.flatten()
    gone = flat.is_null().to_numpy(zero_copy_only=False)
    x = np.floor(flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False) * float(scale))
    bad = gone | ~np.isfinite(x)
    count = np.concatenate([[0], np.cumsum(bad)])
    sound = np.flatnonzero((count[ends] == count[ends - lengths]) & column.is_valid().to_numpy(zero_copy_only=False))
    x[bad] = 0
    whole = x.astype(np.int64) if not len(x) or np.abs(x).max() < 2**62 else np.array([int(v) for v in x], object)
    return sound, [whole[ends[k] - lengths[k] : ends[k]] for k in sound]


def matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Vectors as rows of ``width``, filled up with zeros; 64-bit where distances can't exceed that."""
    if rows and all(len(r) == width for r in rows):
        out = np.stack(rows)
    else:
        out = np.zeros((len(rows), width), object if any(r.dtype == object for r in rows) else np.int64)
        for o, r in zip(out, rows, strict=True):
            o[: len(r)] = r
    return out if out.dtype == object or not out.size or np.abs(out).max() < SMALL else out.astype(object)


def root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(x.astype(float))


class Codebook:
    """The entries of one part position, with their order by norm."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        norms = root((entries * entries).sum(axis=1))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]
        self.evaluated = 0

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row of ``x`` (ties: lower index), and the squared distance."""
        n, size = len(x), len(self.order)
        own = root((x * x).sum(axis=1))
        right = np.searchsorted(self.norms, own)
        below, above = np.maximum(right - 1, 0), np.minimum(right, size - 1)
        at = np.where(own - self.norms[below] <= self.norms[above] - own, below, above)
        best, dist = self.order[at], self._distance(x, self.order[at])
        low, high = self._annulus(own, dist)
        down, up = at - 1, at + 1  # the next entries on both sides of what was evaluated
        rows = np.arange(n)
        while True:
            rows = rows[(down[rows] >= low[rows]) | (up[rows] < high[rows])]
            if not len(rows):
                break
            d, u = down[rows], up[rows]
            inner, outer = own[rows] - self.norms[np.maximum(d, 0)], self.norms[np.minimum(u, size - 1)] - own[rows]
            downward = (d >= low[rows]) & ((u >= high[rows]) | (inner <= outer))  # the nearer norm first
            entry = self.order[np.where(downward, d, u)]
            down[rows], up[rows] = d - downward, u + ~downward
            far = self._distance(x[rows], entry)
            nearer = far < dist[rows]
            better = nearer | (far == dist[rows]) & (entry < best[rows])
            best[rows[better]] = entry[better]
            moved = rows[nearer]
            dist[moved] = far[nearer]
            low[moved], high[moved] = self._annulus(own[moved], dist[moved])
        return best, dist

    def _distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        self.evaluated += len(x)
        apart = x - self.entries[entry]
        return (apart * apart).sum(axis=1)

    def _annulus(self, own: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries, by norm, that may be as near as ``dist``: from, to. The margin covers the roots' rounding."""
        reach = root(dist)
        reach = reach + 1e-9 * (own + reach) + 1e-6
        return np.searchsorted(self.norms, own - reach, "left"), np.searchsorted(self.norms, own + reach, "right")


class Coder:
    """Codebooks of all positions; assigns whole vectors."""

    def __init__(self, books: list[list[list[int]]]) -> None:
        big = any(abs(v) >= SMALL for b in books for e in b for v in e)
        self.books = [Codebook(np.array(b, object if big else np.int64).reshape(len(b), -1)) for b in books]

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance by row and part."""
        found = [b.nearest(part) for b, part in zip(self.books, np.split(x, len(self.books), axis=1), strict=True)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def digest(self) -> str:
        """SHA-256 of all entries' components in order of part, entry and position."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for v in b.entries.ravel()).encode()).hexdigest()


def _blocks(batches: Iterator[pa.RecordBatch], width: int, column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, its sound rows, their vectors), in bounded blocks."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            some = batch.slice(at, AT_ONCE)
            sound, rows = integers(some.column(column))
            if len(sound):
                yield some, sound, matrix(rows, width)


def first_entries(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> tuple[list[list[list[int]]], int]:
    """The codebooks before the first round and the width of vectors: each task keeps its ``entries`` least rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, width, any_row = [], 0, False
        for batch in batches:
            sound, rows = integers(batch.column(1))
            ids = batch.column(0).to_pylist()
            any_row |= len(sound) > 0
            width = max([width, *map(len, rows)])
            have += [((ids[k] is None, ids[k] or 0), r.tolist()) for k, r in zip(sound, rows, strict=True)]
            have = sorted(have)[:entries]
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([None if i[0] else i[1] for i, _ in have], pa.int64()), pa.array([[str(v) for v in r] for _, r in have], pa.list_(pa.string())), pa.array([width] * len(have), pa.int64())], names=["vec_id", "x", "width"])

    least = cut_lineage(vectors.select("vec_id", "embedding").mapInArrow(run, "vec_id long, x array<string>, width long"))
    longest = least.agg(F.max("width")).first()[0]
    if longest is None:
        return [], 0
    order = F.transform("x", lambda v: v.cast("decimal(38,0)"))
    rows = least.orderBy(F.asc_nulls_last("vec_id"), order).limit(entries).collect()
    width = -(-longest // parts) * parts
    full = [[int(v) for v in r.x] + [0] * (width - len(r.x)) for r in rows]
    step = width // parts
    return [[r[p * step : (p + 1) * step] for r in full] for p in range(parts)], width


def moved(vectors: DataFrame, books: list[list[list[int]]], width: int) -> list[list[list[int]]]:
    """The codebooks after a round."""
    parts, size, step = len(books), len(books[0]), width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        sums: np.ndarray = np.zeros((parts * size, step), object)
        count = np.zeros(parts * size, np.int64)
        for _, _, x in _blocks(batches, width):
            codes, _ = coder.codes(x)
            for p, part in enumerate(np.split(x, parts, axis=1)):
                for e in range(size):
                    rows = codes[:, p] == e
                    if rows.any():
                        sums[p * size + e] += part[rows].sum(axis=0).astype(object)
                        count[p * size + e] += int(rows.sum())
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(count[used], pa.int64()), pa.array([[str(v) for v in sums[k]] for k in used], pa.list_(pa.string()))], names=["slot", "n", "sums"])

    totals = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(step)]
    got = vectors.select("embedding").mapInArrow(run, "slot long, n long, sums array<string>").groupBy("slot").agg(F.sum("n").alias("n"), *totals).collect()
    out = [[list(e) for e in b] for b in books]
    for r in got:
        out[r.slot // size][r.slot % size] = [int(v) // r.n for v in r[2:]]
    return out


def coded(vectors: DataFrame, books: list[list[list[int]]], width: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(vec_id, code, error, then ``carry``) of every sound vector."""
    kinds = dict(vectors.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        for batch, sound, x in _blocks(batches, width, 1):
            codes, dist = coder.codes(x)
            text = codes.astype(np.uint8).tobytes().hex()
            wide = 2 * codes.shape[1]
            rows = pa.array(sound)
            others = [batch.column(k).take(rows) for k in (0, *range(2, batch.num_columns))]
            own = [pa.array([text[k : k + wide] for k in range(0, len(text), wide)], pa.string()), pa.array([int(v) for v in dist.sum(axis=1)], pa.int64())]
            yield pa.RecordBatch.from_arrays([others[0], *own, *others[1:]], names=["vec_id", "code", "error", *(f"_{c}" for c in carry)])

    out = vectors.select(F.col("vec_id").cast("long"), "embedding", *carry).mapInArrow(run, "vec_id long, code string, error long" + "".join(f", `_{c}` {kinds[c]}" for c in carry))
    return out.selectExpr("vec_id", "code", "error", *(f"`_{c}` AS `{c}`" for c in carry))


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[list[list[int]]], int]:
    """Codebooks after ``rounds`` rounds over all vectors, and the width. ``vectors``: (vec_id, embedding)."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    importable(vectors.sparkSession)
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    books, width = first_entries(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = moved(vectors, books, width)
    return books, width


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256). Labels' errors come from a partial aggregate, joined back."""
    books, width = train(vectors, parts, entries, rounds)
    if not books:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    rows = cut_lineage(coded(vectors, books, width, ("label",)))
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    both = rows.alias("r").join(sums.alias("s"), F.col("r.label").eqNullSafe(F.col("s.label")))
    return both.select("vec_id", "code", "error", "label_error", F.lit(Coder(books).digest()).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op13_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """All rounds written out, each a common table of assignments and one of entries."""
    assigned = lambda k: f"""
    a{k} AS MATERIALIZED (SELECT vec_id, part, x, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d FROM (
             SELECT p.vec_id, p.part, p.x, c.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda i: (p.x[i] - c.x[i]) * (p.x[i] - c.x[i])))::BIGINT AS d
             FROM p JOIN c{k} c USING (part)) GROUP BY vec_id, part, x)"""  # noqa: E731
    step = lambda k: f"""{assigned(k)},
    m{k} AS (SELECT part, entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS i) GROUP BY ALL),
    n{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM m{k} GROUP BY ALL),
    c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(n.x, c.x) AS x FROM c{k} c LEFT JOIN n{k} n USING (part, entry))"""  # noqa: E731
    return f"""
    WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    p AS MATERIALIZED (SELECT vec_id, part, x[part * len(x) // {parts} + 1:(part + 1) * len(x) // {parts}] AS x FROM v, (SELECT unnest(range({parts})) AS part)),
    c0 AS MATERIALIZED (SELECT part, (row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1) AS entry, x FROM p QUALIFY entry < {entries}),
    {",".join(map(step, range(rounds)))},
    {assigned(rounds)},
    h AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256 FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS i FROM c{rounds})),
    e AS (SELECT vec_id, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e JOIN v USING (vec_id), h"""

"""Near-duplicate documents by an LSH forest over MinHash signatures.

Each document's set of word shingles gets a signature of ``TREES`` orders with ``MAX_DEPTH`` values each. In every order
all documents are sorted by their values, over range partitions, so that equal values of any number of documents are
dealt evenly. A document's candidates are the one before it and the first of the run of documents that share its longest
common prefix with that one: the prefix is as deep as the neighbourhood allows, so large regions are told apart at deeper
values and small ones at shallower. ``depth``, the least prefix that counts, follows from the threshold: the deepest at
which a pair at the threshold is missed by all orders with a chance of at most ``MISS``. Documents that share a prefix of
that depth form a region.

No region is ever held whole and no group is expanded into all its pairs:

1.  Documents with equal sets are one class; its smallest document stands for it.
2.  Candidates by longest common prefix are confirmed on full sets, and components of confirmed links are formed.
3.  Regions that still hold several components are what may hide a link: their members' pairs across components
    (and no others) are confirmed too, in the region's own tasks and once per pair however many regions share it,
    unless sizes or signatures already rule the link out (a signature that agrees so little has a chance below
    ``MISS``). Components are formed anew.

Pairs are confirmed by the exact sizes of intersection and union of 64-bit shingle hashes.

Edge cases: a null, empty or white-space text has no shingles and links with nothing; a text with fewer words than a
shingle has one shingle, all its words; repeated rows of one doc_id are one document of the union of its links (each row is
returned); rows with a null doc_id are returned alone; very long texts are taken whole; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, cut_lineage, partitions, table
from .components import components
from .repeats import U, WordHashes, mixed

TREES, MAX_DEPTH, MISS = 24, 8, 1e-5
#: Shingles of a region's part (a task holds two parts); pairs that share one copy of a document's text.
PART, HUB = 1_000_000, 256

_rng = np.random.default_rng(20240301)
_ODD = (_rng.integers(1, 2**31, TREES * MAX_DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_XOR = _rng.integers(0, 2**32, TREES * MAX_DEPTH, dtype=np.uint32)[:, None]


def depth_for(threshold: float) -> int:
    """The deepest prefix at which all orders miss a pair at the threshold with a chance of at most MISS."""
    return max([1, *(d for d in range(1, MAX_DEPTH + 1) if (1 - threshold**d) ** TREES <= MISS)])


def shingles(text: bytes, size: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text, A-Z lower-cased."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, w), np.uint64, len(w))
    n = min(size, len(w))
    out = np.full(len(w) - n + 1, n, np.uint64)
    for k in range(n):
        out = mixed(out * U(0x9E3779B97F4A7C15) + h[k : k + len(out)])
    return np.unique(out)


def signature(s: np.ndarray) -> np.ndarray:
    """TREES x MAX_DEPTH least values under as many orders of the shingles."""
    x = s.astype(np.uint32)[None, :]
    least = np.full(len(_ODD), 0xFFFFFFFF, np.uint32)
    for at in range(0, x.shape[1], 4096):
        np.minimum(least, ((x[:, at : at + 4096] ^ _XOR) * _ODD).min(axis=1), out=least)
    return least


def links(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, exactly."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return bool(both) and 100 * both >= percent * (len(a) + len(b) - both)


def sketches(docs: DataFrame, size: int, depth: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n, high, low, keys, agree, packed): set size and 128-bit hash; the hash of each order's number and first
    ``depth`` values; a byte of every value, order by order (of its hash: the least values themselves are all small); the
    text compressed; carried columns as _name."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, pack = WordHashes(), zstandard.ZstdCompressor(level=3)
        for batch in batches:
            n, high, low, keys, agree, packed = [], [], [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                s = shingles(text or b"", size, memo)
                n.append(len(s))
                packed.append(None if text is None else pack.compress(text))
                whole = xxhash.xxh3_128_digest(s.tobytes())
                high.append(int.from_bytes(whole[:8], "little", signed=True))
                low.append(int.from_bytes(whole[8:], "little", signed=True))
                if not len(s):
                    for x in (keys, agree):
                        x.append(None)
                    continue
                sig = signature(s).reshape(TREES, MAX_DEPTH)
                h = np.arange(TREES, dtype=np.uint64)
                for k in range(depth):
                    h = mixed(h * U(0x9E3779B97F4A7C15) + sig[:, k].astype(np.uint64))
                keys.append(h.view(np.int64))
                agree.append(((sig ^ (sig >> np.uint32(15))) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes())
            cols = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, high, low)), pa.array(keys, pa.list_(pa.int64())), pa.array(agree, pa.binary()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols + batch.columns[2:], names=["doc_id", "n", "high", "low", "keys", "agree", "packed", *(f"_{c}" for c in carry)])

    bounded_batches(docs.sparkSession)
    kinds = dict(docs.dtypes)
    schema = "doc_id long, n long, high long, low long, keys array<long>, agree binary, packed binary"
    made = docs.select("doc_id", "text", *carry).mapInArrow(run, schema + "".join(f", `_{c}` {kinds[c]}" for c in carry))
    return cut_lineage(made.repartition(partitions(docs.sparkSession), "doc_id"), dealt=True)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of distinct pairs (a, b) those that link, by their full sets. texts: (doc_id, packed), one row per document.

    Many pairs may share b, the first document of a large region. Such a document's text is copied to as many parts as
    its pairs need, so pairs are dealt evenly; the work itself is dealt by a.
    """
    pairs = cut_lineage(pairs.distinct())
    hubs = cut_lineage(pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")
    of_b = texts.join(hubs.withColumnRenamed("b", "doc_id"), "doc_id").select(F.col("doc_id").alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("packed").alias("of_b"))
    first = pairs.join(hubs, "b").withColumn("part", part).join(of_b, ["b", "part"])
    both = first.join(texts.select(F.col("doc_id").alias("a"), F.col("packed").alias("of_a")), "a").select("a", "b", "of_a", "of_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, unpack, last, of_last = WordHashes(), zstandard.ZstdDecompressor(), None, None
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if x != last:
                    last, of_last = x, shingles(unpack.decompress(x), size, memo)
                if links(of_last, shingles(unpack.decompress(y), size, memo), percent):
                    out.append((a, b))
            yield pa.RecordBatch.from_pydict({"a": pa.array([r[0] for r in out], pa.int64()), "b": pa.array([r[1] for r in out], pa.int64())})

    return both.mapInArrow(run, "a long, b long")


def _neighbours(members: DataFrame, depth: int) -> DataFrame:
    """Candidate pairs of every sorted order: (tree, values, doc), a byte a value.

    A partition's first document has no one before it; regions that hold several components are compared in any case.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, before, last = None, b"", None
        first = [None] * (MAX_DEPTH + 1)  # by depth: the first document of the run that shares that many values
        for batch in batches:
            a, b = [], []
            for tree, values, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                common = 0
                if tree == order:
                    common = MAX_DEPTH if values == before else next(k for k in range(MAX_DEPTH) if values[k] != before[k])
                if common >= depth:
                    for other in {last, first[common]}:
                        if other != doc:
                            a.append(max(doc, other))
                            b.append(min(doc, other))
                first[common + 1 :] = [doc] * (MAX_DEPTH - common)
                order, before, last = tree, values, doc
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    by = ("tree", "values", "doc")
    dealt = members.select(*by).repartitionByRange(partitions(members.sparkSession), *by)
    return dealt.sortWithinPartitions(*by).mapInArrow(run, "a long, b long")


def _labelled(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """nodes (doc) with their component, themselves where they have no link."""
    return nodes.join(found.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))


def _across(members: DataFrame, size: int, percent: int, share: float) -> DataFrame:
    """Links between members of one region that are in different components, enough of them to unite what they unite.

    members: (tree, key, weight, n, doc, component, keys, agree, packed), weight: the sum of the region's set sizes. A
    region of more than PART shingles is dealt into parts, and every two parts meet in a task of their own, so that a
    task holds the sets of two parts. There every pair that sizes and signatures allow is compared on the full sets, in
    the first region that the pair shares; no pairs are shipped.
    """
    parts = F.ceil(F.col("weight") / PART).cast("int")
    own = F.pmod(F.xxhash64("doc"), parts).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.select("tree", "key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "n", "doc", "component", "keys", "agree", "packed")

    def united(rows: list[tuple], memo: WordHashes) -> list[tuple[int, int]]:
        unpack = zstandard.ZstdDecompressor()
        tree, _, x, y = rows[0][:4]
        part, n, doc, component = (np.array([r[k] for r in rows]) for k in (4, 5, 6, 7))
        keys, agree = np.array([r[8] for r in rows]), np.array([np.frombuffer(r[9], np.uint8) for r in rows])
        sets = [shingles(unpack.decompress(r[10]), size, memo) for r in rows]
        names, ids = np.unique(np.concatenate(sets), return_inverse=True)
        ids = np.split(ids.reshape(-1), np.cumsum([len(s) for s in sets])[:-1])
        mine, out = np.zeros(len(names), bool), []
        for k in range(1, len(rows)):  # sorted by size: smaller sets come first
            at = np.arange(np.searchsorted(100 * n[:k], percent * n[k]), k)
            at = at[(component[at] != component[k]) & (doc[at] != doc[k]) & ((part[at] != part[k]) | (x == y))]
            at = at[(agree[at] == agree[k]).mean(axis=1) >= share] if len(at) else at
            at = at[(keys[at] == keys[k]).argmax(axis=1) == tree] if len(at) else at
            if not len(at):
                continue
            mine[ids[k]] = True
            both = np.add.reduceat(mine[np.concatenate([ids[c] for c in at])].astype(np.int64), np.cumsum(n[at]) - n[at])
            mine[ids[k]] = False
            for c in at[100 * both >= percent * (n[at] + n[k] - both)].tolist():
                if component[c] != component[k]:
                    out.append((max(doc[c], doc[k]).item(), min(doc[c], doc[k]).item()))
                    component[component == component[c]] = component[k]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, rows, out = WordHashes(), [], []
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and rows[0][:4] != r[:4]:
                    out += united(rows, memo)
                    rows = []
                rows.append(r)
        if rows:
            out += united(rows, memo)
        yield pa.RecordBatch.from_pydict({"a": pa.array([r[0] for r in out], pa.int64()), "b": pa.array([r[1] for r in out], pa.int64())})

    at = ["tree", "key", "x", "y"]
    return dealt.repartition(partitions(members.sparkSession), *at).sortWithinPartitions(*at, "n", "doc").mapInArrow(run, "a long, b long")


def _grouped(docs: DataFrame, size: int, percent: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """The sketches' rows with component_id and kept."""
    depth = depth_for(percent / 100)
    spread = math.sqrt(percent / 100 * (1 - percent / 100) / (TREES * MAX_DEPTH))
    share = max(0.0, percent / 100 - 4.5 * spread)  # 4.5 deviations below the threshold: a chance of about 3e-6
    stored = sketches(docs, size, depth, carry)
    filled = stored.filter("n > 0 AND doc_id IS NOT NULL").select("doc_id", "n", "high", "low", "keys", "agree", "packed")
    filled = filled.dropDuplicates(["doc_id", "high", "low"])
    same = filled.groupBy("high", "low").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"))
    copies = filled.select(F.col("doc_id").alias("a"), "high", "low").join(cut_lineage(same.filter("copies > 1")), ["high", "low"]).filter("a > doc")
    doubles = cut_lineage(copies.select("a", F.col("doc").alias("b"), "high", "low").distinct())
    # one key, the one that the rows are dealt by; that the sets are the same is left to a condition
    gone = doubles.select(F.col("a").alias("__a"), F.col("high").alias("__h"), F.col("low").alias("__l"))
    one = (F.col("doc_id") == F.col("__a")) & (F.col("high").bitwiseXOR(F.col("__h")) == 0) & (F.col("low").bitwiseXOR(F.col("__l")) == 0)
    chosen = filled.join(gone, one, "left_anti").withColumnRenamed("doc_id", "doc")
    doubles = doubles.select("a", "b").distinct()

    orders = chosen.select("doc", "n", "agree", F.posexplode("keys").alias("tree", "key"))
    orders = orders.select("doc", "n", "tree", "key", F.substr("agree", F.col("tree") * MAX_DEPTH + 1, F.lit(MAX_DEPTH)).alias("values"))
    regions = orders.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1").drop("members")
    # what is joined to large groups is checkpointed first: a join of two plain shuffles is one whose hot keys are split
    members = cut_lineage(orders.join(cut_lineage(regions), "key"))
    texts = filled.select("doc_id", "packed")
    near = cut_lineage(confirmed(_neighbours(members, depth), texts, size, percent).union(doubles))
    found = components(near)

    data = chosen.select("doc", "n", "keys", "agree", "packed")
    label = _labelled(members.select("tree", "key", "doc", "n"), found)
    several = label.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.sum("n").alias("weight"))
    several = cut_lineage(several.filter("least < most").select("key", "weight"))
    more = cut_lineage(_across(label.drop("n").join(several, "key").join(data, "doc"), size, percent, share).distinct())
    if not more.isEmpty():
        found = components(near.union(more))
    out = stored.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row; links are pairs of sets with a Jaccard of at least percent / 100."""
    return _grouped(docs, size, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "kept")


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one of each component, the smallest doc_id, in the columns that they came with."""
    carry = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    kept = _grouped(docs, size, percent, carry).filter("kept").select("doc_id", "packed", *(f"_{c}" for c in carry))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            text = pa.array([None if x is None else unpack.decompress(x).decode("utf-8", "replace") for x in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), text, *batch.columns[2:]], names=["doc_id", "text", *(f"_{c}" for c in carry)])

    kinds = dict(docs.dtypes)
    got = kept.mapInArrow(run, "doc_id long, text string" + "".join(f", `_{c}` {kinds[c]}" for c in carry))
    return got.selectExpr(*(c if c in ("doc_id", "text") else f"`_{c}` AS `{c}`" for c in docs.columns))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), 3, 85)


OP4_SQL = r"""
    WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
    r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
    FROM d JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) c USING (doc_id) LEFT JOIN n USING (doc_id)"""

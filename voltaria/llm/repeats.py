"""Finding every repeated window of a corpus without moving every window.

The corpus is a set of texts, each a sequence of elements (bytes or words); a window is ``window`` consecutive
elements of one text. What both repeat operators share:

1.  Blocks. Documents are gathered into blocks of a few MB, compressed, dealt over the cluster by block and
    checkpointed once; every later step reads them where they lie.
2.  Anchors. A window's anchor is the leftmost of the ``gram``-element pieces inside it whose rolling hash is least, or
    for bytes the first whose hash a modulus divides. It depends on the window's content alone, so equal windows have equal anchors at equal offsets, and neighbouring
    windows mostly share one: a text has an anchor about every (window - gram) / 2 elements.
3.  Sharing. Blocks send 4 bytes and a count per distinct anchor to the bucket that its hash names; the bucket answers
    which anchors occur elsewhere, and how often. An anchor that occurs once cannot lie in a repeated window.
4.  Runs. For a shared anchor, the text under the windows that it anchors (a run) goes to the group of its hash. Equal
    runs of one block are told apart there and only the first is sent. Groups expected to be large are split by a salt
    of the document; what is first in its part of a split group meets the firsts of the other parts by the hash of
    the window, so no group is ever held whole.
5.  Order. Within a group distinct runs form a dictionary whose suffixes are ranked by prefix doubling down to the
    window's depth: suffixes of one rank at that depth begin with equal windows (a node of the group's suffix tree at
    that depth, with its leaves in document order). All but the first are repeats.
6.  Spans. What is to be removed goes back to the blocks as spans of documents.

Hash collisions can only add candidates: windows are compared by their elements. (Words are compared by 64-bit
hashes, and firsts of split groups by 128-bit hashes of the window.)
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, cut_lineage, partitions

U = np.uint64
LAST = np.iinfo(np.int64).max
#: Bytes of text in a block; anchors in a bucket; runs in a group before it is split; bytes of runs ranked at a time.
BLOCK, BUCKET, GROUP, RANKED = 2 << 20, 4_000_000, 1024, 2 << 20
#: Elements hashed at a time, so that long texts need no more memory than others.
SLICE = 1 << 18

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = U(int(_rng.integers(2**60, 2**63)) * 2 + 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def gram_hashes(e: np.ndarray, k: int) -> np.ndarray:
    """Rolling polynomial hash of each ``k`` consecutive elements, built from the hashes of power-of-two lengths."""
    h, have, power = None, 0, (e, 1, _BASE)
    while k:
        p, n, b = power
        if k & n:
            if h is None:
                h, have = p, n
            else:
                size = len(e) - have - n + 1
                h, have = h[:size] * b + p[have : have + size], have + n
            k -= n
        if k:
            power = (p[: len(p) - n] * b + p[n:], 2 * n, U(int(b) * int(b) % 2**64))
    return h


def anchors(e: np.ndarray, window: int, gram: int, modulus: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor of a text, and the first and last start of the windows in a row that it anchors.

    With a modulus, a window's anchor is the first piece in it whose hash the modulus divides (a trigger), and only windows
    without one take the piece of the least hash.
    """
    hashes, firsts, lasts = [], [], []
    for at in range(0, max(len(e) - window + 1, 0), SLICE):
        part = e[at : at + SLICE + window - 1]
        h = mixed(gram_hashes(part, gram))
        least = (h & U(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        width, span = 1, window - gram + 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        place = (least & U(0xFFFFFFFF)).astype(np.int64)
        if modulus:
            start = np.arange(len(h))
            trigger = np.where((h & U(0xFFFFFFFF)) % U(modulus) == 0, start, len(h) + span)
            following = np.minimum.accumulate(trigger[::-1])[::-1][: len(place)]
            place = np.where(following - start[: len(place)] < span, following, place)
        cut = np.flatnonzero(place[1:] != place[:-1])
        first = np.concatenate([[0], cut + 1])
        hashes.append(h[place[first]])
        firsts.append(first + at)
        lasts.append(np.concatenate([cut, [len(place) - 1]]) + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(lasts)


class WordHashes(dict):
    """64-bit hash of each word, remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


@dataclass(frozen=True)
class Bytes:
    """Texts as bytes; a repeat is any later occurrence, in the same document too."""

    window: int = 100
    gram: int = 24
    modulus: int = 48  # bytes from trigger to trigger, on average
    same_document: bool = True

    def split(self, text: bytes) -> bytes:
        return text

    def elements(self, text: bytes, memo: WordHashes) -> np.ndarray:
        return _BYTE[np.frombuffer(text, np.uint8)]

    def cut(self, text: bytes, first: int, end: int) -> bytes:
        return text[first:end]

    def join(self, text: bytes) -> bytes:
        return text

    def ranks(self, runs: list[bytes], memo: WordHashes) -> tuple[np.ndarray, np.ndarray, int]:
        """Ranks by the first elements, the runs' sizes, and how many elements the ranks tell apart: here eight."""
        flat = np.frombuffer(b"".join(runs) + bytes(8), np.uint8).astype(np.uint64)
        r = flat
        for n in (1, 2, 4):
            r = (r[: len(r) - n] << U(8 * n)) | r[n:]
        return r[: len(flat) - 8], np.array([len(x) for x in runs]), 8


@dataclass(frozen=True)
class Words:
    """Texts as words; a repeat is an occurrence for which a smaller document has another."""

    window: int = 50
    gram: int = 20
    modulus: int = 0
    same_document: bool = False

    def split(self, text: bytes) -> list[bytes]:
        return text.split()

    def elements(self, text: list[bytes], memo: WordHashes) -> np.ndarray:
        return np.fromiter(map(memo.__getitem__, text), np.uint64, len(text))

    def cut(self, text: list[bytes], first: int, end: int) -> bytes:
        return b" ".join(text[first:end])

    def join(self, text: list[bytes]) -> bytes:
        return b" ".join(text)

    def ranks(self, runs: list[bytes], memo: WordHashes) -> tuple[np.ndarray, np.ndarray, int]:
        split = [x.split(b" ") for x in runs]
        return np.concatenate([self.elements(x, memo) for x in split]), np.array([len(x) for x in split]), 1


Unit = Bytes | Words


def _dense(x: np.ndarray) -> np.ndarray:
    return np.unique(x, return_inverse=True)[1].reshape(-1).astype(np.uint64)


def window_ranks(unit: Unit, runs: list[bytes], memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each window of each run among all, by prefix doubling; and the run that each window lies in.

    Ranks of suffixes by their first n elements give those by their first 2 n. Near a run's end they take in the next
    run, but the windows asked for end within their own.
    """
    r, sizes, have = unit.ranks(runs, memo)
    r = _dense(r)
    while have < unit.window:
        step = min(have, unit.window - have)
        n = len(r)
        nxt = np.concatenate([r[step:], np.zeros(min(step, n), np.uint64)])[:n]
        r, have = _dense(r * U(n + 1) + nxt), have + step
    ends = np.cumsum(sizes)
    counts = sizes - unit.window + 1
    run = np.repeat(np.arange(len(runs)), counts)
    start = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    return r[(ends - sizes)[run] + start], run


def spans(flags: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Half-open spans that the flagged window starts cover."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > window)
    return list(zip(at[np.concatenate([[0], cut + 1])].tolist(), (at[np.concatenate([cut, [len(at) - 1]])] + window).tolist(), strict=True))


# --- blocks -----------------------------------------------------------------------------------------------------


def blocks(docs: DataFrame, unit: Unit, carry: list[str]) -> tuple[DataFrame, int]:
    """Checkpointed (block, ids, sizes, texts, rows), dealt by block, and about how many elements there are.

    texts: the joined texts, compressed; rows: the carried columns of the documents as an Arrow stream.
    """
    from pyspark import TaskContext

    total = docs.sparkSession.sparkContext.accumulator(0)
    columns = ["doc_id", *(c for c in carry if c != "doc_id")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        pack = zstandard.ZstdCompressor(level=3)
        texts: list[bytes] = []
        rows: list[pa.RecordBatch] = []
        held = 0

        def put() -> pa.RecordBatch:
            nonlocal number, held
            keep = pa.Table.from_batches(rows)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, keep.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(keep)
            out = pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([number], pa.int64()),
                    "ids": pa.array([keep.column(0).to_pylist()], pa.list_(pa.int64())),
                    "sizes": pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    "texts": pa.array([pack.compress(b"".join(texts))], pa.binary()),
                    "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                }
            )
            total.add(held)
            number += 1
            held = 0
            texts.clear()
            rows.clear()
            return out

        for batch in batches:
            first = 0
            for k, text in enumerate(batch.column(0).cast(pa.binary()).to_pylist()):
                t = unit.join(unit.split(text or b""))
                texts.append(t)
                held += len(t)
                if held >= BLOCK:
                    rows.append(pa.RecordBatch.from_arrays(batch.columns[1:], names=columns).slice(first, k + 1 - first))
                    first = k + 1
                    yield put()
            if first < batch.num_rows:
                rows.append(pa.RecordBatch.from_arrays(batch.columns[1:], names=columns).slice(first))
        if rows:
            yield put()

    spark = docs.sparkSession
    bounded_batches(spark)
    made = docs.select("text", *columns).mapInArrow(run, "block long, ids array<long>, sizes array<long>, texts binary, rows binary")
    return cut_lineage(made.repartition(partitions(spark), "block"), dealt=True), total.value


def texts_of(unit: Unit, sizes: list[int], packed: bytes) -> list:
    flat, at, out = zstandard.ZstdDecompressor().decompress(packed), 0, []
    for n in sizes:
        out.append(unit.split(flat[at : at + n]))
        at += n
    return out


def _bucketed(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U(32)) % U(buckets)) << U(32) | (h & U(0xFFFFFFFF))


# --- which anchors are shared -------------------------------------------------------------------------------------


def sent_anchors(stored: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """(bucket, block, keys, counts): a block's distinct anchors for a bucket, in order, and how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for row in batch.to_pylist():
                per_doc = []
                for t in texts_of(unit, row["sizes"], row["texts"]):
                    h = _bucketed(anchors(unit.elements(t, memo), unit.window, unit.gram, unit.modulus)[0], buckets)
                    per_doc.append(h if unit.same_document else np.unique(h))
                keys, counts = np.unique(np.concatenate(per_doc), return_counts=True)
                at = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << U(32))
                some = np.flatnonzero(np.diff(at))
                low, counts = (keys & U(0xFFFFFFFF)).astype("<u4"), counts.astype("<u4")
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(some, pa.int64()),
                        "block": pa.array([row["block"]] * len(some), pa.int64()),
                        "keys": pa.array([low[at[b] : at[b + 1]].tobytes() for b in some], pa.binary()),
                        "counts": pa.array([zlib.compress(counts[at[b] : at[b + 1]].tobytes(), 1) for b in some], pa.binary()),
                    }
                )

    return stored.select("block", "sizes", "texts").mapInArrow(run, "bucket long, block long, keys binary, counts binary")


def answers(sent: DataFrame) -> DataFrame:
    """(block, bucket, parts): for each anchor sent, 0 if it occurs once in all, 1 if more often, else into how many parts its group is split."""

    def run(t: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, "<u4") for x in t.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(zlib.decompress(x), "<u4") for x in t.column("counts").to_pylist()]).astype(np.int64)
        flat = np.concatenate(keys)
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        total = np.add.reduceat(counts[order], first)
        parts = np.where(total > GROUP, -(-total // (GROUP // 2)), total > 1).astype("<u4")
        out = np.empty(len(flat), "<u4")
        out[order] = np.repeat(parts, np.diff(np.append(first, len(flat))))
        ends = np.cumsum([len(k) for k in keys])
        reply = [zlib.compress(out[e - len(k) : e].tobytes(), 1) for e, k in zip(ends, keys, strict=True)]
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"), "parts": pa.array(reply, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(run, "block long, bucket long, parts binary")


# --- runs, their groups and spans ---------------------------------------------------------------------------------

RUNS = "key long, part int, parts int, doc long, block long, row int, first int, end int, run binary, more binary"
SPANS = "block long, row int, first int, end int, doc long, window binary"


class _Rows:
    """Rows gathered for a record batch."""

    def __init__(self, schema: str) -> None:
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
        self.fields = [(n, kinds[k]) for n, k in (x.split() for x in schema.split(", "))]
        self.rows: list[tuple] = []

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) or [[]] * len(self.fields)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, self.fields, strict=True)], names=[n for n, _ in self.fields])


def shared_runs(stored: DataFrame, told: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """The runs of shared anchors, one row for all places of a document that hold the same (first and more); those that an
    earlier document of the block has too come as spans to remove (run is null)."""
    w = unit.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, out = WordHashes(), _Rows(RUNS)
        for batch in batches:
            for b in batch.to_pylist():
                texts = texts_of(unit, b["sizes"], b["texts"])
                ids = [LAST if x is None else x for x in b["ids"]]
                found = [anchors(unit.elements(t, memo), w, unit.gram, unit.modulus) for t in texts]
                own = [_bucketed(f[0], buckets) for f in found]
                keys = np.unique(np.concatenate(own))
                parts = np.concatenate([np.frombuffer(zlib.decompress(x["parts"]), "<u4") for x in sorted(b["told"] or [], key=lambda x: x["bucket"])] + [np.zeros(0, "<u4")])
                seen: dict[tuple[int, bytes], int] = {}
                for k in sorted(range(len(texts)), key=lambda k: (ids[k], k)):
                    h, firsts, lasts = found[k]
                    p = parts[np.searchsorted(keys, own[k])]
                    some = np.flatnonzero(p)
                    doc, text, split = ids[k], texts[k], {}
                    mine: dict[tuple[int, bytes], tuple[int, list[int]]] = {}  # size and starts of each run of the document
                    for key, n, f, e in zip(h[some].view(np.int64).tolist(), p[some].tolist(), firsts[some].tolist(), (lasts[some] + w).tolist(), strict=True):
                        mine.setdefault((key, unit.cut(text, f, e)), (e - f, []))[1].append(f)
                        split[key] = n
                    gone: list[tuple[int, int]] = []
                    for (key, piece), (long, at) in mine.items():
                        who = seen.setdefault((key, piece), k)
                        if who != k and (unit.same_document or ids[who] < doc):
                            gone += [(f, f + long) for f in at]
                            continue
                        if unit.same_document:
                            gone += [(f, f + long) for f in at[1:]]
                            at = at[:1]
                        n = split[key]
                        part = xxhash.xxh3_64_intdigest(f"{doc} {b['block']} {k}".encode()) % n if n > 1 else 0
                        more = np.array(at[1:], "<i4").tobytes() or None
                        out.rows.append((key, part, n if n > 1 else 0, doc, b["block"], k, at[0], at[0] + long, piece, more))
                    out.rows += [(0, 0, 0, doc, b["block"], k, f, e, None, None) for f, e in merged(gone)]
                yield out.batch()

    both = stored.select("block", "ids", "sizes", "texts").join(told.groupBy("block").agg(F.collect_list(F.struct("bucket", "parts")).alias("told")), "block", "left")
    return both.mapInArrow(run, RUNS)


def repeated_spans(runs: DataFrame, unit: Unit) -> DataFrame:
    """Spans to remove, by group; and the windows that are first in their part of a split group."""
    w = unit.window

    def starts(r: tuple) -> list[int]:
        return [r[6], *np.frombuffer(r[9] or b"", "<i4").tolist()]

    def settle(rows: list[tuple], out: list[tuple], memo: WordHashes) -> None:
        """rows: whole groups in order, of one part if split."""
        def put(r: tuple, found: list[tuple[int, int]]) -> None:
            out.extend((r[4], r[5], a, b, None, None) for a, b in merged([(f + a, f + b) for f in starts(r) for a, b in found]))

        lexicon: list[tuple] = []  # first occurrence of each distinct run of groups with several
        group, first = None, {}

        def close() -> None:
            if len(first) > 1 or group[2]:
                lexicon.extend(first.values())

        for r in rows:
            if r[:3] != group:
                if group:
                    close()
                group, first = r[:3], {}
            f = first.setdefault(r[8], r)
            if f is not r:
                if unit.same_document or f[3] < r[3]:
                    put(r, [(0, r[7] - r[6])])
                else:  # another row of that document: it shares its fate with every other run
                    first[r[8], r[4:7]] = r
        close()
        for at in _portions(lexicon):
            rank, run = window_ranks(unit, [r[8] for r in at], memo)
            lead = np.unique(rank, return_index=True, return_inverse=True)
            lead = run[lead[1]][lead[2].reshape(-1)]
            doc = np.array([r[3] for r in at])
            gone = lead < run if unit.same_document else doc[lead] < doc[run]
            cut = np.searchsorted(run, np.arange(len(at) + 1))
            for k, r in enumerate(at):
                flags = gone[cut[k] : cut[k + 1]]
                put(r, spans(flags, w))
                if r[2]:
                    text = unit.split(r[8])
                    for s in np.flatnonzero(~flags).tolist():
                        whole = xxhash.xxh3_128_digest(unit.cut(text, s, s + w))
                        out.extend((r[4], r[5], f + s, f + s + w, r[3], whole) for f in starts(r))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, out, rows, held = WordHashes(), _Rows(SPANS), [], 0
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[8] is None:
                    out.rows.append((r[4], r[5], r[6], r[7], None, None))
                    continue
                if rows and (held > RANKED or r[2] or rows[-1][2]) and r[:3] != rows[-1][:3]:
                    settle(rows, out.rows, memo)
                    rows, held = [], 0
                rows.append(r)
                held += len(r[8])
            if len(out.rows) > 20_000:
                yield out.batch()
        if rows:
            settle(rows, out.rows, memo)
        yield out.batch()

    # spans that are settled need no group: they are dealt by block
    where = [F.when(F.col("run").isNull(), F.xxhash64("block", "row", "first")).otherwise(F.col("key")), "part"]
    dealt = runs.repartition(partitions(runs.sparkSession), *where)
    return dealt.sortWithinPartitions("key", "part", "doc", "block", "row", "first").mapInArrow(run, SPANS)


def _portions(lexicon: list[tuple]) -> Iterator[list[tuple]]:
    """Whole groups of about RANKED bytes at a time."""
    at: list[tuple] = []
    held = 0
    for r in lexicon:
        if held > RANKED and r[:3] != at[-1][:3]:
            yield at
            at, held = [], 0
        at.append(r)
        held += len(r[8])
    if at:
        yield at


def firsts_of_parts(found: DataFrame, unit: Unit) -> DataFrame:
    """Spans alone: of windows that are first in several parts of a split group, all but the first are repeats too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, window, lead = _Rows("block long, row int, first int, end int"), None, None
        for batch in batches:
            for block, row, first, end, doc, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is None:
                    out.rows.append((block, row, first, end))
                elif key != window:
                    window, lead = key, doc
                elif unit.same_document or lead < doc:
                    out.rows.append((block, row, first, end))
            yield out.batch()

    where = F.when(F.col("window").isNull(), F.xxhash64("block", "row", "first")).otherwise(F.xxhash64("window"))
    dealt = found.repartition(partitions(found.sparkSession), where)
    return dealt.sortWithinPartitions("window", "doc", "block", "row", "first").mapInArrow(run, "block long, row int, first int, end int")


def merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, unit: Unit, finish: Callable, schema: str, carry: list[str]) -> DataFrame:
    """The carried columns and what ``finish(text, spans)`` gives (a tuple by ``schema``) of each document.

    ``text`` is the document's bytes or words; spans are disjoint, in order and cover what is to be removed.
    """
    stored, total = blocks(docs, unit, carry)
    spark = docs.sparkSession
    density = 2 / (unit.window - unit.gram + 2) / (1 if unit.same_document else 5)
    buckets = max(partitions(spark), int(total * density / BUCKET) + 1)
    told = answers(sent_anchors(stored, unit, buckets))
    found = firsts_of_parts(repeated_spans(shared_runs(stored, told, unit, buckets), unit), unit)
    by_block = found.groupBy("block").agg(F.collect_list(F.struct("row", "first", "end")).alias("found"))
    kinds = dict(docs.dtypes)
    columns = ["doc_id", *(c for c in carry if c != "doc_id")]
    names = [x.split()[0] for x in schema.split(", ")]
    full = ", ".join(f"`_{c}` {kinds[c]}" for c in columns) + ", " + schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            for b in batch.to_pylist():
                mine: dict[int, list[tuple[int, int]]] = {}
                for x in b["found"] or []:
                    mine.setdefault(x["row"], []).append((x["first"], x["end"]))
                texts = texts_of(unit, b["sizes"], b["texts"])
                got = [finish(t, merged(mine.get(k, []))) for k, t in enumerate(texts)]
                rows = pa.ipc.open_stream(b["rows"]).read_all().combine_chunks().to_batches()[0]
                types = types or [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<struct<first:long,end:long>>": pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))}[x.split(" ", 1)[1]] for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays(rows.columns + [pa.array(c, k) for c, k in zip(zip(*got, strict=True), types, strict=True)], names=[f"_{c}" for c in columns] + names)

    out = stored.select("block", "sizes", "texts", "rows").join(by_block, "block", "left").mapInArrow(run, full)
    return out.selectExpr(*(f"`_{c}` AS `{c}`" for c in columns), *names)

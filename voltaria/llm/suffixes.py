"""Suffix-array dedup of byte strings by prefix-free parsing, dealt by trigger.

Rolling-hash triggers (a byte piece whose hash a modulus divides) cut every text into phrases; a phrase is taken with the
bytes after it that its last window needs, so neighbouring phrases overlap and none is a prefix of another's context. A
stretch of a window's length without a trigger is cut at its locally least hash, so phrases stay bounded on any text.
Distinct phrases form the dictionary, the phrases of a text in turn its parse. The dictionary is dealt by the phrases'
first trigger: suffixes that share a first window share it too, so each share's suffixes are ranked by themselves, once,
however often a phrase occurs. The order of corpus positions follows from the ranks of phrase and offset and, among
equals, from the parse's order (document, then position). A position whose first ``window`` bytes have an earlier equal
is a repeat. Phrases whose trigger occurs once are told apart without being moved. See ``repeats`` for the shares.

What the textbook method has and this doesn't: one suffix array of the whole dictionary and one of the whole parse. Both
are global orders of data that grow with the corpus; here only equality to the window's depth and what comes first decide.

Edge cases: a null, empty or short text loses nothing; texts of any length are taken whole; matches never cross
documents; rows that share a doc_id are ordered by where they lie in the input; a null doc_id counts as the greatest;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .repeats import Bytes, remove_repeats

SCHEMA = "n_bytes long, n_removed long, kept binary, spans array<struct<first:long,end:long>>"


def _finish(text: bytes, gone: list[tuple[int, int]]) -> tuple:
    kept, at = [], 0
    for a, b in gone:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    out = b"".join(kept)
    return len(text), len(text) - len(out), out, [{"first": a, "end": b} for a, b in gone]


def _finish_text(text: bytes, gone: list[tuple[int, int]]) -> tuple:
    """What is kept as text: each kept stretch by itself, so that halves of two characters never make a third."""
    kept, at = [], 0
    for a, b in [*gone, (len(text), len(text))]:
        kept.append(text[at:a].decode("utf-8", "ignore"))
        at = b
    out = "".join(kept)
    return out, len(out)


def dedup_bytes(docs: DataFrame, window: int = 100, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, carried columns, n_bytes, n_removed, kept (the remaining bytes) and the removed spans."""
    return remove_repeats(docs, Bytes(window, max(1, window * 6 // 25)), _finish, SCHEMA, list(carry))


def dedup_documents(docs: DataFrame, window: int = 100) -> DataFrame:
    """The documents with repeats taken out of their texts; a character that a removed span cuts in two goes as a whole."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    got = remove_repeats(docs, Bytes(window, max(1, window * 6 // 25)), _finish_text, "text string, n_chars long", rest)
    return got.select(*docs.columns)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_bytes(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
    WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS x FROM documents),
    g AS (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 200)) AS h FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS i FROM d WHERE len(x) >= 200)),
    s AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM g) WHERE k > 1),
    t AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS fresh FROM s),
    r AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM t) GROUP BY doc_id, run),
    p AS (SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS gone, sum(b - a) AS n FROM r GROUP BY doc_id)
    SELECT d.doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(len(gone), 0)::BIGINT AS n_spans,
           sha256(unhex(CASE WHEN gone IS NULL THEN x ELSE array_to_string(list_transform(gone, lambda y, k: substr(x, CASE WHEN k = 1 THEN 1 ELSE 2 * gone[k - 1].b + 1 END, 2 * (y.a - CASE WHEN k = 1 THEN 0 ELSE gone[k - 1].b END))), '') || substr(x, 2 * gone[-1].b + 1) END)) AS kept_sha256
    FROM d LEFT JOIN p USING (doc_id)"""

"""Substring dedup by prefix-partitioned suffix trees over words.

The suffixes of all documents are split by what their first ``window`` words (their prefixes to the depth asked for)
hold: the least of the word pieces in it names the group, and groups that would outgrow memory are split further,
down to whole windows. Suffixes with equal prefixes of that depth therefore always meet. Each group's suffixes
are ranked by doubling, which is its suffix tree read off at word depths 1, 2, 4, ... and ``window``: the internal
nodes at that depth, with leaves in several documents, are the repeats, and runs of them the maximal repeats.
See ``repeats`` for how the groups are built and kept bounded.

Edge cases: a null, empty or short text (fewer than ``window`` words) loses nothing; texts of any length are taken
whole; rows that share a doc_id don't remove each other's words, and a null doc_id counts as the greatest; repeats
within one document stay; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .repeats import Words, remove_repeats

SCHEMA = "n_words long, n_removed long, kept binary, spans array<struct<first:long,end:long>>"


def _finish(text: list[bytes], gone: list[tuple[int, int]]) -> tuple:
    kept, at = [], 0
    for a, b in gone:
        kept += text[at:a]
        at = b
    kept += text[at:]
    return len(text), len(text) - len(kept), b" ".join(kept), [{"first": a, "end": b} for a, b in gone]


def dedup_substrings(docs: DataFrame, window: int = 50, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, carried columns, n_words, n_removed, kept (words joined by one space, UTF-8) and the removed word spans."""
    return remove_repeats(docs, Words(window, max(1, 2 * window // 5)), _finish, SCHEMA, list(carry))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = dedup_substrings(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
    WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    g AS (SELECT doc_id, i, md5_number(array_to_string(ws[i:i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
    f AS (SELECT h, min(doc_id) AS first FROM g GROUP BY h),
    s AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS fresh FROM g JOIN f USING (h) WHERE doc_id > first),
    r AS (SELECT doc_id, min(i) AS a, max(i) + 49 AS b FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s) GROUP BY doc_id, run),
    p AS (SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS gone, sum(b - a + 1) AS n FROM r GROUP BY doc_id)
    SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
           sha256(array_to_string(CASE WHEN gone IS NULL THEN ws ELSE list_concat(flatten(list_transform(gone, lambda x, k: ws[CASE WHEN k = 1 THEN 1 ELSE gone[k - 1].b + 1 END:x.a - 1])), ws[gone[-1].b + 1:]) END, ' ')) AS kept_sha256
    FROM d LEFT JOIN p USING (doc_id)"""

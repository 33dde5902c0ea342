"""How document filters interact, for every order in which they may be applied.

A document is known by its failure mask, one bit per filter, so a part of the corpus is known by how often it has each of
the 32 masks. Counts of masks, over all documents, over the good ones and over the toxic ones, are stacked as rows, three
a part, and multiplied by integer matrices of 32 rows (masks) and 600 columns (120 orders of five steps): a matrix for
each outcome says whether a document with the mask is kept after the step, removed in it, redundant (fails its filter,
but was removed before) or fails its filter alone. So texts are read once, whatever the number of orders.

Filters of a text are columns. The filter on copies needs the whole table: the first row of each text is found by a partial
aggregate over digests (SHA-256) of texts, and documents are marked as first by their id and digest, so a text that a third of the
documents share is never in one task.

Edge cases: a null text counts as an empty one, and the two are copies of each other; a null part joins the part of the empty
string; rows that repeat a doc_id are documents each, and those that hold the smallest doc_id of a text are no copies; a
null doc_id has no smaller one and no label; of several labels of a document any that says 1 counts; a label null or other
than 1 doesn't count; no documents give no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, importable, table

#: Parts that are multiplied at once.
PARTS = 64


#: A filter: of a text and its words, true for a document that fails.
Fails = Callable[[Column, Column], Column]


def _long(x: Column) -> Column:
    return x.cast("long")


#: The filters that a text alone decides, by letter.
FILTERS: Mapping[str, Fails] = {
    "A": lambda text, words: F.size(words) < 100,
    "B": lambda text, words: 100 * _long(F.size(F.array_distinct(words))) < 80 * _long(F.size(words)),
    "C": lambda text, words: 100 * _long(F.regexp_count(text, F.lit("[A-Z]"))) > 10 * _long(F.length(text)),
    "D": lambda text, words: text.rlike("[#$%&*|]"),
}
#: The letter of the filter on copies.
COPY = "E"


class Outcomes:
    """The matrices of all orders of ``letters``: rows are masks (bit k for the k-th letter), columns orders by steps."""

    def __init__(self, letters: str) -> None:
        n = len(letters)
        self.orders = ["".join(p) for p in permutations(letters)]
        self.steps = n
        self.filter = np.array([[letters.index(c) for c in o] for o in self.orders])  # order x step
        fails = (np.arange(2**n)[:, None] >> np.arange(n) & 1).astype(np.int64)  # mask x filter
        here = fails[:, self.filter]  # mask x order x step
        before = np.cumsum(here, axis=2) - here > 0
        self.kept = self._flat(~before & (here == 0))
        self.removed = self._flat(~before & (here == 1))
        self.redundant = self._flat(before & (here == 1))
        self.unique = self._flat((here == 1) & (fails.sum(axis=1) == 1)[:, None, None])

    @staticmethod
    def _flat(x: np.ndarray) -> np.ndarray:
        return x.astype(np.int64).reshape(len(x), -1)

    def shapley(self, removed: np.ndarray) -> np.ndarray:
        """Rows of removed counts -> the step's filter's count summed over all orders, in each column."""
        where = self.filter.ravel()
        return np.stack([removed[:, where == k].sum(axis=1) for k in range(self.steps)], axis=1)[:, where]


@functools.lru_cache(4)
def outcomes(letters: str) -> Outcomes:
    return Outcomes(letters)


def masks(docs: DataFrame, part: str = "lang", filters: Mapping[str, Fails] = FILTERS) -> DataFrame:
    """(doc_id, part, mask, digest) of every document: the bits of its text's filters, and one more for copies."""
    cut = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    bits = [F.when(fails(F.col("text"), F.col("words")), 1 << k).otherwise(0) for k, fails in enumerate(filters.values())]
    of_text = functools.reduce(lambda a, b: a + b, bits, F.lit(0)).cast("int")
    marks = texts.withColumn("words", cut).select("doc_id", "part", of_text.alias("mask"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    marks = cut_lineage(marks)
    first = marks.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").withColumn("first", F.lit(1))
    copy = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 1 << len(filters)).otherwise(0)
    return marks.join(first, ["doc_id", "digest"], "left").select("doc_id", "part", (F.col("mask") + copy).cast("int").alias("mask"), "digest")


def histograms(marks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask, those labelled good and those labelled toxic."""
    is_1 = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    label = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(is_1("quality").alias("good"), is_1("toxic").alias("toxic"))
    of = lambda c: F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    return marks.join(label, "doc_id", "left").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), of("good"), of("toxic"))


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def audit(counted: DataFrame, letters: str) -> DataFrame:
    """``histograms`` -> one row per part, order of ``letters`` and step. A part has at most as many rows as there are masks."""
    rows = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * len(COUNTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = outcomes(letters)
        columns = len(m.orders) * m.steps
        for batch in batches:
            parts, cells = (c.to_pylist() for c in batch.columns)
            for at in range(0, len(parts), PARTS):
                some = parts[at : at + PARTS]
                stack = np.zeros((3, len(some), 2 ** len(letters)), np.int64)
                for k, have in enumerate(cells[at : at + PARTS]):
                    for c in have:
                        stack[:, k, c["mask"]] = c["n"], c["good"], c["toxic"]
                stack = stack.reshape(3 * len(some), -1)  # all, good and toxic of every part, one product for each outcome
                everyone, good, toxic = np.split(stack @ m.removed, 3)
                whole = stack[: len(some)]
                found = [whole @ m.kept, everyone, whole @ m.redundant, whole @ m.unique, good, toxic, m.shapley(everyone)]
                names = [np.repeat(np.array(some, object), columns), np.tile(np.repeat(m.orders, m.steps), len(some)), np.tile(np.arange(1, m.steps + 1), len(m.orders) * len(some))]
                values = [*(list(x) for x in names), *(x.ravel() for x in found)]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "filter_order", "step", *COUNTS])

    importable(counted.sparkSession)
    return rows.mapInArrow(run, SCHEMA)


def interactions(docs: DataFrame, labels: DataFrame, part: str = "lang", filters: Mapping[str, Fails] = FILTERS, copy: str = COPY) -> DataFrame:
    """The audit of ``filters`` and the filter on copies, whose letter is ``copy``."""
    return audit(histograms(masks(docs, part, filters), labels), "".join(filters) + copy)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
    WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
    f AS (SELECT doc_id, part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b, 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text) AS c,
                 regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e FROM w),
    l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
    m AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails,
                 count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
    x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    p AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    s AS (SELECT part, filter_order, step, fails, n, good, toxic, filter_order[step] AS own, contains(fails, filter_order[step]) AS here,
                 len(translate(filter_order[1:step - 1], fails, '')) < step - 1 AS before FROM m, p, (SELECT unnest(range(1, 6))::INTEGER AS step)),
    r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT here AND NOT before THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN here AND NOT before THEN n ELSE 0 END)::BIGINT AS removed,
                 sum(CASE WHEN here AND before THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
                 sum(CASE WHEN here AND NOT before THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN here AND NOT before THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM s GROUP BY ALL)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""

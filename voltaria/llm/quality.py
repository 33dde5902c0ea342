"""Quality rules as a short-circuit cascade.

The cost (seconds a document) and the selectivity (share rejected) of every rule are measured on a bounded random
sample; rules then run by rejection per cost, highest first, and a document leaves at its first failure. The verdict
is the conjunction of the rules, so the measured order changes the time taken and nothing else. The base metrics are
wanted for every document and come first.

Edge cases: a null or empty text has no words, so all its metrics are 0 and it fails the base rule; very long texts
are measured whole; equal rows get equal results; an empty table gives an empty result (rules keep their given order).
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, table, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\v\f"
#: Rows of the sample that rules are measured on.
SAMPLE_ROWS = 2000


@dataclass
class Text:
    """One text with what rules ask for, computed once and only when asked."""

    text: str
    raw: bytes = field(init=False)
    words: list[bytes] = field(init=False)

    def __post_init__(self) -> None:
        self.raw = self.text.encode()
        self.words = words(self.raw)

    def base(self) -> tuple[int, int, int, int, int]:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
        text, w = self.text, self.words
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        self.n_lines = len(lines)
        self.word_chars = len(text) - sum(map(text.count, SPACES))
        self.n_symbols = sum(map(text.count, SYMBOLS))
        self.n_dup_lines = len(lines) - len(set(lines))
        self.n_repeat_words = repeat_words(w)
        return len(w), self.word_chars, self.n_symbols, self.n_dup_lines, self.n_repeat_words


def repeat_words(w: list[bytes], size: int = 5) -> int:
    """Words that lie in a window of five which the text holds twice or more, the first included."""
    grams = list(zip(*(w[k:] for k in range(size)), strict=False))
    if len(set(grams)) == len(grams):
        return 0
    count = Counter(grams)
    total = reach = 0
    for k, g in enumerate(grams):
        if count[g] > 1:
            total += k + size - max(k, reach)
            reach = k + size
    return total


@dataclass(frozen=True)
class Rule:
    """rejects(text) is true for a document to drop."""

    name: str
    rejects: Callable[[Text], bool]


def base_failed(t: Text) -> bool:
    return len(t.words) < 10 or 100 * t.n_repeat_words > 20 * len(t.words)


def _shouted(t: Text) -> bool:
    n = np.bincount(np.frombuffer(t.raw, np.uint8), minlength=256)
    upper, lower = int(n[65:91].sum()), int(n[97:123].sum())
    return upper > lower


_ASCII = re.compile("[A-Za-z]")
_BULLET, _OPEN_END = re.compile("[ \t\r\v\f]*[•‣·*-]"), re.compile(r"(?:\.\.\.|…)[ \t\r\v\f]*\Z")
_BLANKS = str.maketrans(dict.fromkeys(SPACES, " "))


def _few_letters(t: Text) -> bool:
    """Under seven words in ten hold a letter."""
    n = sum(1 for x in t.text.translate(_BLANKS).split(" ") if x and (_ASCII.search(x) or any(map(str.isalpha, x))))
    return 10 * n < 7 * len(t.words)


def _lines(text: str) -> list[str]:
    return [x for x in text.split("\n") if x.strip(SPACES)]


def _bullets(t: Text) -> bool:
    return 10 * sum(1 for x in _lines(t.text) if _BULLET.match(x)) > 9 * t.n_lines


def _open_ended(t: Text) -> bool:
    return 10 * sum(1 for x in _lines(t.text) if _OPEN_END.search(x)) > 3 * t.n_lines


def _digits(t: Text) -> bool:
    return 2 * int(np.bincount(np.frombuffer(t.raw, np.uint8), minlength=256)[48:58].sum()) > t.word_chars


def _one_word(t: Text) -> bool:
    """One word makes up more than three in ten."""
    return 10 * max(Counter(t.words).values()) > 3 * len(t.words)


def _one_phrase(t: Text) -> bool:
    """One window of three words, found twice at least, would fill more than three words in ten."""
    w = t.words
    top = max(Counter(zip(w, w[1:], w[2:])).values(), default=0)  # noqa: B905
    return top > 1 and 10 * 3 * top > 3 * len(w)


def _placeholder(t: Text) -> bool:
    low = t.raw.lower()
    return b"lorem ipsum" in low or b"enable javascript" in low


RULES = (
    Rule("few_letters", _few_letters),
    Rule("symbols", lambda t: 10 * t.n_symbols > len(t.words)),
    Rule("word_length", lambda t: not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words)),
    Rule("duplicate_lines", lambda t: 10 * t.n_dup_lines > 3 * t.n_lines),
    Rule("shouting", _shouted),
    Rule("bullets", _bullets),
    Rule("open_ended_lines", _open_ended),
    Rule("digits", _digits),
    Rule("one_word", _one_word),
    Rule("one_phrase", _one_phrase),
    Rule("broken_characters", lambda t: 100 * t.text.count("\ufffd") > t.word_chars),
    Rule("placeholder", _placeholder),
)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> dict[str, tuple[float, float]]:
    """Seconds a document and share rejected, by rule, on about ``sample_rows`` random rows. One short row per rule reaches the driver."""
    n = docs.count()
    if not n:
        return {}
    sample = docs.select("text").sample(fraction=min(1.0, sample_rows / n), seed=seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, cost, hits = 0, [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                (t := Text(text or "")).base()
                if base_failed(t):
                    continue
                seen += 1
                for k, r in enumerate(rules):
                    began = time.perf_counter()
                    hits[k] += r.rejects(t)
                    cost[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"name": [r.name for r in rules], "seen": [seen] * len(rules), "hits": hits, "cost": cost})

    bounded_batches(docs.sparkSession)
    got = sample.mapInArrow(run, "name string, seen long, hits long, cost double").groupBy("name").sum("seen", "hits", "cost").collect()
    return {r[0]: (r[3] / max(r[1], 1), r[2] / max(r[1], 1)) for r in got}


def ordered(rules: tuple[Rule, ...], measured: dict[str, tuple[float, float]]) -> tuple[Rule, ...]:
    """Highest rejection per second first; rules not measured keep their place at the end."""
    rate = lambda r: measured[r.name][1] / max(measured[r.name][0], 1e-9) if r.name in measured else -1.0
    return tuple(sorted(rules, key=lambda r: -rate(r)))


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Metrics and verdict of every document, one pass without a shuffle. ``carry``: columns handed through after them."""
    chain = ordered(rules, measure(docs, rules, sample_rows))
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                t = Text(text or "")
                base = t.base()
                failed = base_failed(t)
                rows.append((*base, failed, not failed and not any(r.rejects(t) for r in chain)))
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            arrays = [batch.column(0), *(pa.array(c, pa.int64() if k < 5 else pa.bool_()) for k, c in enumerate(cols))]
            yield pa.RecordBatch.from_arrays(arrays + batch.columns[2:], names=names + [f"_{c}" for c in carry])

    bounded_batches(docs.sparkSession)
    kinds = dict(docs.dtypes)
    out = docs.select("doc_id", "text", *carry).mapInArrow(run, SCHEMA + "".join(f", `_{c}` {kinds[c]}" for c in carry))
    return out


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    cols = tuple(c for c in docs.columns if c != "doc_id")
    got = judge(docs, carry=cols).filter("kept")
    return got.selectExpr(*("doc_id" if c == "doc_id" else f"`_{c}` AS `{c}`" for c in docs.columns))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def op1_sql() -> str:
    space = r"[\x20\x09-\x0D]+"
    return rf"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{space}'), lambda x: x <> '') AS ws,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    g AS (SELECT doc_id, i, ws[i:i + 4] AS five FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM w)),
    m AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM g) WHERE n > 1),
    r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM m, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id),
    t3 AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, ws[i:i + 2] AS three FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM w)) GROUP BY doc_id, three) GROUP BY doc_id),
    t1 AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS word FROM w) GROUP BY ALL) GROUP BY doc_id),
    a AS (SELECT w.doc_id, text, len(ws)::BIGINT AS n_words, len(regexp_replace(text, '{space}', '', 'g'))::BIGINT AS word_chars,
                 len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
                 coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines, len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS lettered,
                 len(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper, len(regexp_replace(text, '[^a-z]', '', 'g')) AS lower,
                 len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[•‣·*-]'))) AS bullets, len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS open_ends,
                 len(regexp_replace(text, '[^0-9]', '', 'g')) AS digits, coalesce(t1.n, 0) AS top1, coalesce(t3.n, 0) AS top3, len(text) - len(replace(text, chr(65533), '')) AS broken,
                 regexp_matches(text, '(?i)lorem ipsum|enable javascript') AS placeholder FROM w LEFT JOIN r USING (doc_id) LEFT JOIN t1 USING (doc_id) LEFT JOIN t3 USING (doc_id)),
    b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * lettered < 7 * n_words OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                OR 10 * n_dup_lines > 3 * n_lines OR upper > lower OR 10 * bullets > 9 * n_lines OR 10 * open_ends > 3 * n_lines OR 2 * digits > word_chars
                OR 10 * top1 > 3 * n_words OR (top3 > 1 AND 30 * top3 > 3 * n_words) OR 100 * broken > word_chars OR placeholder) AS kept
    FROM b"""

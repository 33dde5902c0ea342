"""Byte-level BPE with a local tiktoken rank file: whole texts to ids and back to raw bytes.

Long texts are cut before a lone space between two non-space characters. A pattern match never runs over such a
point from the left (only the first character of a match may be a space) and look-ahead sees no white space there, so
the pieces' ids joined are the ids of the whole. Texts with no such point for a long while are matched with the
pattern one match at a time, which needs no more than a match at once.

Edge cases: a null or empty text has no ids and decodes to no bytes; any other text, however long, is encoded whole;
strings that look like special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

#: Characters that tiktoken gets at a time.
PIECE = 50_000
_SAFE = regex.compile(r"(?<=\S) (?=\S)")


def rank_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(4)
def encoding(path: str, pattern: str | None = None) -> tiktoken.Encoding:
    """The encoding of a rank file; the pattern defaults to the public one of these vocabularies."""
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, piece: int = PIECE) -> Iterator[str]:
    """Cuts a text at safe boundaries into pieces of about ``piece`` characters; joined they are the text."""
    at, n = 0, len(text)
    while n - at > piece:
        m = _SAFE.search(text, at + piece)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encode(enc: tiktoken.Encoding, text: str, piece: int = PIECE) -> np.ndarray:
    """Ids of one text as uint32."""
    if len(text) <= piece:
        return enc.encode_to_numpy(text, disallowed_special=())
    out = []
    for part in safe_pieces(text, piece):
        if len(part) <= 4 * piece:
            out.append(enc.encode_to_numpy(part, disallowed_special=()))
        else:  # hardly any lone spaces: match by match
            for m in regex.finditer(enc._pat_str, part):
                out.append(np.array(enc._core_bpe.encode_single_piece(m.group().encode()), np.uint32))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, decode: bool = True) -> DataFrame:
    """(doc_id, ids array<int>, decoded binary): every whole text encoded, and the raw bytes that the ids stand for.

    One pass without a shuffle; a worker holds one bounded Arrow batch.
    """
    path = path or rank_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for batch in batches:
            ids = [encode(enc, t or "") for t in batch.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
            cols = [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
            if decode:
                cols.append(pa.array([enc.decode_bytes(x.tolist()) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "ids", "decoded"][: len(cols)])

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>" + ", decoded binary" * decode)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_documents(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

"""Encoding, packing and placement against plain one-process versions."""

import hashlib
import zlib

import numpy as np
import pytest

from voltaria.llm import bpe, packing, sharding

TEXTS = [
    None, "", " ", "a", "word " * 700, "x" * 9000, "Ünïcödé ñandú 東京 😀 it's 'll\r\n\t tab", "<|endoftext|> plain",
    "  two  spaces  " * 4000, "no-space-" * 20000, "line one\nline one\nline one", "same", "same", "\n \n  x",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "clash") for k, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


@pytest.fixture(scope="module")
def json_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.rank_path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_whole_text_and_decode_to_it(docs):
    enc = bpe.encoding(bpe.rank_path())
    got = {r.doc_id: r for r in bpe.encode_documents(docs).collect()}
    assert len(got) == len(TEXTS)
    for k, t in enumerate(TEXTS):
        assert got[k].ids == enc.encode(t or "", disallowed_special=()), k
        assert bytes(got[k].decoded) == (t or "").encode()


@pytest.mark.parametrize("piece", [1, 7, 50])
def test_safe_pieces_change_no_ids(piece):
    enc = bpe.encoding(bpe.rank_path())
    for t in TEXTS:
        t = (t or "")[:3000]
        assert "".join(bpe.safe_pieces(t, piece)) == t
        assert bpe.encode(enc, t, piece).tolist() == enc.encode_ordinary(t)


def check_pieces(rows, expected):
    """Each id in exactly one piece, no gap in a sequence, at most a window, padding only where no power of two."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(expected)
    for d, ids in expected.items():
        parts = sorted(by_doc[d], key=lambda r: r.start)
        at = 0
        for r in parts:
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert bytes(r.ids) == np.array(ids[at : at + r.length], "<u4").tobytes()
            at += r.length
        assert at == len(ids)
    padding = 0
    for parts in by_seq.values():
        parts.sort(key=lambda r: r.offset)
        at = 0
        for r in parts:
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padding


def test_packing_places_every_id_once_without_padding(docs, json_tokenizer):
    expected = {k: [*json_tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(TEXTS)}
    assert check_pieces(packing.pack_documents(docs).collect(), expected) == 0


def test_packing_of_the_registered_table_matches_the_tokenizer(spark, json_tokenizer):
    rows = packing.op6_packing(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    total = 0
    for r in rows:
        ids = [*json_tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        total += r.length
    assert total == sum(len(json_tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts.values())


def test_packing_of_no_rows(docs):
    assert packing.pack_documents(docs.limit(0)).count() == 0
    assert bpe.encode_documents(docs.limit(0)).count() == 0


def test_solution_is_the_least_squares_one():
    a = np.array([[1.0, 0, 1], [0, 1, 1], [0, 0, 1]])
    assert np.allclose(packing.nnls(a, np.array([3.0, 2, -1])), [3, 2, 0])
    assert np.allclose(packing.nnls(a, np.array([3.0, 2, 1])), [2, 1, 1])


def test_combinations_fill_the_window():
    a = packing.combinations()
    assert ((np.arange(1, packing.BINS + 1) @ a) == packing.BINS).all() and a.sum(0).max() == packing.DEPTH


def test_table_is_even_and_losing_a_shard_moves_little():
    names = sharding.shard_names(13)
    full = sharding.fill_table(names, 1009)
    counts = np.bincount(full)
    assert counts.max() - counts.min() <= 1
    less = sharding.fill_table([n for n in names if n != names[5]], 1009)
    moved = sum(a != (b if b < 5 else b + 1) for a, b in zip(full, less, strict=True) if a != 5)
    assert moved < 0.35 * 1009
    with pytest.raises(ValueError):
        sharding.fill_table(names, 1000)


def test_table_follows_the_turn_rule():
    names, size = ["a", "b", "c"], 7
    order = {n: [(sharding._number(f"offset:{n}") + j * (sharding._number(f"skip:{n}") % (size - 1) + 1)) % size for j in range(size)] for n in names}
    owner: dict[int, int] = {}
    while len(owner) < size:
        for k, n in enumerate(names):
            for slot in order[n]:
                if slot not in owner:
                    owner[slot] = k
                    break
    assert sharding.fill_table(names, size) == [owner[s] for s in range(size)]


def test_placement(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z"), (2, "w")], "doc_id long, shard string")
    rows = sharding.place(df, "doc_id", sharding.shard_names(5), 101).collect()
    table = sharding.fill_table(sharding.shard_names(5), 101)
    assert len(rows) == 4
    for r in rows:
        text = "null" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % 101 and r.shard == table[r.slot]


def test_registered_encoding_query_against_whole_texts(spark):
    """Every document by the library's own call on its whole text, and its bytes back."""
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()}
    encoding = bpe.encoding(bpe.rank_path())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op3_byte_bpe(spark, d).collect()}
    want = {}
    for k, text in texts.items():
        ids = encoding.encode_ordinary(text)
        want[k] = len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
    assert got == want


def test_placing_replaces_columns_of_its_names(spark):
    df = spark.createDataFrame([(k, f"s{k}", 7) for k in range(50)], "id int, slot string, shard int")
    names = sharding.shard_names(4)
    by_slot = {r.id: r.shard for r in sharding.place(df, "slot", names).collect()}
    other = {r.id: r.shard for r in sharding.place(df.withColumnRenamed("slot", "k").drop("shard"), "k", names).collect()}
    assert by_slot == other and set(by_slot.values()) <= set(range(4))

"""The pipeline against plain versions of its stages, and edge cases through all of them."""

import zlib

import numpy as np

import corpus_pipeline
from voltaria.llm import bpe, packing, pii, quality

from .test_neardup import brute
from .test_repeats import brute_bytes

D = "/root/testdata/sf0.001"


def by_stage(spark, docs, tmp_path):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, D).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out.append(docs)
    return out


def test_stages_on_the_small_table(spark, tmp_path):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    good, single, cut, safe, pieces = by_stage(spark, docs, tmp_path)
    assert all(set(x.columns) == set(docs.columns) for x in (good, single, cut, safe))
    rows = {r.doc_id: r for r in docs.collect()}

    def passes(t):
        x = quality.Text(t or "")
        x.base()
        return not quality.base_failed(x) and not any(r.rejects(x) for r in quality.RULES)

    kept = {r.doc_id: r for r in good.collect()}
    assert kept == {d: r for d, r in rows.items() if passes(r.text)}
    reps = {r.doc_id: r for r in single.collect()}
    assert reps == {d: kept[d] for d, _, _, keep in brute([(d, r.text) for d, r in kept.items()], 5, 80) if keep}
    texts = {r.doc_id: r for r in cut.collect()}
    for d, n, gone, _, _ in brute_bytes([(d, r.text) for d, r in reps.items()], 100):
        assert n - gone - 8 <= len(texts[d].text.encode()) <= n - gone if gone else texts[d].text == reps[d].text
        assert texts[d].source == rows[d].source and texts[d].n_chars == len(texts[d].text)
    clean = {r.doc_id: r.text for r in safe.collect()}
    got = {r.doc_id: r.text for r in pii.replace_entities(cut, pii.key_of(spark)).collect()}
    assert clean == got and clean.keys() == texts.keys()
    enc = bpe.encoding(bpe.rank_path())
    count = dict.fromkeys(clean, 0)
    for r in pieces.collect():
        ids = [*enc.encode_ordinary(clean[r.doc_id]), 1]
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        count[r.doc_id] += r.length
    assert all(n == len(enc.encode_ordinary(clean[d])) + 1 for d, n in count.items())


def test_odd_documents_pass_through(spark, tmp_path):
    words = " ".join(f"word{k}" for k in range(60))
    rows = [(1, words, None, None, 5), (2, None, "en", "s", None), (3, words + " more", "en", "s", 1), (None, "x " + words[::-1], "en", "s", 2), (4, "", "", "", 0), (1, words, None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = by_stage(spark, docs, tmp_path)
    assert [x.count() for x in out[:4]] == [4, 3, 3, 3]
    empty = by_stage(spark, docs.limit(0), tmp_path / "none")
    assert [x.count() for x in empty] == [0] * 5


def test_run_gives_whole_sequences(spark):
    rows = corpus_pipeline.run(spark, D).collect()
    size = {}
    for r in rows:
        size[r.sequence_id] = size.get(r.sequence_id, 0) + r.length
    assert all(n == packing.WINDOW or n & (n - 1) == 0 for n in size.values())

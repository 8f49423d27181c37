"""Token files against the tokenizer and against plain arrays."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import no_docs, odd_docs  # noqa: F401

from tidemart.llm import encoding, wavelet
from tidemart.session import fresh_path

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def whole_ids(text):
    return encoding.word_encoder(VOCABULARY).whole.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.one_of(st.none(), st.text(max_size=60),
                          st.text(alphabet="aBc'stdmLl 12.,!?éİ \u0085\x1c\n<|endoftext|>", max_size=60)), max_size=12))
@settings(max_examples=200, deadline=None)
def test_ids_are_those_of_the_whole_tokenizer(texts):
    encoder = encoding.word_encoder(VOCABULARY)
    found = [ids[a:b].tolist() for _, ids, ends in encoder.batch(pa.array(texts, pa.string()), 40)
             for a, b in zip(ends[:-1], ends[1:])]
    assert found == [whole_ids(t) for t in texts]


@given(st.lists(st.integers(0, 70_000), max_size=1500))
@settings(max_examples=60, deadline=None)
def test_matrix_against_an_array(ids):
    ids = np.array(ids, np.uint32)
    _, lengths, matrix = wavelet.from_file(wavelet.to_file([7, None], np.array([1, 2]), ids))
    assert lengths.tolist() == [1, 2]
    assert matrix.all().tolist() == ids.tolist()
    at = np.arange(len(ids))
    assert matrix.access(at).tolist() == ids.tolist()
    for token in [*set(ids[:5].tolist()), 3, 1 << 20]:
        assert matrix.find(token).tolist() == np.flatnonzero(ids == token).tolist()
        assert matrix.count(token, len(ids) // 3, 2 * len(ids) // 3) == (ids[len(ids) // 3:2 * len(ids) // 3] == token).sum()


def test_blocks_are_crossed():
    ids = np.random.default_rng(1).zipf(1.3, 20_000).clip(0, 49_407).astype(np.uint32)
    matrix = wavelet.WaveletMatrix.of(ids)
    assert (matrix.all() == ids).all()
    assert (matrix.access(np.arange(len(ids))) == ids).all()
    assert matrix.find(1).tolist() == np.flatnonzero(ids == 1).tolist()


def expected(docs):
    """By (null first, doc_id): the rows of one id in any order have the same starts if they are equal."""
    rows, start = [], 0
    for row in sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array([*whole_ids(row.text), 1], "<u4")
        rows.append((row.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


@pytest.mark.parametrize("shard", [1, 100, 1 << 22])
def test_files_hold_every_document(spark, odd_docs, shard):
    # A file may be one document; the equal rows of an id can't be told apart.
    shards = wavelet.write_shards(odd_docs, fresh_path(spark, "t"), VOCABULARY, shard_tokens=shard)
    found = wavelet.read_documents(shards).collect()
    got = sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in found), key=lambda r: r[1])
    assert got == expected(odd_docs)
    flat = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(found, key=lambda r: r.start)])
    token = int(flat[3])
    places = sorted(r.position for r in wavelet.find_tokens(shards, [token, 49_407]).collect() if r.token == token)
    assert places == np.flatnonzero(flat == token).tolist()
    assert {r.token: r.n for r in wavelet.count_tokens(shards, [token, 1]).collect()} == {
        token: (flat == token).sum(), 1: (flat == 1).sum()}
    assert {r.position: r.token for r in wavelet.tokens_at(shards, [0, 5, 60]).collect()} == {k: flat[k] for k in (0, 5, 60)}


def test_no_documents(spark, no_docs):
    shards = wavelet.write_shards(no_docs, fresh_path(spark, "t"), VOCABULARY)
    assert wavelet.read_documents(shards).collect() == []


def test_starts_over_blocks_of_tasks(spark):
    rows = [(part, f"{part}-{k}", 10 * k, 1, 10) for part in range(0, 5000, 7) for k in range(2)]
    found = wavelet.with_starts(spark.createDataFrame(rows, wavelet.SHARDS)).orderBy("start").collect()
    assert [r.start for r in found] == [10 * i for i in range(len(rows))]
    assert [r.file for r in found] == [r[1] for r in rows]


def test_query(spark, sf):
    found = wavelet.op13_wavelet_tokens(spark, sf).orderBy("start").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [tuple(r) for r in found] == expected(docs)

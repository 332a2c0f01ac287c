"""Token outputs against the tokenizers library on whole texts."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketlab.llm import packing, wavelet
from basketlab.llm.subwords import Encoder
from tests.llm.brute import ODD, empty_frame, odd_frame

FOLDER = "/root/testdata/sf0.001"
FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


WHOLE = {name: library(name) for name in FILES}


def checksum(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(alphabet="aZé ß\n\t .,!'sdµ½3日😀 ́\x1c<|", max_size=25)), min_size=1, max_size=4))
def test_encoder_equals_the_library(name, texts):
    offsets, ids = Encoder.open(public_tokenizers.path(name)).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [WHOLE[name](t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_parts_seen_before_are_not_cut_again(name, monkeypatch):
    encoder = Encoder(public_tokenizers.path(name), True)
    texts = pa.array(["a gain, again don't 12 Stra\u00dfe", "again 12 a"], pa.string())
    encoder.encode(texts)
    monkeypatch.setattr(Encoder, "piece", lambda self, piece: pytest.fail(f"{piece!r} is cut again"))
    for part in encoder.known:
        assert encoder.known[part] == Encoder(public_tokenizers.path(name), True).part(part)
    offsets, ids = encoder.encode(pa.array(["a again"], pa.string()))
    assert ids.tolist() == WHOLE[name]("a again")


def test_packing_takes_small_batches(spark, monkeypatch):
    seen, stage = [], packing.stage

    def watched(df, *args):
        seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return stage(df, *args)

    monkeypatch.setattr(packing, "stage", watched)
    docs = spark.createDataFrame([(i, "some words " * 5) for i in range(20)], "doc_id long, text string")
    assert packing.pack_documents(docs, public_tokenizers.path(FILES[1])).count() == 20
    assert seen and max(seen) <= packing.BATCH_ROWS


SPECIAL = [
    "see <|endoftext|> here", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>\n<|endoftext|>", "<|EndOfText|> <|endof text|>", "plain", None]


@pytest.mark.parametrize("name", FILES)
def test_encoder_of_special_tokens_equals_the_unchanged_library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    offsets, ids = Encoder.open(public_tokenizers.path(name), literal=False).encode(pa.array(SPECIAL, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [
        tokenizer.encode(t or "", add_special_tokens=False).ids for t in SPECIAL]


def test_queries_encode_special_tokens_as_the_file_does(spark, tmp_path):
    docs = list(enumerate(SPECIAL))
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    stage = packing.pack_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), "")
    results = [(FILES[0], 1, wavelet.query(spark, str(tmp_path))), (FILES[1], 0, packing.query(spark, str(tmp_path))), (FILES[1], 0, stage)]
    for name, end_id, found in results:
        tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        want = [(i, checksum(tokenizer.encode(t or "", add_special_tokens=False).ids + [end_id])) for i, t in docs]
        assert sorted((r["doc_id"], r["ids_crc32"]) for r in found.collect()) == want


def test_wavelet_query(spark):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect())
    found = {r["doc_id"]: r for r in wavelet.query(spark, FOLDER).collect()}
    start = 0
    for doc_id, text in docs:
        ids = WHOLE[FILES[0]](text) + [1]
        row = found[doc_id]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), checksum(ids))
        start += len(ids)


def test_wavelet_access_rank_select():
    values = np.random.default_rng(3).integers(0, 40, 5000).astype(np.uint16)
    values[::7] = 49_000
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values, 16).to_bytes())
    assert (matrix.decode() == values).all()
    assert [matrix.access(i) for i in range(0, 5000, 61)] == values[::61].tolist()
    for token in (0, 7, 39, 49_000, 1234):
        places = np.flatnonzero(values == token)
        assert [matrix.rank(token, i) for i in range(0, 5001, 500)] == [(places < i).sum() for i in range(0, 5001, 500)]
        assert [matrix.select(token, k) for k in range(0, len(places), 20)] == places[::20].tolist()
    with pytest.raises(IndexError):
        matrix.select(1234, 0)
    none = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(np.zeros(0, np.uint16), 16).to_bytes())
    assert none.length == 0 and none.rank(5, 0) == 0


def test_wavelet_odd_rows(spark):
    path = public_tokenizers.path(FILES[0])
    found = wavelet.read_documents(wavelet.write_shards(odd_frame(spark), path)).collect()
    assert sorted((r["doc_id"] or 0, r["ids_crc32"]) for r in found) == sorted(
        (i or 0, checksum(WHOLE[FILES[0]](t) + [1])) for i, t in ODD)
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == np.cumsum([0] + [r["n_tokens"] for r in ordered])[:-1].tolist()
    assert [r["doc_id"] or 0 for r in ordered] == sorted(i or 0 for i, _ in ODD)
    assert wavelet.read_documents(wavelet.write_shards(empty_frame(spark), path)).count() == 0


def check_packed(rows, docs, length):
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    want = sorted((i or 0, checksum(WHOLE[FILES[1]](t) + [0][:1])) for i, t in docs if len(WHOLE[FILES[1]](t)) < length)
    whole = [r for r in rows if r["piece"] == 0 and r["length"] < length and r["start"] == 0]
    assert {w for w in want} <= {(r["doc_id"] or 0, r["ids_crc32"]) for r in whole}
    assert sum(r["length"] for r in rows) == sum(len(WHOLE[FILES[1]](t)) + 1 for _, t in docs)
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in filled.values():
        end = 0
        for offset, size in sorted(spans):
            assert offset == end
            end += size
        assert end <= length
    return len(filled), -(-sum(r["length"] for r in rows) // length)


def test_packing_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows = packing.query(spark, FOLDER).collect()
    for doc_id, text in docs:
        ids, start = WHOLE[FILES[1]](text) + [0], 0
        for r in sorted((r for r in rows if r["doc_id"] == doc_id), key=lambda r: r["piece"]):
            assert r["start"] == start and r["ids_crc32"] == checksum(ids[start:start + r["length"]])
            assert r["length"] == packing.LENGTH or r["piece"] == 0
            start += r["length"]
        assert start == len(ids)
    used, bound = check_packed(rows, docs, packing.LENGTH)
    assert used <= 1.02 * bound + 1


def test_packing_odd_rows_and_groups(spark):
    path = public_tokenizers.path(FILES[1])
    check_packed(packing.pack_documents(odd_frame(spark), path).collect(), ODD, 2048)
    check_packed(packing.pack_documents(odd_frame(spark), path, length=64, group_pieces=50).collect(), ODD, 64)
    assert packing.pack_documents(empty_frame(spark), path).count() == 0


def test_sum_of_squares_prefers_the_smallest_sum():
    bins = packing.sum_of_squares(np.array([6, 6, 3, 3, 4]), 10)
    assert sorted(map(sorted, bins)) == [[0, 4], [1, 2], [3]] or sorted(map(len, bins)) == [1, 2, 2]
    sizes = np.random.default_rng(0).integers(1, 100, 4000)
    packed = packing.pack_group(sizes, 100)
    assert sorted(i for b in packed for i in b) == list(range(4000))
    assert all(sizes[b].sum() <= 100 for b in packed) and len(packed) <= 1.01 * sizes.sum() / 100 + 1

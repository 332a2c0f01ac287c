"""Token counts against the tokenizers library on whole texts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketlab.llm import token_counts
from basketlab.llm.token_counts import PreTokens
from tests.llm.brute import ODD, empty_frame, odd_frame

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(token_counts.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)


def n_tokens(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def row(doc_id, text):
    return doc_id, len((text or "").encode()), n_tokens(text), n_tokens(text) > 2048


def rows(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect()), key=str)


def summed(texts):
    """Counts of a few texts without Spark: frequency times pieces."""
    kept = PreTokens.open(PATH)
    ends, codes, counts, names = kept.frequencies(pa.array(texts, pa.string()))
    pieces = np.array([kept.pieces(n) for n in names], np.int64)
    total = np.concatenate([[0], np.cumsum(pieces[codes] * counts)])
    return np.diff(total[np.concatenate([[0], ends])]).tolist()


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(
    st.none(), st.text(alphabet="aZé ßΣ\n\t\x0b\x0c\r .,!'sdµ½3日😀 ́\x1c\x85\xa0ſKÅ<|", max_size=25), st.text(max_size=12)),
    min_size=1, max_size=4))
def test_counts_equal_the_library(texts):
    assert summed(texts) == [n_tokens(t) for t in texts]


def test_added_tokens_count_as_in_the_file():
    texts = ["see <|endoftext|> here", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>\n<|endoftext|>", "<|EndOfText|> <|endof text|>", "plain"]
    assert summed(texts) == [n_tokens(t) for t in texts]


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    want = sorted((row(r["doc_id"], r["text"]) for r in docs), key=str)
    assert rows(token_counts.query(spark, FOLDER)) == want


def test_odd_rows(spark):
    want = sorted((row(i, t) for i, t in ODD), key=str)
    assert rows(token_counts.count_tokens(odd_frame(spark), PATH)) == want
    assert rows(token_counts.count_tokens(empty_frame(spark), PATH)) == []


def test_many_slices_and_a_limit(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SLICE_BYTES", 200)
    monkeypatch.setattr(token_counts, "RANGE_NAMES", 50)
    texts = [(i, "the cat sat " * (i % 9) + f"word{i % 7} Ünïcode") for i in range(400)] + [(1000, "the " * 5000), (1001, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(3)
    found = token_counts.count_tokens(docs, PATH, limit=20)
    assert rows(found) == sorted(((i, len(t.encode()), n_tokens(t), n_tokens(t) > 20) for i, t in texts), key=str)


def test_a_pre_token_is_split_once(monkeypatch):
    """Over all lists of a range."""
    split = []
    monkeypatch.setattr(PreTokens, "pieces", lambda self, name: split.append(name) or len(name))
    lists = [["a", "bb", "ccc"], [], ["bb", "dd"]]
    table = pa.table({"slice": [3, 4, 5], "range": [0, 0, 0], "names": [token_counts._written(n) for n in lists]})
    found = token_counts._pieces(PATH)(table)
    assert [token_counts._unpacked(p.as_py()).tolist() for p in found.column("pieces")] == [[1, 2, 3], [], [2, 2]]
    assert split == ["a", "bb", "ccc", "dd"]

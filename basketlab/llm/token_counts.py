"""Token counts of whole texts: pieces per distinct pre-token, joined to the documents' pre-token frequencies.

Texts are read in slices of bounded size. A slice keeps, for each of its documents, the
distinct pre-tokens and how often each occurs (packed numbers), and the list of its own
distinct pre-tokens, ordered by hash. The lists are cut into ranges of the hash and meet
there: the tokenizer's model splits each pre-token once, and every slice gets back the
numbers of pieces in the order of its list. They join the slice's frequencies, and frequency
times pieces is summed for its documents. No token id of a document exists anywhere. A word
that is in every document travels once per slice, so frequent words make no heavy key; a
slice and a range, whose number follows the lists' lengths, are the largest groups of a task.

Pre-tokens are the tokenizer's own: texts are cut at ASCII white space, which the tokenizer
drops; a piece of plain Latin letters is split by the file's pattern, any other piece by the
library's normalizer and pre-tokenizer. An added token that a text spells out is one token
and counts as a pre-token of its own.

Defined cases: a null or empty text has no bytes and no tokens. Rows are counted each, also where
they repeat; a null id stays null. No documents give no rows. Other columns are not read.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketlab.llm.subwords import PLAIN, WORD_PATTERN
from basketlab.llm.words import slices
from basketlab.operators.staging import stage

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
SLICE_BYTES = 8 << 20
RANGE_NAMES = 400_000
CACHE_PIECES = 300_000


def name_hashes(names: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(n) for n in names), np.uint64, len(names))


class PreTokens:
    """Pre-tokens of pieces of text and the number of tokens in a pre-token; kept per worker process."""

    _open: dict[str, "PreTokens"] = {}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = set(added)
        self.marks = regex.compile("(" + "|".join(regex.escape(t) for t in added) + ")") if added else None
        self.pattern = regex.compile(WORD_PATTERN)
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in printable]
        self.letters = {b: 256 + i for i, b in enumerate(others)}
        self.known: dict[str, list[str]] = {}

    @classmethod
    def open(cls, path: str) -> "PreTokens":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _segment(self, text: str) -> list[str]:
        """Pre-tokens of text without added tokens, in the letters that stand for bytes."""
        if PLAIN.fullmatch(text) and text.isprintable():
            if text.isascii():
                return self.pattern.findall(text.lower())
            found = self.pattern.findall(unicodedata.normalize("NFC", text).lower())
            return [p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in found]
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def of(self, piece: str) -> list[str]:
        """Pre-tokens of a piece between two white spaces."""
        found = self.known.get(piece)
        if found is None:
            if self.marks is None or not self.marks.search(piece):
                found = self._segment(piece)
            else:
                found = []
                for part in self.marks.split(piece):
                    found += [part] if part in self.added else self._segment(part)
            if len(self.known) < CACHE_PIECES:
                self.known[piece] = found
        return found

    def pieces(self, pre_token: str) -> int:
        return 1 if pre_token in self.added else len(self.tokenizer.model.tokenize(pre_token))

    def frequencies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """(ends, codes, counts, names by hash): text i holds ``names[codes[k]]`` ``counts[k]`` times for its range of k."""
        column = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(column)
        heads = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.values.dictionary_encode()
        code_of: dict[str, int] = {}
        number = code_of.setdefault
        flat: list[int] = []
        sizes = np.zeros(len(coded.dictionary), np.int64)
        for i, piece in enumerate(coded.dictionary.to_pylist()):
            parts = self.of(piece) if piece else ()
            sizes[i] = len(parts)
            for part in parts:
                flat.append(number(part, len(code_of)))
        begins = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy().astype(np.int64)
        lengths = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        where = np.arange(ends[-1]) + np.repeat(begins[codes] - ends[:-1], lengths)
        doc = np.repeat(np.arange(len(column)), np.diff(ends[heads]))
        names = list(code_of)
        order = np.argsort(name_hashes(names), kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        width = max(1, len(names))
        keys, counts = np.unique(doc * width + place[np.array(flat, np.int64)[where]], return_counts=True)
        doc_ends = np.searchsorted(keys // width, np.arange(len(column)), side="right")
        return doc_ends, keys % width, counts, [names[k] for k in order.tolist()]


def _packed(values: np.ndarray) -> bytes:
    """32-bit numbers, byte by byte of all values, compressed."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _written(names: list[str]) -> bytes:
    """Pre-tokens hold no white space, so lines keep them apart."""
    return zstandard.compress("\n".join(names).encode(), 1)


def _read(data: bytes) -> list[str]:
    content = zstandard.decompress(data).decode()
    return content.split("\n") if content else []


def _slices(path: str):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, stop in slices(texts, SLICE_BYTES):
                part = texts.slice(start, stop - start)
                ends, codes, counts, names = PreTokens.open(path).frequencies(part)
                n_bytes = pc.fill_null(pc.binary_length(part.cast(pa.large_string())), 0)
                whole = pa.array([0, stop - start], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(whole, ids.slice(start, stop - start)),
                    pa.ListArray.from_arrays(whole, n_bytes.cast(pa.int64())),
                    pa.array([_packed(np.diff(ends, prepend=0))], pa.binary()),
                    pa.array([_packed(np.diff(codes, prepend=0) & 0xFFFFFFFF)], pa.binary()),
                    pa.array([_packed(counts)], pa.binary()), pa.array([_written(names)], pa.binary()),
                    pa.array([len(names)], pa.int64()),
                ], names=["doc_ids", "n_bytes", "sizes", "codes", "counts", "names", "n_names"])

    return run


def _ranges(count: int):
    """Each slice's list cut into ranges of the hash."""
    def run(batches):
        for batch in batches:
            for slice_, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                names = _read(data.as_py())
                found = ((name_hashes(names) >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
                starts = np.flatnonzero(np.diff(found.astype(np.int64), prepend=-1))
                stops = [*starts[1:].tolist(), len(names)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([slice_] * len(starts), pa.int64()), pa.array(found[starts].astype(np.int64)),
                    pa.array([_written(names[a:b]) for a, b in zip(starts.tolist(), stops)], pa.binary()),
                ], names=["slice", "range", "names"])

    return run


def _pieces(path: str):
    """Numbers of pieces for all lists of one range; each distinct pre-token is split once."""
    def run(table: pa.Table) -> pa.Table:
        known: dict[str, int] = {}
        count = PreTokens.open(path).pieces
        found = []
        for data in table.column("names"):
            names = _read(data.as_py())
            for name in names:
                if name not in known:
                    known[name] = count(name)
            found.append(_packed(np.fromiter(map(known.__getitem__, names), np.int64, len(names))))
        return pa.table({"at": table.column("slice"), "range": table.column("range"), "pieces": pa.array(found, pa.binary())})

    return run


def _sums(slice_rows: pa.Table, piece_rows: pa.Table) -> pa.Table:
    """Token counts of one slice's documents."""
    row = slice_rows.to_pylist()[0]
    lists = [_unpacked(r.as_py()) for r in piece_rows.sort_by("range").column("pieces")]
    pieces = np.concatenate([np.zeros(0, np.int64), *lists])
    sizes = _unpacked(row["sizes"])
    codes = np.cumsum(_unpacked(row["codes"])) & 0xFFFFFFFF
    total = np.concatenate([[0], np.cumsum(pieces[codes] * _unpacked(row["counts"]))])
    ends = np.cumsum(sizes)
    ids = slice_rows.column("doc_ids").combine_chunks().values
    return pa.table({"doc_id": ids, "n_bytes": pa.array(row["n_bytes"], pa.int64()), "n_tokens": total[ends] - total[ends - sizes]})


def piece_counts(lists: DataFrame, tokenizer: str) -> DataFrame:
    """(at, range, pieces) for rows (slice, names, n_names) of pre-token lists ordered by hash."""
    total = lists.agg(F.coalesce(F.sum("n_names"), F.lit(0))).first()[0]
    ranges = max(1, -(-total // RANGE_NAMES))
    cut = lists.select("slice", "names").mapInArrow(_ranges(ranges), "slice long, range long, names binary")
    return cut.groupBy("range").applyInArrow(_pieces(tokenizer), "at long, range long, pieces binary")


def count_tokens(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit, for a word tokenizer file that drops white space."""
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    schema = f"doc_ids array<{id_type}>, n_bytes array<bigint>, sizes binary, codes binary, counts binary, names binary, n_names long"
    read = given.mapInArrow(_slices(tokenizer), schema)
    kept = stage(read.withColumn("slice", F.monotonically_increasing_id()), "pre_tokens")
    pieces = piece_counts(kept, tokenizer)
    counted = kept.drop("names", "n_names").groupBy("slice").cogroup(pieces.groupBy("at")).applyInArrow(
        _sums, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, folder: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path(TOKENIZER))

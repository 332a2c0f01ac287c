"""Token ids as wavelet matrices: one compressed file content per shard, with rank and select.

A wavelet matrix keeps a sequence as one bit plane per binary digit. Every level sorts the
sequence stably by its digit, so a position moves to the next level by counting bits before
it (rank), and back by finding the k-th bit (select). From the one content a reader gets
the token at a place, the number of a token's occurrences before a place, and the place of
its k-th occurrence, in one step per digit; counts before every 512 bits keep a step short.

Documents are range-partitioned by id, so shards are in ascending order of ids and a task
holds one shard at a time. A shard is one row of the written table: first rows it holds,
document lengths, and the compressed planes.

Defined cases: a null or empty text is the end id alone. Equal ids stay next to each other, in
the order of their texts' hashes; null ids come first. No documents give no shards. Other
columns are not read.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlab.llm.subwords import Encoder
from basketlab.llm.words import slices
from basketlab.operators.staging import stage

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SHARD_BYTES = 8 << 20
MAGIC = b"WVM1"
BLOCK_BITS = 512


class WaveletMatrix:
    """Bit planes of a sequence of ids below 2 ** levels."""

    def __init__(self, length: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray]):
        self.length, self.planes, self.zeros, self.ranks = length, planes, zeros, ranks
        self.levels = len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> "WaveletMatrix":
        planes, zeros, ranks, sequence = [], [], [], ids
        for level in range(levels - 1, -1, -1):
            bits = (sequence >> sequence.dtype.type(level)) & sequence.dtype.type(1) == 1
            plane = np.packbits(bits, bitorder="little")
            plane = np.pad(plane, (0, -len(plane) % (BLOCK_BITS // 8)))
            ones = np.bitwise_count(plane.view("<u8")).reshape(-1, BLOCK_BITS // 64).sum(axis=1, dtype=np.int64)
            left = sequence[~bits]
            planes.append(plane)
            zeros.append(len(left))
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype("<u4"))
            sequence = np.concatenate([left, sequence[bits]])
        return cls(len(ids), planes, zeros, ranks)

    def to_bytes(self) -> bytes:
        head = MAGIC + struct.pack("<QB", self.length, self.levels) + struct.pack(f"<{self.levels}Q", *self.zeros)
        body = b"".join(p.tobytes() + r.tobytes() for p, r in zip(self.planes, self.ranks))
        return zstandard.ZstdCompressor(level=1).compress(head + body)

    @classmethod
    def from_bytes(cls, content: bytes) -> "WaveletMatrix":
        data = zstandard.ZstdDecompressor().decompress(content)
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        length, levels = struct.unpack_from("<QB", data, 4)
        zeros = list(struct.unpack_from(f"<{levels}Q", data, 13))
        at, blocks = 13 + 8 * levels, -(-length // BLOCK_BITS)
        planes, ranks = [], []
        for _ in range(levels):
            planes.append(np.frombuffer(data, np.uint8, blocks * BLOCK_BITS // 8, at))
            at += blocks * BLOCK_BITS // 8
            ranks.append(np.frombuffer(data, "<u4", blocks + 1, at))
            at += 4 * (blocks + 1)
        return cls(length, planes, zeros, ranks)

    def _ones(self, level: int, place: int) -> int:
        """Set bits of a plane before a place."""
        block, rest = divmod(place, BLOCK_BITS)
        begin = block * BLOCK_BITS // 8
        tail = int.from_bytes(self.planes[level][begin:begin + -(-rest // 8)].tobytes(), "little")
        return int(self.ranks[level][block]) + (tail & ((1 << rest) - 1)).bit_count()

    def _bit(self, level: int, place: int) -> int:
        return int(self.planes[level][place >> 3]) >> (place & 7) & 1

    def access(self, place: int) -> int:
        """Token at a place."""
        token = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, place), self._ones(level, place)
            place = self.zeros[level] + ones if bit else place - ones
            token = token << 1 | bit
        return token

    def _range(self, token: int, stop: int) -> tuple[int, int]:
        start = 0
        for level in range(self.levels):
            a, b = self._ones(level, start), self._ones(level, stop)
            if token >> (self.levels - 1 - level) & 1:
                start, stop = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def rank(self, token: int, stop: int) -> int:
        """Occurrences of a token before a place."""
        start, stop = self._range(token, stop)
        return stop - start

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence of a token, counted from 0."""
        start, stop = self._range(token, self.length)
        if not 0 <= k < stop - start:
            raise IndexError(k)
        place = start + k
        for level in range(self.levels - 1, -1, -1):
            one = token >> (self.levels - 1 - level) & 1
            place = self._find(level, one, place - self.zeros[level] if one else place)
        return place

    def _find(self, level: int, bit: int, k: int) -> int:
        """Place of the k-th bit of this value in a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK_BITS - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        begin = block * BLOCK_BITS // 8
        bits = np.unpackbits(self.planes[level][begin:begin + BLOCK_BITS // 8], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def decode(self) -> np.ndarray:
        """The whole sequence: the levels' sorts undone from the last to the first."""
        width = np.uint16 if self.levels <= 16 else np.uint32
        sequence = np.zeros(self.length, width)
        for level in range(self.levels - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.length, bitorder="little").view(bool)
            above = np.empty(self.length, width)
            above[~bits] = sequence[:self.zeros[level]]
            above[bits] = sequence[self.zeros[level]:] | width(1 << (self.levels - 1 - level))
            sequence = above
        return sequence


def _encode(path: str, end_id: int, levels: int, literal: bool):
    def run(batches):
        number = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, stop in slices(texts, SHARD_BYTES):
                offsets, tokens = Encoder.open(path, literal).encode(texts.slice(start, stop - start))
                lengths = np.diff(offsets) + 1
                sequence = np.full(int(lengths.sum()), end_id, np.uint16 if levels <= 16 else np.uint32)
                inner = np.ones(len(sequence), bool)
                inner[np.cumsum(lengths) - 1] = False
                sequence[inner] = tokens
                content = WaveletMatrix.build(sequence, levels).to_bytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([number], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, stop - start], pa.int32()), ids.slice(start, stop - start)),
                    pa.array([lengths.tolist()], pa.list_(pa.int64())), pa.array([len(sequence)], pa.int64()),
                    pa.array([content], pa.binary()),
                ], names=["part", "number", "doc_ids", "lengths", "n_tokens", "content"])
                number += 1

    return run


def write_shards(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID, levels: int = 16,
    literal: bool = True,
) -> DataFrame:
    """Shards of the documents in ascending order of ids, written in the shared folder.

    Special tokens that a text spells out are plain text; with ``literal=False`` they are the file's tokens.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    keyed = given.withColumn("tie", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    schema = f"part int, number int, doc_ids array<{id_type}>, lengths array<bigint>, n_tokens long, content binary"
    return stage(ordered.mapInArrow(_encode(tokenizer, end_id, levels, literal), schema), "wavelet_shards")


def _decode(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("part", "number", "lengths", "content")}
            lengths = np.array(row["lengths"], np.int64)
            data = memoryview(WaveletMatrix.from_bytes(row["content"]).decode().astype("<u4").tobytes())
            ends = np.cumsum(lengths) * 4
            checks = [zlib.crc32(data[a:b]) for a, b in zip((ends - lengths * 4).tolist(), ends.tolist())]
            count = len(lengths)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["part"]] * count, pa.int32()), pa.array([row["number"]] * count, pa.int32()),
                batch.column("doc_ids")[i].values, pa.array(np.cumsum(lengths) - lengths), pa.array(lengths),
                pa.array(checks, pa.int64()),
            ], names=["part", "number", "doc_id", "inner", "n_tokens", "ids_crc32"])


def read_documents(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards."""
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()
    found = shards.select("part", "number", "doc_ids", "lengths", "content").mapInArrow(
        _decode, f"part int, number int, doc_id {id_type}, inner long, n_tokens long, ids_crc32 long")
    # Tokens before a shard: those of earlier parts (one row per part), then of the part's earlier shards.
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    earlier = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    starts = shards.select("part", "number", F.coalesce(earlier, F.lit(0)).alias("shard_start")).join(parts, "part")
    return found.join(starts, ["part", "number"]).select(
        "doc_id", (F.col("part_start") + F.col("shard_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return read_documents(write_shards(docs, public_tokenizers.path(TOKENIZER), literal=False))

"""Sum-of-squares packing of documents into sequences of a fixed length.

Longer documents are cut into full sequences and one shorter first piece; every other
document is one piece. Pieces are dealt evenly into groups by a hash of their place, and
each group is packed by one task: a piece goes where the sum of the squared counts of open
sequences per residual gap becomes smallest, among the sequences it fits into, else into a
new one; a gap that it fills exactly comes first. Long pieces go first. Sequences that stay
open are emptied and packed again together for a few rounds, as long as that saves some.
A group holds many thousand pieces, so what its last open sequences leave empty is a small
share, and the number of groups grows with the input.

Defined cases: a null or empty text is the end id alone. Repeated rows are packed each. Pieces
of one document may lie in different sequences. No documents give no rows. Other columns
are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.llm.subwords import Encoder
from basketlab.llm.words import freed, slices
from basketlab.operators.staging import arrow_batches, stage

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
LENGTH = 2048
BLOCK_BYTES = 4 << 20
#: Documents of a batch, about a block of common ones.
BATCH_ROWS = 1_500
GROUP_PIECES = 20_000
ROUNDS = 6


def _pieces(path: str, end_id: int, length: int, literal: bool):
    """Pieces of the documents with the checksum of their ids."""

    def run(batches):
        number = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, stop in slices(texts, BLOCK_BYTES):
                offsets, tokens = Encoder.open(path, literal).encode(texts.slice(start, stop - start))
                sizes = np.diff(offsets) + 1
                ends = np.cumsum(sizes)
                sequence = np.full(int(ends[-1]), end_id, "<u4")
                inner = np.ones(len(sequence), bool)
                inner[ends - 1] = False
                sequence[inner] = tokens
                # The first piece takes what full pieces leave.
                count = -(-sizes // length)
                doc = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                head = sizes - (count - 1) * length
                begin = np.where(piece == 0, 0, head[doc] + (piece - 1) * length)
                size = np.where(piece == 0, head[doc], length)
                data, first = memoryview(sequence.tobytes()), ((ends - sizes)[doc] + begin) * 4
                checks = [zlib.crc32(data[a:a + n]) for a, n in zip(first.tolist(), (size * 4).tolist())]
                row = (TaskContext.get().partitionId() << 32) + number + np.arange(len(doc))
                number += len(doc)
                yield pa.RecordBatch.from_arrays([
                    pa.array(row), ids.slice(start, stop - start).take(pa.array(doc)), pa.array(piece),
                    pa.array(begin), pa.array(size), pa.array(checks, pa.int64()),
                ], names=["row", "doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def sum_of_squares(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Indices of the sizes by bin. Bins without a gap do not count; equal choices take the smallest gap."""
    counts = np.zeros(length + 1, np.int64)
    open_bins: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        gaps = np.flatnonzero(counts[size:]) + size
        if not len(gaps):
            gap, at = length, len(bins)
            bins.append([])
        else:
            left = counts[gaps - size]
            left[gaps == size] = -len(sizes)  # a filled sequence leaves the sum
            gap = int(gaps[np.argmin(left - counts[gaps])])
            at = open_bins[gap].pop()
            counts[gap] -= 1
        bins[at].append(item)
        if gap > size:
            counts[gap - size] += 1
            open_bins.setdefault(gap - size, []).append(at)
    return bins


def pack_group(sizes: np.ndarray, length: int, rounds: int = ROUNDS) -> list[list[int]]:
    """Bins of one group; what stays open is packed again while that saves a bin."""
    done: list[list[int]] = []
    rest = sum_of_squares(sizes, length)
    for _ in range(rounds):
        filled = [b for b in rest if int(sizes[b].sum()) == length]
        open_bins = [b for b in rest if int(sizes[b].sum()) < length]
        if not open_bins:
            break
        items = np.array(sorted(i for b in open_bins for i in b))
        again = [items[b].tolist() for b in sum_of_squares(sizes[items], length)]
        if len(again) >= len(open_bins):
            break
        done += filled
        rest = again
    return done + rest


def _pack(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        sizes = table.column("length").to_numpy()
        sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
        for k, items in enumerate(pack_group(sizes, length)):
            sequence[items] = k
            offset[items] = np.cumsum(sizes[items]) - sizes[items]
        group = table.column("group").to_numpy()
        return table.drop_columns(["group", "row"]).append_column(
            "sequence_id", pa.array((group << 32) + sequence)).append_column("offset", pa.array(offset))

    return run


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, length: int = LENGTH, group_pieces: int = GROUP_PIECES,
    literal: bool = True,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Special tokens that a text spells out are plain text; with ``literal=False`` they are the file's tokens.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {id_type}, piece long, start long, length long, ids_crc32 long"
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        pieces = stage(given.mapInArrow(freed(_pieces(tokenizer, end_id, length, literal)), f"row long, {columns}"), "pieces")
    groups = max(1, math.ceil(pieces.count() / group_pieces))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(_pack(length), f"{columns}, sequence_id long, offset long").select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def query(spark, folder: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path(TOKENIZER), literal=False)


def pack_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path(TOKENIZER), literal=False)

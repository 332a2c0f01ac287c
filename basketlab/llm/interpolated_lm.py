"""Language-model scoring by deleted interpolation of n-gram estimates.

The probability of a token is a mixture of maximum-likelihood estimates of every order and
the uniform distribution. The weights of the mixture depend on how often the context
occurs in training (powers of two form the buckets) and are learned by expectation
maximisation on deleted counts: every training n-gram is predicted by the counts that are
left when that occurrence is held out, so all training text is estimation and held-out
text at once.

How the counts travel: documents are coded once into blocks (a table of word numbers and
distinct words) that are written down. Every block asks for the totals of its distinct
n-grams: it sends sorted hashes with its own training counts, dealt by hash range, so that
a frequent n-gram is one entry per block and never a hot key. One task per range adds them
up and answers every block in the order of its question. The estimates, the statistics for
the weights and the scores are then computed where the block is. The statistics of all
blocks meet in a table of log-odds steps whose size is bounded (``STEP``), whatever the corpus.

A document is preceded by end tokens and ends in one, so an n-gram never reaches into another
document.

Defined cases: a null or wordless text is the end token alone. Without training text all
counts are 0 and the score is log10 of the uniform 1 / (V + 1) per token. Repeated rows count
and score each. Other columns are not read. N-gram hashes have 64 bits.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.llm.words import SPACED, pack_sorted, run_hashes, slices, split_words, unpack_sorted, word_hashes
from basketlab.operators.staging import new_path, stage

ORDER = 2
FOLDS, HELD_FOLD = 7, 2
BLOCK_BYTES = 4 << 20
BUCKETS = 20
#: Estimates enter the statistics of the weights on a grid of 1 / STEP powers of two.
STEP = 8
ROUNDS = 30
LEAST_UNIFORM = 1e-6

END = "\n"  # no word holds white space


def fold_of(doc_id) -> int | None:
    """The held-out split: crc32 of the id as text; a null id is in training."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS


def _blocks(held_fold: int):
    """Blocks of documents: ids, held-out marks, lengths, token codes and word hashes."""

    def run(batches):
        number = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, stop in slices(texts, BLOCK_BYTES):
                offsets, codes, vocabulary = split_words(texts.slice(start, stop - start), SPACED)
                lengths = np.diff(offsets) + 1
                tokens = np.zeros(len(codes) + len(lengths), np.int64)
                ends = np.cumsum(lengths) - 1
                inner = np.ones(len(tokens), bool)
                inner[ends] = False
                tokens[inner] = codes + 1
                # Words are numbered in the order of their hashes, so that both pack well.
                hashes = np.concatenate([word_hashes(pa.array([END])), word_hashes(vocabulary)])
                by_hash = np.argsort(hashes)
                rank = np.empty(len(hashes), np.int64)
                rank[by_hash] = np.arange(len(hashes))
                hashes, tokens = hashes[by_hash], rank[tokens]
                held = [fold_of(x) == held_fold for x in ids.slice(start, stop - start).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, stop - start], pa.int32()), ids.slice(start, stop - start)),
                    pa.array([held], pa.list_(pa.bool_())), pa.array([lengths.tolist()], pa.list_(pa.int64())),
                    pa.array([_pack_tokens(tokens)], pa.binary()), pa.array([pack_sorted(hashes)], pa.binary()),
                ], names=["block", "doc_ids", "held", "lengths", "tokens", "hashes"])
                number += 1

    return run


def _rows(batch: pa.RecordBatch):
    """One row at a time: a block is large, a batch of them need not fit twice."""
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _pack_tokens(tokens: np.ndarray) -> bytes:
    """Codes byte by byte: all lowest bytes first, then the next ones, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack_tokens(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Block:
    """Tokens of a block and, for every kind of n-gram, its distinct ones in hash order.

    Kind n counts the n tokens that end at a place. Kind -n, needed from n = 3 up, counts the
    n - 1 tokens before a place; for n = 2 those are the single tokens themselves.
    """

    def __init__(self, row: dict, order: int):
        self.hashes = unpack_sorted(row["hashes"])
        self.tokens = _unpack_tokens(row["tokens"])
        end = np.searchsorted(self.hashes, word_hashes(pa.array([END]))[0])
        self.lengths = np.array(row["lengths"], np.int64)
        self.held = np.repeat(np.array(row["held"], bool), self.lengths)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.order = order
        self.kinds = [*range(1, order + 1), *range(-3, -order - 1, -1)]
        starts = np.repeat(self.first, self.lengths)
        at = np.arange(len(self.tokens))
        before = [self.hashes[np.where(at - k >= starts, self.tokens[at - k], end)] for k in range(order)]
        self.grams, self.place = {}, {}
        for kind in self.kinds:
            run = before[kind - 1::-1] if kind > 0 else before[-kind - 1:0:-1]
            self.grams[kind], self.place[kind] = np.unique(run_hashes(run), return_inverse=True)

    def own_counts(self, kind: int) -> np.ndarray:
        return np.bincount(self.place[kind][~self.held], minlength=len(self.grams[kind]))

    def counts(self, totals: dict) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per place the training counts of its n-grams, and of the contexts of orders 2 and up."""
        found = {kind: totals[kind][self.place[kind]] for kind in self.kinds}
        contexts = []
        for n in range(2, self.order + 1):
            if n > 2:
                contexts.append(found[-n])
                continue
            last = np.roll(found[1], 1)
            last[self.first] = found[1][np.cumsum(self.lengths) - 1]  # the end token before a document
            contexts.append(last)
        return [found[n] for n in range(1, self.order + 1)], contexts


REQUESTS = {"block": pa.int64(), "part": pa.int32(), "kind": pa.int32(), "grams": pa.binary(), "counts": pa.binary()}


def _small(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs, compressed: most are 0 or 1. The first byte tells the width."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << (8 * w))
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(counts.astype(f"<u{width}").tobytes())


def _large(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


def _ask(order: int, parts: int):
    span = (1 << 64) // parts + 1
    edges = np.array([min(span * k, (1 << 64) - 1) for k in range(1, parts)], np.uint64)

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                block = Block(row, order)
                for kind in block.kinds:
                    grams, counts = block.grams[kind], block.own_counts(kind)
                    cuts = [0, *np.searchsorted(grams, edges).tolist(), len(grams)]
                    out = [(row["block"], part, kind, pack_sorted(grams[a:b]), _small(counts[a:b]))
                           for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
                    cells = [pa.array(c, t) for c, t in zip(zip(*out), REQUESTS.values())]
                    yield pa.RecordBatch.from_arrays(cells, names=list(REQUESTS))

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one hash range, for each block in the order of its question."""
    rows = table.select(list(REQUESTS)).to_pylist()
    grams = [unpack_sorted(r["grams"]) for r in rows]
    every = np.concatenate(grams)
    order = np.argsort(every, kind="stable")  # merges the ascending lists
    every = every[order]
    heads = np.ones(len(every), bool)
    heads[1:] = every[1:] != every[:-1]
    number = np.cumsum(heads) - 1
    counts = np.concatenate([_large(r["counts"]) for r in rows])[order]
    totals = np.bincount(number, weights=counts).astype(np.int64)
    result = np.empty(len(every), np.int64)
    result[order] = totals[number]
    cuts = np.cumsum([len(g) for g in grams])[:-1]
    rest = [0] * (len(rows) - 1)
    return pa.table({
        "block": pa.array([r["block"] for r in rows], pa.int64()), "part": pa.array([r["part"] for r in rows], pa.int32()),
        "kind": pa.array([r["kind"] for r in rows], pa.int32()),
        "totals": pa.array([_small(t) for t in np.split(result, cuts)], pa.binary()),
        "distinct": pa.array([int((totals > 0).sum()), *rest], pa.int64()),
        "seen": pa.array([int(totals.sum()), *rest], pa.int64()),
    })


ANSWER_SCHEMA = "block long, part int, kind int, totals binary, distinct long, seen long"


def _totals(row: dict) -> dict[int, np.ndarray]:
    """Totals by kind, in hash order: ranges follow each other."""
    found: dict = {}
    for answer in sorted(row["answers"], key=lambda a: a["part"]):
        found.setdefault(answer["kind"], []).append(_large(answer["totals"]))
    return {kind: np.concatenate(parts) for kind, parts in found.items()}


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context + 1.0).astype(np.int64), BUCKETS - 1)


def _estimates(counts, contexts, seen: int, uniform: float, gone: int):
    """Estimates of orders 0 and up per place, ``gone`` occurrences deleted, and the context's bucket."""
    found = [np.full(len(counts[0]), uniform)]
    for count, context in zip(counts, [np.full(len(counts[0]), seen), *contexts]):
        left = np.maximum(context - gone, 0)
        found.append(np.where(left > 0, np.maximum(count - gone, 0) / np.maximum(left, 1), 0.0))
    longest = contexts[-1] if contexts else np.full(len(counts[0]), seen)
    return found, _bucket(np.maximum(longest - gone, 0))


def _statistics(order: int, seen: int, distinct: int):
    """How many training tokens have each combination of bucket and deleted estimates, on the grid."""
    levels = 64 * STEP + 2

    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                block = Block(row, order)
                found, bucket = _estimates(*block.counts(_totals(row)), seen, 1.0 / (distinct + 1), 1)
                key = bucket[~block.held]
                for estimate in found[1:]:
                    ratio = estimate[~block.held] * (distinct + 1)
                    step = np.round(np.log2(np.maximum(ratio, 2.0 ** -32)) * STEP).astype(np.int64) + 32 * STEP + 1
                    key = key * levels + np.where(ratio > 0, np.clip(step, 1, levels - 1), 0)
                keys, tokens = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(tokens)], names=["cell", "tokens"])

    return run


def learn_weights(cells: np.ndarray, tokens: np.ndarray, order: int) -> np.ndarray:
    """Mixture weights [bucket, order 0 and up] by expectation maximisation on the statistics.

    Buckets without training tokens take the weights learned from all of them.
    """
    levels, rest, ratios = 64 * STEP + 2, cells.copy(), []
    for _ in range(order):
        step = rest % levels
        ratios.append(np.where(step > 0, 2.0 ** ((step - 32 * STEP - 1) / STEP), 0.0))
        rest //= levels
    odds = np.stack([np.ones(len(cells)), *ratios[::-1]], axis=1) if len(cells) else np.zeros((0, order + 1))

    def learned(rows: np.ndarray) -> np.ndarray | None:
        if not tokens[rows].sum():
            return None
        weights = np.full(order + 1, 1.0 / (order + 1))
        for _ in range(ROUNDS):
            share = odds[rows] * weights
            share /= share.sum(axis=1, keepdims=True)
            weights = (share * tokens[rows][:, None]).sum(axis=0)
            weights = np.maximum(weights / weights.sum(), [LEAST_UNIFORM] + [0.0] * order)
            weights /= weights.sum()
        return weights

    overall = learned(np.ones(len(cells), bool))
    if overall is None:
        overall = np.array([1.0] + [0.0] * order)
    found = [learned(rest == b) for b in range(BUCKETS)]
    return np.array([overall if w is None else w for w in found])


def _scores(order: int, seen: int, distinct: int, weights: np.ndarray):
    def run(batches):
        for batch in batches:
            for row in _rows(batch):
                block = Block(row, order)
                counts, contexts = block.counts(_totals(row))
                found, bucket = _estimates(counts, contexts, seen, 1.0 / (distinct + 1), 0)
                mixture = sum(weights[bucket, n] * p for n, p in enumerate(found))
                base = np.log10((counts[0] + 1) / (seen + distinct + 1))
                sums = [np.add.reduceat(x, block.first) for x in (counts[0] > 0, base, np.log10(mixture))]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], batch.column("doc_ids").type.value_type), pa.array(row["held"], pa.bool_()),
                    pa.array(block.lengths), pa.array(sums[0].astype(np.int64)),
                    pa.array(np.full(len(block.lengths), seen)), pa.array(sums[1]), pa.array(sums[2]),
                ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def _stage_bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """The blocks as a table in the shared folder, bucketed so that joins on the block leave them where they are."""
    path = new_path(df.sparkSession, name)
    table = "basketlab_" + path.rsplit("-", 1)[-1]
    df.write.bucketBy(buckets, "block").option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def score_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER, held_fold: int = HELD_FOLD
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    parts = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    blocks = _stage_bucketed(given.mapInArrow(
        _blocks(held_fold), f"block long, doc_ids array<{id_type}>, held array<boolean>, lengths array<bigint>, "
        "tokens binary, hashes binary"), "token_blocks", parts // 2)
    asked = blocks.mapInArrow(_ask(order, parts), "block long, part int, kind int, grams binary, counts binary")
    answers = stage(asked.groupBy("part", "kind").applyInArrow(_answer, ANSWER_SCHEMA), "gram_totals")
    seen, distinct = answers.filter("kind = 1").agg(F.sum("seen"), F.sum("distinct")).first()
    seen, distinct = seen or 0, distinct or 0

    by_block = answers.groupBy("block").agg(F.collect_list(F.struct("part", "kind", "totals")).alias("answers"))
    known = blocks.join(by_block, "block")  # only the answers are shuffled
    cells = known.mapInArrow(_statistics(order, seen, distinct), "cell long, tokens long")
    rows = cells.groupBy("cell").agg(F.sum("tokens").alias("tokens")).collect()
    weights = learn_weights(np.array([r["cell"] for r in rows], np.int64), np.array([r["tokens"] for r in rows], float), order)
    return known.mapInArrow(
        _scores(order, seen, distinct, weights), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
        "train_tokens long, base_score double, score double")


def query(spark, folder: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{folder}/documents.parquet"))

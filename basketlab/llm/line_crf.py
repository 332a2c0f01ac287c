"""Document quality from a linear-chain conditional random field over lines.

Every line has the features of its own characters and words and those of the lines before
and after it. The field labels the lines of a document good or bad; its parameters are one
weight per feature and one per pair of neighbouring labels. It is fitted on labelled
documents, whose lines all carry the document's label, by maximising the regularised
conditional likelihood; forward-backward gives the gradients. A document's score is the
mean probability of its lines to be good, from the same forward-backward, weighted by their
lengths.

Fitting takes a bounded sample: ``SAMPLE`` labelled documents with the smallest hashes of
their ids, of at most ``SAMPLE_LINES`` lines each; an id on several rows is one document, of the least of its texts.
Scoring covers every line of every text. Features exist for ``PIECE_LINES`` lines at a time, and a long text's
chain is cut into pieces between which messages are carried, so scores are those of the whole chain.

Defined cases: a null or empty text is one empty line. Rows without an id take part in scoring
only; a document labelled twice counts with its higher label. Without any label the score is
0.5. Repeated rows are scored each. Only id, text and, for fitting, the label are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlab.llm.words import SPACED, slices, split_words

FOLDS, HELD_FOLD = 5, 0
SAMPLE = 4_000
SAMPLE_LINES = 500
THRESHOLD = 0.3
BLOCK_BYTES = 4 << 20
#: Lines whose features exist at one time, the length from which a chain is cut, and the lines of its pieces.
PIECE_LINES = 1 << 15
LONG_CHAIN = 1 << 13
CHAIN_PIECE = 1 << 11
STEPS = 150
RATE = 0.1
PENALTY = 1e-3

_KINDS = ("upper", "lower", "digit", "symbol", "exclamation", "stop", "blank", "bracket")


def _kinds() -> np.ndarray:
    """Kind of every byte, -1 for none; bytes above 127 belong to lower letters."""
    found = np.full(256, -1, np.int8)
    for kind, characters in (
        (0, bytes(range(65, 91))), (1, bytes(range(97, 123)) + bytes(range(128, 256))), (2, b"0123456789"),
        (3, b"#*$%&|<>"), (4, b"!"), (5, b".,;:?"), (6, b" \t\x0b\x0c\r"), (7, b"()[]{}=/\\_\"'`~^@+"),
    ):
        found[list(characters)] = kind
    return found


_KIND_OF = _kinds()


def _split_lines(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(lines per text, all lines, 1 for each line that its text had before); a text has one line at least."""
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.split_pattern(column, "\n")
    count, lines = np.diff(split.offsets.to_numpy().astype(np.int64)), split.values
    coded = lines.dictionary_encode()
    text_of = np.repeat(np.arange(len(count)), count)
    _, first = np.unique(text_of * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_index=True)
    again = np.ones(len(lines), np.int8)
    again[first] = 0
    return count, lines, again


def _own_features(lines: pa.Array, again: np.ndarray) -> np.ndarray:
    """Features of each line's own characters and words."""
    sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(lines)
    owner = np.repeat(np.arange(n), sizes)
    content = np.frombuffer(b"".join(lines.cast(pa.large_binary()).to_pylist()), np.uint8)
    kind = _KIND_OF[content]
    known = kind >= 0
    found = np.bincount(owner[known] * len(_KINDS) + kind[known], minlength=n * len(_KINDS)).reshape(n, len(_KINDS))
    upper, lower, digit, symbol, exclamation, stop, blank, bracket = found.T.astype(np.float64)

    offsets, codes, vocabulary = split_words(lines, SPACED)
    words = np.diff(offsets)
    of_word = np.repeat(np.arange(n), words)
    distinct = np.bincount(np.unique(of_word * max(1, len(vocabulary)) + codes) // max(1, len(vocabulary)), minlength=n)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (of_word[1:] == of_word[:-1])
    adjacent = np.bincount(of_word[same], minlength=n)
    short = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False) <= 3
    n_short = np.bincount(of_word[short[codes]], minlength=n) if len(codes) else np.zeros(n)

    per_word, per_byte = np.maximum(words, 1), np.maximum(sizes, 1)
    return np.stack([
        np.log1p(sizes) / 5, np.log1p(words) / 5, np.minimum(symbol / per_word, 3), np.minimum(exclamation / per_word, 3),
        upper / np.maximum(upper + lower, 1), digit / per_byte, np.minimum(stop / per_word, 3), bracket / per_byte,
        np.minimum(sizes / per_word / 10, 3), distinct / per_word, adjacent / per_word, n_short / per_word,
        (upper + lower) / per_byte, again * (words > 0), (words == 0).astype(float),
    ], axis=1)


def line_features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(lines per text, bytes per line, features [line, feature]) by pieces of ``PIECE_LINES`` lines; the first item is whole in every piece."""
    count, lines, again = _split_lines(texts)
    ends = np.cumsum(count)
    is_first, is_last = np.zeros(len(lines), bool), np.zeros(len(lines), bool)
    is_first[ends - count], is_last[ends - 1] = True, True
    for start in range(0, len(lines), PIECE_LINES):
        stop = min(start + PIECE_LINES, len(lines))
        # The lines beside the piece lend their features.
        low, high = max(start - 1, 0), min(stop + 1, len(lines))
        around = _own_features(lines.slice(low, high - low), again[low:high])
        own = around[start - low:stop - low]
        before, after = np.zeros_like(own), np.zeros_like(own)
        before[1 - (start - low):] = around[:stop - low - 1]
        after[:high - start - 1] = around[start - low + 1:]
        before[is_first[start:stop]] = 0
        after[is_last[start:stop]] = 0
        edges = np.stack([np.ones(stop - start), is_first[start:stop], is_last[start:stop]], axis=1)
        sizes = pc.binary_length(lines.slice(start, stop - start)).to_numpy(zero_copy_only=False).astype(np.int64)
        yield count, sizes, np.concatenate([edges, own, before, after], axis=1)


def line_odds(texts: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines per text, bytes per line, log-odds per line); only one piece has its features at a time."""
    pieces = [(count, sizes, features @ weights) for count, sizes, features in line_features(texts)]
    if not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return pieces[0][0], np.concatenate([p[1] for p in pieces]), np.concatenate([p[2] for p in pieces])


def chain_marginals(
    scores: np.ndarray, count: np.ndarray, moves: np.ndarray, share: np.ndarray | None = None,
    enter: np.ndarray | None = None, leave: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """(probability of good per line, expected moves [2, 2]) by forward-backward over all chains at once.

    ``scores`` are the lines' log-odds of good by their features, ``moves`` the weights of
    neighbouring labels. ``share`` weighs the chains in the expected moves. ``enter`` and ``leave`` are messages
    [chain, 2] from what lies before and behind each chain. Chains are ordered by length, so
    step t works on a prefix of them.
    """
    order = np.argsort(-count, kind="stable")
    first = (np.cumsum(count) - count)[order]
    longest = int(count.max()) if len(count) else 0
    alive = np.searchsorted(-count[order], -np.arange(longest), side="left")
    local, step = _local(scores), np.exp(moves)
    forward, backward = np.empty_like(local), np.ones_like(local)
    if leave is not None:
        backward[np.cumsum(count) - 1] = leave
    for t in range(longest):
        at = first[:alive[t]] + t
        if t:
            now = (forward[at - 1] @ step) * local[at]
        else:
            now = local[at] if enter is None else local[at] * enter[order]
        forward[at] = now / now.sum(axis=1, keepdims=True)
    moved = np.zeros((2, 2))
    for t in range(longest - 1, 0, -1):
        at = first[:alive[t]] + t
        ahead = local[at] * backward[at]
        joint = forward[at - 1][:, :, None] * step * ahead[:, None, :]
        weight = 1.0 if share is None else share[order[:alive[t]], None, None]
        moved += (weight * joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = ahead @ step.T
        backward[at - 1] = back / back.sum(axis=1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), moved


def _local(scores: np.ndarray) -> np.ndarray:
    good = 1 / (1 + np.exp(-np.clip(scores, -60, 60)))
    return np.stack([1 - good, good], axis=1) + 1e-300


def long_marginals(scores: np.ndarray, moves: np.ndarray, cut: int | None = None) -> np.ndarray:
    """Probability of good per line of one long chain, in pieces of ``cut`` lines that are worked on together.

    The product of a piece's steps carries the messages over it, so those that enter and leave every piece are
    known before its lines are looked at one by one.
    """
    cut = cut or CHAIN_PIECE
    pieces = -(-len(scores) // cut)
    local, step = _local(scores), np.exp(moves)
    product = np.zeros((pieces, 2, 2))
    product[:, [0, 1], [0, 1]] = local[::cut]
    for t in range(1, cut):
        alive = pieces if t < len(scores) - (pieces - 1) * cut else pieces - 1
        product[:alive] = (product[:alive] @ step) * local[t::cut][:alive, None, :]
        product[:alive] /= product[:alive].sum(axis=(1, 2), keepdims=True)
    enter, leave = np.ones((pieces, 2)), np.ones((pieces, 2))
    for p in range(1, pieces):
        message = enter[p - 1] @ product[p - 1] @ step
        enter[p] = message / message.sum()
    for p in range(pieces - 2, -1, -1):
        message = step @ product[p + 1] @ leave[p + 1]
        leave[p] = message / message.sum()
    count = np.full(pieces, cut, np.int64)
    count[-1] = len(scores) - (pieces - 1) * cut
    return chain_marginals(scores, count, moves, enter=enter, leave=leave)[0]


def line_probabilities(scores: np.ndarray, count: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of good per line: short chains together, each long one by its pieces."""
    good = np.empty(len(scores))
    ends = np.cumsum(count)
    long = count > LONG_CHAIN
    inside = np.repeat(long, count)
    good[~inside] = chain_marginals(scores[~inside], count[~long], moves)[0]
    for i in np.flatnonzero(long).tolist():
        good[ends[i] - count[i]:ends[i]] = long_marginals(scores[ends[i] - count[i]:ends[i]], moves)
    return good


def fit(features: np.ndarray, count: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, moves) that maximise the conditional likelihood of the lines' labels; Adam on the whole sample."""
    weights, moves = np.zeros(features.shape[1]), np.zeros((2, 2))
    if not len(labels):
        return weights, moves
    # Both labels count alike, however rare one of them is.
    share = np.where(labels == 1, 0.5 / max(1, count[labels == 1].sum()), 0.5 / max(1, count[labels == 0].sum()))
    target, line_share = np.repeat(labels, count), np.repeat(share, count)
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (share * np.maximum(count - 1, 0))[labels == label].sum()
    mean, square = np.zeros(len(weights) + 4), np.zeros(len(weights) + 4)
    for i in range(1, STEPS + 1):
        good, moved = chain_marginals(features @ weights, count, moves, share)
        gradient = np.concatenate([features.T @ ((target - good) * line_share), (seen - moved).ravel()])
        gradient -= PENALTY * np.concatenate([weights, moves.ravel()])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        change = RATE * (mean / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.99 ** i)) + 1e-8)
        weights, moves = weights + change[:-4], moves + change[-4:].reshape(2, 2)
    return weights, moves


def _sample_features(batches):
    for batch in batches:
        for start, stop in slices(batch.column(1), BLOCK_BYTES):
            texts, labels = (batch.column(i).slice(start, stop - start) for i in (1, 0))
            # Longer texts are no part of the sample; the others go a bounded number of lines at a time.
            lines = pc.add(pc.count_substring(pc.fill_null(texts, ""), "\n"), 1).to_numpy(zero_copy_only=False)
            keep = np.flatnonzero(lines <= SAMPLE_LINES)
            for part in np.array_split(keep, max(1, -(-int(lines[keep].sum()) // (PIECE_LINES // 2)))):
                if not len(part):
                    continue
                chosen = texts.take(pa.array(part, pa.int64()))
                pieces = list(line_features(chosen))
                count, features = pieces[0][0], np.concatenate([p[2] for p in pieces])
                cuts = np.cumsum(count)
                rows = [features[b - n:b].astype("<f4").tobytes() for n, b in zip(count, cuts)]
                yield pa.RecordBatch.from_arrays(
                    [labels.take(pa.array(part, pa.int64())), pa.array(count), pa.array(rows, pa.binary())], names=["label", "lines", "features"])


def _fold(doc_id: str | Column) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """The field's parameters from labelled documents (doc_id, text), (doc_id, label) outside the held-out fold."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (_fold("doc_id") != HELD_FOLD))
    chosen = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # One text per id, however many rows have it; partial minima come before the shuffle.
    sampled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = sampled.select("label", "text").mapInArrow(
        _sample_features, "label int, lines long, features binary").collect()
    # Rows come in any order: sums of the fit must not depend on it.
    rows.sort(key=lambda r: (r["label"], bytes(r["features"])))
    count = np.array([r["lines"] for r in rows], np.int64)
    wide = next(line_features(pa.array([""])))[2].shape[1]
    features = np.concatenate([np.frombuffer(r["features"], "<f4").reshape(-1, wide) for r in rows] or [np.zeros((0, wide))])
    return fit(features.astype(np.float64), count, np.array([r["label"] for r in rows], np.float64))


def _score(weights: np.ndarray, moves: np.ndarray, threshold: float):
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column(1), BLOCK_BYTES):
                count, sizes, odds = line_odds(batch.column(1).slice(start, stop - start), weights)
                good = line_probabilities(odds, count, moves)
                heads = np.cumsum(count) - count
                weight = sizes + 1.0
                score = np.clip(np.add.reduceat(good * weight, heads) / np.add.reduceat(weight, heads), 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                    names=["doc_id", "score", "predicted"])

    return run


def score_quality(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    given = docs.select("doc_id", "text")
    id_type = given.schema["doc_id"].dataType.simpleString()
    scored = given.mapInArrow(_score(*model, threshold), f"doc_id {id_type}, score double, predicted int")
    return scored.select("doc_id", F.coalesce(_fold("doc_id") == HELD_FOLD, F.lit(False)).alias("held_out"), "score", "predicted")


def _label(weights: np.ndarray, moves: np.ndarray, threshold: float):
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column(1), BLOCK_BYTES):
                count, _, odds = line_odds(batch.column(1).slice(start, stop - start), weights)
                good = line_probabilities(odds, count, moves)
                owner = np.repeat(np.arange(start, stop), count)
                line_no = np.arange(len(good)) - np.repeat(np.cumsum(count) - count, count)
                for a in range(0, len(good), PIECE_LINES):
                    part = slice(a, a + PIECE_LINES)
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(owner[part])), pa.array(line_no[part].astype(np.int32)), pa.array(good[part]),
                        pa.array(good[part] >= threshold)], names=["doc_id", "line_no", "probability", "good"])

    return run


def label_lines(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], threshold: float = 0.5) -> DataFrame:
    """Per line of every document: doc_id, line_no from 0, probability of being good, label."""
    given = docs.select("doc_id", "text")
    id_type = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(_label(*model, threshold), f"doc_id {id_type}, line_no int, probability double, good boolean")


def query(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return score_quality(docs, train(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def _keep(weights: np.ndarray, moves: np.ndarray, threshold: float, text: int):
    score = _score(weights, moves, threshold)

    def run(batches):
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column(text), batch.column(text)], names=["doc_id", "text"])
            predicted = pa.concat_arrays([b.column(2) for b in score([pair])]) if len(pair) else pa.array([], pa.int32())
            yield batch.filter(pc.equal(predicted, 1))

    return run


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts, fitted on the labels of these documents."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.mapInArrow(_keep(*model, THRESHOLD, docs.columns.index("text")), docs.schema)

"""Benchmark decontamination with a positional inverted index.

``build_index`` cuts the training documents into blocks and writes one index segment per
block: for every term of the block its ascending positions, and the lengths of its
documents. Segments are made and searched where their documents are, so no posting is
shuffled, and a lost executor rebuilds its own segments only.

``search`` takes windows of consecutive test words. The number of postings of each test
term over all segments orders a window's terms from the rarest. In each segment the rarest
term's positions give the candidate places; the lists of the other terms, adjusted by their
offsets in the window, are intersected with them one after another. Exact places are
phrase matches; a place is a proximity match when every term stands within ``slack`` words
of where the phrase would have it, counted from the rarest term.

Test windows travel to the tasks in slices of a bounded size; a larger benchmark takes more
passes over the index, never a larger broadcast.

Defined cases: a null or wordless document has no words and no hits; a null or wordless
item has no windows; a null item_id counts as the empty one; items of one id count once.
Repeated documents each get their own row. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlab.llm.columns import keyed_rows
from basketlab.llm.words import ALPHANUMERIC, freed, slices, split_words, word_hashes
from basketlab.operators.joins import lookup_join
from basketlab.operators.staging import arrow_batches, stage

WINDOW = 10
SLACK = 3
BLOCK_BYTES = 1 << 20
MAX_SLICE_BYTES = 4 << 20
#: Rows of an Arrow batch: documents, and segments of ``BLOCK_BYTES``.
DOCUMENT_ROWS = 500
SEGMENT_ROWS = 2
CANDIDATES_AT_ONCE = 2_000_000


def _segment(block: int, ids: pa.Array, texts: pa.Array, gap: int) -> pa.RecordBatch:
    """The index segment of one block's documents; its working arrays are gone when the next block begins."""
    offsets, codes, vocabulary = split_words(texts, ALPHANUMERIC)
    lengths = np.diff(offsets)
    hashes = word_hashes(vocabulary)
    rank = np.empty(len(hashes), np.int64)
    by_hash = np.argsort(hashes)
    rank[by_hash] = np.arange(len(hashes))
    terms = rank[codes].astype(np.int32)
    order = np.argsort(terms, kind="stable")
    places = np.arange(len(codes)) + np.repeat(np.arange(len(lengths)) * gap, lengths)
    ends = np.cumsum(np.bincount(terms, minlength=len(hashes)))
    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()),
        pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        pa.array([lengths.tolist()], pa.list_(pa.int64())),
        pa.array([hashes[by_hash].tobytes()], pa.binary()),
        pa.array([ends.astype("<u4").tobytes()], pa.binary()),
        pa.array([places[order].astype("<u4").tobytes()], pa.binary()),
    ], names=["block", "doc_ids", "lengths", "terms", "ends", "places"])


def _segments(gap: int):
    def run(batches):
        number = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start, stop in slices(texts, BLOCK_BYTES):
                size = stop - start
                yield _segment((TaskContext.get().partitionId() << 32) + number, ids.slice(start, size), texts.slice(start, size), gap)
                number += 1

    return run


def build_index(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, slack: int = SLACK
) -> DataFrame:
    """Index segments of the documents, written in the shared folder.

    Documents of a block stand ``window + slack`` places apart, so no match crosses them.
    """
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    schema = f"block long, doc_ids array<{id_type}>, lengths array<bigint>, terms binary, ends binary, places binary"
    with arrow_batches(docs.sparkSession, DOCUMENT_ROWS):
        return stage(given.mapInArrow(freed(_segments(window + slack)), schema), "index_segments")


@dataclass
class Tests:
    """Windows over distinct test terms: row w of ``words`` has ``sizes[w]`` term numbers."""

    terms: np.ndarray
    words: np.ndarray
    sizes: np.ndarray
    items: np.ndarray
    names: list[str]


def test_windows(rows: list, window: int) -> Tests:
    """Windows of (item_id, text) rows; equal windows of one item are one."""
    offsets, codes, vocabulary = split_words(pa.array([r[1] for r in rows], pa.large_string()), ALPHANUMERIC)
    names = sorted({"" if r[0] is None else str(r[0]) for r in rows})
    number = {name: i for i, name in enumerate(names)}
    found = set()
    for row, start, stop in zip(rows, offsets[:-1].tolist(), offsets[1:].tolist()):
        item = number["" if row[0] is None else str(row[0])]
        words = codes[start:stop].tolist()
        if words:
            found |= {(item, *words[i:i + window]) for i in range(max(1, len(words) - window + 1))}
    listed = sorted(found)
    words = np.zeros((len(listed), window), np.int64)
    for i, row in enumerate(listed):
        words[i, :len(row) - 1] = row[1:]
    return Tests(word_hashes(vocabulary), words, np.array([len(r) - 1 for r in listed], np.int64),
                 np.array([r[0] for r in listed], np.int64), names)


def _lookup(terms: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted term among the sorted terms, or -1."""
    if not len(terms):
        return np.full(len(wanted), -1)
    place = np.minimum(np.searchsorted(terms, wanted), len(terms) - 1)
    return np.where(terms[place] == wanted, place, -1)


def _term_counts(wanted: np.ndarray):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                terms, ends = (batch.column(k)[i].as_py() for k in range(2))
                at = _lookup(np.frombuffer(terms, "<u8"), wanted)
                counts = np.diff(np.frombuffer(ends, "<u4").astype(np.int64), prepend=0)
                here = np.flatnonzero(at >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here), pa.array(counts[at[here]])], names=["term", "postings"])

    return run


def find_windows(tests: Tests, order: np.ndarray, terms, ends, places, slack: int):
    """(window, start, exact) of all proximity matches of a segment."""
    at = _lookup(terms, tests.terms)
    inside = np.arange(tests.words.shape[1]) < tests.sizes[:, None]
    live = np.flatnonzero(((at[tests.words] >= 0) | ~inside).all(axis=1))
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    used = np.unique(at[tests.words[live]][inside[live]])
    spans = [(int(begins[t]), int(ends[t])) for t in used]
    keys = np.concatenate([places[a:b] + (k << 32) for k, (a, b) in enumerate(spans)]) if spans else np.zeros(0, np.int64)
    heads = np.concatenate([[0], np.cumsum([b - a for a, b in spans])]).astype(np.int64)
    slot = np.zeros(len(terms) + 1, np.int64)
    slot[used] = np.arange(len(used))
    anchors = slot[at[tests.words[live, order[live, 0]]]]
    sizes = heads[anchors + 1] - heads[anchors]
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(CANDIDATES_AT_ONCE, sizes.sum() + 1, CANDIDATES_AT_ONCE)) + 1
    for part in np.split(np.arange(len(live)), np.unique(cuts)):
        if not len(part):
            continue
        count = sizes[part]
        window = np.repeat(live[part], count)
        inner = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        place = keys[np.repeat(heads[anchors[part]], count) + inner] & 0xFFFFFFFF
        start = place - np.repeat(order[live[part], 0], count)
        exact = np.ones(len(start), bool)
        for k in range(1, tests.words.shape[1]):
            more = tests.sizes[window] > k
            offset = order[window, k]
            key = (slot[at[tests.words[window, offset]]] << 32) + start + offset
            near = np.searchsorted(keys, key - slack)
            good = ~more | ((near < len(keys)) & (keys[np.minimum(near, len(keys) - 1)] <= key + slack))
            same = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            exact &= ~more | (keys[same] == key)
            window, start, exact = window[good], start[good], exact[good]
        yield window, start, exact


def _matches(tests: Tests, order: np.ndarray, gap: int, slack: int):
    """Per matched document of a segment: merged runs of hit words, items matched exactly and nearly."""

    def run(batches):
        names = ["block", "place", "begins", "ends", "items", "near_items"]
        for batch in batches:
            for i in range(batch.num_rows):  # one segment at a time: they are large
                row = {name: batch.column(name)[i].as_py() for name in ("block", "lengths", "terms", "ends", "places")}
                lengths = np.array(row["lengths"], np.int64)
                first = np.cumsum(lengths) - lengths + np.arange(len(lengths)) * gap
                parts = find_windows(
                    tests, order, np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["ends"], "<u4").astype(np.int64),
                    np.frombuffer(row["places"], "<u4").astype(np.int64), slack)
                found = [part for part in parts if len(part[0])]
                if not found:
                    continue
                window, start, exact = map(np.concatenate, zip(*found))
                anchor = start + order[window, 0]
                doc = np.searchsorted(first, anchor, side="right") - 1
                covered = np.zeros(int(first[-1] + lengths[-1]) + gap + 1, np.int64)
                np.add.at(covered, start[exact], 1)
                np.add.at(covered, start[exact] + tests.sizes[window[exact]], -1)
                hit = np.diff((np.cumsum(covered) > 0).astype(np.int8), prepend=0)
                begins, ends = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
                run_doc = np.searchsorted(first, begins, side="right") - 1
                pairs = np.unique(np.stack([doc, tests.items[window], exact.astype(np.int64)]), axis=1)
                out = []
                for d in np.unique(doc).tolist():
                    own, mine = pairs[:, pairs[0] == d], run_doc == d
                    out.append((row["block"], d, (begins[mine] - first[d]).tolist(), (ends[mine] - first[d]).tolist(),
                                [tests.names[i] for i in own[1][own[2] == 1]], [tests.names[i] for i in np.unique(own[1])]))
                cells = zip(names, zip(*out), (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                                               pa.list_(pa.string()), pa.list_(pa.string())))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for _, c, t in cells], names=names)

    return run


MATCH_SCHEMA = ("block long, place long, begins array<bigint>, ends array<bigint>, "
                "items array<string>, near_items array<string>")


def _slice_matches(index: DataFrame, rows: list, window: int, slack: int) -> DataFrame | None:
    tests = test_windows(rows, window)
    if not len(tests.words):
        return None
    counted = index.select("terms", "ends").mapInArrow(freed(_term_counts(tests.terms)), "term long, postings long")
    postings = np.zeros(len(tests.terms), np.int64)
    with arrow_batches(index.sparkSession, SEGMENT_ROWS):
        for r in counted.groupBy("term").agg(F.sum("postings").alias("n")).collect():
            postings[r["term"]] = r["n"]
    inside = np.arange(tests.words.shape[1]) < tests.sizes[:, None]
    rarity = np.where(inside, postings[tests.words], np.iinfo(np.int64).max)
    order = np.argsort(rarity, axis=1, kind="stable")
    return index.drop("doc_ids").mapInArrow(freed(_matches(tests, order, window + slack, slack)), MATCH_SCHEMA)


def search(index: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
           window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """Per indexed document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, near_items."""
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    items = stage(items.distinct(), "benchmark_items")  # a repeated item would put all its copies in one slice
    size = items.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32)).first()[0] or 0
    n_slices = max(1, math.ceil(size / MAX_SLICE_BYTES))
    found = None
    for k in range(n_slices):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_slices)) == k).collect()
        matched = _slice_matches(index, part, window, slack)
        if matched is not None:
            found = matched if found is None else found.unionByName(matched)
    rows = index.select("block", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("place", "doc")).select(
        "block", F.col("place").cast("long").alias("place"), F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.lengths").alias("n_words"))
    if found is None:
        found = index.limit(0).mapInArrow(lambda batches: iter(()), MATCH_SCHEMA)
    with arrow_batches(index.sparkSession, SEGMENT_ROWS):
        found = stage(found, "matches")

    # Runs of different slices may overlap: each adds what lies behind the farthest end before it.
    runs = found.select("block", "place", F.explode(F.arrays_zip("begins", "ends")).alias("run")).select(
        "block", "place", F.col("run.begins").alias("begin"), F.col("run.ends").alias("end"))
    before = Window.partitionBy("block", "place").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.coalesce(F.max("end").over(before), F.lit(0)), "begin")
    hits = runs.withColumn("new", F.greatest(F.col("end") - reached, F.lit(0))).groupBy("block", "place").agg(
        F.sum("new").alias("n_hit"))
    listed = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    names = found.groupBy("block", "place").agg(listed("items").alias("items"), listed("near_items").alias("near_items"))
    none = F.array().cast("array<string>")
    joined = rows.join(hits, ["block", "place"], "left").join(names, ["block", "place"], "left")
    filled = joined.withColumn("items", F.coalesce("items", none)).withColumn("near_items", F.coalesce("near_items", none))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return filled.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        "items", "near_items",
    )


def query(spark, folder: str) -> DataFrame:
    index = build_index(spark.read.parquet(f"{folder}/documents.parquet"))
    found = search(index, spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.drop("items", "near_items")


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text has no benchmark window."""
    rows, key = keyed_rows(docs, "decontamination_rows")
    found = search(build_index(rows, key), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = stage(found.filter("contaminated").select(F.col("doc_id").alias(key)), "contaminated_rows")
    return lookup_join(rows, hit, [key], "left_anti", hot=[]).select(*[f"`{c}`" for c in docs.columns])


ORACLE_SQL = """
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
docs AS (
  SELECT doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM lowered),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item_id, least(10, len(words)) AS size, array_to_string(words[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM items WHERE len(words) > 0)),
placed AS MATERIALIZED (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs),
sizes AS (SELECT DISTINCT size FROM windows),
phrases AS (
  SELECT doc_id, i, size, string_agg(word, ' ') OVER (
    PARTITION BY doc_id, size ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS phrase
  FROM placed, sizes WHERE size = 10
  UNION ALL
  SELECT p.doc_id, p.i, s.size, string_agg(q.word, ' ' ORDER BY q.i)
  FROM placed p, sizes s, placed q
  WHERE s.size < 10 AND q.doc_id = p.doc_id AND q.i >= p.i AND q.i < p.i + s.size GROUP BY ALL),
found AS MATERIALIZED (
  SELECT doc_id, i, p.size, item_id FROM phrases p JOIN windows w ON p.phrase = w.phrase AND p.size = w.size),
hits AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, range(10) offsets(k) WHERE k < size GROUP BY doc_id),
names AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS listed
  FROM found GROUP BY doc_id)
SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN names n ON d.doc_id = n.doc_id
"""

"""N-gram Jaccard join: documents whose word n-gram sets reach a similarity, as components.

The sets are the rows of a sparse incidence matrix A (document by n-gram) and the links are
cells of A times its transpose. Most cells are never formed, by bounds that follow from
the sizes of the sets alone and lose no link:

* Documents with equal sets are one row, a *class*. A set of n n-grams misses at most
  n - ceil(t * n) of them in any partner. So in any fixed order of all columns, two similar
  rows share one of the first n - ceil(t * n) + 1 columns of each (the *prefix*).
* The order used puts rare columns first. Counting all columns would shuffle the whole
  corpus, so the columns with a hash divisible by a small number are counted exactly and
  come first, ordered by count; the rest follow by hash. Columns of one row only cannot
  meet a partner, and a row with more of them than it may miss has no partner at all. For the
  few rows left, all columns are then counted among themselves and the prefixes drawn again.
* Cells are formed from the prefix column by column, where the sizes and the places of the
  column in both orders leave enough columns to reach t. A pair's overlap is then accumulated
  over blocks of columns and the pair leaves as soon as the columns left cannot bring it to
  its bound.

A group of n similar rows never lists its n * n pairs. First each row of a prefix column
meets the leader of its size band, the row with the most common columns. The components of
these links are found, and in a second pass a column lists only pairs of rows from different
components, starting from rows outside the column's largest component. Pairs inside a component cannot change it, so
the components equal those of the full product.

Defined cases: null text or text without words: an empty set, linked with nothing. Fewer
words than n: the whole sequence is the one n-gram. Repeated rows are copies of each other.
Other columns are not read. Row hashes have 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlab.llm.columns import id_key, keyed_rows
from basketlab.llm.components import components
from basketlab.llm.words import SPACED, freed, gram_hashes, pack_sorted, slices, split_words, unpack_sorted, word_hashes
from basketlab.operators.joins import fits_broadcast, lookup_join
from basketlab.operators.staging import arrow_batches, stage

#: The contract of the query.
NGRAM = 3
PERCENT = 90
#: Stages on word shingles: five words and a similarity of 0.8.
STAGE_NGRAM = 5
STAGE_PERCENT = 80
#: Text that becomes sets at once, and bytes of sets whose columns are asked for together.
BLOCK_BYTES = 2 << 20
HELD_BYTES = 12 << 20
#: Documents, classes or pairs of one batch.
BATCH_ROWS = 500
COLUMN_BLOCKS = 8
MAX_ID_BYTES = 32 << 20


def _ceil_share(sizes, percent: int):
    return -(-(sizes * percent) // 100)


def document_sets(texts: pa.Array, ngram: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    offsets, codes, vocabulary = split_words(texts, SPACED)
    hashes = word_hashes(vocabulary)[codes] if len(codes) else np.zeros(0, np.uint64)
    grams = gram_hashes(hashes, ngram)
    found = []
    for start, stop in zip(offsets[:-1], offsets[1:]):
        count = stop - start
        if count >= ngram:
            found.append(np.unique(grams[start:stop - ngram + 1]))
        elif count:
            found.append(gram_hashes(hashes[start:stop], int(count)))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def _class_of(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).view(np.int64))


REQUESTS = {"part": pa.int32(), "grams": pa.binary(), "owners": pa.binary(), "classes": pa.binary(),
            "sizes": pa.binary(), "counted": pa.binary()}
REQUEST_SCHEMA = "part int, grams binary, owners binary, classes binary, sizes binary, counted binary"


def _find(ngram: int, percent: int, every: int, parts: int):
    """Rows of two kinds: one per document (no grams), and the columns to count, dealt by hash range."""

    def run(batches):
        held, size, id_type = {}, 0, None
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            id_type = ids.type
            for start, stop in slices(texts, BLOCK_BYTES):
                sets = document_sets(texts.slice(start, stop - start), ngram)
                names = [_class_of(s) if len(s) else None for s in sets]
                rows = stop - start
                none = pa.nulls(rows, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, rows), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()),
                     pa.nulls(rows, pa.int32()), none, none, none, none, none], names=columns)
                held.update({k: s for k, s in zip(names, sets) if k is not None})
                size += sum(s.nbytes for s in sets)
                if size >= HELD_BYTES:
                    yield from _requests(held, id_type)
                    held, size = {}, 0
        yield from _requests(held, id_type)

    columns = ["doc_id", "n", "class", *REQUESTS]

    def _requests(classes: dict, id_type):
        rows = request_rows(classes, percent, every, parts)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(rows), id_type), pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64()),
                 *[pa.array(c, t) for c, t in zip(zip(*rows), REQUESTS.values())]], names=columns)

    return run


def request_rows(classes: dict[int, np.ndarray], percent: int, every: int, parts: int) -> list[tuple]:
    """The columns to count of some classes, one row per hash range."""
    if not classes:
        return []
    span = (1 << 64) // parts + 1
    sizes = np.array([len(s) for s in classes.values()], np.int64)
    kept, counts = [], []
    for grams, room in zip(classes.values(), sizes - _ceil_share(sizes, percent) + 1):
        counted = grams % np.uint64(every) == 0
        rare = grams[counted]
        counts.append(len(rare))
        # Too few counted columns to fill the prefix: the next columns in hash order.
        kept.append(rare if len(rare) >= room else np.concatenate([rare, grams[~counted][:room - len(rare)]]))
    grams = np.concatenate(kept)
    owners = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
    order = np.argsort(grams, kind="stable")
    grams, owners = grams[order], owners[order].astype("<u4")
    edges = [min(span * k, (1 << 64) - 1) for k in range(1, parts)]
    cuts = np.concatenate([[0], np.searchsorted(grams, np.array(edges, np.uint64)), [len(grams)]])
    table = [np.fromiter(classes, np.int64, len(classes)), sizes, np.array(counts, np.int64)]
    rows = []
    for part, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            used, local = np.unique(owners[a:b], return_inverse=True)
            rows.append((part, pack_sorted(grams[a:b]), local.astype("<u4").tobytes(),
                         *[t[used].astype(f"<i{w}").tobytes() for t, w in zip(table, (8, 4, 4))]))
    return rows


def _recount(percent: int, parts: int):
    """Requests of the classes left, for all their columns."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                some = batch.slice(start, BATCH_ROWS)
                classes = {k: np.frombuffer(g, "<u8") for k, g in zip(*(some.column(i).to_pylist() for i in range(2)))}
                rows = request_rows(classes, percent, 1, parts)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), REQUESTS.values())], names=list(REQUESTS))

    return run


SHARED_SCHEMA = "bucket int, class binary, size binary, counted binary, gram binary, rows binary"


def _share(buckets: int):
    """Columns of one hash range: those that two or more classes sent, with the number of classes."""

    def run(table: pa.Table) -> pa.Table:
        grams, names, sizes, counted = [], [], [], []
        for row in table.select(["grams", "owners", "classes", "sizes", "counted"]).to_pylist():
            owners = np.frombuffer(row["owners"], "<u4")
            grams.append(unpack_sorted(row["grams"]))
            names.append(np.frombuffer(row["classes"], "<i8")[owners])
            sizes.append(np.frombuffer(row["sizes"], "<i4")[owners])
            counted.append(np.frombuffer(row["counted"], "<i4")[owners])
        grams, names, sizes, counted = map(np.concatenate, (grams, names, sizes, counted))
        order = np.lexsort((names, grams))
        grams, names = grams[order], names[order]
        first = np.ones(len(grams), bool)
        first[1:] = (grams[1:] != grams[:-1]) | (names[1:] != names[:-1])
        order, grams, names = order[first], grams[first], names[first]
        heads = np.ones(len(grams), bool)
        heads[1:] = grams[1:] != grams[:-1]
        column = np.cumsum(heads) - 1
        rows = np.bincount(column)[column] if len(column) else column
        shared = np.flatnonzero(rows >= 2)
        shared = shared[np.argsort(names[shared] % buckets, kind="stable")]
        bucket = names[shared] % buckets
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else []
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            at = shared[a:b]
            out.append((int(bucket[a]), names[at].tobytes(), sizes[order[at]].tobytes(), counted[order[at]].tobytes(),
                        grams[at].tobytes(), rows[at].astype("<i8").tobytes()))
        cells = list(zip(*out)) if out else [[]] * 6
        return pa.table({name: pa.array(cell, pa.int32() if name == "bucket" else pa.binary()) for name, cell in zip(
            ["bucket", "class", "size", "counted", "gram", "rows"], cells)})

    return run


PREFIX = ("gram", "class", "n", "place", "alone", "weight")
PREFIX_SCHEMA = ", ".join(f"{c} long" for c in PREFIX)


def _prefixes(percent: int, every: int):
    """Prefix columns of the classes of one bucket that may have a partner.

    ``place`` is the column's place in the class's order, ``alone`` the number of its columns
    that no other class has, ``weight`` how common its columns are on average.
    """

    def run(table: pa.Table) -> pa.Table:
        types = {"class": "<i8", "size": "<i4", "counted": "<i4", "gram": "<u8", "rows": "<i8"}
        cells = {k: np.concatenate([np.frombuffer(x, t) for x in table.column(k).to_pylist()]) for k, t in types.items()}
        later = cells["gram"] % np.uint64(every) != 0
        order = np.lexsort((cells["gram"], cells["rows"], later, cells["class"]))
        names, sizes, counted, grams = (cells[k][order] for k in ("class", "size", "counted", "gram"))
        later = later[order]
        heads = np.flatnonzero(np.diff(names, prepend=names[0] - 1 if len(names) else 0)) if len(names) else np.zeros(0, int)
        length = np.diff(np.append(heads, len(names)))
        rank = np.arange(len(names)) - np.repeat(heads, length)
        shared = np.repeat(np.add.reduceat(~later, heads) if len(heads) else length, length)
        room = sizes.astype(np.int64) - _ceil_share(sizes.astype(np.int64), percent) + 1
        alone = counted - shared
        keep = (alone < room) & (later | (alone + rank < room))
        common = np.repeat(np.add.reduceat(cells["rows"][order], heads), length) if len(heads) else length
        weight = 1000 * common // np.maximum(counted, 1)
        cells = (grams.view(np.int64), names, sizes, np.where(later, counted, alone + rank), alone, weight)
        return pa.table({k: c[keep].astype(np.int64) for k, c in zip(PREFIX, cells)})

    return run


def overlap(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Common values of two sorted sets, summed over blocks of columns; -1 once ``need`` is out of reach."""
    total = 0
    for k in range(COLUMN_BLOCKS):
        low = np.uint64(k * ((1 << 64) // COLUMN_BLOCKS))
        (i, j), (p, q) = ((np.searchsorted(x, low), len(x) if k == COLUMN_BLOCKS - 1 else np.searchsorted(
            x, low + np.uint64((1 << 64) // COLUMN_BLOCKS))) for x in (a, b))
        if j > i and q > p:
            place = np.searchsorted(b[p:q], a[i:j])
            place[place == q - p] = 0
            total += int(np.count_nonzero(b[p:q][place] == a[i:j]))
        if total + min(len(a) - j, len(b) - q) < need:
            return -1
    return total


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            a, b, left, right = (batch.column(k).to_pylist() for k in range(4))
            good = []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                good.append(overlap(x, y, -(-percent * (len(x) + len(y)) // (100 + percent))) >= 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _sets(ngram: int):
    def run(batches):
        for batch in batches:
            for start, stop in slices(batch.column(0), BLOCK_BYTES):
                sets = [s for s in document_sets(batch.column(0).slice(start, stop - start), ngram) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["class", "grams"])

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("class").alias("a"), F.col("grams").alias("left"))
    right = sets.select(F.col("class").alias("b"), F.col("grams").alias("right"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return rows.mapInArrow(freed(_verify(percent)), "a long, b long")


def _reaches(percent: int, left_a: str, left_b: str):
    """Whether two rows whose common columns are among the last ``left`` of each can reach the similarity."""
    need = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    return F.least(F.expr(left_a), F.expr(left_b)) >= need


def _leader_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """Every row of a column with the leader of its size band: the row with the most common columns.

    Copies of one text with different changes are closer to it than to each other, and
    its columns are the common ones.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")
    placed = prefix.withColumn("band", band)
    leaders = placed.groupBy("gram", "band").agg(F.max(F.struct("weight", "class", "n", "alone")).alias("leader")).select(
        "gram", "band", F.col("leader.class").alias("a"), F.col("leader.n").alias("n_a"), F.col("leader.alone").alias("alone_a"))
    members = placed.select("gram", "band", F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("alone").alias("alone_b"))
    met = members.join(leaders, ["gram", "band"])
    return met.filter((F.col("a") != F.col("b")) & _reaches(percent, "n_a - alone_a", "n_b - alone_b")).select("a", "b").distinct()


def _other_pairs(prefix: DataFrame, found: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Pairs of a column from different components, each listed once and not tried before."""
    component = F.coalesce("component", "class")
    rows = prefix.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "gram", "class", "n", "place", component.alias("component"))
    rows = stage(rows, "prefix_components")
    largest = rows.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("k")).groupBy("gram").agg(
        F.max(F.struct("k", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("kinds"))
    mixed = rows.join(largest.filter("kinds > 1").drop("kinds"), "gram")
    one, two = ([F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("place").alias(f"place_{x}"),
                 F.col("component").alias(f"component_{x}")] for x in "ab")
    minor = mixed.filter("component <> largest").select("gram", *one)
    every = mixed.select("gram", *two, "largest")
    once = (F.col("component_b") == F.col("largest")) | (F.col("a") < F.col("b"))
    # At a pair's first common column no earlier column of either row is common.
    met = minor.join(every, "gram").filter(
        (F.col("component_a") != F.col("component_b")) & once & _reaches(percent, "n_a - place_a", "n_b - place_b"))
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")


def _counted_prefix(requests: DataFrame, parts: int, percent: int, every: int, name: str) -> DataFrame:
    shared = requests.groupBy("part").applyInArrow(_share(parts), SHARED_SCHEMA)
    return stage(shared.groupBy("bucket").applyInArrow(_prefixes(percent, every), PREFIX_SCHEMA), name)


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ngram: int = NGRAM, percent: int = PERCENT,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``.

    Documents link when 100 * intersection >= percent * union of their sets of n-grams.
    ``component_id`` is the smallest id that links reach.
    """
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return _grouped(docs, doc_id, text, ngram, percent)


def _grouped(docs: DataFrame, doc_id: str, text: str, ngram: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, int(100 / (2.5 * max(1, 100 - percent))))
    given = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    found = stage(given.mapInArrow(freed(_find(ngram, percent, every, parts)), f"doc_id {id_type}, n long, class long, {REQUEST_SCHEMA}"), "gram_sets")
    rows = found.filter("grams IS NULL").select("doc_id", "n", "class")
    requests = found.filter("grams IS NOT NULL").drop("doc_id", "n", "class")

    prefix = _counted_prefix(requests, parts, percent, every, "prefix")

    # The sets of classes that may have a partner, from one text each.
    wanted = prefix.select("class").distinct()
    chosen = rows.join(wanted, "class").groupBy("class").agg(F.min(id_key("doc_id")).alias("key")).select("key").distinct()
    chosen = stage(chosen, "class_ids")
    chosen = F.broadcast(chosen) if fits_broadcast(chosen, MAX_ID_BYTES) else chosen
    texts = given.withColumn("key", id_key("doc_id")).join(chosen, "key", "left_semi").select("text")
    sets = stage(texts.mapInArrow(freed(_sets(ngram)), "class long, grams binary").dropDuplicates(["class"]), "class_sets")
    # Few rows are left: now all their columns are counted, among these rows.
    recounted = sets.mapInArrow(freed(_recount(percent, parts)), REQUEST_SCHEMA)
    prefix = _counted_prefix(recounted, parts, percent, 1, "exact_prefix")

    first = stage(_leader_pairs(prefix, percent), "leader_pairs")
    links = stage(_links(first, sets, percent), "leader_links")
    second = _other_pairs(prefix, components(links), first, percent)
    links = links.unionByName(_links(second, sets, percent))
    groups = components(links).withColumnRenamed("node", "class")

    classes = rows.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    grouped = classes.join(groups, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stage(grouped.join(least, "component").select("class", "component_id"), "class_components")
    return rows.join(named, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def query(spark, folder: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{folder}/documents.parquet"))


def keep_one_per_group(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component: the one with the smallest id, null ids last; of rows with one id, the first."""
    rows, key = keyed_rows(docs, "jaccard_rows")
    groups = jaccard_components(rows, key, ngram=STAGE_NGRAM, percent=STAGE_PERCENT)
    groups = stage(groups.select(F.col("doc_id").alias(key), F.col("component_id").alias("component")), "row_groups")
    several = groups.groupBy("component").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("component")
    members = groups.join(several, "component").join(rows.select(key, F.col("doc_id").alias("id")), key)
    members = stage(members.select("component", key, F.struct(F.col("id").isNull(), "id", key).alias("place")), "group_rows")
    first = members.groupBy("component").agg(F.min("place")[key].alias("stays"))
    gone = stage(members.join(first, "component").filter(F.col(key) != F.col("stays")).select(key), "copies")
    return lookup_join(rows, gone, [key], "left_anti", hot=[]).select(*[f"`{c}`" for c in docs.columns])


#: Links of the full product and their closure, without any bound.
ORACLE_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS words
  FROM documents),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS k FROM split),
runs AS (
  SELECT doc_id, i, k, word || ' ' || lead(word, 1) OVER w || ' ' || lead(word, 2) OVER w AS three
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, three AS shingle FROM runs WHERE three IS NOT NULL
  UNION ALL
  SELECT doc_id, array_to_string(words, ' ') FROM split WHERE len(words) IN (1, 2)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT x, y FROM shared JOIN sizes s ON x = s.doc_id JOIN sizes t ON y = t.doc_id
  WHERE 100 * common >= 90 * (s.n + t.n - common)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(start, doc_id) AS (
  SELECT doc_id, doc_id FROM split
  UNION
  SELECT r.start, b.y FROM reached r JOIN both_ways b ON r.doc_id = b.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.component_id
FROM split d LEFT JOIN sizes s ON d.doc_id = s.doc_id
JOIN (SELECT start AS doc_id, min(doc_id) AS component_id FROM reached GROUP BY start) m ON d.doc_id = m.doc_id
"""

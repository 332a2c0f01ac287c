"""Prefix trie of conversations that are rebuilt from a base's head and their own rest.

Every conversation c takes the first h turns of a base (``c - c % 20``; h is crc32 of the
decimal id, modulo 4) and then its own turns after its first h. Rebuilt texts are never
written. A sequence of turns has a fingerprint in a monoid: its length and, for three primes,
the sum of value(turn i) * A^i. Products compose: head and rest give
``F_base(h') + A^(h' - h) * (F_own(k) - F_own(h))``, so the fingerprint of each rebuilt
prefix comes from prefix sums over the stored turns alone.

Prefixes meet in groups of equal depth and fingerprint, and each group is verified: all
members must have the same last turn (turns of one key are compared as stored) and the same
parent group, which by induction makes their sequences equal. A group that fails starts
over with other values, so results are exact.

A conversation may hold any share of all rows. Turns are dealt by range, prefix sums are
taken per share and then carried over shares; joins to a conversation's properties split hot
ids. Subtree sums need no walk: a node belongs to its smallest member, a conversation's own
nodes are the end of its path, and a subtree is the own nodes of its members less the
head of its owner's chain. Ids that end at one node are hashed as a stream of bounded chunks,
in order, by one task per node, as the one digest asks for; memory does not grow with them.

Defined cases: null role and text are empty; rows without a conversation id belong to none and are
left out. Turns are ordered by number, null first, then md5 of role and text; repeated
rows are turns each. A conversation may have no rebuilt turns: it is a member of the root
alone. No conversations give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlab.operators.joins import hot_keys, lookup_join
from basketlab.operators.staging import stage

FAMILY = 20
HEAD = 3
PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587)
SEEDS = 8
CHAIN_BLOCK = 1 << 16
CHUNK_IDS = 4096
WORD = "[^\\x20\\x09-\\x0D]+"
NODE = ["depth", "a", "b"]


class Collision(Exception):
    """Two different sequences shared a fingerprint."""


def _bases(seed: int) -> list[int]:
    """One multiplier per prime for this attempt."""
    return [int.from_bytes(hashlib.sha256(f"{seed}:{p}".encode()).digest()[:8]) % (p - 3) + 2 for p in PRIMES]


def _turn_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "role", "text")


def _power(base: int, exponent: Column, p: int) -> Column:
    """base^exponent modulo p for exponents below 2^31, from the bits of the exponent."""
    total = F.lit(1).cast("long")
    for bit in range(31):
        on = exponent.bitwiseAND(F.lit(1 << bit)) != 0
        total = F.when(on, total * F.lit(pow(base, 1 << bit, p)) % F.lit(p)).otherwise(total) if bit == 0 else (
            total * F.when(on, F.lit(pow(base, 1 << bit, p))).otherwise(F.lit(1)) % F.lit(p))
    return total


def _before(shares: DataFrame, sums: list[str]) -> DataFrame:
    """What a conversation's earlier shares hold, for conversations in several shares: at most two rows per share."""
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = F.count(F.lit(1)).over(Window.partitionBy("conv_id"))
    carried = shares.select(
        "conv_id", "part", parts.alias("parts"), *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in sums])
    return F.broadcast(carried.filter("parts > 1").drop("parts"))


def _stored_turns(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns in order: share, place in all shares, role, text and number of words."""
    rows = turns.select(
        F.col(conversation).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    ).filter(F.col("conv_id").isNotNull())
    rows = rows.withColumn("tie", F.concat(F.md5("role"), F.md5("text"))).withColumn("row", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "tie", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(placed.select(
        "conv_id", "role", "text", F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("ref")), "trie_turns")


def _hashed_turns(stored: DataFrame, seed: int) -> DataFrame:
    """Per stored turn: position, key, words and for each prime the prefix sum with it and without it."""
    share = Window.partitionBy("conv_id", "part")
    keyed = stored.select("conv_id", "part", "ref", "words", _turn_key(seed).alias("key"))
    shares = keyed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    inner = F.row_number().over(share.orderBy("ref")) - 1
    numbered = keyed.withColumn("inner", inner).join(_before(shares, ["n"]), ["conv_id", "part"], "left").withColumn(
        "pos", F.col("inner") + F.coalesce("n_before", F.lit(0))).drop("inner", "n_before")
    for i, (p, base) in enumerate(zip(PRIMES, _bases(seed))):
        value = F.pmod(F.xxhash64("key", F.lit(i)), F.lit(p - 1)) + 1
        numbered = numbered.withColumn(f"t{i}", value * _power(base, F.col("pos"), p) % F.lit(p))
    places = range(len(PRIMES))
    so_far = share.orderBy("ref").rowsBetween(Window.unboundedPreceding, 0)
    local = stage(numbered.select("*", *[F.sum(f"t{i}").over(so_far).alias(f"s{i}") for i in places]), "trie_hashed")
    totals = local.groupBy("conv_id", "part").agg(*[F.sum(f"t{i}").alias(f"t{i}") for i in places])
    carried = local.join(_before(totals, [f"t{i}" for i in places]), ["conv_id", "part"], "left")
    for i, p in enumerate(PRIMES):
        with_it = F.col(f"s{i}") + F.coalesce(f"t{i}_before", F.lit(0))
        carried = carried.withColumn(f"f{i}", with_it % F.lit(p)).withColumn(f"e{i}", (with_it - F.col(f"t{i}")) % F.lit(p))
    return carried.select("conv_id", "pos", "key", "words", *[f"{c}{i}" for c in "fe" for i in places])


def _conversations(hashed: DataFrame) -> DataFrame:
    """One row per conversation: its number of turns, its h, and its first turns."""
    kept = ["key", "words", *[f"f{i}" for i in range(len(PRIMES))]]
    firsts = [F.max(F.when(F.col("pos") == j, F.col(c))).alias(f"{c}_{j}") for j in range(HEAD) for c in kept]
    heads = hashed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), *firsts)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)
    return heads.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)


def _after(prefix: str, i: int, turns: Column) -> Column:
    """The fingerprint after the first ``turns`` (at most HEAD) turns of a conversation."""
    value = F.lit(0).cast("long")
    for j in range(HEAD):
        value = F.when(turns > j, F.col(f"{prefix}f{i}_{j}")).otherwise(value)
    return value


def _packed(values: list[Column]) -> tuple[Column, Column]:
    """The residues in two longs."""
    return values[0] + values[1] * F.lit(1 << 31), values[2]


def _members(hashed: DataFrame, seed: int) -> DataFrame:
    """Every prefix of every rebuilt conversation: conv_id, depth, fingerprint, its parent's, last turn, length."""
    places = range(len(PRIMES))
    convs = stage(_conversations(hashed), "trie_conversations")
    bases = convs.filter(F.col("conv_id") == F.col("base")).select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"),
        *[F.col(f"{c}_{j}").alias(f"base_{c}_{j}") for j in range(HEAD) for c in ("key", "words", *[f"f{i}" for i in places])])
    joined = convs.join(bases, "base", "left").withColumn("hb", F.least("h", F.coalesce("base_n", F.lit(0))))
    length = (F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    own_head = F.least("h", "n")
    info = stage(joined.select(
        "conv_id", "h", "hb", length, *[_after("base_", i, F.col("hb")).alias(f"g{i}") for i in places],
        *[_after("", i, own_head).alias(f"o{i}") for i in places],
        *[F.col(f"base_{c}_{j}") for j in range(HEAD) for c in ("key", "words", *[f"f{i}" for i in places])]), "trie_heads")

    columns = ["conv_id", "depth", "a", "b", "pa", "pb", "key", "words", "length"]

    def shaped(rows: DataFrame, depth: Column, here: list[Column], above: list[Column]) -> DataFrame:
        a, b = _packed(here)
        pa_, pb = _packed(above)
        return rows.select("conv_id", depth.cast("long").alias("depth"), a.alias("a"), b.alias("b"), pa_.alias("pa"), pb.alias("pb"),
                           "key", "words", "length").select(*columns)

    zero = F.lit(0).cast("long")
    root = info.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("pa"), zero.alias("pb"),
                       zero.alias("key"), zero.alias("words"), "length")
    heads = root
    for j in range(HEAD):
        rows = info.filter(F.col("hb") > j).withColumns({"key": F.col(f"base_key_{j}"), "words": F.col(f"base_words_{j}")})
        here = [F.col(f"base_f{i}_{j}") for i in places]
        above = [F.col(f"base_f{i}_{j - 1}") if j else zero for i in places]
        heads = heads.unionByName(shaped(rows, F.lit(j + 1), here, above))

    slim = info.select("conv_id", "h", "hb", "length", *[f"{c}{i}" for c in "go" for i in places])
    rest = lookup_join(hashed, slim, ["conv_id"]).filter(F.col("pos") >= F.col("h"))

    def moved(column: str, i: int) -> Column:
        """Own prefix less the own head, behind the base's head instead."""
        p, base = PRIMES[i], _bases(seed)[i]
        shift = F.lit(1).cast("long")
        for back in range(1, HEAD + 1):
            shift = F.when(F.col("h") - F.col("hb") == back, F.lit(pow(base, -back, p))).otherwise(shift)
        return (F.col(f"g{i}") + F.pmod(F.col(f"{column}{i}") - F.col(f"o{i}"), F.lit(p)) * shift) % F.lit(p)

    depth = F.col("pos") - F.col("h") + F.col("hb") + 1
    own = shaped(rest, depth, [moved("f", i) for i in places], [moved("e", i) for i in places])
    return stage(heads.unionByName(own), "trie_members")


def _verified_turns(stored: DataFrame, seed: int) -> None:
    """All stored turns of one key are equal."""
    said = F.struct("role", "text")
    spans = stored.select(_turn_key(seed).alias("key"), said.alias("said")).groupBy("key").agg(
        F.min("said").alias("low"), F.max("said").alias("high"))
    if spans.filter("low != high").limit(1).count():
        raise Collision(seed)


def _nodes(members: DataFrame) -> DataFrame:
    """Groups of equal prefixes, each verified: one last turn, one parent."""
    same = ["pa", "pb", "key"]
    nodes = stage(members.groupBy(*NODE).agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        *[f(c).alias(f"{c}_{n}") for c in same for f, n in ((F.min, "low"), (F.max, "high"))]), "trie_nodes")
    if nodes.filter(" OR ".join(f"{c}_low != {c}_high" for c in same)).limit(1).count():
        raise Collision("nodes")
    return nodes.select(*NODE, "owner", "n_convs", "words", F.col("pa_low").alias("pa"), F.col("pb_low").alias("pb"))


def _digest_rows(done: list) -> pa.RecordBatch:
    keys = [pa.array([k[i] for k, _ in done], pa.int64()) for i in range(len(NODE))]
    return pa.RecordBatch.from_arrays([*keys, pa.array([d.hexdigest() for _, d in done], pa.string())], names=[*NODE, "ends_sha256"])


def _digests(batches):
    """SHA-256 of the chunks of each node, which arrive in order."""
    node, digest = None, None
    for batch in batches:
        done = []
        for *key, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((node, digest))
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        yield _digest_rows(done)
    if node is not None:
        yield _digest_rows([(node, digest)])


def _ends(members: DataFrame) -> DataFrame:
    """Digest of the ids that end at each node."""
    order = [*NODE, "conv_id"]
    ends = members.filter(F.col("depth") == F.col("length")).select(*order)
    placed = ends.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("part", F.spark_partition_id()), "trie_ends")
    rank = F.row_number().over(Window.partitionBy(*NODE, "part").orderBy("conv_id")) - 1
    chunk = F.floor(rank / CHUNK_IDS)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = placed.withColumn("chunk", chunk).groupBy(*NODE, "part", "chunk").agg(ids.alias("ids"))
    ordered = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "part", "chunk")
    return ordered.select(*NODE, "ids").mapInArrow(_digests, "depth long, a long, b long, ends_sha256 string")


def _chain_sums(nodes: DataFrame) -> DataFrame:
    """Per node: saved words of its owner's nodes above it, in blocks of the chain."""
    saved = nodes.select(*NODE, "owner", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                         F.floor(F.col("depth") / CHAIN_BLOCK).alias("block"))
    above = Window.partitionBy("owner", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("owner").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = saved.groupBy("owner", "block").agg(F.sum("saved").alias("total")).select(
        "owner", "block", F.sum("total").over(earlier).alias("earlier")).filter(F.col("earlier") > 0)
    inner = saved.select(*NODE, "owner", "block", F.coalesce(F.sum("saved").over(above), F.lit(0)).alias("inner"))
    joined = lookup_join(inner, stage(blocks, "trie_blocks"), ["owner", "block"], "left", hot=[])
    return joined.select(*NODE, (F.col("inner") + F.coalesce("earlier", F.lit(0))).alias("above"))


def _attempt(stored: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    _verified_turns(stored, seed)
    members = _members(_hashed_turns(stored, seed), seed)
    return members, _nodes(members)


def prefix_trie(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    stored = _stored_turns(turns, conversation, turn, role, text)
    for seed in range(SEEDS):
        try:
            members, nodes = _attempt(stored, seed)
            break
        except Collision:
            if seed == SEEDS - 1:
                raise
    above = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")]
    children = nodes.filter("depth > 0").select(*above).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    tree = nodes.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    tree = stage(tree, "trie_tree")

    # Each conversation's own nodes: words saved there, and whether its path ends in a leaf of its own.
    own = tree.groupBy(F.col("owner").alias("conv_id")).agg(
        F.sum((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves")).filter("saved != 0 OR leaves != 0")
    shared = lookup_join(members.select(*NODE, "conv_id"), stage(own, "trie_own"), ["conv_id"]).groupBy(*NODE).agg(
        F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))

    parents = tree.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("owner").alias("parent"))
    up = ["depth", "pa", "pb"]
    joined = lookup_join(tree, parents, up, "left", hot=hot_keys(tree, up))
    joined = joined.join(shared, NODE, "left").join(_chain_sums(tree), NODE, "left").join(_ends(members), NODE, "left")
    nothing = hashlib.sha256().hexdigest()
    return joined.select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("leaves", F.lit(0)).alias("n_leaves"),
        (F.coalesce("saved", F.lit(0)) - F.coalesce("above", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


def query(spark, folder: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
    range(1, length(c::VARCHAR) + 1), lambda i: [ascii(substr(c::VARCHAR, i::INT, 1))::BIGINT + 1, 0, 0, 0, 0, 0, 0, 0, 0]))),
    lambda x, e: CASE WHEN e > 0 THEN xor(x, e - 1) ELSE xor(x >> 1, 3988292384 * (x & 1)) END))"""
ORACLE_SQL = rf"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')) || md5(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, {_CRC32} % {HEAD + 1} AS h FROM (SELECT DISTINCT c FROM t)),
rebuilt AS (
  SELECT v.c, 0 AS own, b.pos, b.r, b.x FROM v JOIN t b ON b.c = v.c - v.c % {FAMILY} AND b.pos < v.h
  UNION ALL SELECT v.c, 1, o.pos, o.r, o.x FROM v JOIN t o ON o.c = v.c AND o.pos >= v.h),
path AS (
  SELECT c, row_number() OVER w AS depth, md5(string_agg(md5(r) || md5(x), '') OVER w) AS k,
    len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, pos)),
m AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY depth) AS pk, depth = max(depth) OVER (PARTITION BY c) AS ends
  FROM (SELECT c, 0 AS depth, '' AS k, 0 AS words FROM v UNION ALL SELECT * FROM path)),
nodes AS (
  SELECT depth, k, any_value(pk) AS pk, min(c) AS owner, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM m GROUP BY depth, k),
below AS (SELECT depth - 1 AS depth, pk AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
tree AS (SELECT n.*, coalesce(b.n_children, 0) AS n_children FROM nodes n LEFT JOIN below b USING (depth, k)),
subtree AS (
  SELECT m.depth, m.k, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.words) AS saved
  FROM tree u JOIN m ON m.c = u.owner AND m.depth <= u.depth GROUP BY ALL)
SELECT n.owner AS conv_id, n.depth, p.owner AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
  s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM tree n JOIN subtree s ON s.depth = n.depth AND s.k = n.k LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.k = n.pk
"""

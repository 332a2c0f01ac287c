"""Fuzzy line deduplication: one line stays of each component of similar lines.

All of it is DataFrame operations with built-in functions.

1. Lines are compared in lower case without outer blanks. Equal lines of any length are one key
   (partial minima before the shuffle), whose first place (document, line) is kept.
2. Every distinct line of ``SHINGLE`` characters or more is exploded into character shingles, in code points, by
   their place, so that each one's hash is made in generated code. A hash falls into one
   of ``BANDS`` bins, and per line and bin ``ROWS`` minima under different orders of the hashes
   form the band's key. A short line's bins would hold a shingle or two, too few to tell
   lines apart: all its shingles go into every bin, under another hash in each. Lines of
   ``SHORT`` to 1.25 ``SHORT`` distinct shingles do both: at 0.8 one set has at most 1.25 times the
   shingles of the other, so that similar lines always meet in one of the two ways. The
   lines are grouped by key already, so this needs no shuffle. Similar
   lines agree in a bin's minima with probability about similarity ** ROWS, so at 0.8 all bands
   miss a pair in one case of about a hundred, and at 0.85 in one of a thousand.
3. Lines of a band are candidates. Two long lines must also agree in ``AGREED`` of all their minima, of which a
   byte each is kept, which lines of 0.8 miss in one case of a thousand. Two short lines are held against each other
   by bitmaps, which lose no link: sets that differ in few shingles differ in no more bits. Then the exact Jaccard
   similarity of their shingle sets decides.
4. Links become components; every line but a component's first place is dropped.

A band with many lines never lists all pairs of similar ones: its lines first meet the band's leader,
and after the components of those links only pairs from different components are listed,
starting from lines outside the band's largest component. Lines of one band that are all unlike do meet
each other; their pairs are spread over salts.

Defined cases: lines of white space alone always stay; lines below ``SHINGLE`` characters have no
shingle and only meet equal ones. ``min_chars`` lets shorter lines stay. A null
text stays null, an empty one empty; a document whose lines all go keeps an empty text. Rows
equal in id and text are one document: they lose the same lines, save in the pipeline, which numbers
its rows. Null ids count as one
empty id in comparisons. Other columns are passed on. Line keys have 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlab.llm.columns import id_key, keyed_rows, unused
from basketlab.llm.components import components
from basketlab.operators.joins import lookup_join
from basketlab.operators.staging import stage, unstage

MIN_CHARS = 1
SHINGLE = 8
BANDS = 12
ROWS = 5
PERCENT = 80
SHORT = 64
#: One order of the hashes per row of a band.
ORDERS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0x24093822299F31D0, 0x082EFA98EC4E6C89, 0x452821E638D01377, 0x3E6C5CEC0AC29B7C)
#: How many of the BANDS * ROWS minima of two long lines must agree.
AGREED = 38
#: Words of 64 bits of a short line's bitmap.
WORDS = 4
#: Rows of a band that one salt takes.
SALT_ROWS = 512

def _version(text: str, row: str | None) -> Column:
    return F.xxhash64(text) if row is None else F.col(row)


def _documents(docs: DataFrame, doc_id: str, text: str, row: str | None) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), _version(text, row).alias("version"), F.col(text).alias("text"))


def _lines(given: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, version, line_no, line, key) of the lines that take part."""
    exploded = given.select("doc_id", "version", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "raw"))
    line = exploded.select("doc_id", "version", "line_no", F.lower(F.trim("raw")).alias("line"))
    # White space of any alphabet; a carriage return before the line end is some, too.
    return line.filter((F.char_length("line") >= min_chars) & F.col("line").rlike("(?U)\\S")).select(
        "*", F.xxhash64("line").alias("key"))


def _shingles(line: str | Column, size: int) -> Column:
    """Distinct hashes of a line's shingles, in code points; four bytes hold one, so any place is found at once."""

    def hashes(units: Column) -> Column:
        last = (F.octet_length(units) / 4).cast("int") - size
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                           lambda place: F.xxhash64(F.substring(units, place * 4 + 1, F.lit(4 * size))))

    # The outer transform binds the encoded line, which is else encoded again at every place.
    return F.array_distinct(F.transform(F.array(F.encode(line, "UTF-32")), hashes)[0])


def _distinct_shingles(line: str, size: int) -> Column:
    """Number of a line's distinct shingles where it is at most 1.25 ``SHORT``, else any larger one.

    A line with no more distinct ones than that has a repeated one among the first few more, so the whole line is
    looked at only then.
    """
    few = SHORT * 100 // PERCENT + 1
    start = F.size(_shingles(F.substring(line, 1, few + size - 1), size))
    return F.when((start < few) & (F.char_length(line) > few + size - 1), F.size(_shingles(line, size))).otherwise(start)


def _signatures(lines: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """(key, bin, band, sketch) for lines (key, line), which must be grouped by key; bins of long lines are below 0.

    The sketch holds the low bytes of the band's minima.
    """
    units = lines.select("key", F.encode("line", "UTF-32").alias("units"), _distinct_shingles("line", size).alias("n"))
    # One number stands for a place and a bin: a long line's shingles go to their own bin only, a short line's to each.
    width = F.when(F.col("n") <= SHORT, F.lit(bands)).when(F.col("n") <= SHORT * 100 // PERCENT, F.lit(bands + 1)).otherwise(F.lit(1))
    places = (F.octet_length("units") / 4).cast("int") - size + 1
    wide = units.select("key", "units", width.alias("width"), places.alias("places"))
    numbers = F.sequence(F.lit(0), F.greatest(F.col("places"), F.lit(1)) * F.col("width") - 1)
    placed = wide.select("key", "units", "width", F.explode(numbers).alias("i"))
    start = F.floor(F.col("i") / F.col("width")).cast("int")
    hashed = placed.select("key", "width", (F.col("i") % F.col("width")).alias("bin"), F.xxhash64(
        F.substring("units", start * 4 + 1, F.lit(4 * size))).alias("h"))
    own = (F.col("width") == 1) | (F.col("bin") == bands)
    spread = hashed.select(
        "key", F.when(own, F.pmod("h", F.lit(bands)).cast("int") - bands).otherwise(F.col("bin")).alias("bin"),
        F.when(own, F.col("h")).otherwise(F.xxhash64("h", "bin")).alias("h"))
    minima = [F.min(F.col("h").bitwiseXOR(F.lit(order))).alias(f"m{i}") for i, order in enumerate(ORDERS[:rows])]
    binned = spread.groupBy("key", "bin").agg(*minima)
    sketch = F.lit(0).cast("long")
    for i in range(rows):
        sketch = sketch.bitwiseOR(F.shiftleft(F.col(f"m{i}").bitwiseAND(F.lit(255)), 8 * i))
    return binned.select("key", "bin", F.xxhash64("bin", *[f"m{i}" for i in range(rows)]).alias("band"), sketch.alias("sketch"))


def _agreeing(bands: int) -> Column:
    """In how many minima two sketches agree: bytes that are 0 after an exclusive or. Sums of seven bits reach no other byte."""
    low, top = 0x7F7F7F7F7F, 0x8080808080
    total = F.lit(0)
    for i in range(bands):
        z = F.col(f"a_{i}").bitwiseXOR(F.col(f"b_{i}"))
        carried = z.bitwiseAND(F.lit(low)) + F.lit(low)
        total = total + F.bit_count(F.bitwise_not(carried.bitwiseOR(z)).bitwiseAND(F.lit(top)))
    return total


def _fitting(percent: int) -> Column:
    """Whether two bitmaps leave room for similarity: each bit they differ in is a shingle of one line only.

    Sets of n and m that reach the similarity differ in (n + m) * (100 - percent) / (100 + percent) shingles at most.
    """
    bits = F.lit(0)
    for i in range(WORDS):
        bits = bits + F.bit_count(F.col(f"a_w{i}").bitwiseXOR(F.col(f"b_w{i}")))
    return (100 + percent) * bits <= (100 - percent) * (F.col("a_n") + F.col("b_n"))


def _near(bands: int, percent: int) -> Column:
    """Whether sketches and bitmaps leave room for similarity; a line without the one or the other is near by it."""
    agree = F.col("a_0").isNull() | F.col("b_0").isNull() | (_agreeing(bands) >= AGREED)
    return agree & (F.col("a_n").isNull() | F.col("b_n").isNull() | _fitting(percent))


def _sided(sketches: DataFrame, side: str) -> list[Column]:
    """The columns of sketches and bitmaps, named for one line of a pair."""
    return [F.col(c).alias(f"{side}_{c.lstrip('s')}") for c in sketches.columns if c != "key"]


def _sketches(signatures: DataFrame, wanted: DataFrame, bands: int) -> DataFrame:
    """(key, s0, ...) of the wanted long lines; short ones have no rows."""
    used = lookup_join(signatures.filter("bin < 0").select("key", "bin", "sketch"), wanted, ["key"], "left_semi", hot=[])
    # A bin without shingles agrees with nothing but another such bin.
    words = [F.coalesce(F.max(F.when(F.col("bin") == b - bands, F.col("sketch"))), F.lit(0)).alias(f"s{b}") for b in range(bands)]
    return used.groupBy("key").agg(*words)


def _bitmaps(texts: DataFrame, size: int) -> DataFrame:
    """(key, n, w0, ...) of lines (key, line) of at most 1.25 ``SHORT`` shingles: their number and a bit for each one's hash."""
    units = texts.select("key", F.encode("line", "UTF-32").alias("units"))
    placed = units.withColumn("n", (F.octet_length("units") / 4).cast("int") - size + 1)
    placed = placed.filter(F.col("n").between(1, SHORT * 100 // PERCENT))
    placed = placed.select("key", "units", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    hashed = placed.select("key", "n", F.xxhash64(F.substring("units", F.col("i") * 4 + 1, F.lit(4 * size))).alias("h"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("h", 58).cast("int"))
    word = F.pmod("h", F.lit(WORDS))
    words = [F.coalesce(F.bit_or(F.when(word == i, bit)), F.lit(0)).alias(f"w{i}") for i in range(WORDS)]
    return hashed.groupBy("key").agg(F.max("n").alias("n"), *words)


def _near_pairs(pairs: DataFrame, sketches: DataFrame, bands: int, percent: int) -> DataFrame:
    """The pairs whose sketches and bitmaps leave room for similarity."""
    for side in "ab":
        pairs = pairs.join(sketches.select(F.col("key").alias(side), *_sided(sketches, side)), side, "left")
    return pairs.filter(_near(bands, percent)).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose shingle sets reach the similarity."""
    near = stage(pairs, "near_lines")
    left = texts.select(F.col("key").alias("a"), F.col("line").alias("line_a"))
    right = texts.select(F.col("key").alias("b"), F.col("line").alias("line_b"))
    met = near.join(left, "a").join(right, "b").select("a", "b", _shingles("line_a", size).alias("x"), _shingles("line_b", size).alias("y"))
    counted = met.select("a", "b", "x", "y", F.size("x").alias("n"), F.size("y").alias("m"))
    # The smaller set can hold at most all its shingles in common.
    possible = counted.filter(F.lit(100) * F.least("n", "m") >= percent * F.greatest("n", "m"))
    common = possible.select("a", "b", "n", "m", F.size(F.array_intersect("x", "y")).alias("c"))
    return common.filter(F.lit(100) * F.col("c") >= percent * (F.col("n") + F.col("m") - F.col("c"))).select("a", "b")


def _candidates(bands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs with the leader of each band, and the rows of bands with three lines or more.

    The leader is the line whose bands hold the most lines: copies with different changes are
    closer to the line they come from than to each other.
    """
    counted = stage(bands.groupBy("band").agg(
        F.count(F.lit(1)).alias("lines"), F.min("key").alias("low"), F.max("key").alias("high")
    ).filter("low <> high"), "bands")
    large = counted.filter("lines > 2").select("band", "lines")
    members = stage(lookup_join(bands, large, ["band"], hot=[]), "large_bands")
    weights = members.groupBy("key").agg(F.sum("lines").alias("weight"))
    leaders = members.join(weights, "key").groupBy("band").agg(F.max(F.struct("weight", "key"))["key"].alias("leader"))
    led = members.join(leaders, "band").filter("key <> leader")
    pairs = counted.filter("lines = 2").select(F.col("low").alias("a"), F.col("high").alias("b")).unionByName(
        led.select(F.least("leader", "key").alias("a"), F.greatest("leader", "key").alias("b")))
    pairs = stage(pairs.distinct(), "line_pairs")
    unstage(counted)
    return pairs, members


def _other_pairs(members: DataFrame, found: DataFrame, tried: DataFrame, sketches: DataFrame, bands: int, percent: int) -> DataFrame:
    """Pairs of a band from different components, each once, and not tried before.

    Sketches and bitmaps are compared where two lines meet, so pairs of lines that only share a band are never written.
    """
    rows = stage(members.select("band", "key").join(found.withColumnRenamed("node", "key"), "key", "left").select(
        "band", "key", F.coalesce("component", "key").alias("component")), "band_components")
    largest = rows.groupBy("band", "component").agg(F.count(F.lit(1)).alias("k")).groupBy("band").agg(
        F.max(F.struct("k", "component"))["component"].alias("largest"), F.count(F.lit(1)).alias("kinds"),
        F.ceil(F.sum("k") / SALT_ROWS).alias("salts"))
    mixed = rows.join(largest.filter("kinds > 1").drop("kinds"), "band").join(sketches, "key", "left")

    salt = F.pmod(F.xxhash64("key"), "salts").alias("salt")
    minor = mixed.filter("component <> largest").select(
        "band", salt, F.col("key").alias("a"), F.col("component").alias("component_a"), *_sided(sketches, "a"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    every = mixed.select(
        "band", salts, F.col("key").alias("b"), F.col("component").alias("component_b"), "largest", *_sided(sketches, "b"))
    once = (F.col("component_b") == F.col("largest")) | (F.col("a") < F.col("b"))
    met = minor.join(every, ["band", "salt"]).filter(
        (F.col("component_a") != F.col("component_b")) & once & _near(bands, percent))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")


def similar_lines(
    given: DataFrame, occurrences: DataFrame, min_chars: int = MIN_CHARS, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT,
) -> DataFrame:
    """(key, first) of every line key that occurs twice or has a similar one; ``first`` is the place that stays.

    ``occurrences`` are the places (doc_id, version, line_no, key) of all lines, stored.
    """
    lines = _lines(given, min_chars)
    distinct = lines.groupBy("key").agg(F.min("line").alias("line")).filter(F.char_length("line") >= size)
    signatures = stage(_signatures(distinct, size, bands, rows), "line_signatures")
    pairs, members = _candidates(signatures.select("key", "band"))

    wanted = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).unionByName(
        members.select("key")).distinct()
    wanted = stage(wanted, "line_keys")
    texts = lookup_join(lines.select("key", "line"), wanted, ["key"], "left_semi", hot=[])
    texts = stage(texts.groupBy("key").agg(F.min("line").alias("line")), "line_texts")
    sketches = stage(_sketches(signatures, wanted, bands).join(_bitmaps(texts, size), "key", "full"), "line_sketches")
    unstage(signatures, wanted)

    links = stage(_verified(_near_pairs(pairs, sketches, bands, percent), texts, size, percent), "line_links")
    others = _other_pairs(members, components(links), pairs, sketches, bands, percent)
    unstage(members)
    more = _verified(others, texts, size, percent)
    found = components(links.unionByName(more)).withColumnRenamed("node", "key")

    places = occurrences.groupBy("key").agg(F.min(F.struct("doc_id", "version", "line_no")).alias("place"), F.count(F.lit(1)).alias("n"))
    joined = places.join(found, "key", "left").filter("component IS NOT NULL OR n > 1")
    joined = stage(joined.select("key", "place", F.coalesce("component", "key").alias("component")), "line_places")
    first = joined.groupBy("component").agg(F.min("place").alias("first"))
    return joined.join(first, "component").select("key", "first")


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, row: str | None = None,
) -> DataFrame:
    """``docs`` with ``text`` without its dropped lines, and ``dropped_lines``, their numbers from 0.

    ``row`` is a column that numbers the rows; with it, rows equal in id and text are documents of their own.
    """
    given = _documents(docs, doc_id, text, row)
    occurrences = stage(_lines(given, min_chars).select("doc_id", "version", "line_no", "key"), "line_occurrences")
    repeated = stage(similar_lines(given, occurrences, min_chars).select(
        "key", F.col("first.doc_id").alias("first_doc"), F.col("first.version").alias("first_version"),
        F.col("first.line_no").alias("first_line")), "repeated_lines")
    met = lookup_join(occurrences, repeated, ["key"])
    gone = met.filter(~(F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("version") == F.col("first_version"))
                        & (F.col("line_no") == F.col("first_line"))))
    columns = [c for c in docs.columns if c.lower() != "dropped_lines"]
    rest = docs.select(*[F.col(f"`{c}`") for c in columns])
    names = [unused(rest, "_doc"), unused(rest, "_version")]
    per_document = stage(gone.groupBy(id_key("doc_id").alias(names[0]), F.col("version").alias(names[1])).agg(
        F.sort_array(F.collect_set("line_no")).alias("dropped_lines")), "dropped_lines")
    keyed = rest.withColumn(names[0], id_key(doc_id)).withColumn(names[1], _version(text, row))
    joined = lookup_join(keyed, per_document, names, "left")
    numbers = F.sequence(F.lit(0), F.size(F.split(text, "\n", -1)) - 1)
    # One hash set of the dropped numbers, then the lines by their place.
    numbers = F.array_except(numbers, "dropped_lines")
    left = F.transform(F.array(F.split(text, "\n", -1)), lambda all_: F.array_join(F.transform(numbers, lambda i: F.get(all_, i)), "\n"))[0]
    kept = F.when(F.col("dropped_lines").isNull(), F.col(text)).otherwise(left)
    return joined.select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in columns],
                         F.coalesce("dropped_lines", F.array().cast("array<int>")).alias("dropped_lines"))


def query(spark, folder: str) -> DataFrame:
    """Per document: its lines, how many are dropped, and the digest of the text that stays."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn(
        "n_lines", F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long"))
    return dedup_lines(docs).select(
        "doc_id", "n_lines", F.size("dropped_lines").cast("long").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), "dropped_lines")


def drop_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their remaining lines and characters; those that lose every line go."""
    rows, key = keyed_rows(docs, "line_dedup_rows")
    found = dedup_lines(rows, row=key)
    emptied = (F.size("dropped_lines") > 0) & (F.trim("text") == "")
    counted = F.when(F.size("dropped_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", counted).select(*docs.columns)

"""Near-duplicate operators against plain comparisons of all pairs."""

import hashlib
import random
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest

from basketlab.llm import components, jaccard_join, line_dedup
from basketlab.operators.staging import staged_paths
from checks.compare import compare, oracle
from tests.llm.brute import ODD, empty_frame, odd_frame, words
from tests.llm.brute import components as brute_components

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())


def brute_jaccard(docs, percent=90):
    sets = [(i, shingles(t)) for i, t in docs]
    links = [(a, b) for (a, s), (b, t) in combinations(sets, 2) if s and t and 100 * len(s & t) >= percent * len(s | t)]
    found = brute_components([i for i, _ in sets], links)
    return {i: (len(s), found[i]) for i, s in sets}


def near_copies(seed, groups=12, size=9):
    """Groups of texts with a few words changed, and passages that unrelated texts share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    common = [word() for _ in range(40)]
    docs = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice((12, 60, 150)))]
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            docs.append((len(docs), " ".join(copy)))
    docs += [(len(docs) + k, " ".join(common + [word() for _ in range(rng.randint(1, 5))])) for k in range(25)]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_all_pairs(spark, seed):
    docs = near_copies(seed)
    found = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute_jaccard(docs)


def test_jaccard_takes_small_batches_and_asks_for_columns_of_many(spark, monkeypatch):
    seen, stage = [], jaccard_join.stage

    def watched(df, *args):
        seen.append(int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
        return stage(df, *args)

    monkeypatch.setattr(jaccard_join, "stage", watched)
    usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs = near_copies(1)
    jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert seen and max(seen) <= jaccard_join.BATCH_ROWS
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == usual

    batches = [pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t])], names=["doc_id", "text"]) for i, t in docs]
    rows = pa.Table.from_batches(list(jaccard_join._find(3, 90, 4, 2)(batches)))
    assert rows.filter(pa.compute.is_valid(rows["grams"])).num_rows == 2
    assert rows["doc_id"].drop_null().to_pylist() == [i for i, _ in docs]


def test_jaccard_equals_sql(spark):
    assert compare(spark, oracle(FOLDER), FOLDER, "op10_jaccard_join").startswith("ok")


def test_jaccard_odd_rows(spark):
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(odd_frame(spark)).collect()]
    assert len(found) == len(ODD)
    by_id = {i: (n, c) for i, n, c in found if i is not None}
    assert by_id[1] == (0, 1) and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert by_id[4] == (1, 4) and by_id[5] == by_id[6] == (1, 5) and by_id[8][1] == 7
    kept = jaccard_join.keep_one_per_group(spark, odd_frame(spark), "")
    assert kept.columns == odd_frame(spark).columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in ODD} - {6, 8}


def test_jaccard_empty_table(spark):
    assert jaccard_join.jaccard_components(empty_frame(spark)).count() == 0


def brute_groups(docs, size=5, percent=80):
    """Place of each text's group: the first place that links of word shingles reach."""
    runs = [words(t) for _, t in docs]
    sets = [{tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set() for w in runs]
    links = [(a, b) for a, b in combinations(range(len(sets)), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return brute_components(list(range(len(sets))), links)


@pytest.mark.parametrize("seed", [3, 4])
def test_jaccard_stage_equals_all_pairs_of_five_words(spark, seed):
    docs = near_copies(seed)
    plain = [f"w{seed}x{k}" for k in range(300)]
    for changed in (plain[:50], plain[:20] + ["changed"] + plain[21:50], plain[100:200], plain[100:200] + plain[200:215]):
        docs.append((len(docs), " ".join(changed)))
    found = brute_groups(docs)
    want = {docs[k][0] for k, first in found.items() if k == first}
    assert {docs[-1][0], docs[-3][0]}.isdisjoint(want)
    kept = jaccard_join.keep_one_per_group(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (41, None)]
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    got = {r["node"]: r["component"] for r in found.collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}}


def test_components_keep_one_table_staged(spark):
    before = set(staged_paths(spark))
    links = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
    found = components.components(links)
    assert len(set(staged_paths(spark)) - before) == 1
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(31)}


def test_line_dedup_deletes_signatures(spark):
    before = set(staged_paths(spark))
    docs = spark.createDataFrame([(i, f"one long line that is much like the other ones, number {i}") for i in range(5)], "doc_id long, text string")
    found = line_dedup.dedup_lines(docs)
    names = {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in set(staged_paths(spark)) - before}
    assert "line_texts" in names and not names & {"line_signatures", "line_keys", "bands", "large_bands"}
    assert sorted(len(r["dropped_lines"]) for r in found.collect()) == [0, 1, 1, 1, 1]


def brute_lines(docs):
    """(doc_id, line_no) that go: per component of similar lines all but the first place."""
    places = {}
    for i, t in docs:
        for k, line in enumerate((t or "").split("\n") if t is not None else []):
            line = line.strip(" ").lower()
            if len(line) >= line_dedup.MIN_CHARS:
                places.setdefault(line, []).append((i, k))
    sets = {line: {line[j:j + 8] for j in range(len(line) - 7)} for line in places}
    holders = {}
    for line, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(line)
    links = []
    for line, s in sets.items():
        for other, n in Counter(o for g in s for o in holders[g] if o < line).items():
            if 100 * n >= line_dedup.PERCENT * (len(s) + len(sets[other]) - n):
                links.append((line, other))
    found = brute_components(list(places), links)
    first = {}
    for line, at in places.items():
        first[found[line]] = min(at + [first.get(found[line], at[0])])
    return {p for line, at in places.items() for p in at if p != first[found[line]]}


def test_line_dedup_equals_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    found = line_dedup.query(spark, FOLDER).collect()
    got = {(r["doc_id"], k) for r in found for k in r["dropped_lines"]}
    assert got == brute_lines(docs) and len(found) == len(docs)


def test_line_dedup_of_many_near_lines(spark):
    rng = random.Random(5)
    base = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(30)) for _ in range(4)]
    docs = []
    for k in range(120):
        line = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            line[rng.randrange(len(line))] = rng.choice("xyz")
        docs.append((k, "".join(line)))
    found = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    want = brute_lines(docs)
    got = {(r["doc_id"], k) for r in found for k in r["dropped_lines"]}
    assert got <= want and len(got) >= 0.97 * len(want)


def dropped(spark, docs):
    found = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return {(r["doc_id"], k) for r in found for k in r["dropped_lines"]}


def test_line_dedup_of_short_lines(spark):
    docs = [(1, "All rights reserved.\n\nok\n\t\n\u3000\nhome | about us\nAccept all cookies"),
            (2, "all rights reserved.\n\n OK \n\t\n\u3000\nhome | about\nAccept all cookies!"), (3, "ok\r\n\r\n\r\nabout us")]
    assert dropped(spark, docs) == {(2, 0), (2, 2), (2, 6)}


def test_line_dedup_of_rulers(spark):
    """Equal shingle sets in lines of very different lengths."""
    rng = random.Random(9)
    kinds = ["=", "-=", "|---", "buy now ", "\U0001f600\U0001f601 ", "".join(rng.choice("abcdefgh") for _ in range(70)) + " "]
    lines = [(kind * times)[:-1] + kind[-1].strip() for kind in kinds for times in (16, 40, 200)]
    docs = list(enumerate(lines))
    want = brute_lines(docs)
    assert len(want) == 2 * len(kinds) and dropped(spark, docs) == want


def test_line_dedup_counts_code_points(spark):
    """Three changed characters in a line of about 80; those beyond 16 bits are one character, as accented ones are."""
    rng = random.Random(3)
    docs = []
    for old, new in (("\U0001f600", "\U0001f601"), ("é", "è"), ("日", "月")):
        for _ in range(10):
            words_ = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40)]
            line = " ".join(words_[:3]) + old + " ".join(words_[3:20]) + old + " ".join(words_[20:37]) + old + " ".join(words_[37:])
            docs += [(len(docs), line), (len(docs) + 1, line.replace(old, new))]
    want = brute_lines(docs)
    assert len(want) == 30 and dropped(spark, docs) == want
    short = [(0, "\U0001f600\U0001f600\U0001f600abcdefghijk"), (1, "\U0001f600\U0001f600\U0001f600abcdefghijkl")]
    assert dropped(spark, short) == brute_lines(short) == {(1, 0)}
    sets = spark.createDataFrame(short, "i long, line string").select(line_dedup._shingles("line", 8).alias("s")).collect()
    assert [len(r["s"]) for r in sets] == [7, 8]


def test_line_dedup_of_a_band_of_unlike_lines(spark, monkeypatch):
    """Lines that meet in one band only by a shared start; all their pairs are compared, over several salts."""
    monkeypatch.setattr(line_dedup, "SALT_ROWS", 8)
    rng = random.Random(12)
    shared = " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(9))
    other = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(7))
    lines = [f"{shared} {other()}" for _ in range(60)]
    lines += [line[:-2] + "zz" for line in lines[::6]]
    docs = list(enumerate(lines))
    want = brute_lines(docs)
    assert len(want) == 10 and dropped(spark, docs) == want


def test_line_dedup_of_very_many_lines_and_one_very_long(spark):
    long = " ".join(f"{k * 7919 % 100_003:05d}" for k in range(60_000))
    docs = [(1, "\n".join(hashlib.md5(str(k % 40_000).encode()).hexdigest() for k in range(80_000))), (2, long), (3, long[:-3] + "xyz"), (4, "ab\n" * 50_000)]
    found = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found[1]["dropped_lines"] == list(range(40_000, 80_000))
    assert found[2]["text"] == long and found[3]["text"] == "" and found[4]["text"] == "ab\n"
    assert found[4]["dropped_lines"] == list(range(1, 50_000))


def test_sketches_agree_as_often_as_the_sets(spark):
    from pyspark.sql import functions as F
    rng = random.Random(6)
    rows = []
    for k in range(60):
        line = "".join(rng.choice("abcdefgh ") for _ in range(400))
        cut = rng.randrange(10, 200)
        rows += [(2 * k, line), (2 * k + 1, line[:-cut] + "".join(rng.choice("xyz ") for _ in range(cut)))]
    sets = {k: {line[j:j + 8] for j in range(len(line) - 7)} for k, line in rows}
    signatures = line_dedup._signatures(spark.createDataFrame(rows, "key long, line string").repartition(4, "key"), 8, 12, 5)
    sketches = line_dedup._sketches(signatures, spark.range(120).select(F.col("id").alias("key")), 12)
    named = [sketches.select(F.floor(F.col("key") / 2).alias("k"), (F.col("key") % 2).alias("side"), *[F.col(f"s{i}").alias(f"{c}_{i}") for i in range(12)]) for c in "ab"]
    met = named[0].filter("side = 0").drop("side").join(named[1].filter("side = 1").drop("side"), "k")
    agreeing = {r["k"]: r["n"] for r in met.select("k", line_dedup._agreeing(12).alias("n")).collect()}
    plain = {r["key"]: tuple(r)[1:] for r in sketches.collect()}
    similar = {k: len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) for k in range(60)}
    for k in range(60):
        assert agreeing[k] == sum((x >> 8 * j & 255) == (y >> 8 * j & 255) for x, y in zip(plain[2 * k], plain[2 * k + 1]) for j in range(5))
        assert abs(agreeing[k] / 60 - similar[k]) < 0.25 and (similar[k] < 0.8 or agreeing[k] >= line_dedup.AGREED)


def test_bitmaps_of_short_lines_lose_no_link(spark):
    """Similar lines of up to 80 shingles always fit; most pairs that only share half of them do not."""
    from pyspark.sql import functions as F
    rng = random.Random(8)
    rows = []
    for k in range(300):
        line = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(8, 87)))
        cut = rng.randint(0, max(1, len(line) // (6 if k % 2 else 2)))
        rows += [(2 * k, line), (2 * k + 1, line[:len(line) - cut] + "".join(rng.choice("xyz\U0001f600") for _ in range(cut)))]
    rows += [(600, "=" * 80), (601, "=" * 20), (602, "y" * 400)]
    sets = {k: {line[j:j + 8] for j in range(len(line) - 7)} for k, line in rows}
    bitmaps = line_dedup._bitmaps(spark.createDataFrame(rows, "key long, line string"), 8)
    sides = [bitmaps.select(F.floor(F.col("key") / 2).alias("k"), (F.col("key") % 2).alias("side"), *line_dedup._sided(bitmaps, c)) for c in "ab"]
    met = sides[0].filter("side = 0").drop("side").join(sides[1].filter("side = 1").drop("side"), "k")
    fits = {r["k"]: r["fits"] for r in met.select("k", line_dedup._fitting(80).alias("fits")).collect()}
    similar = {k: len(sets[2 * k] & sets[2 * k + 1]) / len(sets[2 * k] | sets[2 * k + 1]) for k in range(301)}
    assert set(fits) == set(range(301)) and all(fits[k] for k in fits if similar[k] >= 0.8)
    unlike = [k for k in fits if similar[k] < 0.6]
    assert len(unlike) > 50 and sum(fits[k] for k in unlike) < 0.1 * len(unlike)


def test_unlike_short_lines_of_a_band_are_not_listed(spark, monkeypatch):
    """Short lines that share a band by their start alone: no pair of them reaches the exact sets."""
    listed = []
    verified = line_dedup._verified

    def watched(pairs, *args):
        listed.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(line_dedup, "_verified", watched)
    rng = random.Random(4)
    shared = "a start that many lines have "
    lines = [shared + "".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(150)]
    docs = list(enumerate([*lines, lines[7] + "x"]))
    assert dropped(spark, docs) == brute_lines(docs) == {(150, 0)}
    assert sum(listed) <= 20


def test_few_distinct_shingles_are_counted_whole(spark):
    lines = ["=" * 300, "ab" * 200, "".join(map(chr, range(0x100, 0x180))) * 3, "short line", "x" * 8, "".join(map(chr, range(0x100, 0x140))) * 2]
    rows = spark.createDataFrame([(line,) for line in lines], "line string").select("line", line_dedup._distinct_shingles("line", 8).alias("n"))
    for line, n in rows.collect():
        exact = len({line[j:j + 8] for j in range(len(line) - 7)})
        assert n == exact if exact <= 80 else n > 80


def test_line_dedup_odd_rows(spark):
    given = odd_frame(spark)
    found = line_dedup.dedup_lines(given)
    assert found.columns == ["doc_id", "text", "n_words", "class", "_key", "dropped_lines"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(ODD) and rows[1]["text"] is None and rows[2]["text"] == ""
    assert rows[13]["dropped_lines"] == [] and rows[14]["dropped_lines"] == [0]
    assert rows[15]["text"] == "\nshort" and rows[8]["text"] == "" and rows[7]["dropped_lines"] == []
    assert rows[16]["dropped_lines"] == []  # rows equal in id and text are one document
    assert line_dedup.dedup_lines(empty_frame(spark)).count() == 0



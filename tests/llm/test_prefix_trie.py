"""The prefix trie against plain Python and its SQL."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from basketlab.llm import prefix_trie
from basketlab.llm.prefix_trie import prefix_trie as build

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def brute(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, md5(role or "") + md5(text or ""), role or "", text or ""))
    said = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(said.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(convs) - 1) * words
    return sorted((
        min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
        hashlib.sha256(",".join(map(str, sorted(c for c in convs if rebuilt[c] == node))).encode()).hexdigest(),
    ) for node, convs in members.items())


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "k", 0) for r in rows], "conv_id long, turn int, role string, text string, depth int, key string, part int")


def corpus(seed, n=90, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if turn else "user", rng.choice(["a b c", "hello there", "x", ""])))
    return rows


def test_query_equals_brute_force(spark):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()]
    assert found(prefix_trie.query(spark, FOLDER)) == brute(rows)


ODD = [
    (None, 0, "user", "lost"), (2040, None, None, None), (2040, 0, "user", "hi  there\tyou\x0bnow"), (2040, 0, "assistant", None),
    (2041, 5, "user", "x"), (2042, 1, "user", ""), (2042, 1, "user", ""), (2042, 1, None, ""), (2043, 0, "user", "word " * 40_000),
    (100_007, 0, "user", "日本 😀 é"), (3000, 0, "user", "a"), *((3007, k, "user", "c" if k else "b") for k in range(5)),
]


def test_random_odd_copied_and_long_conversations(spark, monkeypatch):
    """Small bounds: copies end at one node in several chunks, chains and conversations lie in several blocks and shares."""
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    monkeypatch.setattr(prefix_trie, "CHAIN_BLOCK", 16)
    copies = [(c, t, "user", f"turn {t}") for c in range(400, 530) for t in range(5)]
    long = [(c, t, "user", f"word {t // 3}") for c in (620, 621, 622, 626) for t in range(60)] + [(625, t, "user", f"only {t % 7}") for t in range(400)]
    rows = corpus(1) + ODD + copies + long
    assert found(build(frame(spark, rows).repartition(6))) == brute(rows)


def test_no_conversations(spark):
    assert found(build(frame(spark, ODD).filter("conv_id IS NULL"))) == []


def test_equal_fingerprints_start_over(spark, monkeypatch):
    """Weak values at first: the checks must see different turns, then different sequences, under one key."""
    strong_key, strong_bases, tried = prefix_trie._turn_key, prefix_trie._bases, []
    monkeypatch.setattr(prefix_trie, "_turn_key", lambda seed: (tried.append(seed), strong_key(seed) if seed else strong_key(seed) % 2)[1])
    rows = corpus(3, 60)
    assert found(build(frame(spark, rows))) == brute(rows) and {0, 1} <= set(tried)
    monkeypatch.setattr(prefix_trie, "_turn_key", strong_key)
    monkeypatch.setattr(prefix_trie, "_bases", lambda seed: strong_bases(seed) if seed > 1 else [1, 1, 1])
    rows = [(c, t, "user", w) for c, path in {1: "abcdab", 2: "abdcab", 3: "aabbcd"}.items() for t, w in enumerate(path)]
    assert found(build(frame(spark, rows))) == brute(rows)

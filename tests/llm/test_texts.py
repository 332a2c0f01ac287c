"""Operators on single texts, models and the pipeline."""

import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from basketlab.llm import decontaminate, interpolated_lm, jaccard_join, line_crf, line_dedup, personal_data, perspectives, quality_rules
from basketlab.operators import staging
from checks.compare import compare, oracle
from tests.llm.brute import ODD, empty_frame, fold, odd_frame, words

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_perspectives", "op3_decontaminate", "op9_quality_rules"])
def test_query_equals_sql(spark, name):
    assert compare(spark, oracle(FOLDER), FOLDER, name).startswith("ok")


def test_rules_odd_rows(spark):
    rows = quality_rules.quality_rules(odd_frame(spark)).collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and found[1]["n_words"] == found[3]["n_words"] == 0 and found[1]["base_failed"]
    assert found[7]["n_words"] == found[7]["n_repeat_words"] == 4200 and found[7]["base_failed"]
    assert found[9]["n_words"] == 7 and found[12]["word_chars"] == 30_000 and found[12]["_key"] == "k"
    assert quality_rules.quality_rules(empty_frame(spark)).count() == 0


def test_rules_count_repeated_windows(spark):
    text = "a b c d a b c e f g a b c\nx x x x\nx x x x"
    row = quality_rules.quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_repeat_words"], row["n_dup_lines"], row["n_lines"]) == (17, 1, 3)


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(number):
        total = 0
        for i, c in enumerate(reversed(number)):
            value = int(c) * (1 + i % 2)
            total += value - 9 if value > 9 else value
        return total % 10 == 0

    at = lambda kind, pattern, check: [
        (kind, m.start(), m.end()) for m in re.finditer(pattern, text) if check(m[0])]
    return [
        *at("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        *at("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        *at("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        *at("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]


def test_base_spans_equal_plain_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("ab1234@@..-+ ()é%9") for _ in range(rng.randint(0, 30)))
        assert list(personal_data.base_spans(text)) == plain_spans(text), text


def test_further_spans_need_checksum_or_context():
    spans = lambda text: [(k, text[a:b]) for k, a, b in personal_data.further_spans(text)]
    assert spans("pay DE89 3704 0044 0532 0130 00 now") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert spans("pay DE88 3704 0044 0532 0130 00 now") == []
    assert spans("my ssn is 123-45-6789") == [("social_number", "123-45-6789")] and spans("part 123-45-6789") == []
    assert spans("call (555) 123-4567") == [("local_phone", "(555) 123-4567")]
    assert spans("amex card 3782 822463 10005") == [("short_card", "3782 822463 10005")]


def test_personal_data_query_and_odd_rows(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for r in personal_data.query(spark, FOLDER).collect():
        want = plain_spans(texts[r["doc_id"]] or "")
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest()
        assert set(shown.split(",")) - {""} <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in personal_data.BASE_KINDS] == [sum(s[0] == k for s in want) for k in personal_data.BASE_KINDS]
    found = personal_data.find_personal_data(odd_frame(spark)).collect()
    assert len(found) == len(ODD)
    assert [r["spans"] for r in found if r["doc_id"] == 16] == ["email:5:13,card:17:36"] * 2
    assert personal_data.find_personal_data(empty_frame(spark)).count() == 0


def test_long_runs_cost_their_length():
    text = "a" * 400_000 + " " + "1" * 400_000 + " " + "+1(" * 100_000 + "A" * 200_000
    assert list(personal_data.base_spans(text)) == [] and list(personal_data.further_spans(text)) == []


def test_language_model_counts_and_scores(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    tokens = {i: [*words(t), "\n"] for i, t in docs}
    training = [t for i, t in tokens.items() if fold(i, 7) != 2]
    counts = Counter(w for t in training for w in t)
    pairs = Counter(p for t in training for p in zip(["\n", *t[:-1]], t))
    total, distinct = sum(counts.values()), len(counts)
    found = {r["doc_id"]: r for r in interpolated_lm.query(spark, FOLDER).collect()}
    better = worse = 0
    for i, t in tokens.items():
        row = found[i]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (fold(i, 7) == 2, len(t), total)
        assert row["n_known"] == sum(counts[w] > 0 for w in t)
        assert row["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t))
        if row["held_out"]:
            better, worse = better + row["score"], worse + row["base_score"]
    assert better > worse

    # The score follows from the counts and the learned weights.
    cells = Counter()
    for t in training:
        for v, w in zip(["\n", *t[:-1]], t):
            low = (counts[w] - 1) / (total - 1)
            high = (pairs[v, w] - 1) / (counts[v] - 1) if counts[v] > 1 else 0.0
            key = min(int(math.log2(counts[v])), interpolated_lm.BUCKETS - 1)
            for p in (low, high):
                level = int(np.clip(round(math.log2(p * (distinct + 1)) * interpolated_lm.STEP) + 32 * interpolated_lm.STEP + 1,
                                    1, 64 * interpolated_lm.STEP + 1)) if p > 0 else 0
                key = key * (64 * interpolated_lm.STEP + 2) + level
            cells[key] += 1
    weights = interpolated_lm.learn_weights(np.array(list(cells)), np.array(list(cells.values()), float), 2)
    assert np.allclose(weights.sum(axis=1), 1)
    for i in list(tokens)[:40]:
        score = 0.0
        for v, w in zip(["\n", *tokens[i][:-1]], tokens[i]):
            mix = weights[min(int(math.log2(counts[v] + 1)), interpolated_lm.BUCKETS - 1)]
            score += math.log10(mix[0] / (distinct + 1) + mix[1] * counts[w] / total + mix[2] * (pairs[v, w] / counts[v] if counts[v] else 0))
        assert found[i]["score"] == pytest.approx(score, rel=1e-6)


def test_language_model_odd_rows_and_orders(spark):
    rows = interpolated_lm.score_documents(odd_frame(spark)).collect()
    assert len(rows) == len(ODD) and all(math.isfinite(r["score"]) for r in rows)
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)] == [1, 1, 1]
    three = interpolated_lm.score_documents(odd_frame(spark), order=3).collect()
    assert all(math.isfinite(r["score"]) for r in three) and len(three) == len(ODD)
    assert interpolated_lm.score_documents(empty_frame(spark)).count() == 0


def test_crf_marginals_equal_all_labellings():
    rng = np.random.default_rng(2)
    count = np.array([3, 1, 4])
    scores, moves = rng.normal(size=8), rng.normal(size=(2, 2))
    good, moved = line_crf.chain_marginals(scores, count, moves)
    start, want = 0, np.zeros((2, 2))
    for n in count:
        mass, total, steps = np.zeros(n), 0.0, np.zeros((2, 2))
        for labelling in np.ndindex(*[2] * n):
            weight = math.exp(sum(scores[start + k] * y for k, y in enumerate(labelling))
                              + sum(moves[a, b] for a, b in zip(labelling, labelling[1:])))
            total += weight
            mass += weight * np.array(labelling)
            for a, b in zip(labelling, labelling[1:]):
                steps[a, b] += weight
        assert np.allclose(good[start:start + n], mass / total)
        want += steps / total
        start += n
    assert np.allclose(moved, want)


def test_classifier_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = line_crf.query(spark, folder).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    assert all(p for p, y in held if y)


def test_classifier_odd_rows(spark):
    labels = spark.createDataFrame([(7, 1), (12, 0), (12, None), (None, 1), (9, 0)], "doc_id long, quality int")
    model = line_crf.train(odd_frame(spark), labels)
    rows = line_crf.score_quality(odd_frame(spark), model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    none = line_crf.train(odd_frame(spark), labels.limit(0))
    assert {r["score"] for r in line_crf.score_quality(odd_frame(spark), none).collect()} == {0.5}
    assert line_crf.score_quality(empty_frame(spark), model).count() == 0


def brute_windows(docs, items, size=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    phrases = {}
    for item, t in items:
        w = split(t)
        for k in range(max(1, len(w) - size + 1)) if w else ():
            phrases.setdefault(tuple(w[k:k + size]), set()).add(str(item))
    out = []
    for i, t in docs:
        w, hit, names = split(t), set(), set()
        for n in {len(p) for p in phrases}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in phrases:
                    hit |= set(range(k, k + n))
                    names |= phrases[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(names)))
    return out


def test_windows_of_frequent_terms_and_slices(spark, monkeypatch):
    rng = random.Random(4)
    word = lambda: rng.choice(["a", "b", "the", "of", "x1", "é"])
    docs = [(k, " ".join(word() for _ in range(rng.randint(0, 400)))) for k in range(60)]
    items = [(k, " ".join(word() for _ in range(rng.choice((1, 3, 4, 10, 12))))) for k in range(25)] + [(99, None), (98, " ")]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute_windows(docs, items))
    index = decontaminate.build_index(given)
    for size in (decontaminate.MAX_SLICE_BYTES, 300):
        monkeypatch.setattr(decontaminate, "MAX_SLICE_BYTES", size)
        found = decontaminate.search(index, bench).collect()
        assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found) == want


def test_copies_of_an_item_do_not_fill_a_slice(spark, monkeypatch):
    sizes, matches = [], decontaminate._slice_matches
    monkeypatch.setattr(decontaminate, "MAX_SLICE_BYTES", 300)
    monkeypatch.setattr(decontaminate, "_slice_matches", lambda index, rows, *a: sizes.append(len(rows)) or matches(index, rows, *a))
    docs = spark.createDataFrame([(1, "a b c d"), (2, "e")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")] * 60 + [(2, "x y")], "item_id long, text string")
    found = {r["doc_id"]: r["items"] for r in decontaminate.search(decontaminate.build_index(docs), bench).collect()}
    assert found == {1: ["1"], 2: []} and sum(sizes) == 2


def test_proximity_allows_a_word_between(spark):
    docs = spark.createDataFrame([(1, "one two three four extra five six"), (2, "six five four three two one")], "doc_id long, text string")
    bench = spark.createDataFrame([("q", "one two three four five six")], "item_id string, text string")
    found = {r["doc_id"]: r for r in decontaminate.search(decontaminate.build_index(docs), bench).collect()}
    assert found[1]["near_items"] == ["q"] and not found[1]["contaminated"] and found[2]["near_items"] == []


def test_decontamination_odd_rows(spark):
    bench = spark.createDataFrame([(1, "The cat sat on the mat the cat sat on"), (None, "one"), (3, None)], "item_id long, text string")
    found = decontaminate.search(decontaminate.build_index(odd_frame(spark)), bench).collect()
    rows = {r["doc_id"]: r for r in found}
    assert len(found) == len(ODD) and rows[7]["n_hit"] == 4198 and rows[1]["n_words"] == 0
    assert rows[4]["items"] == [""] and rows[4]["items_sha256"] == hashlib.sha256(b"").hexdigest() and rows[4]["contaminated"]
    kept = decontaminate.search(decontaminate.build_index(odd_frame(spark)), bench.limit(0)).collect()
    assert not any(r["contaminated"] for r in kept)
    assert decontaminate.search(decontaminate.build_index(empty_frame(spark)), bench).count() == 0


def test_perspectives_odd_rows(spark):
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi"), (1, 1, "ann", "hi"), (1, None, "bob", None), (1, 2, None, "?"),
            (2, 0, "system", "alone"), (None, 1, "eve", ""), (3, 0, "ann", "x" * 5000)]
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn int, role string, text string, name string, part int")
    found = perspectives.rotate_perspectives(given).collect()
    assert Counter((r["conv_id"], r["perspective"]) for r in found) == {
        (1, "ann"): 5, (1, "bob"): 5, (None, "eve"): 1, (3, "ann"): 1}
    for view in ("ann", "bob"):
        mine = sorted((r for r in found if r["conv_id"] == 1 and r["perspective"] == view), key=lambda r: r["position"])
        text = "".join(r["segment"] for r in mine)
        trained = [text[r["mask_start"]:r["mask_end"]] for r in mine if r["mask_end"] > r["mask_start"]]
        assert trained == (["hi<|end|>"] * 2 if view == "ann" else ["<|end|>"])
        assert [text[r["start"]:r["start"] + len(r["segment"])] for r in mine] == [r["segment"] for r in mine]
        assert "<|user name=unknown|>" in text and "<|system|>\nrules" in text
    assert perspectives.rotate_perspectives(given.limit(0)).count() == 0


def test_perspectives_of_a_long_conversation(spark):
    rows = [(7, t, "ann" if t % 3 else "bob", f"turn {t}") for t in range(3000)] + [(8, 0, "ann", "hi")]
    found = perspectives.rotate_perspectives(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    mine = sorted((r for r in found.collect() if r["conv_id"] == 7 and r["perspective"] == "bob"), key=lambda r: r["position"])
    assert [r["position"] for r in mine] == list(range(3000))
    text = "".join(r["segment"] for r in mine)
    assert all(text[r["mask_start"]:r["mask_end"]] == f"turn {k}<|end|>" for k, r in enumerate(mine) if k % 3 == 0)


def test_pipeline_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: a row neither goes nor stays because of another row under its id."""
    text = lambda seed: " ".join(f"w{seed}x{k}" for k in range(30))
    spark.createDataFrame([(1, text("q"))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = lambda rows: spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, n_chars long")
    left = lambda found: sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)

    clean = [(None, text("a")), (5, text("b")), (None, None)]
    docs = frame([*clean, (None, text("q")), (5, text("q"))])
    assert left(decontaminate.drop_contaminated(spark, docs, str(tmp_path))) == sorted(clean, key=str)

    once = [(7, text("c")), (None, text("a")), (8, text("d")), (None, None), (None, "")]
    docs = frame([(None, text("d")), *once, (7, text("c")), (None, text("a")), (9, text("d"))])
    assert left(jaccard_join.keep_one_per_group(spark, docs, "")) == sorted(once, key=str)

    docs = frame([(7, text("c")), (7, text("c")), (None, text("a")), (None, text("a")), (None, None)])
    assert left(line_dedup.drop_lines(spark, docs, "")) == sorted([(7, text("c")), (None, text("a")), (None, None)], key=str)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for name, function in corpus_pipeline.STAGES:
        kept = function(spark, docs, FOLDER).cache()
        left = {r["doc_id"] for r in kept.collect()}
        assert left <= ids
        if name == "quality_classifier":
            assert all(labels[i] == 0 for i in ids - left if i in labels)
        if name == "jaccard_join":
            groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs, ngram=5, percent=80).collect()}
            assert left == {min(i for i in groups if groups[i] == c) for c in set(groups.values())}
        if name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert left == {i for i, _, hit, _ in brute_windows(texts, items) if not hit}
        if name == "packing":
            assert left == ids
        else:
            assert kept.columns == columns
        docs, ids = kept, left
    rows = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in rows.collect()} == ids


def test_pipeline_keeps_one_stages_tables_at_a_time(spark, monkeypatch):
    """Before a stage only the documents it reads are left of the run; after the last one only the result."""
    seen, before = [], set(staging.staged_paths(spark))

    def watched(name, function):
        def run(session, docs, sf_dir):
            found = function(session, docs, sf_dir)
            seen.append((name, [p for p in staging.staged_paths(session) if p not in before]))
            return found
        return name, run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*step) for step in corpus_pipeline.STAGES])
    rows = corpus_pipeline.run(spark, FOLDER)
    for (name, paths), (last, _) in zip(seen[1:], seen):
        assert [p for p in paths if "/pipeline_" in p and f"/pipeline_{last}-" not in p] == []
        mine = {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in paths}
        assert name == "line_dedup" or "line_texts" not in mine
    left = [p for p in staging.staged_paths(spark) if p not in before]
    assert len(left) == 1 and "/pipeline_packing-" in left[0] and rows.count() > 0


def test_index_segments_take_bounded_memory(monkeypatch):
    class Task:
        get = staticmethod(lambda: Task)
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(decontaminate, "TaskContext", Task)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randint(0, 30_000)}" for _ in range(300)) for _ in range(5_000)]  # 10 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    tracemalloc.start()
    words = sum(sum(segment.column("lengths")[0].as_py()) for segment in decontaminate._segments(13)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert words == 300 * 5_000
    assert peak < 12 << 20  # 28 MB with blocks of 4 MB

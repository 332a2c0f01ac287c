"""The line field in pieces against the whole chain, its memory, its sample and its line labels."""

import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from basketlab.llm import line_crf
from tests.llm.brute import ODD, odd_frame

TEXTS = [None, "", "one", "a b\n\nC!! 12\na b\n", "\n" * 40, "\n".join(f"line {k % 7} of #{k}\t!" for k in range(90)), "x" * 500, "é\nß 日本\nx"]


def features(texts):
    pieces = list(line_crf.line_features(pa.array(texts, pa.string())))
    return pieces[0][0], np.concatenate([p[1] for p in pieces]), np.concatenate([p[2] for p in pieces])


@pytest.mark.parametrize("piece", [1, 2, 7, 50])
def test_features_do_not_depend_on_pieces(monkeypatch, piece):
    whole = features(TEXTS)
    monkeypatch.setattr(line_crf, "PIECE_LINES", piece)
    for a, b in zip(whole, features(TEXTS)):
        assert a.shape == b.shape and (a == b).all()
    assert whole[0].sum() == len(whole[1]) == sum((t or "").count("\n") + 1 for t in TEXTS)


@pytest.mark.parametrize("n", [1, 2, 5, 8, 9, 63, 64, 65, 1000])
def test_pieces_of_a_chain_give_the_whole_chains_marginals(n):
    rng = np.random.default_rng(n)
    scores, moves = rng.normal(0, 3, n), rng.normal(0, 1.5, (2, 2))
    whole, _ = line_crf.chain_marginals(scores, np.array([n]), moves)
    for cut in (1, 2, 8, 64, 2000):
        assert np.allclose(line_crf.long_marginals(scores, moves, cut), whole, atol=1e-12)


def test_scores_do_not_depend_on_pieces(spark, monkeypatch):
    rng = np.random.default_rng(4)
    weights, moves = rng.normal(0, 1, 48), rng.normal(0, 1, (2, 2))
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(TEXTS)), pa.int64()), pa.array(TEXTS, pa.string())], names=["doc_id", "text"])
    score = line_crf._score(weights, moves, 0.3)
    whole = np.concatenate([b.column(1).to_numpy() for b in score([docs])])
    for name, value in (("PIECE_LINES", 7), ("LONG_CHAIN", 5), ("CHAIN_PIECE", 4)):
        monkeypatch.setattr(line_crf, name, value)
    assert np.allclose(np.concatenate([b.column(1).to_numpy() for b in score([docs])]), whole, atol=1e-12)


def test_millions_of_lines_stay_in_bounds():
    """Four megabytes of line ends and many short lines, scored below one gigabyte."""
    code = (
        "import numpy as np, pyarrow as pa, resource; from basketlab.llm import line_crf\n"
        "rng = np.random.default_rng(1); texts = pa.array(['\\n' * (4 << 20), 'a b\\n' * (1 << 18)])\n"
        "batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), texts], names=['doc_id', 'text'])\n"
        "found = [b.to_pydict() for b in line_crf._score(rng.normal(0, 1, 48), rng.normal(0, 1, (2, 2)), 0.3)([batch])]\n"
        "assert sum(len(b['score']) for b in found) == 2\n"
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 1_000_000  # kilobytes


def test_a_sampled_id_on_many_rows_is_one_document(spark):
    docs = [(1, "good text of one line")] * 300 + [(1, "a")] + [(k, f"{'fine words here' if k % 2 else '### 12 !!'} {k}\nline") for k in range(2, 60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    once = spark.createDataFrame([(1, "a")] + docs[301:], "doc_id long, text string")
    for a, b in zip(line_crf.train(frame, labels), line_crf.train(once, labels)):
        assert np.allclose(a, b)


def test_lines_are_labelled(spark):
    labels = spark.createDataFrame([(i, 0 if i in (7, 8, 12) else 1) for i, _ in ODD if i], "doc_id long, quality int")
    model = line_crf.train(odd_frame(spark), labels)
    found = line_crf.label_lines(odd_frame(spark), model).collect()
    assert len(found) == sum((t or "").count("\n") + 1 for _, t in ODD)
    assert all(r["good"] == (r["probability"] >= 0.5) and 0 <= r["probability"] <= 1 for r in found)
    assert sorted(r["line_no"] for r in found if r["doc_id"] == 15) == [0, 1, 2]

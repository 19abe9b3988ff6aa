import random

import numpy as np
import pytest
from llm import brute

from wattloom.llm import backoff, queries


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, order):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["the", "The", "of", "cat", "dog", "é", "x"]) for _ in range(rng.randrange(12))) for _ in range(40)]
    texts += [None, "", " \n", "the", texts[3], "the " * 3000]
    data = [(i, t, "extra", 5.0) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(data, "doc_id long, text string, grp string, n_words double").repartition(3)
    found = {r["doc_id"]: r for r in backoff.scores(frame, order=order).collect()}
    for number, score in enumerate(brute.backoff(texts, order)):
        assert found[number]["log_score"] == pytest.approx(score, rel=1e-9, abs=1e-9)
        assert found[number]["n_words"] == len(brute.blank_words(texts[number]))
        assert (found[number]["per_word"] is None) == (found[number]["n_words"] == 0)


def test_repeated_rows_missing_ids_and_no_rows(spark):
    data = [(1, "a b c"), (1, "a b c"), (None, "a b"), (None, None)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    assert backoff.scores(frame).count() == 4
    assert backoff.scores(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        backoff.scores(frame, order=0)


def test_registered_query_scores_with_trigrams(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    found = {r["doc_id"]: r["log_score"] for r in queries.op4_backoff_scores(spark, sf_dir).collect()}
    for row, score in zip(rows, brute.backoff([r["text"] for r in rows], 3)):
        assert found[row["doc_id"]] == pytest.approx(score, rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("hashes", [[], [0], [5, 6, 1 << 63, (1 << 64) - 1]])
def test_packed_hashes(hashes):
    ordered = np.array(hashes, np.uint64)
    assert backoff.unpacked_hashes(backoff.packed_hashes(ordered)).tolist() == hashes


@pytest.mark.parametrize("value", [b"", b"a", "é\n".encode() * 5000])
def test_squeezed_bytes(value):
    assert backoff.expanded(backoff.squeezed(value)) == value


def test_what_is_sent_takes_the_room_of_its_entropy():
    # repeats alone, as shuffles compress, leave six bytes of a hash and two thirds of a text
    rng = np.random.default_rng(3)
    words = np.array(["the", "model", "river", "of", "green", "data", "walks", "and"])
    text = " ".join(rng.choice(words, 2000)).encode()
    hashes = np.unique(rng.integers(0, 1 << 63, 30_000).astype(np.uint64))
    assert len(backoff.squeezed(text)) < len(text) / 2
    assert len(backoff.packed_hashes(hashes)) < 6.5 * len(hashes)
    counts = rng.choice([1, 2, 3], 30_000, p=[0.94, 0.05, 0.01]).astype(np.int32)
    assert len(backoff.planes(counts)) < len(counts) / 8

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import brute

from wattloom.llm import periodic, queries


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=50), max_size=4))
def test_runs_equal_brute_force(texts):
    words = [[str(w).encode() for w in text] for text in texts]
    assert periodic.text_runs(words) == [brute.runs(text) for text in words]


@pytest.mark.parametrize("letters", [1, 2, 5, 40])
def test_planted_periods(letters):
    rng = random.Random(21)
    for _ in range(60):
        n = rng.randrange(1, 200)
        words = [str(rng.randrange(letters)).encode() for _ in range(n)]
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randrange(3, 9)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        assert periodic.text_runs([words, words[::-1]]) == [brute.runs(words), brute.runs(words[::-1])]


def test_reach_over_long_stretches():
    words = np.array([*range(50), *([7, 8, 9] * 4000), 1, *range(100, 150)])
    assert periodic.runs_of(words) == [(50, 12_000, 3)]
    assert periodic.runs_of(np.zeros(30_000, np.int64)) == [(0, 30_000, 1)]
    assert periodic.runs_of(np.zeros(5, np.int64)) == []
    assert periodic.runs_of(np.zeros(0, np.int64)) == []


def test_rows(spark):
    data = [(1, "a " * 6), (1, "a " * 6), (None, "x y " * 4), (2, None), (3, ""), (4, "\t\n "), (5, "a b c"), (6, "É é  É é  É é  É é ")]
    data += [(7, "one two three " * 40_000)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in data], "doc_id long, text string, runs int, n_words string")
    found = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(docs).collect()), key=repr)
    expected = []
    for i, text in data:
        words = brute.blank_words(text)
        runs = brute.runs(words) if i != 7 else [(0, 120_000, 3)]
        expected.append((i, len(words), runs, brute.collapsed(words, runs)))
    assert found == sorted(expected, key=repr)
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_the_strongest_run_is_the_first_of_equal_ones(spark):
    text = "a a a a a a x b b b b b b y c d c d c d c d c d c d"
    docs = spark.createDataFrame([(1, text), (2, "plain")], "doc_id long, text string")
    found = {r["doc_id"]: r["strongest"] for r in periodic.with_strongest(periodic.periodic_runs(docs)).collect()}
    assert tuple(found[1]) == (0, 6, 1)
    assert found[2] is None


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = {r["doc_id"]: r.asDict() for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert found.keys() == {r["doc_id"] for r in rows}
    planted = 0
    for row in rows:
        words = brute.planted(row["doc_id"], brute.blank_words(row["text"]))
        # a distance of more than a quarter of the text is no period
        runs = brute.runs(words) if len(words) < 1500 else None
        mine = found[row["doc_id"]]
        if runs is None:
            continue
        planted += bool(runs)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        assert mine == {
            "doc_id": row["doc_id"],
            "n_runs": len(runs),
            "start": best[0],
            "length": best[1],
            "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            "collapsed_sha256": sha256(brute.collapsed(words, runs).encode()).hexdigest(),
        }
    assert planted > 10


def test_planting_of_odd_documents(spark):
    data = [(i, t) for i in range(200) for t in ("", None, "a", "a b c d e f g", " é\x0b\tb  c ")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = sorted(((r["doc_id"], r["text"]) for r in queries.with_planted_runs(docs).collect()), key=repr)
    expected = []
    for i, text in data:
        words = brute.blank_words(text)
        changed = brute.planted(i, words)
        expected.append((i, " ".join(changed) if words and zlib.crc32(str(i).encode()) % 10 == 0 else text))
    assert found == sorted(expected, key=repr)

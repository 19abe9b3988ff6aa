import random

import numpy as np
import pytest
from llm import brute

from wattloom.llm import ball_search, queries
from wattloom.llm.ball_search import BallTree, Rows


def random_rows(rng, n, n_terms):
    sizes = [rng.randrange(1, 12) for _ in range(n)]
    terms = [t for size in sizes for t in sorted(rng.sample(range(n_terms), min(size, n_terms)))]
    sizes = [min(size, n_terms) for size in sizes]
    weights = [rng.choice([1, 5, 700_000, rng.randrange(1, 1_000_000)]) for _ in terms]
    return Rows(np.concatenate(([0], np.cumsum(sizes))), np.array(terms), np.array(weights))


@pytest.mark.parametrize("n", [1, 2, 7, 300])
def test_no_document_exceeds_its_nodes_bounds(n):
    rng = random.Random(41)
    rows = random_rows(rng, n, 30)
    tree = BallTree(rows, 30, leaf=4)
    query_rows = np.array([[rng.choice([0, 0, 3, 20_000]) for _ in range(30)] for _ in range(20)])
    bounds = tree.bounds(query_rows)
    below = {}
    for node in reversed(range(len(tree.children))):
        pair = tree.children[node]
        below[node] = tree.members[node].tolist() if pair is None else below[pair[0]] + below[pair[1]]
    assert sorted(below[0]) == list(range(n))
    for place, query in enumerate(query_rows):
        scores = rows.dot(query)
        for node, members in below.items():
            assert scores[members].max() <= bounds[node, place]


def test_walks_find_the_highest_and_leave_leaves_out():
    rng = random.Random(42)
    best, plain, scored, leaves = [[] for _ in range(30)], [[] for _ in range(30)], 0, 0
    # groups of vectors that differ in one weight, as copies do
    query_rows = np.array([[rng.choice([0] * 9 + [1000 * rng.randrange(1, 9)]) for _ in range(60)] for _ in range(30)])
    for shard in range(3):
        base = random_rows(rng, 40, 60)
        rows = base.take(np.repeat(np.arange(40), 10))
        rows.weights[rows.ends[:-1]] += np.array([rng.randrange(9) for _ in range(400)])
        ids = [1000 * shard + i if i % 50 else None for i in range(400)]
        tree = BallTree(rows, 60, leaf=8)
        bounds = tree.bounds(query_rows).T.tolist()
        leaves += len(tree.leaves) * 30
        for query, bound, heap, all_found in zip(query_rows, bounds, best, plain):
            scored += ball_search.search(tree, ids, query, bound, heap, 20)
            all_found += [(s, i is not None, -(i or 0)) for s, i in zip(rows.dot(query).tolist(), ids) if s > 0]
    for heap, all_found in zip(best, plain):
        assert sorted(heap) == sorted(sorted(all_found)[-20:])
    assert scored < 0.8 * leaves


def compare(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id string, text string, term string")
    found = sorted((tuple(r) for r in ball_search.ranked_documents(frame, asked, **options).collect()), key=repr)
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(brute.search_terms(text))
    expected = brute.search(docs, terms, options.get("top", 50))
    assert found == sorted(expected, key=repr)
    return found


@pytest.mark.parametrize("shard", [5, 64])
def test_results_equal_brute_force(spark, shard, monkeypatch):
    rng = random.Random(43)
    # workers see the module as it is on disk, so small shards come from few documents
    words = [f"w{i}" for i in range(40)] + ["É", "ß9"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 40)))) for i in range(shard * 20)]
    items = [(f"q{i}", " ".join(rng.choices(words + ["unseen"], k=rng.randrange(1, 12)))) for i in range(12)]
    compare(spark, docs, items, top=7)


def test_odd_rows(spark):
    text = "Alpha beta-GAMMA 42 É"
    docs = [(3, text), (3, text), (None, text), (1, text), (2, None), (4, ""), (5, " .,\n"), (6, "beta " * 50_000), (7, "delta")]
    items = [("a", "alpha GAMMA"), ("a", "beta"), (None, "42 é É"), ("none", None), ("empty", " ."), ("b", "zeta"), ("c", "delta delta")]
    found = compare(spark, docs, items)
    assert {r[0] for r in found} == {"a", None, "c"}
    compare(spark, docs, items, top=2)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "a")], "item_id string, text string")
    for some, asked in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0))):
        found = ball_search.ranked_documents(some, asked)
        assert found.collect() == []
        assert found.dtypes == [("item_id", "string"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_blocks_stay_within_their_bound():
    rng = random.Random(44)
    rows = [{"item_id": i, "terms": [f"t{t}" for t in rng.sample(range(60), rng.randrange(1, 20))]} for i in range(50)]
    for row in rows:
        row["weights"] = [rng.randrange(1, 99) for _ in row["terms"]]
    blocks = list(ball_search.blocks_of(iter(rows), cells=200))
    assert [item for block in blocks for item in block.items] == list(range(50))
    assert all(len(b.items) * len(b.terms) <= 200 or len(b.items) == 1 for b in blocks)
    names = {place: term for term, place in blocks[0].terms.items()}
    first = blocks[0].matrix()[0]
    assert {names[i].decode(): int(first[i]) for i in np.flatnonzero(first)} == dict(zip(rows[0]["terms"], rows[0]["weights"]))
    assert list(ball_search.blocks_of(iter([]))) == []


def test_several_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(45)
    docs = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(20))) for i in range(80)]
    items = [(f"q{i}", " ".join(f"w{rng.randrange(30)}" for _ in range(6))) for i in range(10)]
    whole = compare(spark, docs, items)
    small = ball_search.blocks_of
    monkeypatch.setattr(ball_search, "blocks_of", lambda rows: small(rows, cells=40))
    assert compare(spark, docs, items) == whole


def test_the_bitmap_lets_every_term_pass(spark):
    import xxhash

    terms = [f"term{i}" for i in range(5000)] + ["é", "0"]
    bits = ball_search.term_bitmap(spark.createDataFrame([(t,) for t in terms], "term string"))
    for term in terms:
        place = xxhash.xxh64_intdigest(term.encode(), 42) & (ball_search.FILTER_BITS - 1)
        assert bits[place >> 3] >> (place & 7) & 1
    assert np.unpackbits(bits).sum() <= len(terms)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = {r["item_id"]: set(brute.search_terms(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    found = sorted(tuple(r) for r in queries.op13_ranked_search(spark, sf_dir).collect())
    assert found == sorted(brute.search(docs, items))

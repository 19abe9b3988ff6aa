import random

import pytest
from llm import brute

from wattloom.llm import decontaminate as d

RNG = random.Random(9)
WORDS = ["the", "of", "and", "Cat", "dog2", "é", "x", "y", "日本"]


def words(n):
    return RNG.choice([" ", ", ", "\n"]).join(RNG.choice(WORDS) for _ in range(n))


ITEMS = [(i, words(RNG.randrange(1, 25))) for i in range(12)] + [(20, ""), (21, None), (22, "..."), (23, "unique"), (24, "the"), (3, words(11)), (None, words(12)), (None, "nameless")]


def documents():
    data = []
    for number in range(50):
        text = words(RNG.randrange(0, 60))
        for _ in range(RNG.randrange(3)):
            item = RNG.choice(ITEMS)[1] or ""
            text += " " + item[RNG.randrange(5) :].upper() + RNG.choice([" ", "_", "ß "]) + words(3)
        data.append((number, text))
    return data + [(103, "a nameless one"), (100, None), (101, ""), (None, ITEMS[0][1]), (5, data[6][1]), (5, data[6][1]), (102, "x y " * 60_000 + (ITEMS[1][1] or ""))]


def report(found):
    return sorted(((r["doc_id"], r["n_words"], d.hit_words(r["spans"]), r["items"]) for r in found.collect()), key=repr)


@pytest.mark.parametrize("block_words", [d.BLOCK_WORDS, 40])
def test_spans_equal_brute_force(spark, monkeypatch, block_words):
    monkeypatch.setattr(d, "BLOCK_WORDS", block_words)
    data = documents()
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in data], "doc_id long, text string, n_words int, items string").repartition(3)
    items = spark.createDataFrame([(i, t, "z") for i, t in ITEMS], "item_id long, text string, doc_id string")
    assert report(d.contamination(docs, items)) == sorted(((i, *brute.contamination(t, ITEMS)) for i, t in data), key=repr)
    clean = d.remove_contaminated(docs, items)
    kept = sorted(((i, t) for i, t in data if not brute.contamination(t, ITEMS)[1]), key=repr)
    assert clean.columns == docs.columns
    assert sorted([(r[0], r[1]) for r in clean.collect()], key=repr) == kept


def test_blocks_hold_every_window_of_their_items():
    block = d.Block.of([("a", b"one two three"), ("b", b"one two three"), ("c", b" ".join(b"w%d" % i for i in range(12)))])
    assert sorted(block.owners) == [["a", "b"], ["c"], ["c"], ["c"]]
    matcher = d.Matcher(block, {})
    assert len(matcher.codes) == len(block.owners)


def test_the_rarest_shingle_keys_a_window():
    block = d.Block.of([("a", b"the of the of rare word the of")])
    codes, _, offset = block.shingles()
    counts = {c: 1 if o == 4 else 1000 for c, o in zip(codes.tolist(), offset.tolist())}
    assert d.Matcher(block, counts).offset.tolist() == [4]


def test_nothing_to_compare(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert report(d.contamination(docs, none)) == [(1, 2, 0, []), (2, 0, 0, [])]
    assert d.remove_contaminated(docs, none).count() == 2
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert d.contamination(docs.limit(0), items).collect() == []
    found = d.contamination_report(d.contamination(docs, items)).collect()
    assert sorted((r["doc_id"], r["n_hit"], r["n_items"], r["contaminated"]) for r in found) == [(1, 2, 1, True), (2, 0, 0, False)]

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import brute
from pyspark.sql import functions as F

from wattloom.llm import simhash
from wattloom.llm.components import components


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abAÉé \n\x0b\x1c", max_size=60))
def test_fingerprints_equal_brute_force(text):
    assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


def clusters(rng, n=120):
    prints = [rng.getrandbits(64) for _ in range(8)]
    for _ in range(n - len(prints)):
        value = rng.choice(prints)
        for _ in range(rng.randrange(4)):
            value ^= 1 << rng.randrange(64)
        prints.append(value)
    return prints


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_trees_find_all_within_the_radius(radius):
    values = list(dict.fromkeys(clusters(random.Random(10))))
    tree = simhash.BKTree(values)
    for value in values[:40]:
        assert sorted(tree.within(value, radius)) == [i for i, v in enumerate(values) if (v ^ value).bit_count() <= radius]
    assert simhash.BKTree([]).within(3, 2) == []


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_groups_equal_brute_force(spark, radius):
    prints = {i: p for i, p in enumerate(clusters(random.Random(11), 200))}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    frame = spark.createDataFrame(signed, "doc_id long, fingerprint long")
    found = {r["doc_id"]: r["component_id"] for r in simhash.group_by_fingerprint(frame, radius).collect()}
    assert found == brute.groups(prints, radius)
    with pytest.raises(ValueError):
        simhash.links(frame, simhash.BANDS)


def test_chains_and_stars_are_components(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    frame = spark.createDataFrame(chain + star + [(7, 7), (3, 2)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(frame).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert components(frame.limit(0)).collect() == []


def test_rows_of_documents(spark):
    data = [(3, "a b c d"), (1, "A  b\nc d"), (2, None), (5, ""), (4, " \n"), (None, "a b c d"), (1, "A  b\nc d"), (9, "q w e r t"), (None, "lonely text here now")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in data], "doc_id long, text string, component_id string, fingerprint int")
    found = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_groups(docs).collect()), key=repr)
    assert found == sorted([(3, 1), (1, 1), (1, 1), (None, 1), (2, 2), (5, 2), (4, 2), (9, 9), (None, None)], key=repr)
    hexed = simhash.near_groups(docs).select("doc_id", simhash.hex16("fingerprint").alias("h")).filter("doc_id in (2, 9)").collect()
    assert {r[0]: r[1] for r in hexed} == {2: "0" * 16, 9: f"{brute.fingerprint('q w e r t'):016x}"}
    assert simhash.near_groups(docs.limit(0)).collect() == []


def single_rows(data, size=3, radius=2):
    """Positions of the rows that stay, by brute force; ``data`` is (id, text) of distinct ids."""
    prints = {i: brute.fingerprint(t, size) for i, t in data}
    return sorted(set(brute.groups(prints, radius).values()))


def test_one_of_each_group_stays(spark):
    rng = random.Random(12)
    bases = [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(80, 400))) for _ in range(40)]
    data = list(enumerate(bases))
    data += [(1000 + i, base.upper()) for i, base in enumerate(bases[:20])]
    # one changed word moves some bits, seldom more than the radius in long texts
    data += [(2000 + i, f"{base} x") for i, base in enumerate(bases)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in data], "doc_id long, text string, copy_key string").repartition(4)
    kept = simhash.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == single_rows(data)


def test_edges_of_copies(spark):
    text = " ".join(f"w{i}" for i in range(60))
    data = [(2, text), (2, text), (None, text), (7, None), (8, ""), (None, "only one"), (3, " ".join(f"v{i}" for i in range(100_000)))]
    # one id, two texts: each is judged in its own group
    data += [(2, "another text of this id"), (None, "lonely and twice"), (None, "lonely and twice")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("a.b", F.lit(1)).repartition(3)
    kept = sorted(((r[0], (r[1] or "")[:8]) for r in simhash.drop_copies(docs).collect()), key=repr)
    expected = [(2, text[:8]), (2, "another "), (7, ""), (None, "only one"), (None, "lonely a"), (3, "v0 v1 v2")]
    assert kept == sorted(expected, key=repr)
    assert simhash.drop_copies(docs.limit(0)).collect() == []


def test_a_chain_keeps_its_smallest(spark):
    data = [(i, "same text of every row here") for i in range(300)]
    assert [r[0] for r in simhash.drop_copies(spark.createDataFrame(data, "doc_id long, text string")).collect()] == [0]


def test_links_stay_few(spark):
    frame = spark.range(3000).select(F.col("id").alias("fingerprint"), F.col("id").alias("doc_id"))
    assert simhash.links(frame).count() < 15 * 3000

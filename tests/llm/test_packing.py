import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattloom.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=40), st.integers(1, 9))
def test_differencing_parts_all_pieces(lengths, windows):
    filled = packing.differencing(lengths, windows)
    assert sorted(i for pieces in filled for i in pieces) == list(range(len(lengths)))
    assert len(filled) == (windows if lengths else 0)


def test_differencing_by_hand():
    # the textbook case: 8 against 7 leaves 1, 6 against 5 leaves 1, then 4
    filled = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in pieces) for pieces in filled) == [14, 16]


def test_windows_are_nearly_equal():
    rng = random.Random(31)
    lengths = [rng.randrange(1, 900) for _ in range(2000)]
    sums = [sum(lengths[i] for i in pieces) for pieces in packing.differencing(lengths, 200)]
    assert max(sums) - min(sums) <= 20


def test_the_window_count_rises_until_all_fits():
    # no two fit together
    assert len(packing.windows_within([5] * 37, 8)) == 37
    assert len(packing.windows_within([8] * 5, 8)) == 5
    assert packing.windows_within([], 8) == []
    rng = random.Random(32)
    for _ in range(200):
        lengths = [rng.randrange(1, 65) for _ in range(rng.randrange(1, 60))]
        filled = packing.windows_within(lengths, 64)
        assert max(sum(lengths[i] for i in pieces) for pieces in filled) <= 64
        assert sorted(i for pieces in filled for i in pieces) == list(range(len(lengths)))


def check(pieces, documents, capacity, partitions=1):
    """``pieces`` are (doc, start, tokens, doc_tokens, sequence, offset); every token of
    ``documents`` lies in one, sequences are gapless, and padding is none."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, tokens, n, sequence, offset in pieces:
        assert n == len(documents[doc]) and len(tokens)
        by_doc[doc].append((start, tokens))
        by_sequence[sequence].append((offset, len(tokens)))
    assert by_doc.keys() == documents.keys()
    for doc, parts in by_doc.items():
        joined = []
        for start, tokens in sorted(parts):
            assert start == len(joined)
            joined.extend(tokens)
        assert joined == list(documents[doc])
    part_full = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
        part_full += at < capacity
    assert part_full <= partitions * capacity.bit_length()


@pytest.mark.parametrize("capacity", [1, 8, 64])
@pytest.mark.parametrize("group", [1, 4, 32])
def test_packer_keeps_every_token(capacity, group):
    rng = random.Random(33)
    for n in (0, 1, 5, 300):
        packer, rows = packing.Packer(capacity, group), []
        documents = {doc: list(range(rng.choice([1, rng.randrange(1, 20), rng.randrange(1, 4 * capacity + 1)]))) for doc in range(n)}
        for doc, tokens in documents.items():
            rows.extend(packer.add(doc, np.array(tokens, packing.TOKEN).tobytes()))
        rows.extend(packer.finish())
        check([(d, s, np.frombuffer(t, packing.TOKEN).tolist(), n, q, o) for d, s, _, t, n, q, o in rows], documents, capacity)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZéあ \n\x1c.'<|>😀9"), max_size=40), max_size=5))
def test_tokens_are_the_librarys(texts):
    library = Tokenizer.from_file(PATH)
    found = [np.frombuffer(t, packing.TOKEN).tolist() for t in packing.word_tokens(PATH).encode(texts)]
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_latin_pattern_finds_the_same_words():
    words = packing.word_tokens(PATH)
    rng = random.Random(34)
    letters = [chr(c) for c in range(256)]
    for _ in range(300):
        text = "".join(rng.choices(letters + ["'s", "'ll", " ", "ab"], k=60))
        assert words.latin.findall(text) == words.bpe.words.findall(text)


def test_special_tokens_and_a_small_cache(monkeypatch):
    library = Tokenizer.from_file(PATH)
    special = next(iter(library.get_added_tokens_decoder().values())).content
    monkeypatch.setattr(packing, "WORDS", 3)
    encoder = packing.WordTokens(PATH)
    for text in ("one two", f"one {special} two{special}three", "one two three four five", special, f"{special} {special}"):
        [tokens] = encoder.encode([text])
        assert np.frombuffer(tokens, packing.TOKEN).tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows(spark):
    data = [(1, "one two"), (1, "one two"), (None, "no id"), (2, None), (3, ""), (4, "word " * 30_000), (5, " \n")]
    docs = spark.createDataFrame([(i, t, "x", 9) for i, t in data], "doc_id long, text string, tokens string, sequence_id int").repartition(2)
    found = packing.pack_documents(docs, PATH, capacity=64, group_windows=4).collect()
    library = Tokenizer.from_file(PATH)
    wanted = sorted(([*library.encode(t or "", add_special_tokens=False).ids, packing.END] for _, t in data), key=repr)
    # rows that share an id are told apart by where their pieces lie
    assert sum(r["length"] for r in found) == sum(map(len, wanted))
    assert sum(r["start"] == 0 for r in found) == len(data)
    single = [r for r in found if r["doc_id"] in (None, 2, 3, 4, 5)]
    documents = {i: [*library.encode(t or "", add_special_tokens=False).ids, packing.END] for i, t in data if i != 1}
    joined = defaultdict(list)
    for r in sorted(single, key=lambda r: r["start"]):
        assert r["start"] == len(joined[r["doc_id"]]) and r["doc_tokens"] == len(documents[r["doc_id"]])
        joined[r["doc_id"]].extend(np.frombuffer(r["tokens"], packing.TOKEN).tolist())
    assert joined == documents
    assert packing.pack_documents(docs.limit(0), PATH).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(docs, PATH, capacity=100)


def test_a_partition_that_runs_again_packs_the_same(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), (F.col("id") % 90).cast("int")).alias("text"))
    ordered, mixed = (packing.pack_documents(frame, PATH).collect() for frame in (docs.coalesce(1), docs.coalesce(1).orderBy(F.rand(3)).coalesce(1)))
    assert ordered == mixed


def test_query_equals_the_library(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    library = Tokenizer.from_file(PATH)
    documents = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in rows}
    found = queries.op11_packed_windows(spark, sf_dir).collect()
    pieces = []
    for r in found:
        tokens = documents[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(tokens, "<u4").tobytes()) == r["ids_crc32"]
        pieces.append((r["doc_id"], r["start"], tokens, r["doc_tokens"], r["sequence_id"], r["offset"]))
    check(pieces, documents, 4096)

import random
from hashlib import sha256

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wattloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
HARD = [
    "", "  ", "a", "It's we'll DON'T 'S", "ΑΣ ΣΑΣ Σ", "İstanbul ǅ", "é e\u0301 ａ ﬁ", "<|endoftext|> a<|startoftext|>b<|ENDOFTEXT|>",
    "x" * 3000, "ab" * 500, "日本語 텍스트 🎉🎉", "\x00\x01 \x85\xa0 a\u200bb", "12345 ½ ²³ ٣", "ß ẞ µ ª", "<|endoftext|", "..\x1c.. \x85x",
    "Σ\x1cΣΑ \x1d", "\x00<|endoftext|>", "नमस्ते", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
]


@pytest.fixture(scope="module")
def own():
    return bpe.word_bpe(PATH)


def agrees(own, texts):
    for text, pieces in zip(texts, own.pieces(texts)):
        ids = LIBRARY.encode(text, add_special_tokens=False).ids
        assert [int(i) for p in pieces for i in p[1].split()] == ids == own.encode(text)
        assert own.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == " ".join(p[2] for p in pieces if p[0])


def test_hard_texts(own):
    agrees(own, HARD)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    agrees(bpe.word_bpe(PATH), [text])


def test_single_and_joint_merges_agree(own):
    rng = random.Random(15)
    words = ["".join(rng.choice("etaoinshr日é") for _ in range(rng.randrange(1, 90))) for _ in range(400)]
    assert own.merge_all(words) == [own.merge(word) for word in words]


def test_a_small_cache_changes_nothing(own, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 3)
    agrees(own, HARD[:8] + ["one two three four", "two three five"])


def test_tree_roots():
    tree = bpe.PairTree([5, 3, 9, 3, 9], 9)
    assert tree.leftmost() == 1
    tree.set(1, 9)
    assert tree.leftmost() == 3
    tree.set(3, 9)
    tree.set(0, 9)
    assert tree.leftmost() == -1


def test_documents(spark):
    data = [(i, t, "x") for i, t in enumerate(HARD)] + [(None, "a b", "x"), (1, "a b", "x"), (1, "a b", "x"), (99, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string").repartition(3)
    encoded = {(r["doc_id"], r["decoded"]): r["ids"] for r in bpe.encode_documents(docs, PATH).collect()}
    digests = bpe.encoding_digests(docs, PATH).collect()
    assert len(digests) == len(data)
    for r in digests:
        ids = next(v for (i, d), v in encoded.items() if i == r["doc_id"] and sha256(d.encode()).hexdigest() == r["decoded_sha256"])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
    for i, text in enumerate(HARD):
        wanted = LIBRARY.encode(text, add_special_tokens=False).ids
        assert wanted in [ids for (number, _), ids in encoded.items() if number == i]
    assert encoded[(99, "")] == []
    assert bpe.encode_documents(docs.limit(0), PATH).collect() == [] == bpe.encoding_digests(docs.limit(0), PATH).collect()

import random

import numpy as np
import public_tokenizers
import pytest
from conftest import rows

from wattloom.llm import token_files as t
from wattloom.llm.chat import byte_encoding

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def write(path, lengths, tail=0):
    rng = np.random.default_rng(16)
    parts = [np.append(rng.integers(0, 50_000, n), t.SEPARATOR) for n in lengths] + [rng.integers(0, 50_000, tail)]
    np.concatenate(parts).astype(t.TYPE).tofile(path)


@pytest.mark.parametrize("block", [1, 3, 7, 64, 1 << 19])
def test_lengths_across_blocks(spark, folder, monkeypatch, block):
    monkeypatch.setattr(t, "RUN_BLOCKS", 4)
    rng = random.Random(block)
    files = {f"f{i}": [rng.choice([0, 0, 1, 2, 5, 90]) for _ in range(rng.randrange(1, 12))] for i in range(4)}
    tails = {"f0": 0, "f1": 9, "f2": 1, "f3": 0}
    for name, lengths in files.items():
        write(f"{folder}/{name}", lengths, tails[name])
    write(f"{folder}/only", [], 40)
    open(f"{folder}/empty", "w").close()
    found = t.document_lengths(t.read_flat_files(spark, folder, block))
    expected = [(name, at, n, True) for name, lengths in files.items() for at, n in enumerate(lengths)]
    expected += [(name, len(files[name]), n, False) for name, n in tails.items() if n] + [("only", 0, 40, False)]
    got = [(r[0].rsplit("/", 1)[1], *r[1:]) for r in found.select("file", "ordinal", "n_tokens", "closed").collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("block", [2, 50, 1 << 19])
def test_documents(spark, block):
    texts = ["hello there", "", None, "<|endoftext|> a", "é 日本 " * 50, "x" * 3000, "hello there"]
    data = [(i, text, "f", b"x") for i, text in enumerate(texts)] + [(None, "no id", "f", b"x"), (3, "again", "f", b"x"), (3, "again", "f", b"x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, file string, tokens binary").repartition(3)
    found = t.document_lengths(t.flatten_documents(docs, RANKS, block_tokens=block))
    encoding, _ = byte_encoding(RANKS)
    expected = sorted([(i, len(encoding.encode_ordinary(text or ""))) for i, text, *_ in data], key=repr)
    assert rows(found, "doc_id", "n_tokens") == expected
    assert t.document_lengths(t.flatten_documents(docs.limit(0), RANKS)).collect() == []

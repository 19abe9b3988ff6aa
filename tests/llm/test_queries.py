from hashlib import sha256

import public_tokenizers
import pytest
from llm import brute
from tokenizers import Tokenizer

import __spark_entry__ as spark_entry
from wattloom.llm import queries
from wattloom.llm.chat import byte_encoding
from wattloom_checks.compare import connect, same


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert queries.QUERIES.keys() | {"pipeline"} <= spark_entry.queries().keys()


# these return pieces of documents and rows of items
OTHER_ROWS = ("op11_packed_windows", "op13_ranked_search")


@pytest.mark.parametrize("name", [name for name in queries.QUERIES if name not in OTHER_ROWS])
def test_query_returns_a_row_per_input_row(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    found = spark_entry.queries()[name](spark, sf_dir)
    if name == "op2_chat_masks":
        expected = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count() + 1
    else:
        expected = spark.read.parquet(f"{sf_dir}/{'pages' if name == 'op6_url_reputation' else 'documents'}.parquet").count()
    assert found.count() == expected


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_its_sql(spark, name):
    sf_dir = "/root/testdata/sf0.001"
    equal, detail = same(spark_entry.queries()[name](spark, sf_dir), connect(sf_dir).sql(spark_entry.oracle_sql()[name]))
    assert equal, detail


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def results(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()}


def test_suffix_repeats_equal_brute_force(spark, documents):
    flags = brute.repeats(documents)
    found = results(spark, "op1_suffix_repeats")
    for number, text in documents:
        row = found[number]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["kept_sha256"]) == brute.repeats_row(text, flags[number, text])


def test_quality_counts_equal_brute_force(spark, documents):
    found = results(spark, "op5_quality_rules")
    for number, text in documents:
        row, (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) = found[number], brute.counts(text)
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)
        assert row["base_failed"] == (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
        assert not (row["base_failed"] and row["kept"])


def test_simhash_groups_equal_brute_force(spark, documents):
    prints = {number: brute.fingerprint(text) for number, text in documents}
    found = results(spark, "op8_simhash_groups")
    assert {n: r["fingerprint"] for n, r in found.items()} == {n: f"{p:016x}" for n, p in prints.items()}
    assert {n: r["component_id"] for n, r in found.items()} == brute.groups(prints, 2)


def test_word_bpe_equals_the_library(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = results(spark, "op9_word_bpe")
    for number, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        row = found[number]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_token_counts_equal_the_encoding(spark, documents):
    encoding, _ = byte_encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    found = results(spark, "op10_token_counts")
    assert {n: r["n_tokens"] for n, r in found.items()} == {n: len(encoding.encode_ordinary(text or "")) for n, text in documents}

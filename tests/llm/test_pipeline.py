import corpus_pipeline
import public_tokenizers
from llm import brute
from tokenizers import Tokenizer

SF_DIR = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, folder):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    docs, tables = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        tables[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
    raw = {r["doc_id"]: r for r in documents.collect()}
    good, single, cut, clean, encoded = tables.values()
    for number, row in raw.items():
        n_words, _, _, _, repeats = brute.counts(row["text"])
        if n_words < 50 or 100 * repeats > 50 * n_words:
            assert number not in good
    prints = {number: brute.fingerprint(row["text"]) for number, row in good.items()}
    assert set(single) == set(brute.groups(prints, 2).values())
    flags = brute.repeats([(number, row["text"]) for number, row in single.items()])
    assert set(cut) == set(single)
    for number, row in single.items():
        kept = bytes(b for b, gone in zip(row["text"].encode(), flags[number, row["text"]]) if not gone)
        # bytes of a character that is only partly repeated stay
        assert len(cut[number]["text"].encode()) - len(kept) in range(0, 4 * 2 * 60)
        assert cut[number]["text"].encode() == kept or len(kept) < len(row["text"].encode())
        assert cut[number]["n_chars"] == len(cut[number]["text"])
    assert set(clean) == {number for number, row in cut.items() if not brute.contamination(row["text"], items)[1]}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(encoded) == set(clean)
    for number, row in encoded.items():
        assert row["ids"] == library.encode(clean[number]["text"], add_special_tokens=False).ids
        assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False)


def test_run_and_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(80))
    data = [(1, words, "en", None, 5), (1, words, "en", None, 5), (None, "x " + words, None, None, None), (2, None, None, None, None), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").withColumnRenamed("source", "kept")
    docs = docs.selectExpr("*", "'clash' as grp", "1 as doc_key")
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.limit(0)):
            found = stage(spark, some, SF_DIR)
            assert found.count() <= some.count()
            if name != "bpe_encoding":
                assert found.columns == docs.columns
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "ids", "decoded"]

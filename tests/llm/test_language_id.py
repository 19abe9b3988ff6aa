import numpy as np
import pytest

from wattloom.llm import language_id

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def test_a_filter_forgets_no_ngram():
    rng = np.random.default_rng(6)
    grams = {name: rng.integers(0, 1 << 62, 5000, dtype=np.uint64) for name in ("aa", "bb", "cc")}
    learned = language_id.LanguageFilter.of(grams)
    for bit, name in enumerate(sorted(grams)):
        assert ((learned.masks(grams[name])[0] >> np.uint64(bit)) & np.uint64(1)).all()
    (absent,) = learned.masks(rng.integers(0, 1 << 62, 200_000, dtype=np.uint64))
    for bit in range(3):
        rate = ((absent >> np.uint64(bit)) & np.uint64(1)).mean()
        assert rate == pytest.approx(learned.false_rate[bit], abs=3e-4)


def test_more_than_64_languages():
    grams = {f"l{i:03d}": np.arange(i * 50, i * 50 + 50, dtype=np.uint64) for i in range(130)}
    learned = language_id.LanguageFilter.of(grams)
    for number in (0, 63, 64, 129):
        masks = learned.masks(grams[f"l{number:03d}"])
        assert masks.shape == (3, 50) and ((masks[number // 64] >> np.uint64(number % 64)) & np.uint64(1)).all()


def test_ngrams_hold_letters_and_edges_only():
    codes = language_id.ngrams(language_id._points("Ab, é"))[0]
    same = language_id.ngrams(language_id._points("aB..é"))[0]
    assert sorted(codes) == sorted(same) and len(codes) > 0
    assert len(language_id.ngrams(language_id._points("12 #"))[0]) == 0


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(DOCUMENTS)
    learned = language_id.learn(documents.filter(~language_id.held_out()))
    predicted = language_id.identify(documents.filter(language_id.held_out()), learned)
    joined = predicted.join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(joined) > 150
    assert np.mean([r["lang"] == r["lang_pred"] for r in joined]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in joined)


def test_edges(spark):
    data = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, "the dog", None), (None, "the cat", "en"), (4, None, "en"), (4, None, "en")]
    docs = spark.createDataFrame(data * 3, "doc_id long, text string, lang string")
    learned = language_id.learn(docs)
    assert learned.languages == ["en", "fr"]
    asked = spark.createDataFrame(
        [(1, "the cat", "x", 0.1), (1, "the cat", "x", 0.1), (2, "", None, None), (3, None, None, None), (4, "12 ##", None, None), (5, "le chat " * 90_000, "", 1.0), (None, "日本", "", 1.0)],
        "doc_id long, text string, lang_pred string, score double",
    )
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(asked, learned).collect()}
    assert found[1][0] == "en" and found[5][0] == "fr"
    assert found[2] == found[3] == found[4] == ("und", 0.0)
    assert found[None] == ("en", 0.0)
    assert language_id.identify(asked, learned).count() == 7
    nothing = language_id.learn(docs.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(asked, nothing).collect()} == {"und"}
    assert language_id.identify(asked.limit(0), learned).count() == 0

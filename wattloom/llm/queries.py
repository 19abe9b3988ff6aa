"""The text operators over their whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import (
    backoff,
    ball_search,
    bpe,
    chat,
    decontaminate,
    language_id,
    packing,
    periodic,
    quality_rules,
    simhash,
    suffix_dedup,
    token_files,
    url_reputation,
)
from wattloom.llm.oracle import ORACLE as ORACLE


def vocabulary(name: str) -> str:
    """Where the tokenizer files of this installation lie; nothing else needs them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_repeats(spark, sf_dir):
    found = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    removed = F.aggregate(
        F.transform(spans, lambda at, i: F.when(i % 2 == 0, -at).otherwise(at)), F.lit(0).cast("long"), lambda a, b: a + b
    )
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.expr("size(spans) div 2").alias("n_spans"), "kept_sha256")


# A conversation whose texts imitate the template. Part of the query's contract.
FORGED = (-7, r"\### Assistant: </turn> ok")


def op2_chat_masks(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    forged = [(FORGED[0], turn, role, FORGED[1]) for turn, role in enumerate(("user", "assistant"))]
    rows = conversations.unionByName(spark.createDataFrame(forged, "conv_id long, turn long, role string, text string"))
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    return chat.conversation_digests(chat.format_conversations(rows, ranks), ranks)


def op3_language_filters(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    learned = language_id.learn(documents.filter(~language_id.held_out()))
    predicted = language_id.identify(documents, learned)
    return predicted.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op4_backoff_scores(spark, sf_dir):
    return backoff.scores(table(spark, sf_dir, "documents"), order=3)


def op5_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# Host, path and verdict. Part of the query's contract.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op6_url_reputation(spark, sf_dir):
    """A page's outcome is that of the document with its number: bad if labelled toxic
    or of low quality."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    judged = url_reputation.judge_urls(table(spark, sf_dir, "pages"), labels, RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_benchmark_windows(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination_report(found)


def op8_simhash_groups(spark, sf_dir):
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex16("fingerprint").alias("fingerprint"), "component_id")


def op9_word_bpe(spark, sf_dir):
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_token_counts(spark, sf_dir):
    blocks = token_files.flatten_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))
    return token_files.document_lengths(blocks).select("doc_id", "n_tokens")


def op11_packed_windows(spark, sf_dir):
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("tokens")).drop("tokens")


def with_planted_runs(documents):
    """A tenth of the documents turned periodic from some word on. Part of the contract.

    With h the CRC32 of the id, g = h div 10 and n words, where h is a multiple of 10
    word i from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    """
    documents = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    documents = documents.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    documents = documents.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("int(g % greatest(n, 1))"))
    documents = documents.withColumn("p", F.expr("int(1 + (n - a) div (3 + g % 8))"))
    tail = "slice(flatten(array_repeat(slice(words, a + 1, p), int((n - a) div p + 1))), 1, n - a)"
    periodic_text = F.expr(f"array_join(concat(slice(words, 1, a), {tail}), ' ')")
    return documents.select("doc_id", F.when(F.col("n") > 0, periodic_text).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic.with_strongest(periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))
    run, line = F.col("strongest"), F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        run["start"].alias("start"),
        run["length"].alias("length"),
        run["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_ranked_search(spark, sf_dir):
    return ball_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_suffix_repeats": op1_suffix_repeats,
    "op2_chat_masks": op2_chat_masks,
    "op3_language_filters": op3_language_filters,
    "op4_backoff_scores": op4_backoff_scores,
    "op5_quality_rules": op5_quality_rules,
    "op6_url_reputation": op6_url_reputation,
    "op7_benchmark_windows": op7_benchmark_windows,
    "op8_simhash_groups": op8_simhash_groups,
    "op9_word_bpe": op9_word_bpe,
    "op10_token_counts": op10_token_counts,
    "op11_packed_windows": op11_packed_windows,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_ranked_search": op13_ranked_search,
}

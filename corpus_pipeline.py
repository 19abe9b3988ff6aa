"""From raw documents to encoded training text, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import bpe, decontaminate, quality_rules, simhash, suffix_dedup
from wattloom.llm.common import ensure_scratch
from wattloom.llm.queries import table, vocabulary
from wattloom.session import scratch_path


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, calibrated on the labels, keep.

    NULL, empty and short texts go by the base rule. Repeated rows are judged one by one;
    rows without an id are judged but have no label. Without labels the base rule alone
    rejects. No rows give none; other columns stay as they are.
    """
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours: three-word shingles, two bits.

    The smallest id stays, of rows with one id the one with the smallest digest of its
    text, of equal rows one. Rows without an id stay only if their group has no other;
    NULL, empty and wordless texts are one group.
    """
    return simhash.drop_copies(docs, size=3, radius=2)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occurred in an earlier document cut out of later ones.

    Every row stays, NULL texts as NULL. Rows equal in id and text are one document;
    rows without an id come before all others.
    """
    cut = suffix_dedup.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs.

    Documents without words stay; repeated rows are judged one by one; items without an
    id count, items without words match nothing.
    """
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` text of what is left; NULL encodes as empty,
    repeated rows give a row each."""
    return bpe.encode_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", good_documents),
    ("simhash_near_dedup", without_near_copies),
    ("suffix_array_dedup", without_repeats),
    ("benchmark_decontamination", without_benchmarks),
    ("bpe_encoding", encoded),
]

# Binomial bounds, min-hash sketches and BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them lie in the scratch folder."""
    ensure_scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{scratch_path(spark, f'pipeline-{name}')}/{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Bucketed tables: stored by key, so that joins and merges leave them where they are.

A table is dealt to a fixed number of buckets by its key and sorted there. Two tables
with the same keys and number of buckets join without a shuffle, and a merge shuffles
its source only. Buckets live in the catalog, so such tables have a name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators.tables import checked_source, conform
from wattloom.schemas import Dataset


def save_bucketed(df: DataFrame, dataset: Dataset, name: str, buckets: int, path: str | None = None) -> None:
    """Store ``df`` as the catalog table ``name``, in ``buckets`` by the dataset's key.

    Each bucket is written by one task, so choose their number for some hundred MB each,
    and the same one for all tables that meet. ``path`` places the files; without it
    they lie in the warehouse. An older table of that name is replaced.
    """
    _save(conform(df, dataset).repartition(buckets, *dataset.key), dataset, name, buckets, path)


def _save(dealt: DataFrame, dataset: Dataset, name: str, buckets: int, path: str | None) -> None:
    """Write rows whose tasks hold whole buckets already."""
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *dataset.key).sortBy(*dataset.key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_bucketed(spark: SparkSession, dataset: Dataset, name: str) -> DataFrame:
    return spark.table(name).select(*dataset.columns)


def join_bucketed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """An equi join that sorts and merges buckets instead of copying a side."""
    return left.join(right.hint("merge"), list(keys), how)


def merge_bucketed(
    spark: SparkSession, source: DataFrame, dataset: Dataset, name: str, into: str, updates: Sequence[str], buckets: int, path: str | None = None
) -> None:
    """``tables.merged`` of ``source`` into the bucketed table ``name``, stored as ``into``.

    Buckets cannot be replaced one by one, so the result is a new table, which readers
    take up by its name. Only the source is shuffled, to the buckets of the stored side,
    which stays where it is for the join and for the write.
    """
    keys = list(dataset.key)
    target = read_bucketed(spark, dataset, name)
    checked = checked_source(conform(source, dataset).repartition(buckets, *keys), keys)
    s, t = checked.withColumn("_in_source", F.lit(True)).alias("s").hint("merge"), target.alias("t")
    same = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys]

    def outcome(column: str) -> Column:
        ours, theirs = F.col(f"t.{column}"), F.col(f"s.{column}")
        return (F.when(F.col("s._in_source").isNotNull(), theirs).otherwise(ours) if column in updates else ours).alias(column)

    kept = t.join(s, same, "left").select(*[outcome(column) for column in dataset.columns])
    added = checked.join(target.select(*keys).hint("merge"), keys, "left_anti").select(*dataset.columns)
    _save(kept.unionByName(added), dataset, into, buckets, path)

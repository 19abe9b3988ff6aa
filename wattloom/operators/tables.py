"""Writing stored tables: overwrite, partition replacement, append and upsert.

Parquet folders have no transactions. A write replaces the touched partitions at job
commit: a failed job leaves them as they were, but readers may see some partitions
replaced before others while the commit runs. A whole table is published at once, as a
generation (``sources.generations``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.schemas import Dataset
from wattloom.session import scratch
from wattloom.sources.generations import located, publishing
from wattloom.sources.tables import read_table, read_table_or_empty


# Distinct values that a row group's Bloom filter is made for: some 2 KB each.
BLOOM_VALUES = 1024


def _write(
    df: DataFrame,
    dataset: Dataset,
    path: str,
    mode: str,
    overwrite: str = "static",
    gather: bool = True,
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    partition_by = dataset.partition_by
    if gather and partition_by:
        # Brings the rows of a partition together, so that tasks do not each write a
        # sliver of every partition, and lets AQE split a large one over several tasks.
        df = df.hint("rebalance", *[F.col(name) for name in partition_by])
    if observed:
        # in the stage that writes, whose tasks count once even if earlier ones are repeated
        df = df.observe(observed[0], *observed[1])
    if dataset.sort_by:
        # the write sorts by the partition columns anyway
        df = df.sortWithinPartitions(*partition_by, *dataset.sort_by)
    writer = df.write.mode(mode)
    for name in dataset.bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true").option(f"parquet.bloom.filter.expected.ndv#{name}", str(BLOOM_VALUES))
    if partition_by:
        writer = writer.option("partitionOverwriteMode", overwrite).partitionBy(*partition_by)
    writer.parquet(path)


def conform(df: DataFrame, dataset: Dataset) -> DataFrame:
    """The table's columns by case-insensitive name, cast to its types.

    Columns the table lacks are left out; nullable columns the frame lacks are NULL. A
    value that does not fit its type, or a NULL in a required column, fails.
    """
    found: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in found:
            raise ValueError(f"columns {found[name.lower()]!r} and {name!r} differ only in case")
        found[name.lower()] = name
    selected = []
    for field in dataset.schema.fields:
        source = found.get(field.name.lower())
        if source is None and not field.nullable:
            raise ValueError(f"{dataset.name} needs a column {field.name!r}")
        column = F.lit(None) if source is None else df[source]
        column = column.cast(field.dataType)
        if not field.nullable:
            missing = F.raise_error(F.lit(f"NULL in {dataset.name}.{field.name}")).cast(field.dataType)
            column = F.coalesce(column, missing)
        selected.append(column.alias(field.name))
    return df.select(*selected)


def write_table(df: DataFrame, dataset: Dataset, folder: str, gather: bool = True, counts: Sequence[Column] = ()) -> dict[str, int] | None:
    """Write all rows to an empty folder. ``counts`` are named aggregates over the rows,
    taken by the write itself and returned by name.

    ``gather=False`` writes rows from the tasks that read them, without a shuffle: for
    input whose files already hold few partitions each, such as files in day order.
    """
    observation = Observation()
    _write(conform(df, dataset), dataset, folder, "overwrite", gather=gather, observed=(observation, counts) if counts else None)
    return observation.get if counts else None


def overwrite_table(
    df: DataFrame, dataset: Dataset, path: str, gather: bool = True, counts: Sequence[Column] = ()
) -> dict[str, int] | None:
    """``write_table`` as a new generation. Whatever increments wrote since the last one
    is replaced; a job that fails leaves the old table, and readers see the old one until
    the new one is whole. ``df`` may read the table it replaces."""
    with publishing(df.sparkSession, path) as new:
        return write_table(df, dataset, new, gather, counts)


def replace_partitions(df: DataFrame, dataset: Dataset, path: str) -> DataFrame:
    """Replace every partition that occurs in ``df``, which must hold all of its rows.

    Returns the touched partitions. An empty ``df`` changes nothing. ``df`` is computed
    once, into the scratch folder, so it may read the table it replaces.
    """
    with _staged(df, dataset) as (staged, touched):
        if touched:
            _write(staged, dataset, located(staged.sparkSession, path), "overwrite", "dynamic")
    return _as_frame(df.sparkSession, touched, dataset)


def touched_partitions(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.select(*partition_by).distinct()


def flat_copy(df: DataFrame, path: str, max_files: int | None = None) -> None:
    """An unpartitioned copy with the partition columns kept as data.

    File sizes follow AQE's advisory size. ``max_files`` caps the number of files, for
    loaders that want few; it caps the writing tasks with it, so use it on small frames.
    """
    df = df.hint("rebalance") if max_files is None else df.repartition(max_files)
    df.write.mode("overwrite").parquet(path)


def append_by_name(df: DataFrame, dataset: Dataset, path: str) -> None:
    """Append rows as ``conform`` shapes them. Not idempotent: increments that may be
    re-run belong in ``replace_by_key`` or ``upsert_table``."""
    _write(conform(df, dataset), dataset, located(df.sparkSession, path), "append")


def checked_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail on a NULL key, or on a key that occurs twice and so has no single new value."""
    seen = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    no_null = F.lit(True)
    for key in keys:
        no_null = no_null & F.col(key).isNotNull()
    problem = (
        F.when(~no_null, F.raise_error(F.lit("NULL in a key column of the upsert source")).cast("boolean"))
        .when(F.col("_seen") > 1, F.raise_error(F.lit("a key occurs more than once in the upsert source")).cast("boolean"))
        .otherwise(True)
    )
    return source.withColumn("_seen", seen).filter(problem).drop("_seen")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], updates: Sequence[str]) -> DataFrame:
    """Target rows with the ``updates`` columns taken from the source row of the same
    key, also where that is NULL, plus the source rows whose key the target lacks.

    One full outer join on the key; the source's duplicate check shares its shuffle.
    """
    checked = checked_source(source.select(*target.columns), keys)
    t, s = target.withColumn("_in_target", F.lit(True)).alias("t"), checked.withColumn("_in_source", F.lit(True)).alias("s")
    same_key = [F.col(f"t.{key}") == F.col(f"s.{key}") for key in keys]
    in_source, in_target = F.col("s._in_source").isNotNull(), F.col("t._in_target").isNotNull()

    def outcome(name: str) -> Column:
        ours, theirs = F.col(f"t.{name}"), F.col(f"s.{name}")
        if name in updates:
            return F.when(in_source, theirs).otherwise(ours).alias(name)
        return F.when(in_target, ours).otherwise(theirs).alias(name)

    return t.join(s, same_key, "full_outer").select(*[outcome(name) for name in target.columns])


def keys_replaced(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source lacks, plus all source rows.

    Unlike ``merged`` the source may repeat a key; repeats are kept. Running it again
    with the same source changes nothing. Only the source's distinct keys are joined.
    """
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def changed_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``source`` whose rows differ from the target's rows of that key, or that
    the target lacks. Rows are counted and their digests summed per key, each side with
    partial aggregates, so the order of rows does not matter."""
    columns = [c for c in target.columns if c not in keys]

    def digests(df: DataFrame, prefix: str) -> DataFrame:
        row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns]).cast("decimal(38,0)")
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"{prefix}_rows"), F.sum(row).alias(f"{prefix}_digest"))

    both = digests(source, "_s").join(digests(target, "_t"), list(keys), "left")
    same = F.col("_s_rows").eqNullSafe(F.col("_t_rows")) & F.col("_s_digest").eqNullSafe(F.col("_t_digest"))
    return both.filter(~same).select(*keys)


def in_touched(df: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame | None:
    """Rows of the touched partitions; None if no partition is touched.

    The least and greatest value of every partition column, and of the date where year
    and month are among them, make a predicate that prunes folders whatever the number
    of partitions; a semi-join makes it exact.
    """
    columns = {name: F.col(name) for name in partition_by}
    if {"year", "month"} <= set(partition_by):
        columns["_date"] = F.make_date("year", "month", F.col("day") if "day" in partition_by else F.lit(1))
    extremes = [e for name, c in columns.items() for e in (F.min(c).alias(f"min_{name}"), F.max(c).alias(f"max_{name}"))]
    bounds = touched.agg(F.count(F.lit(1)).alias("rows"), *extremes).first()
    if not bounds["rows"]:
        return None
    for name, column in columns.items():
        low, high = bounds[f"min_{name}"], bounds[f"max_{name}"]
        near = column.isNull() if low is None else column.isNull() | column.between(F.lit(low), F.lit(high))
        df = df.filter(near)
    renamed = touched.select(*[F.col(name).alias(f"_touched_{name}") for name in partition_by]).distinct()
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_touched_{name}")) for name in partition_by])
    return df.join(renamed, same, "left_semi")


@contextmanager
def _staged(df: DataFrame, dataset: Dataset) -> Iterator[tuple[DataFrame, list]]:
    """``df`` written once to scratch, which is removed afterwards, and the partitions
    it touches, as short rows. Scratch has no partition folders: nothing there is read by
    partition, and each folder costs more than its rows."""
    if not dataset.partition_by:
        raise ValueError(f"{dataset.name} has no partitions to replace: use overwrite_table")
    spark = df.sparkSession
    with scratch(spark, f"staged-{dataset.name}") as folder:
        path = f"{folder}/rows"
        _write(conform(df, dataset), replace(dataset, partition_by=(), sort_by=(), bloom=()), path, "overwrite")
        staged = read_table(spark, dataset, path)
        yield staged, touched_partitions(staged, dataset.parts).collect()


def _as_frame(spark: SparkSession, touched: list, dataset: Dataset) -> DataFrame:
    fields = [dataset.schema[name] for name in dataset.parts]
    return spark.createDataFrame(touched, type(dataset.schema)(fields))


def _rewrite_touched(
    df: DataFrame,
    dataset: Dataset,
    path: str,
    combine: Callable[[DataFrame, DataFrame], DataFrame],
    flat_path: str | None,
    changed: Callable[[DataFrame], None] | None = None,
    touching: Callable[[list], None] | None = None,
) -> DataFrame:
    """Stage ``df``, combine it with the partitions it touches, replace only those."""
    spark = df.sparkSession
    with _staged(df, dataset) as (staged, touched):
        partitions = touched_partitions(staged, dataset.partition_by)
        near = in_touched(read_table_or_empty(spark, dataset, path), partitions, dataset.partition_by) if touched else None
        if near is not None:
            if changed:
                changed(changed_keys(near.select(*dataset.columns), staged, dataset.key))
            if touching:
                touching(touched)
            combined = combine(near.select(*dataset.columns), staged)
            _write(combined, dataset, located(spark, path), "overwrite", "dynamic")
        if flat_path:
            flat_copy(staged, flat_path)
    return _as_frame(spark, touched, dataset)


def upsert_table(
    df: DataFrame,
    dataset: Dataset,
    path: str,
    updates: Sequence[str],
    flat_path: str | None = None,
    touching: Callable[[list], None] | None = None,
) -> DataFrame:
    """``merged`` into the stored table by its key. No rows, no change.

    The source is written once to the shared scratch folder, so it is computed once
    and its partitions are known; only those partitions are read and replaced.
    Returns the touched partitions; ``flat_path`` gets a flat copy of the source.
    ``touching`` is given the touched partitions before the table is written.
    """

    def combine(target: DataFrame, staged: DataFrame) -> DataFrame:
        return merged(target, staged, dataset.key, updates)

    return _rewrite_touched(df, dataset, path, combine, flat_path, touching=touching)


def replace_by_key(
    df: DataFrame,
    dataset: Dataset,
    path: str,
    flat_path: str | None = None,
    changed: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """``keys_replaced`` in the stored table. No rows, no change. Returns the touched
    partitions; ``flat_path`` gets a flat copy of the source. ``changed`` is given the
    ``changed_keys`` before the table is written."""

    def combine(target: DataFrame, staged: DataFrame) -> DataFrame:
        return keys_replaced(target, staged, dataset.key)

    return _rewrite_touched(df, dataset, path, combine, flat_path, changed)

"""What the text operators share: scratch tables and Arrow batches of whole texts."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from wattloom.session import scratch_base, scratch_path


# Text that a task works on at a time.
PART_BYTES = 2 << 20


def ensure_scratch(spark: SparkSession) -> None:
    """Name a scratch folder where the session names none, as in tests.

    A cluster names it in ``spark.checkpoint.dir``; only a local master, whose tasks
    all share this machine, gets a folder of its own.
    """
    if scratch_base(spark):
        return
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="wattloom-text-"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor repeats a scan instead of the work before it.
    """
    spark = df.sparkSession
    ensure_scratch(spark)
    path = f"{scratch_path(spark, label)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that ``df`` does not have yet."""
    taken = {name.lower() for name in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        names.append(name)
    return names


def quoted(name: str) -> str:
    """A column name that may hold dots or other signs, as Spark parses it."""
    return "`" + name.replace("`", "``") + "`"


def utf8_slices(column: pa.Array) -> Iterator[bytes]:
    """The bytes of every value of a string or binary column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    binary = column.cast(pa.large_binary() if large else pa.binary())
    for value in binary:
        yield value.as_py() or b""


def in_parts(batches: Iterator[pa.RecordBatch], text: str, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``text`` at most, or of one
    row. What a task makes of a batch, and sends back, is bounded with it."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy()
        part = (np.cumsum(lengths) - lengths) // limit
        cuts = (np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                yield batch.slice(a, b - a)
    # Python workers outlive tasks: what Arrow keeps for later goes back now
    pa.default_memory_pool().release_unused()


def word_sequence(text: bytes) -> list[bytes]:
    """Words between the six ASCII white-space characters, which is what ``split`` splits at."""
    return text.split()


# Upper-case ASCII letters to lower case; every other byte stays, also inside UTF-8.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

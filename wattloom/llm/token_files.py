"""Token counts of documents in flat token files without an index.

A flat file is one token identifier after another, with a separator after each document.
Files are taken in blocks. A vectorised search finds a block's separators; documents
inside a block are measured there, and those that reach across blocks are stitched by a
prefix scan: the tokens before a block, and the place of the last separator before it,
are a running sum and a running maximum over block summaries. The scan runs over runs of
blocks first and inside the runs after, so a file of any length is no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.llm.chat import byte_encoding
from wattloom.llm.common import stored, utf8_slices

BLOCK_TOKENS = 1 << 19
# Blocks whose summaries are scanned together.
RUN_BLOCKS = 1024
# The rank file leaves this identifier free; it is the one for end of text.
SEPARATOR = 50256
TYPE = "<u2"


def read_flat_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, dtype: str = TYPE) -> DataFrame:
    """``file``, ``block`` (its number in the file) and ``tokens`` (bytes) of flat files.

    A file is read by one task and cut there, so shards of up to some hundred MB suit it.
    An empty file has no block; a path without files fails.
    """
    width = np.dtype(dtype).itemsize * block_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                data = content.as_buffer()
                for number, at in enumerate(range(0, data.size, width)):
                    block = data[at : min(at + width, data.size)].to_pybytes()
                    yield pa.RecordBatch.from_arrays([pa.array([file.as_py()]), pa.array([number], pa.int64()), pa.array([block], pa.binary())], names=["file", "block", "tokens"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(cut, "file string, block long, tokens binary")


def flatten_documents(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``docs`` as blocks of flat token files, one file for each partition, as
    ``read_flat_files`` gives them, and ``ids``: of the documents whose separator lies
    in the block, in order. Blocks do not respect documents.

    NULL and empty texts are a separator alone; repeated and NULL ids are documents of
    their own; a document longer than a block spans several. No rows give no block."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(picked.dtypes)["doc_id"]

    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = byte_encoding(ranks)
        file, number = str(TaskContext.get().partitionId()), 0
        held, ids, id_type = np.empty(0, TYPE), [], pa.int64()
        ends: list[int] = []

        def block(size: int) -> pa.RecordBatch:
            nonlocal held, ids, ends, number
            inside = sum(1 for end in ends if end < size)
            row = [pa.array([file]), pa.array([number], pa.int64()), pa.array([held[:size].tobytes()], pa.binary()), pa.array([ids[:inside]], pa.list_(id_type))]
            held, ids, ends, number = held[size:], ids[inside:], [end - size for end in ends[inside:]], number + 1
            return pa.RecordBatch.from_arrays(row, names=["file", "block", "tokens", "ids"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            parts, length = [held], len(held)
            for doc, text in zip(batch.column(0).to_pylist(), utf8_slices(batch.column(1))):
                tokens = np.array([*encoding.encode_ordinary(text.decode("utf-8", "replace")), SEPARATOR], TYPE)
                parts.append(tokens)
                length += len(tokens)
                ids.append(doc)
                ends.append(length - 1)
                if length >= block_tokens:
                    held = np.concatenate(parts)
                    while len(held) >= block_tokens:
                        yield block(block_tokens)
                    parts, length = [held], len(held)
            held = np.concatenate(parts)
        if len(held):
            yield block(len(held))

    return picked.mapInArrow(flatten, f"file string, block long, tokens binary, ids array<{kind}>")


def summarise(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = TYPE) -> DataFrame:
    """Per block: ``n_tokens``, ``first`` and ``last`` (places of its outer separators,
    NULL without any), ``n_separators`` and ``inner``, the lengths of the documents
    between them."""
    rest = [name for name in blocks.columns if name not in ("file", "block", "tokens")]
    kinds = dict(blocks.dtypes)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, firsts, lasts, counts, inner = [], [], [], [], []
            for value in batch.column(batch.schema.get_field_index("tokens")):
                tokens = np.frombuffer(value.as_buffer() if value.is_valid else b"", dtype)
                places = np.flatnonzero(tokens == separator)
                sizes.append(len(tokens))
                counts.append(len(places))
                firsts.append(int(places[0]) if len(places) else None)
                lasts.append(int(places[-1]) if len(places) else None)
                inner.append(np.diff(places) - 1)
            columns = [batch.column(batch.schema.get_field_index(name)) for name in ("file", "block", *rest)]
            columns += [pa.array(c, pa.int64()) for c in (sizes, firsts, lasts, counts)] + [pa.array(inner, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", *rest, "n_tokens", "first", "last", "n_separators", "inner"])

    kept = ", ".join(f"`{name}` {kinds[name]}" for name in ("file", "block", *rest))
    return blocks.mapInArrow(search, f"{kept}, n_tokens long, first long, last long, n_separators long, inner array<long>")


def stitch(summaries: DataFrame) -> DataFrame:
    """``summaries`` (a stored table) with what precedes each block in its file:
    ``tokens_before``, ``docs_before`` and ``separator_before``, the place in the file
    of the last separator before the block, or -1."""
    run = F.expr(f"block div {RUN_BLOCKS}")
    blocks = summaries.withColumn("run", run)
    inside = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    local = blocks.withColumn("tokens_in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    local = local.withColumn("docs_in", F.coalesce(F.sum("n_separators").over(inside), F.lit(0)))
    local = local.withColumn("separator_in", F.max(F.col("tokens_in") + F.col("last")).over(inside))
    # a run's last separator, counted from the start of the run
    runs = local.groupBy("file", "run").agg(
        F.sum("n_tokens").alias("tokens"), F.sum("n_separators").alias("docs"), F.max(F.col("tokens_in") + F.col("last")).alias("last")
    )
    before = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("run_tokens", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    runs = runs.withColumn("run_docs", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    runs = runs.withColumn("run_separator", F.max(F.col("run_tokens") + F.col("last")).over(before))
    joined = local.join(runs.select("file", "run", "run_tokens", "run_docs", "run_separator"), ["file", "run"])
    return joined.select(
        *summaries.columns,
        (F.col("run_tokens") + F.col("tokens_in")).alias("tokens_before"),
        (F.col("run_docs") + F.col("docs_in")).alias("docs_before"),
        F.coalesce(F.col("run_tokens") + F.col("separator_in"), F.col("run_separator"), F.lit(-1)).alias("separator_before"),
    )


def document_lengths(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = TYPE) -> DataFrame:
    """Per document of the flat files: ``file``, ``ordinal`` (from 0), ``n_tokens``
    without the separator, ``closed``, and ``doc_id`` where ``blocks`` has ``ids``.

    Tokens after a file's last separator are one more document that is not ``closed``.
    Empty documents count 0. Blocks of a file must be whole; their order is free.
    """
    named = "ids" in blocks.columns
    stitched = stitch(stored(summarise(blocks, separator, dtype), "token-blocks"))
    head = F.col("tokens_before") + F.col("first") - F.col("separator_before") - 1
    lengths = F.concat(F.array(head), F.col("inner"))
    entry = F.arrays_zip(lengths.alias("n_tokens"), F.col("ids").alias("doc_id")) if named else F.arrays_zip(lengths.alias("n_tokens"))
    closed = stitched.filter("n_separators > 0").select("file", "docs_before", F.posexplode(entry).alias("place", "doc"))
    columns = ["file", (F.col("docs_before") + F.col("place")).alias("ordinal"), F.col("doc.n_tokens").alias("n_tokens"), F.lit(True).alias("closed")]
    found = closed.select(*columns, *([F.col("doc.doc_id").alias("doc_id")] if named else []))
    ends = stitched.groupBy("file").agg(
        F.max(F.col("tokens_before") + F.col("n_tokens")).alias("stop"),
        F.max(F.greatest(F.coalesce(F.col("tokens_before") + F.col("last"), F.lit(-1)), F.col("separator_before"))).alias("last"),
        F.max(F.col("docs_before") + F.col("n_separators")).alias("ordinal"),
    )
    left = ends.filter("stop - last > 1").select("file", "ordinal", (F.col("stop") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return found.unionByName(left, allowMissingColumns=True)

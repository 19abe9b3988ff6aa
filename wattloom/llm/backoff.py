"""Stupid-backoff scores of whole corpora, computed with partitioned count tables.

Words are hashed to 64 bits and n-grams to a hash of theirs. Documents are dealt into
groups; a group explodes its texts into n-grams and adds them up, so the count tables
receive each n-gram once per group, cut into hash ranges. A hash range is one partition
of the count tables: it adds up the groups' counts and joins the totals back to the
groups' n-grams, and the scores are summed per document.

    S(w | h) = count(hw) / count(h)     where the n-gram hw was seen
               0.4 S(w | shorter h)     elsewhere, down to count(w) / N

Counts leave out the scored document itself, or every n-gram would have been seen.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import ASCII_LOWER, in_parts, stored, utf8_slices, word_sequence

BACKOFF = 0.4
# A word that no other document has counts as half an occurrence.
UNSEEN = 0.5
# Text of one group, which one task holds, and holds as hashes.
GROUP_BYTES = 12 << 20


def word_hashes(text: bytes) -> np.ndarray:
    words = word_sequence(text.translate(ASCII_LOWER))
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; runs of different sizes never share one on purpose."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    value = np.full(n, size, np.uint64)
    for step in range(size):
        value = (value ^ (value >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + words[step : step + n]
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(31))


def squeezed(value: bytes) -> bytes:
    """``value`` as Zstandard, after its length. Shuffles compress by repeats alone;
    this also codes frequent bytes in fewer bits."""
    return len(value).to_bytes(8, "little") + pa.compress(value, codec="zstd", asbytes=True)


def expanded(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)


def planes(values: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on, compressed: bytes that are nearly
    always zero lie together and take no room."""
    return squeezed(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes())


def from_planes(packed: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(expanded(packed), np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def packed_hashes(ordered: np.ndarray) -> bytes:
    """Ascending hashes as planes of their differences."""
    return planes(np.diff(ordered, prepend=np.uint64(0)))


def unpacked_hashes(packed: bytes) -> np.ndarray:
    return np.cumsum(from_planes(packed, np.uint64), dtype=np.uint64)


def counted_grams(hashed: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The group's distinct n-grams of one size in order of hash, and their counts."""
    grams = [gram_hashes(words, size) for words in hashed]
    return np.unique(np.concatenate(grams) if grams else np.empty(0, np.uint64), return_counts=True)


def other_counts(hashed: list[np.ndarray], size: int, totals: np.ndarray) -> np.ndarray:
    """For every n-gram of every text in order, its count in all other documents.

    ``totals`` are the corpus counts of ``counted_grams``' n-grams, in that order.
    """
    grams = [gram_hashes(words, size) for words in hashed]
    flat = np.concatenate(grams) if grams else np.empty(0, np.uint64)
    number = np.unique(flat, return_inverse=True)[1].astype(np.int32)
    del flat
    others = totals[number]
    at = 0
    for part in grams:
        # what the text itself contributes
        own = number[at : at + len(part)]
        _, kind, times = np.unique(own, return_inverse=True, return_counts=True)
        others[at : at + len(part)] -= times[kind]
        at += len(part)
    return others


def score_texts(n_words: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of log scores short of the ``log N`` terms, and how many of
    those there are. ``others`` are ``other_counts`` by size."""
    starts = np.cumsum(n_words) - n_words
    value, settled = np.zeros(n_words.sum()), np.zeros(n_words.sum(), bool)
    for k in range(len(others), 1, -1):
        # the k-gram that ends at a word, and its history, which ends at the word before
        per_text = np.maximum(n_words - k + 1, 0)
        within = np.arange(per_text.sum()) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        word = np.repeat(starts, per_text) + within + k - 1
        per_shorter = np.maximum(n_words - k + 2, 0)
        history = np.repeat(np.cumsum(per_shorter) - per_shorter, per_text) + within
        now = np.flatnonzero((others[k - 1] > 0) & ~settled[word])
        value[word[now]] += np.log(others[k - 1][now]) - np.log(others[k - 2][history[now]])
        settled[word[now]] = True
        value[word[~settled[word]]] += math.log(BACKOFF)
    rest = ~settled
    value[rest] += np.log(np.maximum(others[0][rest], UNSEEN))
    owner = np.repeat(np.arange(len(n_words)), n_words)
    return np.bincount(owner, weights=value, minlength=len(n_words)), np.bincount(owner[rest], minlength=len(n_words))


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 3) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``log_score`` (natural log of the
    product of its words' scores) and ``per_word``, its mean (NULL without words).

    Every row takes part in the counts, repeated ones too. NULL text has no words; rows
    without an id are scored like others.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = picked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // GROUP_BYTES))
    # repeated rows of one id spread as well
    deal = F.pmod(F.xxhash64("doc_id", F.octet_length("text"), F.substring("text", 1, 64)), F.lit(groups)).cast("int")
    kind = dict(picked.dtypes)["doc_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            texts = pa.array([squeezed(text) for text in utf8_slices(batch.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, batch.column("grp")], names=["doc_id", "packed", "grp"])

    # texts are sent once and read twice
    packed = picked.withColumn("grp", deal).mapInArrow(pack, f"doc_id {kind}, packed binary, grp int")
    dealt = packed.repartition(groups, "grp")

    def hashes_of(table: pa.Table) -> list[np.ndarray]:
        return [word_hashes(expanded(value)) for value in utf8_slices(table.column("packed"))]

    def explode(table: pa.Table) -> pa.Table:
        hashed = hashes_of(table)
        number = table.column("grp")[0].as_py()
        # equal ranges of the hash, one for each partition of the count table
        cuts = np.array([(i << 64) // groups for i in range(1, groups)], np.uint64)
        rows = []
        for size in range(1, order + 1):
            hashes, times = counted_grams(hashed, size)
            edges = [0, *np.searchsorted(hashes, cuts).tolist(), len(hashes)]
            for part, (a, b) in enumerate(zip(edges, edges[1:])):
                if a < b:
                    rows.append((size, part, number, packed_hashes(hashes[a:b]), planes(times[a:b].astype(np.int32))))
        return _table(rows, TABLE)

    def add_up(table: pa.Table) -> pa.Table:
        hashes = [unpacked_hashes(value.as_py()) for value in table.column("hashes")]
        times = np.concatenate([from_planes(value.as_py(), np.int32) for value in table.column("times")])
        ends = np.cumsum([len(h) for h in hashes])
        flat = np.concatenate(hashes)
        del hashes
        _, number = np.unique(flat, return_inverse=True)
        total = np.bincount(number, weights=times).astype(np.int64)[number]
        parts = [planes(part) for part in np.split(total, ends[:-1])]
        rows = zip(table.column("size").to_pylist(), table.column("part").to_pylist(), table.column("grp").to_pylist(), parts)
        return _table(list(rows), TOTALS)

    def sum_up(table: pa.Table, totals: pa.Table) -> pa.Table:
        hashed = hashes_of(table)
        ordered = totals.sort_by([("size", "ascending"), ("part", "ascending")])
        sizes, others = ordered.column("size").to_numpy(), []
        for size in range(1, order + 1):
            parts = [from_planes(value.as_py(), np.int64) for value in ordered.filter(pa.array(sizes == size)).column("totals")]
            counts = np.concatenate(parts) if parts else np.empty(0, np.int64)
            others.append(other_counts(hashed, size, counts))
        n_words = np.array([len(words) for words in hashed], np.int64)
        value, terms = score_texts(n_words, others)
        columns = [table.column("doc_id"), pa.array(n_words), pa.array(value), pa.array(terms.astype(np.int64))]
        return pa.table(columns, names=["doc_id", "n_words", "value", "terms"])

    exploded = dealt.groupBy("grp").applyInArrow(explode, "size int, part int, grp int, hashes binary, times binary")
    totals = exploded.groupBy("size", "part").applyInArrow(add_up, "size int, part int, grp int, totals binary")
    summed = dealt.groupBy("grp").cogroup(totals.groupBy("grp")).applyInArrow(sum_up, f"doc_id {kind}, n_words long, value double, terms long")
    summed = stored(summed, "backoff-sums")
    words = summed.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("value") - F.col("terms") * math.log(words)
    return summed.select("doc_id", "n_words", log_score.alias("log_score"), (log_score / F.nullif("n_words", F.lit(0))).alias("per_word"))


TABLE = pa.schema([("size", pa.int32()), ("part", pa.int32()), ("grp", pa.int32()), ("hashes", pa.binary()), ("times", pa.binary())])
TOTALS = pa.schema([("size", pa.int32()), ("part", pa.int32()), ("grp", pa.int32()), ("totals", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)

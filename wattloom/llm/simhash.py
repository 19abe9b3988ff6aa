"""SimHash fingerprints and the groups that they form, searched with BK-trees.

Two 64-bit fingerprints that differ in at most ``radius`` bits agree in all but
``radius`` of any disjoint bands. Every distinct fingerprint is therefore dealt to one
shard for each choice of ``BANDS - radius`` bands, keyed by the bits of those bands, and
a shard holds all fingerprints that share them. A BK-tree is built in each shard: the
children of a node are keyed by their Hamming distance to it, and a search follows only
edges within the radius of the query's own distance. Shards travel by shuffle instead of
broadcast, as a broadcast would have to gather all fingerprints first.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from wattloom.llm.common import ASCII_LOWER, fresh, in_parts, quoted, stored, utf8_slices, word_sequence
from wattloom.llm.components import components

SEED = 42
BANDS = 6


def fingerprint(text: bytes, size: int = 3) -> int:
    """A bit is set if more than half of the shingles' XXH64 hashes set it.

    Shingles are ``size`` words joined by one space, repeats included; a text of fewer
    words is one shingle, and one without words has fingerprint zero.
    """
    words = word_sequence(text.translate(ASCII_LOWER))
    if not words:
        return 0
    hashes = shingle_hashes(words, size)
    votes = np.zeros(64, np.int64)
    # blocks keep the unpacked bits of very long texts small
    for at in range(0, len(hashes), 65_536):
        votes += bit_votes(hashes[at : at + 65_536])
    return majority(votes, len(hashes))


def bit_votes(hashes: np.ndarray) -> np.ndarray:
    """How many hashes set each bit."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def majority(votes: np.ndarray, total: int) -> int:
    return sum(1 << bit for bit in np.flatnonzero(2 * votes > total).tolist())


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, or of all words if there are fewer."""
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    hashed = (digest(line[a:b], SEED) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist()))
    return np.fromiter(hashed, np.uint64, len(words) - size + 1)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, longs: Sequence[str] = ()
) -> DataFrame:
    """``doc_id`` and its ``fingerprint`` as a signed long, one row per input row, and
    the long columns named in ``longs``."""
    picked = docs.select(
        F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"), *[F.col(quoted(c)) for c in longs]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            prints = np.array([fingerprint(text, size) for text in utf8_slices(batch.column(1))], np.uint64)
            arrays = [batch.column(0), pa.array(prints.view(np.int64)), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "fingerprint", *longs])

    return picked.mapInArrow(scan, ", ".join(["doc_id long", "fingerprint long", *(f"{quoted(c)} long" for c in longs)]))


class BKTree:
    """A BK-tree over distinct 64-bit integers."""

    def __init__(self, values: list[int]):
        self.values = values
        self.children: list[dict[int, int]] = []
        for at in range(len(values)):
            self._add(at)

    def _add(self, at: int) -> None:
        self.children.append({})
        value, node = self.values[at], 0
        while node != at:
            distance = (value ^ self.values[node]).bit_count()
            nearer = self.children[node].get(distance)
            if nearer is None:
                self.children[node][distance] = at
                return
            node = nearer

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of all values at most ``radius`` bits from ``value``."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            node = open_nodes.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= radius:
                found.append(node)
            for edge in range(max(1, distance - radius), distance + radius + 1):
                child = self.children[node].get(edge)
                if child is not None:
                    open_nodes.append(child)
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the radius connects, at most one fewer than values.

    Each search from an unreached value walks outwards through the tree, so a shard of
    n fingerprints yields fewer than n links however many pairs are near each other.
    """
    tree, root, links = BKTree(values), [-1] * len(values), []
    for start in range(len(values)):
        if root[start] >= 0:
            continue
        root[start], frontier = start, [start]
        while frontier:
            for near in tree.within(values[frontier.pop()], radius):
                if root[near] < 0:
                    root[near] = start
                    frontier.append(near)
                    links.append((start, near))
    return links


def _band_masks() -> list[int]:
    edges = [round(i * 64 / BANDS) for i in range(BANDS + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def shards(classes: DataFrame, radius: int) -> DataFrame:
    """One row per choice of bands: the choice, the shared bits, and the fingerprint."""
    if not 0 <= radius < BANDS:
        raise ValueError(f"radius must be below {BANDS}")
    choices = []
    for number, bands in enumerate(combinations(_band_masks(), BANDS - radius)):
        mask = sum(bands)
        signed = mask - (1 << 64) if mask >> 63 else mask
        choices.append(F.struct(F.lit(number).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(signed)).alias("bits")))
    dealt = classes.select(F.explode(F.array(*choices)).alias("shard"), "doc_id", "fingerprint")
    return dealt.select("shard.choice", "shard.bits", "doc_id", "fingerprint")


def links(classes: DataFrame, radius: int = 2) -> DataFrame:
    """``a`` and ``b``: ids of classes that link, enough of them to connect each group.

    ``classes`` has one row per distinct fingerprint with a non-NULL ``doc_id`` naming
    it. Shards arrive sorted, so one is held at a time; its fingerprints differ only in
    the bits of ``radius`` bands, which bounds it whatever the number of documents.
    """
    dealt = shards(classes, radius).repartition("choice", "bits").sortWithinPartitions("choice", "bits", "fingerprint")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, prints = None, [], []
        found: list[tuple[int, int]] = []

        def close() -> None:
            if len(ids) > 1:
                found.extend((ids[a], ids[b]) for a, b in shard_links(prints, radius))

        def rows() -> pa.RecordBatch:
            a, b = zip(*found) if found else ((), ())
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            choice, bits = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            id_list, print_list = batch.column(2).to_pylist(), batch.column(3).to_numpy().view(np.uint64).tolist()
            cuts = np.flatnonzero((choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(id_list)]):
                if a == b:
                    continue
                here = (int(choice[a]), int(bits[a]))
                if here != key:
                    close()
                    key, ids, prints = here, [], []
                ids.extend(id_list[a:b])
                prints.extend(print_list[a:b])
            yield rows()
        close()
        yield rows()

    return dealt.mapInArrow(search, "a long, b long")


def fingerprint_roots(printed: DataFrame, radius: int = 2) -> DataFrame:
    """``fingerprint``, ``least`` (the smallest ``doc_id`` that has it) and ``root``, the
    fingerprint that names what links reach, one row per distinct fingerprint."""
    by_print = printed.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    # classes are named by their fingerprint, which every class has
    classes = stored(by_print, "simhash-classes")
    near = links(classes.select(F.col("fingerprint").alias("doc_id"), "fingerprint"), radius)
    roots = components(near)
    least = classes.join(roots, classes.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    return stored(least, "simhash-roots")


def group_by_fingerprint(printed: DataFrame, radius: int = 2) -> DataFrame:
    """``printed`` (``doc_id``, ``fingerprint``) with ``component_id``, the smallest
    ``doc_id`` that links reach from the row. Read it from a stored table.

    A row without an id takes part as its fingerprint; where a whole group has no id,
    its ``component_id`` is NULL.
    """
    least = fingerprint_roots(printed, radius)
    group_least = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(group_least, "root").select("fingerprint", "component_id")
    return printed.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` (long) and ``component_id`` for every row of ``docs``.

    NULL and empty texts have fingerprint zero and link like others. Repeated ids give
    a row each. Other columns are not read.
    """
    return group_by_fingerprint(stored(fingerprints(docs, id_col, text_col, size), "simhash-prints"), radius)


def hex16(column: str):
    """16 lower-case hex digits of a signed long taken as 64 bits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2) -> DataFrame:
    """The rows of ``docs``, all columns, less all but one of each group that links of
    ``radius`` bits connect.

    The row with the smallest id stays, of rows that share it the one with the smallest
    digest of its text, of rows equal in both any one. Rows without an id only stay if
    their group has no other. NULL, empty and wordless texts have fingerprint zero and
    are one group. An empty table stays empty; clashing column names are left alone.
    """
    key, mark, place = fresh(docs, "copy_key", "copy_mark", "copy_place")
    # the largest long stands for no id, and so loses to every other
    ids = F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit((1 << 63) - 1))
    text = F.col(quoted(text_col)).cast("string")
    keyed = docs.withColumns({key: ids, mark: F.xxhash64(text)})
    printed = fingerprints(keyed.select(key, F.col(quoted(text_col)), mark), key, text_col, size, [mark])
    printed = stored(printed.withColumnRenamed(mark, "mark"), "simhash-prints")
    roots = fingerprint_roots(printed, radius).select("fingerprint", "root")
    picked = printed.join(roots, "fingerprint").groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("one"))
    stays = picked.select(F.col("one.doc_id").alias(key), F.col("one.mark").alias(mark))
    # before the exchange a partition already gives up all but one of its equal rows
    single = keyed.withColumn(place, F.row_number().over(Window.partitionBy(key, mark).orderBy(F.lit(0)))).filter(F.col(place) == 1)
    return single.join(stays, [key, mark], "left_semi").select(*[quoted(c) for c in docs.columns])

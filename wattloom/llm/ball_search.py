"""Exact ranked lexical search with sparse ball trees.

A document is a sparse vector of integer term weights, a query one of inverse document
frequencies, and the score their inner product. Documents are dealt to shards as they are
read. A shard's vectors form a ball tree: a node halves its documents between two that
are far apart, and has an integer centroid and the greatest distance to it, rounded up.
No document of a node scores more than the centroid's product plus that distance times
the norm of the query (over the terms that the node has), both rounded up. Each query
walks the tree best-first and leaves out nodes whose bound is below its worst result so
far, which a task carries from shard to shard; at leaves scores are exact integers.

Queries travel in blocks of bounded size, one scan of the documents for each. Statistics
of the corpus come from one scan before, which counts only terms that a bitmap of fixed
size lets through.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from wattloom.llm.common import in_parts, quoted, stored, utf8_slices
from wattloom.llm.decontaminate import words_of

TOP = 50
# One megabyte of bits: terms of queries, and a few others, pass.
FILTER_BITS = 1 << 23
BUCKET_BITS = 32_768
# Documents and term weights that a tree holds, and documents of a leaf.
SHARD_DOCS, SHARD_WEIGHTS, LEAF = 4096, 1 << 21, 64
# A block's queries by its distinct terms, as a dense matrix of integers.
BLOCK_CELLS = 1 << 21
KNOWN_TERMS = 300_000
# Tasks whose results meet first.
MEETING = 64
# Float bounds are raised by far more than their rounding errors.
SLACK = 1e-9


# --- statistics ----------------------------------------------------------------------


def query_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``item_id`` and ``term``, each once."""
    picked = items.select(F.col(quoted(item_col)).alias("item_id"), F.col(quoted(text_col)).cast("string").alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            terms = [list(set(words_of(text))) for text in utf8_slices(batch.column(1))]
            found = pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["item_id", "terms"])

    kind = dict(picked.dtypes)["item_id"]
    return picked.mapInArrow(scan, f"item_id {kind}, terms array<string>").select("item_id", F.explode("terms").alias("term")).distinct()


def term_bitmap(terms: DataFrame) -> np.ndarray:
    """``FILTER_BITS`` bits, as bytes, of the hashes of all ``term``."""
    place = F.pmod(F.xxhash64("term"), F.lit(FILTER_BITS)) + 1
    buckets = terms.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    bitmap, width = np.zeros(FILTER_BITS // 8, np.uint8), BUCKET_BITS // 8
    # at most FILTER_BITS / BUCKET_BITS rows
    for row in buckets.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
        bitmap[(row["bucket"] - 1) * width : row["bucket"] * width] = np.frombuffer(row["bits"], np.uint8)
    return bitmap


def statistics(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """``term``, ``holders`` (documents that hold it) and, for the NULL term, ``holders``
    (documents with a term) and ``total`` (terms of all documents with repeats).

    ``docs`` has ``text`` alone. Terms outside of the bitmap are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, passed = sent.value, {}

        def passes(term: bytes) -> bool:
            place = xxhash.xxh64_intdigest(term, 42) & (FILTER_BITS - 1)
            return bool(bits[place >> 3] >> (place & 7) & 1)

        for batch in in_parts(batches, "text"):
            holders: Counter[bytes] = Counter()
            with_terms = total = 0
            for text in utf8_slices(batch.column(0)):
                words = words_of(text)
                total += len(words)
                with_terms += bool(words)
                holders.update(set(words))
            for term in holders.keys() - passed.keys():
                passed[term] = passes(term)
            found = [(t, n) for t, n in holders.items() if passed[t]]
            if len(passed) > KNOWN_TERMS:
                passed.clear()
            terms = pa.array([t for t, _ in found] + [None], pa.binary()).cast(pa.string())
            counts = pa.array([n for _, n in found] + [with_terms], pa.int64())
            totals = pa.array([0] * len(found) + [total], pa.int64())
            yield pa.RecordBatch.from_arrays([terms, counts, totals], names=["term", "holders", "total"])

    counted = docs.mapInArrow(scan, "term string, holders long, total long")
    return counted.groupBy("term").agg(F.sum("holders").alias("holders"), F.sum("total").alias("total"))


# --- ball trees ----------------------------------------------------------------------


@dataclass
class Rows:
    """Sparse integer vectors, one after another."""

    ends: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.ends)[rows]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        flat = np.repeat(self.ends[rows] - ends[:-1], sizes) + np.arange(ends[-1])
        return Rows(ends, self.terms[flat], self.weights[flat])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """The product of every vector with ``dense``. No vector is empty."""
        return np.add.reduceat(dense[self.terms] * self.weights, self.ends[:-1])


class BallTree:
    """A ball tree over ``rows``; every node is a range of ``order``."""

    def __init__(self, rows: Rows, n_terms: int, leaf: int = LEAF):
        self.n_terms, self.leaf = n_terms, leaf
        self.order: list[np.ndarray] = []
        self.leaves: dict[int, Rows] = {}
        self.members: dict[int, np.ndarray] = {}
        self.children: list[tuple[int, int] | None] = []
        self.centroids: list[np.ndarray] = []
        self.radii: list[int] = []
        self._grow(rows, np.arange(len(rows)))
        self.centroid_matrix = np.array(self.centroids, np.float64)
        self.radius_column = np.array(self.radii, np.float64)[:, None]

    def _grow(self, rows: Rows, members: np.ndarray) -> int:
        node = len(self.children)
        self.children.append(None)
        total = np.bincount(rows.terms, rows.weights, self.n_terms)
        # the sums are below 2**53, so they are whole; 0 where the node lacks the term
        centroid = (total // len(rows)).astype(np.int64)
        squares = np.add.reduceat(rows.weights * rows.weights, rows.ends[:-1])
        away = squares - 2 * rows.dot(centroid) + int(centroid @ centroid)
        self.centroids.append(centroid)
        self.radii.append(math.isqrt(int(away.max())) + 1)
        if len(rows) <= self.leaf or not away.any():
            self.leaves[node], self.members[node] = rows, members
            return node
        ends = [int(away.argmax())]
        for _ in range(2):
            dense = self._dense(rows, ends[-1])
            ends.append(int((squares - 2 * rows.dot(dense)).argmax()))
        along = rows.dot(self._dense(rows, ends[-1]) - self._dense(rows, ends[-2]))
        ranked, half = np.argsort(along, kind="stable"), len(rows) // 2
        near, far = ranked[:half], ranked[half:]
        self.children[node] = (self._grow(rows.take(near), members[near]), self._grow(rows.take(far), members[far]))
        return node

    def _dense(self, rows: Rows, row: int) -> np.ndarray:
        dense = np.zeros(self.n_terms, np.int64)
        here = slice(rows.ends[row], rows.ends[row + 1])
        dense[rows.terms[here]] = rows.weights[here]
        return dense

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For every node and query (a row of ``queries``) a number that no score of the
        node's documents exceeds. It is rounded up."""
        columns = queries.T.astype(np.float64)
        support = self._support().astype(np.float64)
        norms = np.sqrt(support @ (columns * columns))
        raised = (self.centroid_matrix @ columns + norms * self.radius_column) * (1 + SLACK)
        return raised + 1

    def _support(self) -> np.ndarray:
        """Whether a node has a term; an inner node has what its children have."""
        held = np.zeros((len(self.children), self.n_terms), bool)
        for node in reversed(range(len(self.children))):
            pair = self.children[node]
            if pair is None:
                held[node, self.leaves[node].terms] = True
            else:
                held[node] = held[pair[0]] | held[pair[1]]
        return held


Found = tuple[int, int, int]


def search(tree: BallTree, ids: list[int | None], query: np.ndarray, bounds: list[float], best: list[Found], top: int) -> int:
    """Put the tree's documents into ``best``, a heap of the ``top`` highest (score, has
    id, -id) above score 0. Returns how many leaves it had to score."""
    scored, open_nodes = 0, [(-bounds[0], 0)]
    while open_nodes:
        bound, node = heapq.heappop(open_nodes)
        least = best[0][0] if len(best) == top else 1
        # an equal score may still win by its id
        if -bound < least:
            break
        pair = tree.children[node]
        if pair is not None:
            for child in pair:
                if bounds[child] >= least:
                    heapq.heappush(open_nodes, (-bounds[child], child))
            continue
        scored += 1
        scores = tree.leaves[node].dot(query)
        here = np.flatnonzero(scores >= least)
        for score, member in zip(scores[here].tolist(), tree.members[node][here].tolist()):
            doc = ids[member]
            entry = (score, doc is not None, -(doc or 0))
            if len(best) < top:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)
    return scored


# --- search --------------------------------------------------------------------------


@dataclass
class Block:
    """Queries of bounded size: their items, distinct terms, and (terms, weights)."""

    items: list
    terms: dict[bytes, int]
    vectors: list[tuple[list[int], list[int]]]

    def matrix(self) -> np.ndarray:
        dense = np.zeros((len(self.items), len(self.terms)), np.int64)
        for row, (terms, weights) in enumerate(self.vectors):
            dense[row, terms] = weights
        return dense


def blocks_of(queries: Iterator, cells: int = BLOCK_CELLS) -> Iterator[Block]:
    """Blocks of (``item_id``, ``terms``, ``weights``) rows, so large that a block's items
    times its distinct terms stay within ``cells``; a single item always fits."""
    block = Block([], {}, [])
    for row in queries:
        terms = [t.encode() for t in row["terms"]]
        new = sum(1 for t in terms if t not in block.terms)
        if block.items and (len(block.items) + 1) * (len(block.terms) + new) > cells:
            yield block
            block = Block([], {}, [])
        block.items.append(row["item_id"])
        block.vectors.append(([block.terms.setdefault(t, len(block.terms)) for t in terms], list(row["weights"])))
    if block.items:
        yield block


def search_block(docs: DataFrame, block: Block, n_docs: int, n_terms: int, top: int, item_type: T.DataType) -> DataFrame:
    """``item_id``, ``doc_id``, ``score`` and ``part``: for each task its highest rows.

    ``docs`` has ``doc_id`` (long) and ``text``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(block)
    arrow_type = to_arrow_type(item_type)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        queries, place = held.matrix(), held.terms.get
        best: list[list[Found]] = [[] for _ in held.items]
        ids: list[int | None] = []
        sizes: list[int] = []
        counts: list[int] = []
        flat: list[int] = []
        times: list[int] = []

        def close() -> None:
            terms, tf = np.array(flat, np.int64), np.array(times, np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            length = 100 - 50 + (50 * np.array(counts, np.int64) * n_docs) // n_terms
            weights = (1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(length, sizes))
            tree = BallTree(Rows(ends, terms, weights), len(held.terms))
            bounds = tree.bounds(queries).T.tolist()
            for query, bound, found in zip(queries, bounds, best):
                search(tree, ids, query, bound, found, top)
            for column in (ids, sizes, counts, flat, times):
                column.clear()

        for batch in in_parts(batches, "text"):
            for doc, text in zip(batch.column(0).to_pylist(), utf8_slices(batch.column(1))):
                words = words_of(text)
                tf = Counter(map(place, words))
                tf.pop(None, None)
                if not tf:
                    continue
                ids.append(doc)
                sizes.append(len(tf))
                counts.append(len(words))
                flat.extend(tf.keys())
                times.extend(tf.values())
                if len(ids) >= SHARD_DOCS or len(flat) >= SHARD_WEIGHTS:
                    close()
        if ids:
            close()
        part = TaskContext.get().partitionId()
        rows = [(item, -entry[2] if entry[1] else None, entry[0]) for item, found in zip(held.items, best) for entry in found]
        for at in range(0, len(rows), 100_000):
            items, docs_found, scores = zip(*rows[at : at + 100_000])
            arrays = [pa.array(items, arrow_type), pa.array(docs_found, pa.int64()), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(items), pa.int64())], names=["item_id", "doc_id", "score", "part"])

    schema = T.StructType([T.StructField("item_id", item_type), *[T.StructField(c, T.LongType()) for c in ("doc_id", "score", "part")]])
    return docs.mapInArrow(scan, schema)


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: for each item of ``items``
    the ``top`` rows of ``docs`` with the highest scores above 0, equal ones by id.

    Terms are runs of ASCII letters (lower-cased), digits and characters beyond ASCII in
    whole texts. With N documents that have a term, L terms in all and df documents that
    hold a term, the term weighs floor(1000 ln((2 N + 2) / (2 df + 1))). With tf
    occurrences among a document's n terms it adds that times 10^9 tf div (1000 tf + 20 m),
    m = 50 + 50 n N div L, once however often the item has it.

    NULL, empty and wordless texts have no terms: such documents are never found and such
    items find none. Rows of ``items`` with one id, also NULL, are one item with the terms
    of all. Rows of ``docs`` are ranked one by one, so a repeated id may stand twice; a
    NULL id comes after all others of its score. Ids must cast to long. Empty tables
    give an empty result. ``docs`` is read once and then once for each block of items.
    """
    spark = docs.sparkSession
    kind = items.schema[item_col].dataType
    picked = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    terms = stored(query_terms(items, item_col, item_text_col), "search-terms")
    counted = stored(statistics(picked.select("text"), term_bitmap(terms)), "search-counts")
    whole = counted.filter("term IS NULL").agg(F.sum("holders").alias("n"), F.sum("total").alias("l")).first()
    n_docs, n_terms = whole["n"] or 0, whole["l"] or 0
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("holders") + 1))).cast("long")
    weighed = terms.join(counted.filter("term IS NOT NULL"), "term").select("item_id", "term", weight.alias("weight")).filter("weight > 0")
    pairs = F.sort_array(F.collect_list(F.struct("term", "weight")))
    queries = weighed.groupBy("item_id").agg(pairs.alias("pairs")).select("item_id", F.col("pairs.term").alias("terms"), F.col("pairs.weight").alias("weights"))
    results = None
    for block in blocks_of(stored(queries, "search-queries").toLocalIterator()):
        found = stored(search_block(picked, block, n_docs, n_terms, top, kind), "search-found")
        results = found if results is None else results.union(found)
    if results is None:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind)])).selectExpr("item_id", "1 as rank", "1L as doc_id", "1L as score")
    highest = [F.desc("score"), F.asc_nulls_last("doc_id")]
    meeting = F.floor(F.col("part") / MEETING)
    nearly = results.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", meeting).orderBy(*highest))).filter(F.col("rank") <= top)
    ranked = nearly.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*highest))).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")

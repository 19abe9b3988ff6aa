"""Benchmark decontamination: windows of benchmark items found in documents.

A set join by prefix filter. The shingles of a window are its pairs of neighbouring
words (a window of one word is its own shingle); they are ordered by how rare they are in
all documents. A document that contains a window contains its rarest shingle, so for
full containment a prefix of one shingle per window is enough: the join matches those
only. A match fixes where the window would start, which must lie inside the document
(position bound) and leave room for the window (length bound); then all its words are
compared. The windows travel to the tasks in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import in_parts, quoted, utf8_slices

WINDOW = 10
# Words of windows in one block: some ten MB as a broadcast, whatever the benchmark's size.
BLOCK_WORDS = 1_000_000

# ASCII letters, lower-cased, digits and all bytes beyond ASCII belong to words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    """All runs of ``size`` words; a shorter item is one window, an empty one has none."""
    if len(words) <= size:
        return [words] if words else []
    return [words[i : i + size] for i in range(len(words) - size + 1)]


@dataclass
class Block:
    """Windows of some items, as word numbers."""

    vocabulary: dict[bytes, int]
    words: np.ndarray  # one row per distinct window, padded with -2
    lengths: np.ndarray
    owners: list[list[str | None]]  # ids of the items that hold the window

    @staticmethod
    def of(items: list[tuple[str | None, bytes]], size: int = WINDOW) -> Block:
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], list[str | None]] = {}
        for item, text in items:
            numbered = [[vocabulary.setdefault(w, len(vocabulary)) for w in window] for window in windows_of(words_of(text), size)]
            for window in dict.fromkeys(map(tuple, numbered)):
                held = owners.setdefault(window, [])
                if item not in held[-1:]:
                    held.append(item)
        words = np.full((len(owners), size), -2, np.int64)
        for row, window in enumerate(owners):
            words[row, : len(window)] = window
        return Block(vocabulary, words, (words >= 0).sum(axis=1), list(owners.values()))

    def shingles(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code, window and offset of every shingle of every window."""
        base = len(self.vocabulary) + 1
        pairs = self.words[:, :-1] * base + self.words[:, 1:]
        there = (self.words[:, :-1] >= 0) & (self.words[:, 1:] >= 0)
        window, offset = np.nonzero(there)
        single = np.flatnonzero(self.lengths == 1)
        codes = np.concatenate([pairs[there], self.words[single, 0] * base + base - 1])
        return codes, np.concatenate([window, single]), np.concatenate([offset, np.zeros(len(single), np.int64)])


def _numbered(texts: list[bytes], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, -1 for words of no window, and where each text starts.

    A -1 follows every text, so that no window reaches into the next one.
    """
    get, parts, starts, at = vocabulary.get, [], [0], 0
    for text in texts:
        words = words_of(text)
        parts.append(np.fromiter([get(w, -1) for w in words], np.int64, len(words)))
        parts.append(np.array([-1]))
        at += len(words) + 1
        starts.append(at)
    return np.concatenate(parts) if parts else np.empty(0, np.int64), np.array(starts)


def _codes(numbers: np.ndarray, base: int, singles: bool) -> tuple[np.ndarray, np.ndarray]:
    """Shingle codes that occur, and where they start."""
    pairs = np.flatnonzero((numbers[:-1] >= 0) & (numbers[1:] >= 0))
    codes = numbers[pairs] * base + numbers[pairs + 1]
    if not singles:
        return codes, pairs
    alone = np.flatnonzero(numbers >= 0)
    return np.concatenate([codes, numbers[alone] * base + base - 1]), np.concatenate([pairs, alone])


class Matcher:
    """One block with its windows keyed by their rarest shingle."""

    def __init__(self, block: Block, counts: dict[int, int]):
        self.block, self.base = block, len(block.vocabulary) + 1
        codes, window, offset = block.shingles()
        rarity = np.fromiter((counts.get(c, 0) for c in codes.tolist()), np.int64, len(codes))
        order = np.lexsort((offset, codes, rarity, window))
        first = np.ones(len(order), bool)
        first[1:] = window[order][1:] != window[order][:-1]
        prefix = order[first]
        prefix = prefix[np.argsort(codes[prefix], kind="stable")]
        self.codes, self.window, self.offset = codes[prefix], window[prefix], offset[prefix]
        self.singles = bool((block.lengths == 1).any())

    def hits(self, numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and windows of all occurrences in numbered texts."""
        codes, places = _codes(numbers, self.base, self.singles)
        low, high = np.searchsorted(self.codes, codes, "left"), np.searchsorted(self.codes, codes, "right")
        times = high - low
        found = np.flatnonzero(times)
        times = times[found]
        place = np.repeat(places[found], times)
        entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low[found], times)
        window = self.window[entry]
        start = place - self.offset[entry]
        text = np.searchsorted(starts, place, "right") - 1
        # the window must lie inside the text
        inside = (start >= starts[text]) & (start + self.block.lengths[window] < starts[text + 1])
        start, window = start[inside], window[inside]
        for step in range(self.block.words.shape[1]):
            wanted = self.block.words[window, step]
            same = (wanted < 0) | (numbers[np.minimum(start + step, len(numbers) - 1)] == wanted)
            start, window = start[same], window[same]
        return start, window


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Block]:
    """Items in blocks of bounded size, read one after another."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.encode(F.col(text_col).cast("string"), "UTF-8").alias("text"))
    # one of a kind, in an order that does not depend on the reading
    items = items.filter("text IS NOT NULL").distinct().orderBy("item", "text")
    held, words = [], 0
    for row in items.toLocalIterator():
        held.append((row["item"], bytes(row["text"])))
        words += WINDOW * len(row["text"]) // 2 + 1
        if words >= BLOCK_WORDS * WINDOW:
            yield Block.of(held)
            held, words = [], 0
    if held:
        yield Block.of(held)


def _shingle_counts(docs: DataFrame, blocks: list) -> list[dict[int, int]]:
    """Occurrences in all documents of the shingles of each block's windows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = []
        for shared in blocks:
            block = shared.value
            codes = np.unique(block.shingles()[0])
            sums.append((block, codes, np.zeros(len(codes), np.int64), bool((block.lengths == 1).any())))
        for batch in in_parts(batches, "text"):
            texts = list(utf8_slices(batch.column(0)))
            for block, codes, total, singles in sums:
                found, _ = _codes(_numbered(texts, block.vocabulary)[0], len(block.vocabulary) + 1, singles)
                at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
                total += np.bincount(at[codes[at] == found], minlength=len(codes))
        for number, (_, codes, total, _) in enumerate(sums):
            there = np.flatnonzero(total)
            arrays = [pa.array(np.full(len(there), number), pa.int32()), pa.array(codes[there]), pa.array(total[there])]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "code", "times"])

    counted = docs.mapInArrow(count, "block int, code long, times long").groupBy("block", "code").agg(F.sum("times"))
    # at most one row per shingle of a block, and blocks are bounded
    counts: list[dict[int, int]] = [{} for _ in blocks]
    for block, code, times in counted.toLocalIterator():
        counts[block][code] = times
    return counts


def _spans(marks: np.ndarray) -> np.ndarray:
    """Starts and stops of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return edges.reshape(-1, 2)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``spans`` (word positions, half open,
    that any window covers, as flat starts and stops) and ``items`` (ids of the items
    with windows in it, sorted as strings, NULL last).

    NULL texts have no words; repeated documents give a row each; items without words
    match nothing. Items that share an id are one item, and so are those without one,
    which count as an item but have no name in the digest. A benchmark larger than one
    block makes a scan per block, merged by text.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    blocks = [spark.sparkContext.broadcast(block) for block in _blocks(benchmark, item_col, item_text_col)]
    counts = _shingle_counts(texts, blocks) if blocks else []
    rarities = [spark.sparkContext.broadcast(c) for c in counts]
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(picked.dtypes)["doc_id"]
    schema = f"doc_id {kind}, text_key binary, n_words long, spans array<long>, items array<string>"

    def scan(number: int | None) -> DataFrame:
        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = None if number is None else Matcher(blocks[number].value, rarities[number].value)
            for batch in in_parts(batches, "text"):
                rows = _matched(list(utf8_slices(batch.column(1))), matcher, len(blocks) > 1)
                columns = list(zip(*rows)) if rows else [(), (), (), ()]
                kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())]
                arrays = [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "n_words", "spans", "items"])

        return picked.mapInArrow(match, schema)

    if len(blocks) < 2:
        return scan(0 if blocks else None).drop("text_key")
    scans = scan(0)
    for number in range(1, len(blocks)):
        scans = scans.unionByName(scan(number))
    merged = scans.groupBy("doc_id", "text_key", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.count(F.lit(1)).alias("times"),
    )
    copies = F.explode(F.sequence(F.lit(1), (F.col("times") / len(blocks)).cast("int")))
    return merged.withColumn("copy", copies).select("doc_id", "n_words", "spans", "items")


def _matched(texts: list[bytes], matcher: Matcher | None, keyed: bool) -> list[tuple]:
    """Key, number of words, spans and items of each text."""
    key = (lambda t: sha256(t).digest()) if keyed else (lambda t: b"")
    if matcher is None:
        return [(key(t), len(words_of(t)), [], []) for t in texts]
    numbers, starts = _numbered(texts, matcher.block.vocabulary)
    start, window = matcher.hits(numbers, starts)
    order = np.argsort(start, kind="stable")
    start, window = start[order], window[order]
    stop = start + matcher.block.lengths[window]
    owner = np.searchsorted(starts, start, "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    rows = []
    for i, text in enumerate(texts):
        n, a, b = int(starts[i + 1] - starts[i] - 1), bounds[i], bounds[i + 1]
        if a == b:
            rows.append((key(text), n, [], []))
            continue
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, start[a:b] - starts[i], 1)
        np.add.at(marks, stop[a:b] - starts[i], -1)
        spans = _spans(np.cumsum(marks)[:n] > 0)
        items = sorted({item for w in set(window[a:b].tolist()) for item in matcher.block.owners[w]}, key=lambda item: (item is None, item or ""))
        rows.append((key(text), n, spans.ravel().tolist(), items))
    return rows


def hit_words(spans: list[int]) -> int:
    """Words that flat spans cover, overlaps once; spans of several blocks may overlap."""
    total, reached = 0, 0
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        total += max(0, b - max(a, reached))
        reached = max(reached, b)
    return total


def contamination_report(found: DataFrame) -> DataFrame:
    """Counts and digests of ``contamination``'s rows."""
    kind = dict(found.dtypes)["doc_id"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [hit_words(spans) for spans in batch.column(2).to_pylist()]
            items = batch.column(3).to_pylist()
            arrays = [
                batch.column(0),
                batch.column(1),
                pa.array(hits, pa.int64()),
                pa.array([len(i) for i in items], pa.int64()),
                pa.array([sha256(",".join([x for x in i if x is not None]).encode()).hexdigest() for i in items], pa.string()),
                pa.array([h > 0 for h in hits], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    schema = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return found.select("doc_id", "n_words", "spans", "items").mapInArrow(digest, schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark window occurs.

    Rows without words stay, repeated rows are judged one by one, items without an id
    count like others. Without items every row stays; an empty table stays empty.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(quoted(text_col)).cast("string").alias("text"))
    blocks = [spark.sparkContext.broadcast(block) for block in _blocks(benchmark, "item_id", "text")]
    counts = _shingle_counts(texts, blocks) if blocks else []
    kept = docs
    for block, rarity in zip(blocks, [spark.sparkContext.broadcast(c) for c in counts]):

        def cleaned(batches: Iterator[pa.RecordBatch], block=block, rarity=rarity) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block.value, rarity.value)
            for batch in in_parts(batches, text_col):
                texts = list(utf8_slices(batch.column(batch.schema.get_field_index(text_col))))
                numbers, starts = _numbered(texts, matcher.block.vocabulary)
                start, _ = matcher.hits(numbers, starts)
                clean = np.ones(len(texts), bool)
                clean[np.searchsorted(starts, start, "right") - 1] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(cleaned, docs.schema)
    return kept

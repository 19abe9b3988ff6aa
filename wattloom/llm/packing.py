"""Packing of token sequences by multiway differencing.

The pieces of a group of documents go into windows of one capacity. Karmarkar-Karp
differencing starts with one partial partition per piece, a list of window sums, and
merges the two with the widest spread, fullest windows with emptiest, until one partition
of nearly equal windows is left. The window count starts at what the tokens need and
rises whenever a window exceeds the capacity. As documents may be cut, the emptiest
windows then fill the gaps of the fullest. What is left of a group goes on to the next,
and what is left of the last is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import gc
import heapq
import re
from bisect import insort
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattloom.llm.bpe import WordBPE
from wattloom.llm.common import in_parts, quoted, utf8_slices

CAPACITY = 4096
# Windows that are filled together: a million tokens, which a task holds.
GROUP_WINDOWS = 256
# Words of one age that a Python worker remembers: some 100 MB for both ages.
WORDS = 300_000
# Text that is encoded together: the more, the fewer words come again and again.
TEXT_BYTES = 4 << 20
END = 2
TOKEN = np.dtype("<u4")


def differencing(lengths: list[int], windows: int) -> list[list[int]]:
    """Positions of ``lengths`` in ``windows`` lists whose sums are nearly equal.

    A partial partition is an ascending list of (sum, content); a content is a piece, a
    node that joins two contents, or -1 for none.
    """
    n = len(lengths)
    joined: list[tuple[int, int]] = []

    def join(a: int, b: int) -> int:
        if a < 0 or b < 0:
            return max(a, b)
        joined.append((a, b))
        return n + len(joined) - 1

    # of equal spreads the newest goes first, which leaves few partitions half made; a
    # single piece stays a number until it is merged
    heap: list[tuple[int, int, object]] = [(-length, -i, i) for i, length in enumerate(lengths)]
    heapq.heapify(heap)
    for made in range(n, 2 * n - 1):
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if isinstance(a, int):
            a, b = b, a
        if isinstance(a, int):
            a = [(0, -1)] * (windows - 1) + [(lengths[a], a)]
        if isinstance(b, int):
            least, content = a[0]
            del a[0]
            insort(a, (least + lengths[b], join(content, b)))
        else:
            a = sorted((x + y, join(c, d)) for (x, c), (y, d) in zip(a, reversed(b)))
        heapq.heappush(heap, (a[0][0] - a[-1][0], -made, a))
    last = heap[0][2] if heap else []
    if isinstance(last, int):
        last = [(0, -1)] * (windows - 1) + [(lengths[last], last)]
    filled = []
    for _, content in last:
        pieces, open_nodes = [], [content] if content >= 0 else []
        while open_nodes:
            node = open_nodes.pop()
            if node < n:
                pieces.append(node)
            else:
                open_nodes.extend(joined[node - n])
        filled.append(sorted(pieces))
    return filled


def windows_within(lengths: list[int], capacity: int) -> list[list[int]]:
    """``differencing`` with the first window count that exceeds the capacity nowhere.

    No length may exceed it. The steps of the count double, so that pieces of which no
    two fit together need few attempts.
    """
    windows, step = max(1, -(-sum(lengths) // capacity)), 1
    while True:
        filled = differencing(lengths, windows)
        if all(sum(lengths[i] for i in pieces) <= capacity for pieces in filled):
            return [pieces for pieces in filled if pieces]
        windows, step = min(windows + step, max(len(lengths), 1)), 2 * step


def topped_up(filled: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """The same (piece, start, length) in full windows and at most one last that is not.

    The emptiest windows give their pieces, cut where needed, to the fullest with a gap.
    """
    size = lambda window: sum(length for _, _, length in window)
    ranked = sorted(filled, key=size, reverse=True)
    at, giver = 0, len(ranked) - 1
    gap = capacity - size(ranked[0]) if ranked else 0
    while at < giver:
        if not gap:
            at += 1
            gap = capacity - size(ranked[at])
        elif not ranked[giver]:
            giver -= 1
        else:
            piece, start, length = ranked[giver].pop()
            moved = min(gap, length)
            ranked[at].append((piece, start, moved))
            if moved < length:
                ranked[giver].append((piece, start + moved, length - moved))
            gap -= moved
    return [window for window in ranked[: giver + 1] if window]


def in_powers(window: list[tuple[int, int, int]]) -> Iterator[list[tuple[int, int, int]]]:
    """The pieces of a window in sequences whose lengths are its set bits."""
    pieces, total = window[::-1], sum(length for _, _, length in window)
    for bit in reversed(range(total.bit_length())):
        room, part = total & 1 << bit, []
        while room:
            piece, start, length = pieces.pop()
            taken = min(room, length)
            part.append((piece, start, taken))
            if taken < length:
                pieces.append((piece, start + taken, length - taken))
            room -= taken
        if part:
            yield part


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for cycles: what is made inside has none, and the search would go
    through all remembered words again and again."""
    collects = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collects:
            gc.enable()


class TwoAges:
    """A bounded memory: what was used since the last change of ages stays, and what
    was not used for a whole age is forgotten."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def unknown(self, keys: list[str]) -> list[str]:
        """Of different keys those that are not in memory. All others are young then."""
        young = self.young
        missing = [key for key in keys if key not in young]
        if len(young) + len(missing) > self.size:
            self.young, self.old, missing = {}, young, keys
        old = self.old
        self.young.update({key: old[key] for key in missing if key in old})
        return [key for key in missing if key not in old]


def latin_pattern(pattern: str) -> re.Pattern:
    """A word pattern of Unicode classes for text up to U+00FF, with the classes written
    out, which the standard library matches faster."""
    for name in ("White_Space", "L", "N"):
        members = "".join(f"\\x{c:02x}" for c in range(256) if regex.match(rf"\p{{{name}}}", chr(c)))
        pattern = pattern.replace(f"\\p{{{name}}}", members)
    return re.compile(pattern)


class WordTokens:
    """Whole texts to token bytes. The library's model encodes words, which are remembered;
    Arrow finds the different words of many texts and puts their tokens one after another."""

    def __init__(self, path: str):
        self.bpe = WordBPE(path)
        self.special = {token: np.array([number], TOKEN).tobytes() for token, number in self.bpe.special.items()}
        self.latin = latin_pattern(self.bpe.words.pattern)
        self.model = Tokenizer.from_file(path).model
        self.shown = dict(enumerate(self.bpe.alphabet))
        self.known = TwoAges(WORDS)

    def _words(self, text: str) -> list[str]:
        """The words of a text without special tokens; none holds white space."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [word for chunk in self.bpe.split(text) for word in self.bpe.chunk_words(chunk)]
        return self.latin.findall(self.bpe.normalize(text))

    def _tokens(self, words: list[str]) -> list[bytes]:
        """The tokens of different words."""
        new = self.known.unknown(words)
        tokenize, shown = self.model.tokenize, self.shown
        # the vocabulary spells bytes as printable characters, printable ASCII as itself
        spelled = [word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(shown) for word in new]
        merged = [[token.id for token in tokenize(word)] for word in spelled]
        stops = (np.cumsum([0, *map(len, merged)]) * TOKEN.itemsize).tolist()
        data = np.fromiter(chain.from_iterable(merged), TOKEN).tobytes()
        young = self.known.young
        young.update(zip(new, [data[a:b] for a, b in zip(stops, stops[1:])]))
        return [young[word] for word in words]

    def _with_special(self, text: str) -> bytes:
        found = []
        for part in self.bpe.special_split.split(text):
            words = self._words(part) if part not in self.special else []
            different = list(set(words))
            known = dict(zip(different, self._tokens(different)))
            found.append(self.special.get(part, b""))
            found.extend(known[word] for word in words)
        return b"".join(found)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The tokens of each text, in order."""
        special = {i: self._with_special(text) for i, text in enumerate(texts) if any(token in text for token in self.special)}
        lines = pa.array([" ".join(self._words(text)) if i not in special else "" for i, text in enumerate(texts)], pa.large_string())
        by_line = pc.split_pattern(lines, " ")
        different = by_line.flatten().dictionary_encode()
        tokens = pa.array(self._tokens(different.dictionary.to_pylist()), pa.large_binary()).take(different.indices)
        if len(tokens):
            _, stops, data = tokens.buffers()
            stops = np.frombuffer(stops, np.int64)[by_line.offsets.to_numpy()].tolist()
        for i in range(len(texts)):
            if i in special:
                yield special[i]
            elif stops[i] < stops[i + 1]:
                yield data[stops[i] : stops[i + 1]].to_pybytes()
            else:
                yield b""


@lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """One encoder, with its memory of words, for all tasks of a Python worker."""
    return WordTokens(path)


class Packer:
    """Takes documents in order and gives back packed pieces, a group at a time."""

    def __init__(self, capacity: int, group_windows: int):
        self.capacity, self.limit = capacity, capacity * group_windows
        self.sequences = 0
        # what is open: document, start of the piece in it, tokens of the piece
        self.open: list[tuple[tuple, int, bytes]] = []
        self.held = 0

    def _rows(self, window: list[tuple[int, int, int]], pieces: list[tuple[tuple, int, bytes]]) -> Iterator[tuple]:
        offset = 0
        for piece, start, length in window:
            (doc, doc_tokens), before, data = pieces[piece]
            tokens = data[TOKEN.itemsize * start : TOKEN.itemsize * (start + length)]
            yield doc, before + start, length, tokens, doc_tokens, self.sequences, offset
            offset += length
        self.sequences += 1

    def add(self, doc, data: bytes) -> Iterator[tuple]:
        """Rows that are decided once the document is in: what it fills alone, and a
        group when one is complete."""
        width, n = TOKEN.itemsize, len(data) // TOKEN.itemsize
        full = n - n % self.capacity
        for start in range(0, full, self.capacity):
            yield doc, start, self.capacity, data[width * start : width * (start + self.capacity)], n, self.sequences, 0
            self.sequences += 1
        if full < n:
            self.open.append(((doc, n), full, data[width * full :]))
            self.held += n - full
        if self.held >= self.limit:
            yield from self._close(False)

    def _close(self, last: bool) -> Iterator[tuple]:
        pieces = self.open
        lengths = [len(data) // TOKEN.itemsize for _, _, data in pieces]
        whole = [[(i, 0, lengths[i]) for i in window] for window in windows_within(lengths, self.capacity)]
        self.open, self.held = [], 0
        for window in topped_up(whole, self.capacity):
            size = sum(length for _, _, length in window)
            if size == self.capacity:
                yield from self._rows(window, pieces)
            elif last:
                for part in in_powers(window):
                    yield from self._rows(part, pieces)
            else:
                for piece, start, length in window:
                    doc, before, data = pieces[piece]
                    self.open.append((doc, before + start, data[TOKEN.itemsize * start : TOKEN.itemsize * (start + length)]))
                self.held = size

    def finish(self) -> Iterator[tuple]:
        yield from self._close(True)


def pack_documents(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    group_windows: int = GROUP_WINDOWS,
    end: int = END,
) -> DataFrame:
    """Every token of every row of ``docs`` in exactly one piece of one sequence.

    A document is its tokens by the tokenizer file ``path`` and then ``end``. A piece is
    ``doc_id``, ``start`` (tokens of the document before it), ``length``, ``tokens``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset``, its
    place in the sequence. Sequences are full, but for the last of each partition, whose
    lengths are powers of two.

    NULL and empty texts are documents of the one token ``end``. Rows are packed one by
    one, so repeated and NULL ids are documents of their own; other columns are not read.
    Documents longer than a sequence fill some alone. An empty table has no sequences.

    Partitions are packed apart, without a shuffle, in the order of id and text, so that
    a task that runs again packs the same. Read ``docs`` from a stored table.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    picked = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    kind = dict(picked.dtypes)["doc_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, id_type = Packer(capacity, group_windows), pa.null()
        first = TaskContext.get().partitionId() << 40
        closing = np.array([end], TOKEN).tobytes()

        def rows(found: list[tuple]) -> pa.RecordBatch:
            ids, *rest = zip(*found)
            sequences = np.array(rest[4], np.int64) + first
            arrays = [pa.array(ids, id_type), pa.array(rest[0], pa.int64()), pa.array(rest[1], pa.int64()), pa.array(rest[2], pa.binary())]
            arrays += [pa.array(rest[3], pa.int64()), pa.array(sequences), pa.array(rest[5], pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"])

        encoder = word_tokens(path)
        for batch in in_parts(batches, "text", TEXT_BYTES):
            id_type = batch.schema.field(0).type
            with uncollected():
                texts = [text.decode("utf-8", "replace") for text in utf8_slices(batch.column(1))]
                found: list[tuple] = []
                for doc, data in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                    found.extend(packer.add(doc, data + closing))
            if found:
                yield rows(found)
        if found := list(packer.finish()):
            yield rows(found)

    ordered = picked.sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(pack, f"doc_id {kind}, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long")

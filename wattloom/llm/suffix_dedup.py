"""Repeated substrings across documents, by longest-previous-factor arrays.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: the
longest previous factor (LPF) at the string's start is ``LENGTH`` or more. One suffix
array over a corpus cannot be distributed, so the text is first parsed, as in prefix-free
parsing, into blocks by content alone: every window of ``LENGTH`` bytes has as its key
the least hash of the ``GRAM``-byte strings inside, and a block is a run of window starts
of one key. Equal windows have equal keys, so each key is a small suffix-sorting problem
of its own:

1. Documents are dealt into groups. Each group reports its distinct keys, and keys that
   occur once in the corpus are dropped.
2. Each group emits its distinct blocks of the remaining keys; a block repeated inside
   the group is an earlier factor of itself and only marked.
3. Blocks meet by key. Their windows are sorted (a suffix array to depth ``LENGTH``),
   neighbours give common prefixes, and previous and next smaller text positions in that
   order give the LPF array.
4. Marks return to the documents.

A key of more than ``HOT_BLOCKS`` blocks is taken apart into single windows keyed by
their own bytes, of which a group emits each once, so no key gathers more rows than
there are groups or ``HOT_BLOCKS``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import fresh, utf8_slices

LENGTH, GRAM = 100, 32
# GRAM-byte strings in a window.
SPAN = LENGTH - GRAM + 1
HOT_BLOCKS = 10_000
# Longest run of window starts in one block; longer runs, as in periodic text, are cut.
MOST_STARTS = 256
# Window starts hashed at a time, so that the arrays stay in cache.
SLICE = 1 << 16
# Bytes of distinct block text suffix-sorted at a time; a key is never divided.
SORT_BYTES = 1 << 21
# Text of one group, which one task holds.
GROUP_BYTES = 8 << 20
NO_ID = -(1 << 63)

MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= MULTIPLIERS[3]
    x ^= x >> np.uint64(29)
    return x


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one integer each."""
    return np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=data.data, strides=(1,))


def window_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``LENGTH`` bytes the least hash of its ``GRAM``-byte strings,
    and the hashes."""
    words = _words(data)
    n = len(data) - GRAM + 1
    hashes = words[:n] * MULTIPLIERS[0]
    for step in range(1, GRAM // 8):
        hashes += words[8 * step : 8 * step + n] * MULTIPLIERS[step]
    least, width = _mix(hashes), 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    return np.minimum(least[:-rest], least[rest:]) if rest else least, hashes


def parse(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts and key of every block, and whether the hash that
    is its key occurs in it twice, as it must if two of its own windows are equal.

    ``bounds`` are the starts of the documents in ``data``, and its length. No window
    crosses a bound.
    """
    firsts, counts, keys, echoes = [], [], [], []
    total = len(data) - LENGTH + 1
    doc_starts = bounds[:-1]
    # from here on a window would reach into the next document
    dead = np.maximum(bounds[1:] - LENGTH + 1, doc_starts)
    for at in range(0, max(total, 0), SLICE):
        key, hashes = window_keys(data[at : at + SLICE + LENGTH - 1])
        cut = np.ones(len(key), bool)
        cut[1:] = key[1:] != key[:-1]
        for edges in (doc_starts, dead):
            inside = edges[np.searchsorted(edges, at) : np.searchsorted(edges, at + len(key))] - at
            cut[inside] = True
        start = np.flatnonzero(cut)
        count = np.diff(np.append(start, len(key)))
        if count.max() > MOST_STARTS:
            pieces = -(-count // MOST_STARTS)
            step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start, count = np.repeat(start, pieces) + step * MOST_STARTS, np.repeat(count, pieces) - step * MOST_STARTS
            count = np.minimum(count, MOST_STARTS)
        doc = np.searchsorted(doc_starts, start + at, "right") - 1
        live = start + at < dead[doc]
        start, count = start[live], count[live]
        around = np.lib.stride_tricks.sliding_window_view(hashes, SPAN)
        least, last = key[start], start + count - 1
        leftmost = start + (around[start] == least[:, None]).argmax(axis=1)
        rightmost = last + SPAN - 1 - (around[last, ::-1] == least[:, None]).argmax(axis=1)
        firsts.append(start + at)
        counts.append(count)
        keys.append(least)
        echoes.append(leftmost != rightmost)
    if not firsts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, bool)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(keys), np.concatenate(echoes)


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Slices of ``data`` as a binary array, gathered some at a time."""
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    gathered = np.empty(offsets[-1], np.uint8)
    edges = np.unique(np.append(np.searchsorted(offsets, np.arange(0, offsets[-1], SORT_BYTES)), len(starts)))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        shift = np.repeat(starts[a:b] - offsets[a:b], lengths[a:b])
        gathered[offsets[a] : offsets[b]] = data[np.arange(offsets[a], offsets[b]) + shift]
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(gathered)]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)


def _first_of_each(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which values are the first of their kind, and the kind of each value."""
    kinds = values.dictionary_encode().indices.to_numpy()
    first = np.zeros(len(kinds), bool)
    first[np.unique(kinds, return_index=True)[1]] = True
    return first, kinds


class Group:
    """The documents of a group in order of id and text, joined into one array.

    Rows equal in id and text are one document. Rows that share an id but not the text
    lie one after the other, and positions count through them.
    """

    def __init__(self, ids: list[int], texts: list[bytes]):
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.row_doc = np.zeros(len(ids), np.int64)
        docs: list[int] = []
        for row in order:
            if not docs or (ids[row], texts[row]) != (ids[docs[-1]], texts[docs[-1]]):
                docs.append(row)
            self.row_doc[row] = len(docs) - 1
        self.data = np.frombuffer(b"".join([texts[i] for i in docs]), np.uint8)
        self.bounds = np.concatenate(([0], np.cumsum([len(texts[i]) for i in docs]))).astype(np.int64)
        self.ids = np.array([ids[i] for i in docs], np.int64)
        new_id = np.ones(len(docs), bool)
        new_id[1:] = self.ids[1:] != self.ids[:-1]
        starts = self.bounds[:-1]
        # where the text of each document's id begins
        self.origin = starts[np.maximum.accumulate(np.where(new_id, np.arange(len(docs)), 0))] if docs else starts

    def locate(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        doc = np.searchsorted(self.bounds, starts, "right") - 1
        # an empty document shares its start with the next one
        return self.ids[doc], starts - self.origin[doc]


def _tables(table: pa.Table, id_name: str, text_name: str) -> Group:
    return Group(table.column(id_name).to_pylist(), list(utf8_slices(table.column(text_name))))


def group_blocks(group: Group, keys: np.ndarray, hot: np.ndarray) -> pa.Table:
    """The group's blocks of the given sorted keys, each distinct text once, and marks.

    A row with text is a block, one without a mark: window starts ``start`` up to
    ``start + starts`` of document ``doc`` start earlier as well.
    """
    first, count, key, echo = parse(group.data, group.bounds)
    at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
    chosen = keys[at] == key if len(keys) else np.zeros(len(key), bool)
    first, count, key, echo, is_hot = first[chosen], count[chosen], key[chosen], echo[chosen], hot[at[chosen]]
    if is_hot.any():
        # windows of hot keys one by one, keyed by their own bytes
        times = count[is_hot]
        single = np.repeat(first[is_hot], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        words, own = _words(group.data), np.zeros(len(single), np.uint64)
        for step in (*range(0, LENGTH - 8, 8), LENGTH - 8):
            own = _mix((own + words[single + step]) * MULTIPLIERS[step % 3])
        first = np.concatenate([first[~is_hot], single])
        count = np.concatenate([count[~is_hot], np.ones(len(single), np.int64)])
        key = np.concatenate([key[~is_hot], own])
        echo = np.concatenate([echo[~is_hot], np.zeros(len(single), bool)])
        order = np.argsort(first, kind="stable")
        first, count, key, echo = first[order], count[order], key[order], echo[order]
    texts = _gather(group.data, first, count + LENGTH - 1)
    new, _ = _first_of_each(texts)
    texts = texts.filter(pa.array(new)).cast(pa.binary())
    doc, start = group.locate(first)
    # consecutive marks of a document are one
    m_start, m_stop = _runs(doc[~new], start[~new], count[~new])
    m_doc = doc[~new][m_start[0]] if len(m_start[0]) else doc[:0]
    blocks = pa.table(
        {
            "key": pa.array(key[new].view(np.int64)),
            "doc": pa.array(doc[new]),
            "start": pa.array(start[new]),
            "starts": pa.array(count[new]),
            "echo": pa.array(echo[new]),
            "text": texts,
        }
    )
    marks = pa.table(
        {
            "key": pa.array(m_doc ^ m_start[1]),
            "doc": pa.array(m_doc),
            "start": pa.array(m_start[1]),
            "starts": pa.array(m_stop - m_start[1]),
            "echo": pa.array(np.zeros(len(m_doc), bool)),
            "text": pa.nulls(len(m_doc), pa.binary()),
        }
    )
    return pa.concat_tables([blocks, marks])


def _runs(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Rows in order, joined where one begins at the stop of the one before: the row
    that opens each run and its start, and where the run stops."""
    opens = np.ones(len(doc), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + count[:-1])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    return (first, start[first]), start[last] + count[last]


def suffix_array(windows: np.ndarray) -> np.ndarray:
    """Windows (rows of bytes) in lexicographic order, equal ones in text order."""
    width = windows.shape[1]
    return np.argsort(np.ascontiguousarray(windows).view(f"S{width}").ravel(), kind="stable")


def neighbour_prefixes(windows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each window and its predecessor in ``order``."""
    prefixes = np.zeros(len(order), np.int64)
    if len(order) > 1:
        differ = windows[order[1:]] != windows[order[:-1]]
        some = differ.any(axis=1)
        prefixes[1:] = np.where(some, differ.argmax(axis=1), windows.shape[1])
    return prefixes


def _to_nearest_smaller(order: np.ndarray, prefixes: np.ndarray, least: int) -> np.ndarray:
    """The prefix shared with the next smaller position on, where ``least`` or more.

    ``prefixes`` are shared with the next rank. Every rank points at a later one with
    only larger positions between; while that one is larger too, the pointer follows
    its own, so a run of n ranks takes about log n rounds.
    """
    n = len(order)
    value, reach = np.append(order, -1), np.append(prefixes, 0)
    ahead = np.append(np.arange(1, n + 1), n)
    rank = np.arange(n)
    while len(rank):
        target = ahead[rank]
        more = (value[target] > value[rank]) & (reach[rank] >= least)
        rank, target = rank[more], target[more]
        further, shared = ahead[target], np.minimum(reach[rank], reach[target])
        ahead[rank], reach[rank] = further, shared
    return np.where(reach[:n] >= least, reach[:n], 0)


def previous_factors(order: np.ndarray, prefixes: np.ndarray, least: int) -> np.ndarray:
    """The LPF array, in text order, where it is ``least`` or more; 0 elsewhere.

    The longest earlier factor of a position is shared with the nearest smaller position
    before it, or after it, in suffix order, and is as long as the least common prefix
    on the way. ``prefixes`` are shared with the rank before.
    """
    longest = np.zeros(len(order), np.int64)
    if len(order):
        after = _to_nearest_smaller(order, np.append(prefixes[1:], 0), least)
        before = _to_nearest_smaller(order[::-1], np.append(prefixes[1:][::-1], 0), least)[::-1]
        longest[order] = np.maximum(before, after)
    return longest


def _sorted_marks(key: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray, echo: np.ndarray, text: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Marks (document, start, stop) of blocks that come in order of key and text."""
    new, _ = _first_of_each(text)
    yield doc[~new], start[~new], start[~new] + count[~new]
    key, doc, start, count, text = key[new], doc[new], start[new], count[new], text.filter(pa.array(new))
    # a key with one text left has nothing to compare, unless with itself
    same = np.zeros(len(key), bool)
    same[1:] = key[1:] == key[:-1]
    shared = same | np.append(same[1:], False) | echo[new]
    doc, start, count, text = doc[shared], start[shared], count[shared], text.filter(pa.array(shared))
    if not len(doc):
        return
    data = np.frombuffer(b"".join(text.to_pylist()), np.uint8)
    sizes = count + LENGTH - 1
    origin = np.cumsum(sizes) - sizes
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    places = np.repeat(origin, count) + within
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[places]
    order = suffix_array(windows)
    lpf = previous_factors(order, neighbour_prefixes(windows, order), LENGTH)
    repeated = lpf >= LENGTH
    owner = np.repeat(np.arange(len(doc)), count)[repeated]
    position = start[owner] + within[repeated]
    (first, begin), stop = _runs(doc[owner], position, np.ones(len(owner), np.int64))
    yield doc[owner][first], begin, stop


def _repeated_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that occur more than once; rows come sorted by key."""
    held = [np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)]

    def close(key: np.ndarray, group: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        kind = np.cumsum(first) - 1
        total = np.bincount(kind, weights=times).astype(np.int64)[kind] if len(key) else times
        many = total > 1
        arrays = [pa.array(group[many]), pa.array(key[many]), pa.array(total[many] > HOT_BLOCKS)]
        return pa.RecordBatch.from_arrays(arrays, names=["grp", "key", "hot"])

    for batch in batches:
        held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
        if not len(held[0]):
            continue
        # the last key may go on in the next batch
        last = np.searchsorted(held[0], held[0][-1])
        yield close(*[h[:last] for h in held])
        held = [h[last:] for h in held]
    yield close(*held)


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks from blocks sorted by key, document and start."""
    held: list[pa.RecordBatch] = []
    size = 0

    def close(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        is_block = rows.column("text").combine_chunks().is_valid()
        plain = rows.filter(pc.invert(is_block))
        blocks = rows.filter(is_block)
        columns = [blocks.column(i).to_numpy() for i in range(5)]
        found = [(plain.column(1).to_numpy(), plain.column(2).to_numpy(), plain.column(2).to_numpy() + plain.column(3).to_numpy())]
        found.extend(_sorted_marks(*columns, blocks.column(5).cast(pa.large_binary()).combine_chunks()))
        for doc, start, stop in found:
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(start), pa.array(stop)], names=["doc", "start", "stop"])

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= SORT_BYTES:
            rows = pa.Table.from_batches(held)
            key = rows.column(0).to_numpy()
            last = int(np.searchsorted(key, key[-1]))
            if last:
                yield from close(rows.slice(0, last))
                held = rows.slice(last).combine_chunks().to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield from close(pa.Table.from_batches(held))


def covered(starts: np.ndarray, stops: np.ndarray, length: int) -> np.ndarray:
    """Bytes covered by a window that starts in any of the ranges, as sorted disjoint
    starts and stops."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    begin, end = starts[order], np.minimum(stops[order] + LENGTH - 1, length)
    reach = np.maximum.accumulate(end)
    opens = np.ones(len(begin), bool)
    opens[1:] = begin[1:] > reach[:-1]
    first = np.flatnonzero(opens)
    return np.column_stack([begin[first], np.append(reach[first[1:] - 1], reach[-1])])


def _with_spans(docs: DataFrame, id_col: str, text_col: str, finish, schema: str) -> DataFrame:
    """``finish(table, spans)`` for every group of ``docs``; ``spans`` holds the removed
    byte ranges of each row."""
    spark = docs.sparkSession
    grp, key_id = fresh(docs, "grp", "doc_key")
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // GROUP_BYTES))
    keyed = docs.withColumn(key_id, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
    dealt = keyed.withColumn(grp, F.pmod(F.xxhash64(key_id), F.lit(groups)).cast("int")).repartition(groups, grp)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            numbers = batch.column(batch.schema.get_field_index(grp)).to_numpy()
            for number in np.unique(numbers).tolist():
                part = pa.Table.from_batches([batch]).filter(pa.array(numbers == number))
                texts = list(utf8_slices(part.column(text_col)))
                bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
                _, _, key, echo = parse(np.frombuffer(b"".join(texts), np.uint8), bounds)
                # a key whose block may repeat itself counts as repeated
                found.setdefault(number, []).extend([key, key[echo]])
        for number, keys in found.items():
            key, times = np.unique(np.concatenate(keys), return_counts=True)
            arrays = [pa.array(key.view(np.int64)), pa.array(np.full(len(key), number, np.int32)), pa.array(times)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "grp", "times"])

    def blocks(table: pa.Table, keys: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        wanted = keys.column("key").to_numpy().view(np.uint64)
        order = np.argsort(wanted)
        return group_blocks(_tables(table, key_id, text_col), wanted[order], keys.column("hot").to_numpy()[order])

    def apply(table: pa.Table, marks: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        group = _tables(table, key_id, text_col)
        doc, start, stop = [marks.column(name).to_numpy() for name in ("doc", "start", "stop")]
        order = np.argsort(doc, kind="stable")
        doc, start, stop = doc[order], start[order], stop[order]
        spans = []
        for number, at in enumerate(group.row_doc.tolist()):
            a, b = np.searchsorted(doc, [group.ids[at], group.ids[at] + 1]) if group.ids[at] < (1 << 63) - 1 else (np.searchsorted(doc, group.ids[at]), len(doc))
            begin = group.bounds[at] - group.origin[at]
            length = group.bounds[at + 1] - group.bounds[at]
            own = (start[a:b] >= begin) & (start[a:b] < begin + length)
            spans.append(covered(start[a:b][own] - begin, stop[a:b][own] - begin, length))
        return finish(table.drop_columns([grp, key_id]), spans)

    keys = dealt.mapInArrow(report, "key long, grp int, times long").repartition("key").sortWithinPartitions("key")
    repeated = keys.mapInArrow(_repeated_keys, "grp int, key long, hot boolean")
    block_schema = "key long, doc long, start long, starts long, echo boolean, text binary"
    met = dealt.groupBy(grp).cogroup(repeated.groupBy("grp")).applyInArrow(blocks, block_schema)
    marks = met.repartition("key").sortWithinPartitions("key", "doc", "start").mapInArrow(_marks, "doc long, start long, stop long")
    marks = marks.withColumn("grp", F.pmod(F.xxhash64("doc"), F.lit(groups)).cast("int"))
    return dealt.groupBy(grp).cogroup(marks.groupBy("grp")).applyInArrow(apply, schema)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_bytes``, ``spans`` (removed byte ranges as
    flat starts and stops) and ``kept_sha256`` of the remaining bytes.

    Earlier means a smaller id, or the same text further left. NULL text is empty; rows
    without an id come first; rows equal in id and text are one document, and each gets
    its result; rows that share an id only are ordered by text. Ids are longs, of which
    the least is reserved.
    """
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def finish(table: pa.Table, spans: list[np.ndarray]) -> pa.Table:
        sizes, digests = [], []
        for text, cut in zip(utf8_slices(table.column("text")), spans):
            kept = sha256()
            at = 0
            for a, b in cut.tolist():
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            sizes.append(len(text))
            digests.append(kept.hexdigest())
        flat = pa.array([s.ravel() for s in spans], pa.list_(pa.int64()))
        return pa.table({"doc_id": table.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "spans": flat, "kept_sha256": pa.array(digests, pa.string())})

    return _with_spans(picked, "doc_id", "text", finish, "doc_id long, n_bytes long, spans array<long>, kept_sha256 string")


def whole_points(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The part of a byte range that holds whole code points."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, later copies cut from the text.

    As ``repeated_spans``, but a code point goes only if all of its bytes do.
    """
    # grouped tables cannot name columns with dots in them
    names = [f"column_{i}" for i in range(len(docs.columns))]
    original, docs = docs.columns, docs.toDF(*names)
    id_col, text_col = names[original.index(id_col)], names[original.index(text_col)]

    def finish(table: pa.Table, spans: list[np.ndarray]) -> pa.Table:
        cleaned: list[bytes | None] = []
        column = table.column(text_col).combine_chunks()
        for text, there, cut in zip(utf8_slices(column), column.is_valid().to_pylist(), spans):
            pieces, at = [], 0
            for a, b in cut.tolist():
                a, b = whole_points(text, a, b)
                pieces.append(text[at:a])
                at = b
            pieces.append(text[at:])
            cleaned.append(b"".join(pieces) if there else None)
        texts = pa.array(cleaned, pa.binary()).cast(pa.string())
        return table.set_column(table.schema.get_field_index(text_col), text_col, texts).select(names)

    cleaned = docs.withColumn(text_col, F.col(text_col).cast("string"))
    return _with_spans(cleaned, id_col, text_col, finish, cleaned.schema).toDF(*original)

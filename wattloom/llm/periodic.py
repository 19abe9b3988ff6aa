"""Periodic runs of words, by a dictionary of basic factors.

A basic factor is a stretch of ``2**j`` words. Level ``j`` of the dictionary names equal
factors of a text alike; a name of the next level is a pair of names ``2**j`` words apart.
Positions whose factor occurs once in its text lie in no run that the next levels could
add, so only the others go on, and in plain prose few do. A factor's successor is its
next occurrence; within twice the factor's length, neighbouring positions with
successors at one distance ``q`` are arithmetic progressions of occurrences and propose
the period ``q``. Proposals are extended word by word to both sides and deduplicated.

A run of period ``q`` and at least four periods is proposed, whole, at the level whose
factors are at least ``q`` and less than ``2 q`` words long: there a nearer occurrence
inside the run would give the run a smaller period. Texts are taken many at a time, with
words numbered apart in each, so that no factor recurs in another text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import in_parts, quoted, utf8_slices, word_sequence

LEAST_WORDS = 6
LEAST_PERIODS = 4


def _reach(words: np.ndarray, at: int, q: int) -> int:
    """How many words from ``at`` on equal the word ``q`` places after them."""
    n, count, step = len(words) - q, 0, 16
    while at + count < n:
        size = min(step, n - at - count)
        here = at + count
        differ = np.flatnonzero(words[here : here + size] != words[here + q : here + q + size])
        if len(differ):
            return count + int(differ[0])
        count += size
        step *= 2
    return count


def _back(words: np.ndarray, at: int, q: int) -> int:
    """How many words before ``at`` equal the word ``q`` places after them."""
    count, step = 0, 16
    while count < at:
        size = min(step, at - count)
        start = at - count - size
        differ = np.flatnonzero(words[start : start + size] != words[start + q : start + q + size])
        if len(differ):
            return count + size - 1 - int(differ[-1])
        count += size
        step *= 2
    return count


def proposals(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: starts, ends and distances of progressions of successors that a run of
    enough words and periods must have.

    ``words`` holds the numbered words of all texts, the longest of ``longest`` words.
    """
    n, size = len(words), 1
    places, codes = np.arange(n), words
    while len(places) and size < 2 * max(1, longest // LEAST_PERIODS):
        order = np.argsort(codes, kind="stable")
        ranked = codes[order]
        same = ranked[1:] == ranked[:-1]
        # successors: the sort is stable, so equal names stand in order of position
        here, after = places[order[:-1][same]], places[order[1:][same]]
        near = after - here <= 2 * size
        here, distance = here[near], (after - here)[near]
        by_place = np.argsort(here)
        here, distance = here[by_place], distance[by_place]
        if len(here):
            cuts = np.flatnonzero((np.diff(here) != 1) | (np.diff(distance) != 0)) + 1
            first, last = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(here)])) - 1
            q = distance[first]
            least = np.maximum(LEAST_WORDS, LEAST_PERIODS * q) - q - size + 1
            enough = last - first + 1 >= least
            first, last, q = first[enough], last[enough], q[enough]
            yield here[first], here[last] + size + q, q
        # names of this level; a factor that occurs once has none
        again = np.zeros(len(codes), bool)
        again[1:] = same
        again[:-1] |= same
        names = np.full(n, -1)
        names[places[order[again]]] = (np.cumsum(np.concatenate(([True], ~same))) - 1)[again]
        alive = places[names[places] >= 0]
        alive = alive[alive + size < n]
        alive = alive[names[alive + size] >= 0]
        codes = names[alive] * n + names[alive + size]
        places, size = alive, 2 * size


def runs_of(words: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """Start, length and period of every run in numbered words, by start and period."""
    found: dict[tuple[int, int], int] = {}
    for starts, ends, periods in proposals(words, len(words) if longest is None else longest):
        for start, end, q in zip(starts.tolist(), ends.tolist(), periods.tolist()):
            # inside a run that is known already nothing new can be proposed
            start -= _back(words, start, q)
            if (start, q) in found:
                continue
            length = end - start + _reach(words, end - q, q)
            if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
                found[start, q] = length
    return [(start, length, q) for (start, q), length in sorted(found.items())]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, apart for each text, and where each text starts."""
    numbers: list[int] = []
    starts, base = [0], 0
    for words in texts:
        known: dict[bytes, int] = {}
        numbers.extend([known.setdefault(w, base + len(known)) for w in words])
        base += len(known)
        starts.append(len(numbers))
    return np.array(numbers, np.int64), np.array(starts)


def text_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words."""
    numbers, starts = _numbered(texts)
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, q in runs_of(numbers, int(np.diff(starts).max(initial=0))):
        owner = int(np.searchsorted(starts, start, "right")) - 1
        result[owner].append((start - int(starts[owner]), length, q))
    return result


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by a space, less those after the first period of any run."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, length, q in runs:
        gone[start + q : start + length] = True
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` of every row of ``docs``.

    ``runs`` is an array of (``start``, ``length``, ``period``), counted in words from 0
    and ordered by start and period: stretches with that smallest period, of at least six
    words and four periods, that no neighbouring word extends. ``collapsed`` is the text
    without what follows the first period of a run, words joined by one space.

    NULL, empty and blank texts have no words and no runs. Every row is judged alone and
    whole, so repeated ids give a row each, and other columns are not read. A text is
    the most that a task holds; an empty table gives an empty result.
    """
    picked = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, "text"):
            texts = [word_sequence(text) for text in utf8_slices(batch.column(1))]
            runs = text_runs(texts)
            ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            flat = np.array([run for some in runs for run in some], np.int64).reshape(-1, 3)
            fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(run_type.value_type))
            kept = [collapse(words, some).decode("utf-8", "replace") for words, some in zip(texts, runs)]
            arrays = [batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.ListArray.from_arrays(ends, fields), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "runs", "collapsed"])

    kind = dict(picked.dtypes)["doc_id"]
    return picked.mapInArrow(scan, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_strongest(found: DataFrame) -> DataFrame:
    """``periodic_runs`` with ``strongest``, the run of the greatest length by period;
    of equal ones the first by start and period. NULL without a run."""
    first = F.get("runs", F.lit(0))
    strongest = F.aggregate(
        "runs",
        first,
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
    return found.withColumn("strongest", strongest)

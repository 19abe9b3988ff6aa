"""Language identification with bit-sliced Bloom filters over character n-grams.

One array of slots serves 64 languages: bit ``l`` of a slot belongs to language ``l``,
and an n-gram sets the bit of its language in ``HASHES`` slots. The AND of an n-gram's
slots is the mask of all languages that may contain it. Popcounts per language over a
text, less the false positives that the fill of each slice predicts, decide. A filter
holds the n-grams that occur in a fixed share of a language's training documents, whose
number has a bound that does not grow with the corpus.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import in_parts, stored

HASHES = 3
SLOT_BITS = 20  # 2^20 slots of 8 bytes for every 64 languages
SIZES = (2, 3)
# A part of a text, in code points; longer texts are taken in parts that overlap.
PART = 1 << 18
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For every code point its lower-case letter, or 0 where it is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if unicodedata.category(char)[0] == "L":
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def _mixed(codes: np.ndarray, turn: int) -> np.ndarray:
    """A slot for every n-gram code, by the ``turn``-th hash."""
    x = codes * np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)[turn])
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def ngrams(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams of letters and word edges, and where each starts.

    Non-letters are edges; an n-gram may begin or end with one, but holds a letter and
    no edge inside.
    """
    low = letters()[points].astype(np.uint64)
    codes, places = [], []
    for size in SIZES:
        if len(low) < size:
            continue
        columns = [low[i : len(low) - size + 1 + i] for i in range(size)]
        code = np.full(len(columns[0]), size, np.uint64)
        for column in columns:
            code = (code << np.uint64(21)) | column
        inner = columns[0] + columns[1] > 0
        for column in columns[1:-1]:
            inner &= column > 0
        there = np.flatnonzero(inner)
        codes.append(code[there])
        places.append(there)
    if not codes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(codes), np.concatenate(places)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _parts(points: np.ndarray) -> Iterator[np.ndarray]:
    """Parts that overlap so that no n-gram is lost."""
    for at in range(0, max(1, len(points)), PART):
        yield points[at : at + PART + max(SIZES) - 1]


@dataclass
class LanguageFilter:
    languages: list[str]
    slots: np.ndarray  # uint64 masks, a row for every 64 languages
    false_rate: np.ndarray  # chance that an absent n-gram seems present, by language

    @staticmethod
    def of(grams: dict[str, np.ndarray]) -> LanguageFilter:
        languages = sorted(grams)
        slots, rates = np.zeros((-(-len(languages) // 64), 1 << SLOT_BITS), np.uint64), []
        for number, language in enumerate(languages):
            row, bit = slots[number // 64], np.uint64(1 << number % 64)
            for turn in range(HASHES):
                row[_mixed(grams[language], turn)] |= bit
            fill = np.count_nonzero(row & bit) / len(row)
            rates.append(fill**HASHES)
        return LanguageFilter(languages, slots, np.array(rates))

    def masks(self, codes: np.ndarray) -> np.ndarray:
        """For every n-gram the languages that may hold it, 64 to a row."""
        found = self.slots[:, _mixed(codes, 0)]
        for turn in range(1, HASHES):
            found &= self.slots[:, _mixed(codes, turn)]
        return found

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Languages and scores. The score is the winner's share of the text's n-grams
        after correction, times its lead over the runner-up, from 0 to 1."""
        total, popcounts = np.zeros(len(texts)), np.zeros((len(texts), len(self.languages)))
        lettered = np.zeros(len(texts), bool)
        joined: list[tuple[int, np.ndarray]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            if not joined:
                return
            # a line end between texts keeps their n-grams apart
            points = np.concatenate([x for _, p in joined for x in (p, [10])]).astype(np.uint32)
            bounds = np.cumsum([0] + [len(p) + 1 for _, p in joined])
            owners = np.array([i for i, _ in joined])
            starts_letter = letters()[points] > 0
            has = np.add.reduceat(starts_letter, bounds[:-1]) > 0
            np.logical_or.at(lettered, owners, has)
            codes, places = ngrams(points)
            owner = owners[np.searchsorted(bounds, places, "right") - 1]
            found = self.masks(codes)
            total[:] += np.bincount(owner, minlength=len(texts))
            for number in range(len(self.languages)):
                bit = (found[number // 64] >> np.uint64(number % 64)) & np.uint64(1)
                popcounts[:, number] += np.bincount(owner, weights=bit, minlength=len(texts))
            joined.clear()
            held = 0

        for number, text in enumerate(texts):
            for part in _parts(_points(text)):
                joined.append((number, part))
                held += len(part)
                if held >= PART:
                    flush()
        flush()
        labels, scores = [], []
        shares = (popcounts - total[:, None] * self.false_rate) / np.maximum(total[:, None] * (1 - self.false_rate), 1e-9)
        shares = np.clip(shares, 0, 1)
        for number in range(len(texts)):
            if not lettered[number] or not self.languages:
                labels.append(UNKNOWN)
                scores.append(0.0)
                continue
            ranked = np.argsort(-shares[number], kind="stable")
            best = shares[number][ranked[0]]
            second = shares[number][ranked[1]] if len(ranked) > 1 else 0.0
            labels.append(self.languages[ranked[0]])
            scores.append(float(best * (1 - 0.5 * second / best)) if best > 0 else 0.0)
        return labels, scores


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 3_000,
    least_share: float = 0.005,
) -> LanguageFilter:
    """A filter from labelled documents.

    At most about ``per_language`` documents of each language are used, chosen by a hash
    of their id; texts are whole. A language keeps the n-grams that occur in at least
    ``least_share`` of its chosen documents. The languages themselves, distinct labels,
    are listed on the driver.
    """
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    labelled = labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = labelled.groupBy("lang").count().collect()
    if not sizes:
        return LanguageFilter.of({})
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(1_000_000))
    shares = [(row["lang"], min(1_000_000, -(-per_language * 1_000_000 // row["count"]))) for row in sizes]
    # a local table, whose size Spark knows, so that texts need not be shuffled to meet it
    rates = docs.sparkSession.createDataFrame(shares, "lang string, share long")
    chosen = labelled.join(rates, "lang").filter(draw < F.col("share"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(0)):
                codes = [np.unique(ngrams(part)[0]) for part in _parts(_points(text.as_py()))]
                codes = np.unique(np.concatenate(codes))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.view(np.int64))], names=["lang", "gram"])
            yield pa.RecordBatch.from_arrays([pa.array([lang for lang in batch.column(1).to_pylist()], pa.string()), pa.nulls(len(batch), pa.int64())], names=["lang", "gram"])

    # a NULL n-gram counts the documents themselves
    counted = chosen.select("text", "lang").mapInArrow(grams, "lang string, gram long").groupBy("lang", "gram").count()
    counted = stored(counted, "language-grams")
    documents = counted.filter("gram IS NULL").select("lang", F.col("count").alias("documents"))
    # a document holds few n-grams on average, so those in a fixed share of all are few
    common = counted.join(documents, "lang").filter(F.col("gram").isNotNull() & (F.col("count") >= F.greatest(F.lit(2), F.ceil(F.col("documents") * least_share))))
    found: dict[str, list[int]] = {row["lang"]: [] for row in sizes}
    for lang, gram in common.select("lang", "gram").toLocalIterator():
        found[lang].append(gram)
    return LanguageFilter.of({lang: np.sort(np.array(list_, np.int64)).view(np.uint64) for lang, list_ in found.items()})


def identify(docs: DataFrame, learned: LanguageFilter, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, from its text alone.

    ``und`` and 0 where the text is NULL or has no letter. The filter is 8 MB at any
    scale; texts are read whole, long ones in parts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language_filter = shared.value
        for batch in in_parts(batches, "text"):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            labels, scores = language_filter.predict(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = dict(picked.dtypes)["doc_id"]
    return picked.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """Documents kept from learning: a fifth by CRC-32 of the id; a NULL id is held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))

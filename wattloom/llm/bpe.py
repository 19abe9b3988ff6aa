"""BPE encoding with a segment tree over the ranks of adjacent pairs.

The tokenizer's JSON file gives vocabulary, merges and word pattern. A word is a row of
symbols; leaf ``i`` of a segment tree holds the rank of the merge of symbol ``i`` with
the next live one, an inner node the least of its children. The root names the next
merge, the leftmost one among equal ranks, and a merge updates at most three leaves and
their paths, until the root holds no rank. Many words take these steps together, one
tree per matrix row; long words have a tree of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
import unicodedata
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattloom.llm.common import in_parts, utf8_slices

# Encoded chunks that a Python worker remembers, some 60 MB; then it forgets the rare ones.
CACHED_CHUNKS = 150_000
# Texts are taken in parts of about so many characters, which bounds the words held.
PART_CHARS = 1 << 20
# Words up to so many bytes merge together; each size of tree has its own matrix.
TREE_SIZES = (4, 8, 16, 32, 64)


def byte_alphabet() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    extra = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class PairTree:
    """Ranks of adjacent pairs of one word, with the least at the root."""

    def __init__(self, ranks: list[int], none: int):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size, self.none = size, none
        self.nodes = [none] * size + ranks + [none] * (size - len(ranks))
        for node in range(size - 1, 0, -1):
            self.nodes[node] = min(self.nodes[2 * node], self.nodes[2 * node + 1])

    def set(self, leaf: int, rank: int) -> None:
        nodes, node = self.nodes, self.size + leaf
        nodes[node] = rank
        node >>= 1
        while node:
            least = min(nodes[2 * node], nodes[2 * node + 1])
            if nodes[node] == least:
                return
            nodes[node] = least
            node >>= 1

    def leftmost(self) -> int:
        """The first leaf that holds the root's rank, or -1."""
        nodes = self.nodes
        least = nodes[1]
        if least == self.none:
            return -1
        node = 1
        while node < self.size:
            node = 2 * node if nodes[2 * node] == least else 2 * node + 1
        return node - self.size


class WordBPE:
    """Encodes and decodes by a tokenizer file of words that end in a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.names = {number: token for token, number in self.vocab.items()}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.none = len(pairs)
        split = next(step for step in spec["pre_tokenizer"]["pretokenizers"] if step["type"] == "Split")
        # the library's white space is Unicode's, without U+001C to U+001F
        self.words = regex.compile(split["pattern"]["Regex"].replace("\\s", "\\p{White_Space}"))
        self.controls = regex.compile("[\x1c-\x1f]")
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.names.update({number: token for token, number in self.special.items()})
        self.special_split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.alphabet = byte_alphabet()
        self.inner = np.array([self.vocab.get(c, -1) for c in self.alphabet], np.int64)
        self.final = np.array([self.vocab.get(c + self.suffix, -1) for c in self.alphabet], np.int64)
        codes = np.array([a * len(self.names) + b for a, b in self.merges], np.int64)
        order = np.argsort(codes)
        self.codes = np.append(codes[order], np.iinfo(np.int64).max)
        self.ranks = np.append(np.array([rank for rank, _ in self.merges.values()], np.int32)[order], self.none).astype(np.int32)
        self.made = np.zeros(self.none + 1, np.int64)
        for rank, number in self.merges.values():
            self.made[rank] = number
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.cache: dict[str, tuple[int, str, str]] = {}

    def normalize(self, text: str) -> str:
        """As the file's normalizer: composed and lower case.

        Up to U+00FF lower case is the same in every Unicode version and composition
        changes nothing; other texts go through the library's own normalizer. White
        space only separates words here, so it is left as it is.
        """
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.normalizer.normalize_str(text)
        return text.lower()

    def merge(self, word: str) -> list[int]:
        """Ids of one word, by the segment tree."""
        symbols = [self.alphabet[b] for b in word.encode("utf-8")]
        symbols[-1] += self.suffix
        # a symbol that the vocabulary lacks is left out, as there is no unknown token
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        n = len(ids)
        if n < 2:
            return ids
        merges, none = self.merges, self.none
        lookup = lambda a, b: merges.get((ids[a], ids[b]), (none, -1))[0]
        tree = PairTree([lookup(i, i + 1) for i in range(n - 1)], none)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (at := tree.leftmost()) >= 0:
            gone = after[at]
            ids[at] = merges[(ids[at], ids[gone])][1]
            following = after[at] = after[gone]
            ids[gone] = -1
            if gone < n - 1:
                tree.set(gone, none)
            if following < n:
                before[following] = at
                tree.set(at, lookup(at, following))
            else:
                tree.set(at, none)
            if before[at] >= 0:
                tree.set(before[at], lookup(before[at], at))
        return [number for number in ids if number >= 0]

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = a * len(self.names) + b
        at = np.searchsorted(self.codes, wanted)
        return np.where(self.codes[at] == wanted, self.ranks[at], self.none).astype(np.int32)

    def _merge_rows(self, ids: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        """Merge every row of ``ids``, whose first ``lengths`` symbols are a word."""
        count, size = ids.shape
        none, place = self.none, np.arange(size)
        nodes = np.full((count, 2 * size), none, np.int32)
        paired = place[:-1] + 1 < lengths[:, None]
        nodes[:, size : 2 * size - 1][paired] = self._pair_ranks(ids[:, :-1][paired], ids[:, 1:][paired])
        half = size
        while half > 1:
            half //= 2
            nodes[:, half : 2 * half] = np.minimum(nodes[:, 2 * half : 4 * half : 2], nodes[:, 2 * half + 1 : 4 * half : 2])
        after, before = np.tile(place + 1, (count, 1)), np.tile(place - 1, (count, 1))

        def put(rows: np.ndarray, leaves: np.ndarray, ranks: np.ndarray) -> None:
            node = leaves + size
            nodes[rows, node] = ranks
            while size > 1 and len(node) and node[0] > 1:
                node = node >> 1
                nodes[rows, node] = np.minimum(nodes[rows, 2 * node], nodes[rows, 2 * node + 1])

        rows = np.flatnonzero(nodes[:, 1] < none)
        while len(rows):
            least, node = nodes[rows, 1], np.ones(len(rows), np.int64)
            for _ in range(size.bit_length() - 1):
                node = 2 * node
                node += nodes[rows, node] != least
            at = node - size
            gone = after[rows, at]
            following = after[rows, gone]
            ids[rows, at], ids[rows, gone] = self.made[least], -1
            after[rows, at] = following
            put(rows, gone, np.full(len(rows), none, np.int32))
            ranks, inside = np.full(len(rows), none, np.int32), np.flatnonzero(following < lengths[rows])
            before[rows[inside], following[inside]] = at[inside]
            ranks[inside] = self._pair_ranks(ids[rows[inside], at[inside]], ids[rows[inside], following[inside]])
            put(rows, at, ranks)
            preceded = np.flatnonzero(before[rows, at] >= 0)
            r, b = rows[preceded], before[rows[preceded], at[preceded]]
            put(r, b, self._pair_ranks(ids[r, b], ids[r, at[preceded]]))
            rows = rows[nodes[rows, 1] < none]
        live = ids >= 0
        flat, ends = ids[live].tolist(), np.cumsum(live.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merge_all(self, words: list[str]) -> list[list[int]]:
        """``merge`` of every word; words of one size class in one matrix."""
        raw = [word.encode("utf-8") for word in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        result: list[list[int]] = [[]] * len(raw)
        least = 0
        for size in TREE_SIZES:
            group = np.flatnonzero((sizes > least) & (sizes <= size))
            least = size
            if not len(group):
                continue
            lengths, matrix = sizes[group], np.full((len(group), size), -1, np.int64)
            data = np.frombuffer(b"".join([raw[i] for i in group.tolist()]), np.uint8)
            matrix[np.arange(size) < lengths[:, None]] = self.inner[data]
            matrix[np.arange(len(group)), lengths - 1] = self.final[data[np.cumsum(lengths) - 1]]
            # a word with a byte that the vocabulary lacks goes the single way
            whole = (matrix >= 0).sum(axis=1) == lengths
            for i in group[~whole].tolist():
                result[i] = self.merge(words[i])
            for i, ids in zip(group[whole].tolist(), self._merge_rows(matrix[whole], lengths[whole])):
                result[i] = ids
        for i in np.flatnonzero(sizes > least).tolist():
            result[i] = self.merge(words[i])
        return result

    def chunk_words(self, chunk: str) -> list[str]:
        """Words of a chunk. Beyond U+00FF letters and digits depend on the version of
        Unicode, and the library says what they are."""
        try:
            chunk.encode("latin-1")
        except UnicodeEncodeError:
            return [chunk[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(chunk)]
        return [chunk] if chunk.isalpha() else self.words.findall(chunk)

    def learn(self, chunks: set[str]) -> None:
        """Encode chunks, runs without white space, that are not in the cache."""
        if len(self.cache) + len(chunks) > CACHED_CHUNKS:
            # what this part uses stays, and with it the frequent chunks
            self.cache = {chunk: self.cache[chunk] for chunk in chunks if chunk in self.cache}
        new = [chunk for chunk in chunks if chunk not in self.cache]
        parts = [self.chunk_words(chunk) for chunk in new]
        words = list(set().union(*parts))
        encoded = dict(zip(words, self.merge_all(words)))
        names = self.names
        for chunk, part in zip(new, parts):
            ids = encoded[part[0]] if len(part) == 1 else [i for word in part for i in encoded[word]]
            self.cache[chunk] = (len(ids), " ".join(map(str, ids)), " ".join([names[i] for i in ids]))

    def split(self, text: str) -> list[str]:
        """Chunks of ``text``, and its special tokens after a space.

        No word of the pattern holds white space, so words of the chunks are the words
        of the text. ``str.split`` also splits at four control characters that are not
        Unicode white space; texts with those are split by words.
        """
        parts = self.special_split.split(text) if any(token in text for token in self.special) else [text]
        found = []
        for part in parts:
            if part in self.special:
                found.append(" " + part)
            elif self.controls.search(part):
                found.extend(self.words.findall(self.normalize(part)) if part.isascii() else self.chunk_words(self.normalize(part)))
            else:
                found.extend(self.normalize(part).split())
        return found

    def pieces(self, texts: list[str]) -> Iterator[list[tuple[int, str, str]]]:
        """For each text its chunks in order: the number of ids, the ids, their tokens."""
        at = 0
        while at < len(texts):
            stop, chars = at, 0
            while stop < len(texts) and chars < PART_CHARS:
                chars += len(texts[stop])
                stop += 1
            split = [self.split(text) for text in texts[at:stop]]
            wanted = set().union(*split)
            special = {" " + token for token in self.special} & wanted
            self.learn(wanted - special)
            for chunk in special:
                self.cache[chunk] = (1, str(self.special[chunk[1:]]), chunk[1:])
            known = self.cache
            for chunks in split:
                yield [known[c] for c in chunks]
            at = stop

    def encode(self, text: str) -> list[int]:
        return [int(i) for words in self.pieces([text]) for _, ids, _ in words for i in ids.split(" ") if i]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space: the file names no decoder."""
        return " ".join(self.names[i] for i in ids if i in self.names)


@lru_cache(maxsize=1)
def word_bpe(path: str) -> WordBPE:
    """One encoder, with its cache of words, for all tasks of a Python worker."""
    return WordBPE(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int) and ``decoded`` text of every row.

    NULL text encodes as empty. Each row is encoded alone and whole, so repeated ids
    give a row each. ``path`` must be readable by every executor.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in in_parts(batches, "text"):
            ids, decoded = [], []
            texts = [text.decode("utf-8", "replace") for text in utf8_slices(batch.column(1))]
            for pieces in bpe.pieces(texts):
                ids.append(np.array(" ".join([p[1] for p in pieces if p[0]]).split(), np.int32))
                decoded.append(" ".join([p[2] for p in pieces if p[0]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    kind = dict(picked.dtypes)["doc_id"]
    return picked.mapInArrow(encode, f"doc_id {kind}, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens`` and the digests of ids and decoded text, as
    ``encode_documents`` gives them, without carrying either out of the task."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in in_parts(batches, "text"):
            counts, ids, decoded = [], [], []
            texts = [text.decode("utf-8", "replace") for text in utf8_slices(batch.column(1))]
            for words in bpe.pieces(texts):
                pieces = [p for p in words if p[0]]
                counts.append(sum([p[0] for p in pieces]))
                ids.append(sha256(" ".join([p[1] for p in pieces]).encode()).hexdigest())
                decoded.append(sha256(" ".join([p[2] for p in pieces]).encode("utf-8")).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(picked.dtypes)["doc_id"]
    return picked.mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

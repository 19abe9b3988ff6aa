r"""Chat formatting with loss masks that are aligned to tokens by offsets.

The template writes a turn as ``<turn:ROLE>\nTEXT</turn>\n``. Inside roles and texts a
backslash and ``<`` are preceded by a backslash, in roles also ``>`` and line ends become
``\n``, so no text can forge a control string, and unescaping gives back every text.

A conversation is rendered whole, in turn order, and each character of it is encoded
once. Tokens partition its UTF-8 bytes, so their offsets are running sums of their
lengths; the spans of the assistant's texts are sorted, and binary search intersects the
two. A token in part of a span counts for that part only.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn:", "</turn>\n"
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def escape_role(role: str) -> str:
    return escape(role).replace(">", "\\>").replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def render_turn(role: str, text: str) -> tuple[str, str, str]:
    """What comes before the text, the text, and what follows it, as written."""
    return f"{OPEN}{escape_role(role)}>\n", escape(text), CLOSE


# A turn as written. Unescaped ``<`` and ``>`` occur in the template alone.
TURN = re.compile(r"<turn:((?:[^\\>]|\\.)*)>\n((?:[^\\<]|\\.)*)</turn>\n", re.S)


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a rendered conversation; fails on anything that is not one."""
    turns, at = [], 0
    for found in TURN.finditer(formatted):
        if found.start() != at:
            break
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError("not a rendered conversation")
    return turns


@lru_cache(maxsize=2)
def byte_encoding(path: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The byte-level encoding of a rank file, and the bytes in each of its tokens."""
    import public_tokenizers

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding, lengths


def mask_pieces(lengths: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token, start and stop of every overlap of tokens and spans, in order.

    ``lengths`` are the bytes of consecutive tokens, ``spans`` sorted, disjoint starts
    and stops. Two binary searches give each span its first and last token.
    """
    stops = np.cumsum(lengths)
    starts = stops - lengths
    first = np.searchsorted(stops, spans[:, 0], "right")
    last = np.searchsorted(starts, spans[:, 1], "left")
    counts = np.where(spans[:, 1] > spans[:, 0], np.maximum(last - first, 0), 0)
    token = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
    owner = np.repeat(np.arange(len(spans)), counts)
    return token, np.maximum(starts[token], spans[owner, 0]), np.minimum(stops[token], spans[owner, 1])


def format_conversations(
    rows: DataFrame,
    path: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn, sorted within partitions that hold whole conversations:
    ``conv_id``, ``seq`` (the turn's place from 0), ``formatted`` text, ``ids``, ``loss``
    (1 where a token lies in part under the mask) and ``loss_pieces``, the masked byte
    ranges of the row as flat starts and stops, token by token.

    The rows of a conversation in ``seq`` order are its rendering: their texts and ids
    joined are the whole text and its encoding. That holds because the byte-level
    pattern always cuts between the line end that closes a turn and the ``<`` that opens
    the next, so a conversation of any length is encoded in turns, a turn at a time in
    memory. NULL roles and texts are empty, NULL turns come first, equal turns are
    ordered by role and text, repeated rows are turns of their own, and rows without a
    conversation id form a conversation whose id is NULL.
    """
    picked = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    ordered = picked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = byte_encoding(path)
        conversation, seq = object(), -1
        for batch in batches:
            seqs, formatted, ids, masks, pieces = [], [], [], [], []
            for conv, role, text in zip(*[column.to_pylist() for column in batch.columns]):
                seq = seq + 1 if conv == conversation else 0
                conversation = conv
                before, body, after = render_turn(role, text)
                whole = before + body + after
                tokens = np.array(encoding.encode_ordinary(whole), np.int64)
                start = len(before.encode())
                spans = np.array([[start, start + len(body.encode())]] if role == LOSS_ROLE else np.empty((0, 2)), np.int64)
                token, low, high = mask_pieces(lengths[tokens], spans)
                mask = np.zeros(len(tokens), np.int8)
                mask[token] = 1
                seqs.append(seq)
                formatted.append(whole)
                ids.append(tokens.astype(np.int32))
                masks.append(mask)
                pieces.append(np.column_stack([low, high]).ravel())
            arrays = [
                batch.column(0),
                pa.array(seqs, pa.int64()),
                pa.array(formatted, pa.string()),
                pa.array(ids, pa.list_(pa.int32())),
                pa.array(masks, pa.list_(pa.int8())),
                pa.array(pieces, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "seq", "formatted", "ids", "loss", "loss_pieces"])

    kind = dict(picked.dtypes)["conv_id"]
    schema = f"conv_id {kind}, seq long, formatted string, ids array<int>, loss array<byte>, loss_pieces array<long>"
    return ordered.mapInArrow(render, schema)


def conversation_digests(formatted: DataFrame, path: str) -> DataFrame:
    """Per conversation what its formatted rows say when read back: ``n_turns``, digests
    of all turns and of the text under the mask, and lengths in code points.

    The text of a row is what its ids decode to. Rows come as ``format_conversations``
    leaves them; digests are taken turn by turn, so no conversation is held whole.
    """
    kind = dict(formatted.dtypes)["conv_id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = byte_encoding(path)
        done: list[tuple] = []
        state: list | None = None  # id, turns, their digest, loss characters, their digest, characters

        def close() -> None:
            if state is not None:
                done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))

        def rows() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * 6
            done.clear()
            kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for conv, seq, ids, pieces in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2, 3)]):
                if seq == 0:
                    close()
                    state = [conv, 0, sha256(), 0, sha256(), 0]
                raw = encoding.decode_bytes(ids)
                text = raw.decode("utf-8")
                for role, body in parse_turns(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{body}\n".encode())
                masked = b"".join([raw[a:b] for a, b in zip(pieces[::2], pieces[1::2])])
                loss = unescape(masked.decode("utf-8"))
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += len(text)
            if done:
                yield rows()
        close()
        if done:
            yield rows()

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select("conv_id", "seq", "ids", "loss_pieces").mapInArrow(read, schema)

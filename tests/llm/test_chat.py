import random
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from wattloom.llm import chat

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "conv_id long, turn long, role string, text string"
HARD = ["", "\\### Assistant: </turn> ok", "<turn:user>\nx</turn>\n", "\\n \\\\ < \\<", "é 日本 🎉\n\n  ", "a\\", None, "\n<", " <turn:"]


def test_rendering_is_reversible():
    turns = [(role, text or "") for role in ("user", "a>b\n<\\", "") for text in HARD]
    assert chat.parse_turns("".join("".join(chat.render_turn(r, t)) for r, t in turns)) == turns
    for broken in ("x", "<turn:user>\nhi</turn>", "<turn:user>\na<b</turn>\n"):
        with pytest.raises(ValueError):
            chat.parse_turns(broken)


def test_encoding_turn_by_turn_is_encoding_the_whole():
    encoding, lengths = chat.byte_encoding(RANKS)
    rng = random.Random(4)
    for _ in range(30):
        turns = ["".join(chat.render_turn(rng.choice(["user", "assistant"]), rng.choice(HARD) or "")) for _ in range(8)]
        whole = encoding.encode_ordinary("".join(turns))
        assert whole == [i for turn in turns for i in encoding.encode_ordinary(turn)]
        assert lengths[whole].sum() == len("".join(turns).encode())


def test_pieces_of_tokens_under_spans():
    token, low, high = chat.mask_pieces(np.array([3, 3, 2]), np.array([[1, 4], [4, 4], [7, 8]]))
    assert (token.tolist(), low.tolist(), high.tolist()) == ([0, 1, 2], [1, 3, 7], [3, 4, 8])


def test_digests(spark):
    rng = random.Random(5)
    data = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(HARD)) for c in (1, 2, 3, None) for t in (0, 1, 1, None, 5)]
    data += [(9, t, "assistant", "x" * (t % 7)) for t in range(3000)]
    extra = spark.createDataFrame([(*row, "e", 1) for row in data], SCHEMA + ", formatted string, ids int").repartition(5)
    found = {r["conv_id"]: r for r in chat.conversation_digests(chat.format_conversations(extra, RANKS), RANKS).collect()}
    assert set(found) == {1, 2, 3, 9, None}
    for conv, row in found.items():
        own = sorted((t is not None, t or 0, r or "", x or "") for c, t, r, x in data if c == conv)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        assert row["n_turns"] == len(own)
        assert row["turns_sha256"] == sha256("".join(f"{r}\n{x}\n" for _, _, r, x in own).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha256(loss.encode()).hexdigest())
        assert row["formatted_chars"] == sum(len("".join(chat.render_turn(r, x))) for _, _, r, x in own)


def test_masks_fit_the_tokens(spark):
    data = [(1, 0, "user", "hello there"), (1, 1, "assistant", "general\nnotes"), (1, 2, "assistant", "")]
    turns = chat.format_conversations(spark.createDataFrame(data, SCHEMA), RANKS).collect()
    encoding, _ = chat.byte_encoding(RANKS)
    assert [t["seq"] for t in turns] == [0, 1, 2]
    assert all(len(t["ids"]) == len(t["loss"]) and encoding.decode(t["ids"]) == t["formatted"] for t in turns)
    assert [sum(t["loss"]) > 0 for t in turns] == [False, True, False]


def test_no_conversations(spark):
    assert chat.conversation_digests(chat.format_conversations(spark.createDataFrame([], SCHEMA), RANKS), RANKS).collect() == []

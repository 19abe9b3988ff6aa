import random

import numpy as np
import pytest
from conftest import rows
from llm import brute

from wattloom.llm import suffix_dedup


def random_text(rng, size, letters="abcdeé \n"):
    return "".join(rng.choice(letters) for _ in range(size))


def corpus():
    rng = random.Random(1)
    passages = [random_text(rng, n) for n in (120, 300, 700, 99, 100, 101)]
    data = []
    for number in range(60):
        text = random_text(rng, rng.randrange(0, 600))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(passages)[rng.randrange(20) :] + text[at:]
        data.append((number, text))
    # periodic texts, copies, shared ids, repeated rows, no id, no text, NUL bytes
    data += [(500, "a" * 1000), (501, "ab" * 700), (502, "abc" * 500 + "a" * 300), (503, None), (504, ""), (505, data[3][1])]
    data += [(506, data[3][1][5:]), (None, data[4][1]), (7, data[4][1]), (7, data[5][1]), (8, data[8][1]), (8, data[8][1])]
    data += [(-3, data[9][1] + "x"), (507, "\0" * 400), (508, "x" + "\0" * 250), (509, "abcdefg" * 15)]
    return data


def expected(data):
    flags = brute.repeats(data)
    return sorted([(i, *brute.repeats_row(t, flags[i, t])) for i, t in data], key=repr)


def found(frame):
    got = []
    for row in suffix_dedup.repeated_spans(frame).collect():
        spans = row["spans"]
        got.append((row["doc_id"], row["n_bytes"], sum(spans[1::2]) - sum(spans[::2]), len(spans) // 2, row["kept_sha256"]))
    return sorted(got, key=repr)


@pytest.mark.parametrize("hot", [10_000, 2])
def test_spans_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT_BLOCKS", hot)
    data = corpus()
    assert found(spark.createDataFrame(data, "doc_id long, text string")) == expected(data)


def test_many_copies_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", 1)
    rng = random.Random(2)
    passage = random_text(rng, 400)
    data = [(i, passage) for i in range(40)] + [(100 + i, random_text(rng, 50) + passage[:150] + random_text(rng, 50)) for i in range(40)]
    assert found(spark.createDataFrame(data, "doc_id long, text string")) == expected(data)


def test_long_and_no_documents(spark):
    rng = random.Random(3)
    text = random_text(rng, 300_000)
    data = [(1, text), (2, text[1000:250_000] + "x" + text[:90_000])]
    got = found(spark.createDataFrame(data, "doc_id long, text string"))
    assert [g[2] for g in got] == [0, got[1][1] - 1]
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_factors_of_a_suffix_array():
    text = np.frombuffer(b"abracadabra abracadabra!" + b"\0" * 8, np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(text, 8)
    order = suffix_dedup.suffix_array(windows)
    lpf = suffix_dedup.previous_factors(order, suffix_dedup.neighbour_prefixes(windows, order), 3)
    data = text.tobytes()
    for at in range(len(windows)):
        longest = max((n for n in range(9) for e in range(at) if data[e : e + n] == data[at : at + n]), default=0)
        assert lpf[at] == (longest if longest >= 3 else 0)


def test_removal_keeps_rows_columns_and_whole_characters(spark):
    passage = "é" * 30 + "".join(chr(0x4E00 + i) for i in range(80))
    data = [(1, "x" + passage, "a"), (2, "yy" + passage + "z", "b"), (3, None, None), (None, "", "c"), (2, "yy" + passage + "z", "b")]
    frame = spark.createDataFrame(data, "doc_id long, TEXT string, grp string")
    cleaned = rows(suffix_dedup.remove_repeats(frame, text_col="TEXT"))
    assert cleaned == sorted([(1, "x" + passage, "a"), (2, "yyz", "b"), (2, "yyz", "b"), (3, None, None), (None, "", "c")], key=repr)


def test_columns_with_dots(spark):
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text, 5), (2, f"more {text}", 6)], "doc_id long, text string, `a.b` int")
    found = suffix_dedup.remove_repeats(docs)
    assert found.columns == docs.columns
    assert sorted((r[0], r[1][:4], r[2]) for r in found.collect()) == [(1, "word", 5), (2, "more", 6)]

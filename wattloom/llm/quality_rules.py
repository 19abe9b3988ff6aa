"""Quality rules whose cutoffs come with an exact bound on false rejections.

Counts of a text become five signals. For each stratum one half of the labelled
documents, all of it, proposes cutoffs; the other half, all of it, then tests the
proposed rules of that stratum as one: with ``k`` of ``n`` good documents
rejected, they are certified if ``P(Binomial(n, alpha) <= k)`` is at most ``delta``
divided by the number of strata tested (Bonferroni). With probability ``1 - delta`` no
certified stratum rejects more than ``alpha`` of its good documents. Rules of a stratum
that fails, or has no labels, are off there.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from wattloom.llm.common import fresh, in_parts, quoted, stored, utf8_slices, word_sequence

# Characters that mark markup and debris. Fixed by the operator's contract.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
SIGNALS = ["symbol_share", "dup_line_share", "repeat_share", "long_words", "short_words"]
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words covered by a window of ``size`` words that the text holds twice or more."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, last = 0, -1
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + size - max(at, last)
            last = at + size
    return covered


def text_counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    """The ``COUNTS`` of one whole text, given as UTF-8."""
    words = word_sequence(text)
    blanks = sum(text.count(blank) for blank in BLANKS)
    # continuation bytes do not start a code point
    points = len(text) if text.isascii() else len(text.decode("utf-8", "replace"))
    symbols = sum(text.count(symbol) for symbol in SYMBOLS)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return len(words), points - blanks, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def with_counts(docs: DataFrame, text: str, names: list[str]) -> DataFrame:
    """``docs`` with the ``COUNTS`` under ``names``; NULL text counts as empty."""
    schema = T.StructType(docs.schema.fields + [T.StructField(name, T.LongType()) for name in names])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, text):
            counts = [text_counts(value) for value in utf8_slices(batch.column(text))]
            columns = zip(*counts) if counts else [[] for _ in names]
            arrays = [pa.array(column, pa.int64()) for column in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *names])

    return docs.mapInArrow(count, schema)


def base_failed(count) -> Column:
    """Too short, or mostly repeated. ``count`` gives the column of a count."""
    repeats = count("n_repeat_words") * 100 > count("n_words") * MAX_REPEAT_PERCENT
    return (count("n_words") < MIN_WORDS) | repeats


def signals(count) -> list[Column]:
    """The ``SIGNALS``; a rule rejects where one exceeds its cutoff."""

    def share(part: str, whole: str) -> Column:
        return count(part).cast("double") / F.greatest(count(whole), F.lit(1)).cast("double")

    mean_word = share("word_chars", "n_words")
    values = [share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), mean_word, -mean_word]
    return [value.alias(name) for value, name in zip(values, SIGNALS)]


def binomial_cdf(k: int, n: int, p: float) -> float:
    """``P(Binomial(n, p) <= k)``, summed exactly."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    choose = math.lgamma(n + 1) - np.array([math.lgamma(x + 1) + math.lgamma(n - x + 1) for x in i])
    logs = choose + i * math.log(p) + (n - i) * math.log1p(-p)
    top = logs.max()
    return float(min(1.0, math.exp(top) * np.exp(logs - top).sum()))


def upper_bound(k: int, n: int, delta: float) -> float:
    """The exact (Clopper-Pearson) upper bound at level ``1 - delta``."""
    if k >= n:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        if binomial_cdf(k, n, mid) > delta:
            low = mid
        else:
            high = mid
    return high


def best_cutoffs(left: DataFrame, cost: float, gain: float) -> DataFrame:
    """``stratum``, ``s`` and ``cut``: per stratum the signal and cutoff worth most, if
    that is more than ``gain``.

    ``left`` has ``stratum``, ``good``, ``signals`` (NULL for those not wanted) and the
    stratum's ``n_good`` and ``n_bad``. A cutoff lies midway between neighbouring values
    and is worth the share of bad documents above it, less ``cost`` times the share of
    good ones. Values are counted, dealt out in their order, and summed up within their
    part and over parts, so that no stratum has to fit one task.
    """
    each = left.select("stratum", "n_good", "n_bad", "good", F.posexplode("signals").alias("s", "v")).filter("v IS NOT NULL")
    steps = each.groupBy("stratum", "n_good", "n_bad", "s", "v").agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    ranged = steps.repartitionByRange("stratum", "s", F.col("v").desc()).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "quality-steps")
    parts = ranged.groupBy("stratum", "s", "part").agg(F.sum("g").alias("g"), F.sum("b").alias("b"), F.max("v").alias("top"))
    following = Window.partitionBy("stratum", "s").orderBy("part")
    earlier = following.rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "stratum",
        "s",
        "part",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in ("g", "b")],
        F.lead("top").over(following).alias("v_after"),
    )
    inside = Window.partitionBy("stratum", "s", "part").orderBy(F.col("v").desc())
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g, b = (F.sum(n).over(so_far) + F.col(f"{n}_before") for n in ("g", "b"))
    worth = b.cast("double") / F.col("n_bad") - F.lit(float(cost)) * g.cast("double") / F.col("n_good")
    below = F.coalesce(F.lead("v").over(inside), F.col("v_after"))
    cuts = ranged.join(offsets, ["stratum", "s", "part"]).select("stratum", "s", "v", worth.alias("worth"), below.alias("below"))
    # of equal worth the first signal, and its greatest value
    first = F.max(F.struct("worth", (-F.col("s")).alias("back"), "v", "below")).alias("best")
    best = cuts.filter("below IS NOT NULL").groupBy("stratum").agg(first).filter(F.col("best.worth") > gain)
    return best.select("stratum", (-F.col("best.back")).alias("s"), ((F.col("best.v") + F.col("best.below")) / 2).alias("cut"))


def propose(labelled: DataFrame, cost: float, gain: float) -> DataFrame:
    """``stratum`` and a cutoff per signal, or infinity, for strata with a rule; signals
    are taken greedily, each on all rows of ``labelled`` that those before it leave. A
    signal whose best cutoff is worth no more than ``gain`` stays off."""
    sums = [F.greatest(F.count_if(c), F.lit(1)).cast("double").alias(n) for c, n in ((F.col("good"), "n_good"), (~F.col("good"), "n_bad"))]
    # stored, so that Spark knows how short they are before it plans a join
    totals = stored(labelled.groupBy("stratum").agg(*sums), "quality-totals")
    left = labelled.select("stratum", "good", F.array(*SIGNALS).alias("signals")).join(totals, "stratum")
    found = []
    for _ in SIGNALS:
        # one short row per stratum
        best = stored(best_cutoffs(left, cost, gain), "quality-cutoffs")
        if best.isEmpty():
            break
        found.append(best)
        passed = left.join(best, "stratum").filter(F.get("signals", F.col("s")) <= F.col("cut"))
        signals_left = F.transform("signals", lambda v, i: F.when(i != F.col("s"), v)).alias("signals")
        left = passed.select("stratum", "good", signals_left, "n_good", "n_bad")
    if not found:
        return labelled.sparkSession.createDataFrame([], "stratum string, " + ", ".join(f"{name} double" for name in SIGNALS))
    taken = found[0]
    for best in found[1:]:
        taken = taken.unionByName(best)
    cut = [F.coalesce(F.max(F.when(F.col("s") == i, F.col("cut"))), F.lit(math.inf)).alias(name) for i, name in enumerate(SIGNALS)]
    return stored(taken.groupBy("stratum").agg(*cut), "quality-cutoffs")


def calibrate(
    counts: DataFrame,
    labels: DataFrame,
    alpha: float = 0.05,
    delta: float = 0.05,
    cost: float = 20.0,
    gain: float = 0.01,
) -> DataFrame:
    """Certified cutoffs: ``stratum``, one column per signal, ``n_good``, ``n_false``,
    ``bound``; one row per stratum that passed.

    ``counts`` has ``doc_id``, ``stratum``, ``digest`` (of the text) and the ``COUNTS``;
    ``labels`` has ``doc_id`` and ``quality``. A document labelled more than once is good
    only if all its labels say so, and a text that several documents hold counts once in
    its stratum, good only if all of them are: the bound needs independent cases, and
    copies on both sides would not be. Halves go by the digest. Cutoffs are proposed from
    all labelled texts of one half, and certified by all of the other.
    """
    votes = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    column = lambda name: F.col(name)
    labelled = (
        counts.join(votes, "doc_id")
        .filter(~base_failed(column))
        .select("stratum", "digest", (F.col("quality") > 0).alias("good"), *signals(column))
        .groupBy("stratum", "digest")
        .agg(F.min("good").alias("good"), *[F.first(name).alias(name) for name in SIGNALS])
    )
    labelled = stored(labelled, "quality-labelled")
    half = F.pmod(F.xxhash64(F.col("digest"), F.lit("half")), F.lit(2))
    proposed = propose(labelled.filter(half == 0), cost, gain)
    cutoffs = proposed.select("stratum", *[F.col(name).alias(f"cut_{name}") for name in SIGNALS])
    rejected = F.lit(False)
    for name in SIGNALS:
        rejected = rejected | (F.col(name) > F.col(f"cut_{name}"))
    tested = (
        labelled.filter((half == 1) & F.col("good"))
        .join(cutoffs, "stratum")
        .groupBy("stratum", *[f"cut_{name}" for name in SIGNALS])
        .agg(F.count(F.lit(1)).alias("n_good"), F.sum(rejected.cast("long")).alias("n_false"))
    )
    tested = stored(tested, "quality-tested")
    share = delta / max(1, tested.count())

    @F.pandas_udf("double")
    def bound(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([upper_bound(int(x), int(y), share) for x, y in zip(k, n)], dtype=float)

    return (
        tested.withColumn("bound", bound("n_false", "n_good"))
        .filter(F.col("bound") <= alpha)
        .select("stratum", *[F.col(f"cut_{name}").alias(name) for name in SIGNALS], "n_good", "n_false", "bound")
    )


def verdicts(counted: DataFrame, cutoffs: DataFrame, stratum: str, names: list[str], flags: list[str]) -> DataFrame:
    """``counted`` with ``base_failed`` and ``kept`` under the two ``flags``.

    ``names`` are its columns of ``COUNTS`` and ``stratum`` its stratum column. Cutoffs
    are one row per stratum; the join keeps every row.
    """
    taken = fresh(counted, "_stratum", *[f"_cut_{name}" for name in SIGNALS])
    renamed = cutoffs.select(F.col("stratum").alias(taken[0]), *[F.col(s).alias(c) for s, c in zip(SIGNALS, taken[1:])])
    joined = counted.join(renamed, F.col(stratum) == F.col(taken[0]), "left")
    count = dict(zip(COUNTS, names)).__getitem__
    column = lambda name: F.col(count(name))
    rejected = F.lit(False)
    for signal, cut in zip(signals(column), taken[1:]):
        rejected = rejected | F.coalesce(signal > F.col(cut), F.lit(False))
    failed = base_failed(column)
    return joined.select(*[quoted(c) for c in counted.columns], failed.alias(flags[0]), (~failed & ~rejected).alias(flags[1]))


def stratum_of(column: str) -> Column:
    """NULL is a stratum of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(quoted(column)).cast("string")), F.lit("none"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **options) -> DataFrame:
    """Per document ``doc_id``, the ``COUNTS``, ``base_failed`` and ``kept``.

    Every row gives one row, repeated ids included. NULL text counts as empty, a NULL
    id is judged like any other but has no label, a NULL stratum is its own stratum.
    With no labels only the base rules reject. Other columns are not read.
    """
    picked = docs.select(F.col(quoted(id_col)).alias("doc_id"), stratum_of(stratum_col).alias("stratum"), F.col(quoted(text_col)).cast("string").alias("text"))
    picked = picked.withColumn("digest", F.xxhash64("text"))
    counts = stored(with_counts(picked, "text", COUNTS).drop("text"), "quality-counts")
    cutoffs = calibrate(counts, labels, **options)
    return verdicts(counts, cutoffs, "stratum", COUNTS, ["base_failed", "kept"]).drop("stratum", "digest")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge`` keeps.

    Counts are taken again beside the rows themselves rather than joined by id, so
    texts are not shuffled and repeated ids keep their own verdicts.
    """
    # Arrow functions cannot name columns with dots in them
    original = docs.columns
    docs = docs.toDF(*[f"column_{i}" for i in range(len(original))])
    id_col, text_col, stratum_col = (docs.columns[original.index(c)] for c in (id_col, text_col, stratum_col))
    picked = docs.select(F.col(quoted(id_col)).alias("doc_id"), stratum_of(stratum_col).alias("stratum"), F.col(quoted(text_col)).cast("string").alias("text"))
    picked = picked.withColumn("digest", F.xxhash64("text"))
    known = labels.select("doc_id", "quality")
    counts = stored(with_counts(picked, "text", COUNTS).drop("text"), "quality-counts")
    cutoffs = calibrate(counts, known, **options)
    names = fresh(docs, *[f"_{name}" for name in COUNTS])
    extra = fresh(docs, "_row_stratum", "_base_failed", "_kept")
    counted = with_counts(docs.withColumn(extra[0], stratum_of(stratum_col)), text_col, names)
    judged = verdicts(counted, cutoffs, extra[0], names, extra[1:])
    return judged.filter(F.col(extra[2])).select(*docs.columns).toDF(*original)

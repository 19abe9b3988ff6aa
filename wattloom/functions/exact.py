"""Means that do not depend on the order of their values.

A sum of doubles changes in its last bits with the order in which tasks deliver them.
Here every value is taken apart into a whole number and a fraction of 62 binary places,
which loses nothing of values from a thousandth on (and 2e-19 of smaller ones). Both are
integers, add up exactly, and meet again in the mean.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 1 << 62
# Values from here on, infinite ones and NaN have no fixed-point form.
LIMIT = "4e18D"


def exact_mean_sql(value: str, over: str = "") -> str:
    """SQL text of the mean of a double column, each aggregate followed by ``over``, a
    window in SQL text. NULL values are left out, and the mean of one value is that
    value. Where a value has no fixed-point form, the mean is the plain one."""
    v = f"`{value.replace('`', '``')}`"
    fits = f"abs({v}) < {LIMIT}"
    whole = f"sum(CASE WHEN {fits} THEN cast(floor({v}) AS decimal(20, 0)) END) {over}"
    part = f"sum(CASE WHEN {fits} THEN cast(floor(({v} - floor({v})) * {PLACES}D + 0.5D) AS decimal(20, 0)) END) {over}"
    carried = f"cast({whole} + cast({part} div {PLACES}BD AS decimal(20, 0)) AS double)"
    rest = f"cast({part} % {PLACES}BD AS double) / {PLACES}D"
    misfits = f"count(CASE WHEN NOT {fits} THEN 1 END) {over}"
    return f"CASE WHEN {misfits} > 0 THEN avg({v}) {over} ELSE ({carried} + {rest}) / nullif(count({v}) {over}, 0) END"


def exact_mean(value: str) -> Column:
    return F.expr(exact_mean_sql(value))

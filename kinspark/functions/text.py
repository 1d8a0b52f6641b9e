"""String helpers that follow Java's ``String.split(regex)`` contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body) -> Column:
    """let x = value in body(x).

    A lambda that uses an outer expression evaluates it once per element; bound
    to a lambda variable it is evaluated once.
    """
    return F.transform(F.array(value), body)[0]


def _without_trailing_empties(parts: Column) -> Column:
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("last"))
    last = F.aggregate(
        parts,
        start,
        lambda a, x: F.struct((a["i"] + 1).alias("i"), F.when(x != "", a["i"] + 1).otherwise(a["last"]).alias("last")),
        lambda a: a["last"],
    )
    return F.slice(parts, 1, last)


def java_split(col: Column | str, pattern: str) -> Column:
    """Split like Java's ``String.split(pattern)`` (limit 0), in time linear in the text.

    Spark's ``split`` keeps trailing empty strings; Java drops them, and an
    empty input gives ``[""]``.  Matching itself is the same left-to-right
    regex scan, so the tokens are Spark's with the trailing empties cut off.
    Leading and inner empty tokens stay.  NULL in, NULL out.
    """
    c = F.col(col) if isinstance(col, str) else col

    def split(x: Column) -> Column:
        return F.when(x == "", F.array(F.lit(""))).otherwise(bind(F.split(x, pattern, -1), _without_trailing_empties))

    return bind(c, split)

"""Similarity and rule measures as column expressions.

Every score is a function of the overlap ``m11`` and the two sizes (or
frequencies) ``fa`` and ``fb``; m10 = fa - m11 and m01 = fb - m11.
Integer parts are combined first and cast once, in the same order as the
documented formulas, so results are bit-equal to a SQL engine doing the
same arithmetic.  A zero denominator gives 0.0 (an empty set has no
similarity) instead of raising under ANSI mode.

Arguments are Spark SQL expressions (usually column names).  Each measure
is one SQL expression string, parsed once by Spark, so building a plan with
many scores costs few round trips to the JVM.  The ``*_sql`` functions give
the text, the plain names wrap it in a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def ratio_sql(num: str, den: str) -> str:
    """num / den in double; 0.0 where den is 0."""
    return f"CASE WHEN ({den}) <> 0 THEN {_d(num)} / {_d(den)} ELSE 0.0D END"


def jaccard_sql(m11: str, fa: str, fb: str) -> str:
    """|A n B| / |A u B| = m11 / (m10 + m11 + m01)."""
    return ratio_sql(m11, f"(({fa}) - ({m11})) + ({m11}) + (({fb}) - ({m11}))")


def euclid_sql(m11: str, fa: str, fb: str) -> str:
    """1 / (1 + sqrt(m10 + m01)): Euclidean distance of binary vectors, as a similarity."""
    return f"1.0D / (1.0D + SQRT({_d(f'(({fa}) - ({m11})) + (({fb}) - ({m11}))')}))"


def cosine_sql(m11: str, fa: str, fb: str) -> str:
    """m11 / (sqrt(|A|) * sqrt(|B|))."""
    den = f"(SQRT({_d(fa)}) * SQRT({_d(fb)}))"
    return f"CASE WHEN {den} <> 0 THEN {_d(m11)} / {den} ELSE 0.0D END"


def containment_sql(m11: str, fa: str) -> str:
    """m11 / |A|: share of A found in B (asymmetric)."""
    return ratio_sql(m11, fa)


def one_sided_euclid_sql(m11: str, fa: str) -> str:
    """1 / (1 + sqrt(|A| - m11)): distance counting only A's missing part."""
    return f"1.0D / (1.0D + SQRT({_d(f'({fa}) - ({m11})')}))"


def confidence_sql(support: str, ant_support: str) -> str:
    """support(a, b) / support(a)."""
    return f"({support}) / ({ant_support})"


def lift_sql(support: str, ant_support: str, cons_support: str) -> str:
    """support(a, b) / (support(a) * support(b)), in this operation order."""
    return f"({support}) / (({ant_support}) * ({cons_support}))"


def jaccard(m11: str, fa: str, fb: str) -> Column:
    return F.expr(jaccard_sql(m11, fa, fb))


def euclid(m11: str, fa: str, fb: str) -> Column:
    return F.expr(euclid_sql(m11, fa, fb))


def cosine(m11: str, fa: str, fb: str) -> Column:
    return F.expr(cosine_sql(m11, fa, fb))


def containment(m11: str, fa: str) -> Column:
    return F.expr(containment_sql(m11, fa))


def one_sided_euclid(m11: str, fa: str) -> Column:
    return F.expr(one_sided_euclid_sql(m11, fa))

"""Sinks: tables to files, and rows to the original text-line layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspark.operators.rules import RULE_COLUMNS


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] | None = None,
    **options: str,
) -> None:
    """Write ``df``; by default fails if ``path`` exists, like the original output dirs.  ``options`` are the writer's."""
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def _text(c: str) -> F.Column:
    # Java prints a missing value as "null"
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def to_lines(df: DataFrame, cols: Sequence[str], sep: str = ", ", line_col: str = "value") -> DataFrame:
    """One string column: the given columns joined by ``sep``."""
    return df.select(F.concat_ws(sep, *[_text(c) for c in cols]).alias(line_col))


def rule_lines(rules: DataFrame, with_descriptions: bool = False) -> DataFrame:
    """Rules as ``a, b, antSup, consSup, sup, conf, lift`` text lines.

    With descriptions, ``,antDesc,consDesc`` is appended (no spaces).
    """
    line = F.concat_ws(", ", *[_text(c) for c in RULE_COLUMNS])
    if with_descriptions:
        line = F.concat_ws(",", line, _text("ant_description"), _text("cons_description"))
    return rules.select(line.alias("value"))

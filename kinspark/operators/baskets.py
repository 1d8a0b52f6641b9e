"""Basket operators: flattening, counts, item support, basket pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinspark.operators.pairs import DEFAULT_TILE_ROWS, mirror, pair_counts, pair_rows, split_members


def flatten_baskets(
    baskets: DataFrame, trans_col: str = "trans_id", items_col: str = "items", item_col: str = "item"
) -> DataFrame:
    """One row per (transaction, list entry); repeats and empty strings kept."""
    return baskets.select(F.col(trans_col), F.explode(F.col(items_col)).alias(item_col))


def basket_count_col(df: DataFrame, trans_col: str = "trans_id", by: str = "distinct") -> Column:
    """Basket count N as a scalar-subquery column (stays inside the plan).

    ``by='distinct'``: distinct transaction ids (flat and retail input).
    ``by='rows'``: rows / lines, so a repeated id counts twice (listed input).
    """
    if by == "distinct":
        return df.select(F.count_distinct(F.col(trans_col))).scalar()
    if by == "rows":
        return df.select(F.count(F.lit(1))).scalar()
    raise ValueError(f"by must be 'distinct' or 'rows', not {by!r}")


def basket_count(df: DataFrame, trans_col: str = "trans_id", by: str = "distinct") -> DataFrame:
    """One-row table ``n_baskets`` (see :func:`basket_count_col`)."""
    if by == "distinct":
        return df.agg(F.count_distinct(F.col(trans_col)).alias("n_baskets"))
    if by == "rows":
        return df.agg(F.count(F.lit(1)).alias("n_baskets"))
    raise ValueError(f"by must be 'distinct' or 'rows', not {by!r}")


def item_frequency(
    flat: DataFrame,
    item_col: str = "item",
    trans_col: str = "trans_id",
    dedupe: bool = True,
    freq_col: str = "freq",
) -> DataFrame:
    """Baskets holding each item (set form) or rows per item (bag form)."""
    rows = flat.where(F.col(item_col).isNotNull())
    if dedupe:
        rows = rows.where(F.col(trans_col).isNotNull()).select(trans_col, item_col).distinct()
    return rows.groupBy(item_col).agg(F.count(F.lit(1)).alias(freq_col))


def _n_col(flat: DataFrame, trans_col: str, n_baskets) -> Column:
    if n_baskets is None:
        return basket_count_col(flat, trans_col, "distinct")
    if isinstance(n_baskets, Column):
        return n_baskets
    return F.lit(int(n_baskets))


def item_support(
    flat: DataFrame,
    item_col: str = "item",
    trans_col: str = "trans_id",
    dedupe: bool = True,
    n_baskets: int | Column | None = None,
) -> DataFrame:
    """(item, support) with support = frequency / N as double."""
    n = _n_col(flat, trans_col, n_baskets)
    freq = item_frequency(flat, item_col, trans_col, dedupe)
    return freq.select(item_col, (F.col("freq").cast("double") / n).alias("support"))


def basket_pairs(
    flat: DataFrame,
    trans_col: str = "trans_id",
    item_col: str = "item",
    dedupe: bool = False,
    tile_rows: int | None = DEFAULT_TILE_ROWS,
) -> DataFrame:
    """Per basket, every ordered pair of different items: (trans, antecedent, consequent, n).

    ``n`` is the number of joined row pairs behind it: 1 in set form, the
    product of the two repeat counts in bag form (the self-join's rows,
    collapsed).  Self pairs are excluded by value.
    """
    memb = split_members(flat, trans_col, item_col, dedupe, tile_rows)
    rows = pair_rows(memb, trans_col, item_col, a_col="antecedent", b_col="consequent")
    rows = rows.select(trans_col, "antecedent", "consequent", F.col("_w").alias("n"))
    return mirror(rows, "antecedent", "consequent", [trans_col, "n"]).select(
        trans_col, "antecedent", "consequent", "n"
    )


def pair_frequency(
    flat: DataFrame,
    trans_col: str = "trans_id",
    item_col: str = "item",
    dedupe: bool = True,
    tile_rows: int | None = DEFAULT_TILE_ROWS,
    min_count: int | None = None,
) -> DataFrame:
    """Baskets (or joined row pairs in bag form) per ordered (antecedent, consequent).

    ``min_count`` keeps pairs that count at least as much; items that can't leave before the self-join.
    """
    return pair_counts(
        flat,
        trans_col,
        item_col,
        dedupe=dedupe,
        ordered=True,
        tile_rows=tile_rows,
        a_col="antecedent",
        b_col="consequent",
        count_col="n",
        min_count=min_count,
    )

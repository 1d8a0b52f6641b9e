"""Pair counts of few items by matrix products, in place of a self-join.

Where a least count leaves few items, a group of m of them still costs the self-join m^2 / 2 rows, though
there are only ``n_items``^2 / 2 pairs to count.  A task lays its groups out as rows of a matrix of ``n_items``
columns, the weights as values, and adds up X^T X block by block; what is shuffled then are its sums, one row per
pair.  A group has at most ``n_items`` members here, so none is hot, and a task's memory is
``n_items``^2 counts and one block of ``CELLS``, whatever the input.  Partitions follow the rows, not the pairs.

The sums are exact: doubles (floats in set form) only where no sum of a block can pass their whole numbers, else longs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most items whose pairs are counted by products: n^2 longs are 32 MB then.
FEW_ITEMS = 2_048

#: Cells of a block: groups times items.
CELLS = 4_000_000

#: Member rows that a task is meant to count: its sums are up to n^2 / 2 rows, so fewer rows a task shuffle more.
ROWS_PER_PRODUCT = 4_000_000


def _sums(lead: int, n_items: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per partition of (_l) rows, arrays of (_k, _w): (_i, _j, _n) for i < j, i below ``lead``.

    What it returns is sent by value: it names nothing of this package, which workers needn't have.
    """
    size = max(1, CELLS // n_items)

    def product(x: np.ndarray, bound: int) -> np.ndarray:
        kind = np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64
        x = x.astype(kind)
        return (x[:, :lead].T @ x).astype(np.int64)

    def found(total: np.ndarray) -> pa.RecordBatch:
        i, j = np.nonzero(np.triu(total, 1))
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        return pa.RecordBatch.from_arrays(columns, names=["_i", "_j", "_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, passed = np.zeros((lead, n_items), np.int64), 0  # no sum passes the latter
        for batch in batches:
            lists = batch.column("_l")
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            members = lists.flatten()
            keys = members.field("_k").to_numpy(zero_copy_only=False)
            weights = members.field("_w").to_numpy(zero_copy_only=False)
            for at in range(0, len(ends), size):
                low = ends[at - 1] if at else 0
                upto = ends[at : at + size]
                x = np.zeros((len(upto), n_items), np.int64)
                rows = np.repeat(np.arange(len(upto)), np.diff(upto, prepend=low))
                x[rows, keys[low : upto[-1]]] = weights[low : upto[-1]]
                bound = int(x.max()) ** 2 * len(x)
                if bound >= 2**63:
                    raise OverflowError("repeats of items in baskets are too many to multiply as longs")
                if passed + bound >= 2**63:  # Spark's sum goes on, and tells an overflow
                    yield found(total)
                    total, passed = np.zeros_like(total), 0
                total += product(x, bound)
                passed += bound
        yield found(total)

    return run


def few_pair_counts(
    rows: DataFrame,
    freq: DataFrame,
    group_col: str,
    item_col: str,
    *,
    n_items: int,
    n_rows: int,
    dense: float | None = None,
    n_dense: int = 0,
) -> DataFrame:
    """(_x, _y, _n, _fx, _fy) for every unordered pair of items with a group in common, x before y.

    ``rows`` is a (group, item, _w) table with one row per group and item, ``freq`` the (item, freq) of the ``n_items`` items
    to count, ``n_rows`` the rows there are, about.  Pairs of two items of a frequency of ``dense`` or more, of which there are
    ``n_dense``, are left out.
    """
    lead = n_items - n_dense
    late = F.lit(False) if dense is None else F.col("freq") >= F.lit(float(dense))
    # n_items rows: numbered in one task, those that lead no pair last
    number = F.row_number().over(Window.orderBy(late, item_col)) - 1
    numbered = freq.select(F.col(item_col).alias("_item"), F.col("freq").alias("_freq"), number.cast("int").alias("_k"))
    own = rows.join(F.broadcast(numbered), F.col(item_col) == F.col("_item")).select(group_col, "_k", "_w")
    parts = max(math.ceil(n_rows / ROWS_PER_PRODUCT), min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows * 10 / ROWS_PER_PRODUCT)))
    dealt = own.repartition(max(2, parts), group_col)
    lists = dealt.groupBy(group_col).agg(F.collect_list(F.struct("_k", "_w")).alias("_l")).select("_l")
    sums = lists.mapInArrow(_sums(lead, n_items), "_i int, _j int, _n bigint")
    counts = sums.groupBy("_i", "_j").agg(F.sum("_n").alias("_n"))
    x = numbered.selectExpr("_k AS _i", "_item AS _x", "_freq AS _fx")
    y = numbered.selectExpr("_k AS _j", "_item AS _y", "_freq AS _fy")
    return counts.join(F.broadcast(x), "_i").join(F.broadcast(y), "_j").select("_x", "_y", "_n", "_fx", "_fy")

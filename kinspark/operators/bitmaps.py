"""Pair counts of frequent items by bit arrays, of all other pairs by the self-join.

A group (user, basket) of m items costs the self-join m^2 / 2 candidate pairs, and where a few
items are in a large share of all groups, most of these are pairs of such *dense* items.  Their
counts are the sizes of intersections of long sets, which bit arrays give 512 groups at a time:

* **dense ids without a global sort**: groups are dealt into buckets by a hash of the group, about
  ``FILL`` groups each, and numbered within their bucket; a block is 512 places of a bucket, so a
  bucket of more groups has a second block and none is left out.
* **bit arrays**: per block and dense item eight 64-bit words, one bit per group, by ``bit_or``.
* **counts**: items of a block meet pairwise, a pair counts ``bit_count`` of the ANDs of its words;
  the sum over blocks is a partial and a final aggregate, as in the self-join.
* **the rest**: a pair with an item that isn't dense is listed by its rarer item, as in the self-join
  (:func:`~kinspark.operators.pairs.pair_lists`): dense items list nothing, so two of them never meet.  Large groups are tiled.

An item is dense when at least ``share`` of all groups hold it.  A pair of dense items costs one
row per 512 groups here and at least ``512 * share^2`` rows in the self-join, so 1/16, where a
block saves half, is the least share that pays.  Item frequencies sum to the member rows, so there are at most
(rows per group) / share dense items, however many groups there are; beyond ``tile_rows`` of them a block is tiled.

Where a least count leaves few items, matrix products count the rest (:func:`split_few_counts`).

Set form only: a bit holds no multiplicity.  NULL groups and items count for nothing, repeated rows
once, an empty table has no pairs; a share above 1 makes every item sparse, 0 makes every item dense.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinspark.operators.pairs import DEFAULT_TILE_ROWS, PAIRS_PER_TASK, Members, listed_counts, ordered_pairs, with_frequency
from kinspark.operators.products import few_pair_counts

DENSE_SHARE = 1 / 16
WORDS = 8
PLACES = 64 * WORDS
FILL = 448  # groups per bucket on average: 512 is three deviations above


def group_bits(rows: DataFrame, group_col: str, item_col: str, n_groups: int) -> DataFrame:
    """(_bucket, _chunk, item, _f, _w0 .. _w7) of distinct (group, item, _f) rows: one row per block and item.

    One shuffle by bucket: numbering the groups and the aggregate both keep it.  A bucket has about ``FILL`` groups, each with its dense items.
    """
    buckets = max(1, math.ceil(n_groups / FILL))
    bucket = F.pmod(F.xxhash64(group_col), F.lit(buckets)).alias("_bucket")
    dealt = rows.select(bucket, F.col(group_col).alias("_g"), F.col(item_col).alias("_i"), "_f")
    numbered = dealt.withColumn("_place", F.dense_rank().over(Window.partitionBy("_bucket").orderBy("_g")) - 1)
    placed = numbered.selectExpr(
        "_bucket",
        f"CAST(_place div {PLACES} AS INT) AS _chunk",
        "_i",
        "_f",
        f"CAST((_place % {PLACES}) div 64 AS INT) AS _word",
        "shiftleft(1L, CAST(_place % 64 AS INT)) AS _bit",
    )
    words = [F.expr(f"bit_or(if(_word = {w}, _bit, 0L))").alias(f"_w{w}") for w in range(WORDS)]
    return placed.groupBy("_bucket", "_chunk", "_i").agg(F.max("_f").alias("_f"), *words)


def dense_pair_counts(bits: DataFrame, n_groups: int, n_items: int, tile_rows: int, slots: int) -> DataFrame:
    """(_a, _b, _n, _fa, _fb) for a < b of the items in ``bits`` that share a group."""
    blocks = max(1, math.ceil(n_groups / FILL))
    tiles = max(1, math.ceil(n_items / tile_rows))
    work = blocks * n_items * n_items / 2
    parts = max(1, math.ceil(work / PAIRS_PER_TASK), min(slots, blocks * tiles))
    keys = ["_bucket", "_chunk"]
    words = [f"_w{w}" for w in range(WORDS)]
    if tiles > 1:  # a block's items are cut into chunks, which meet in tiles of chunk <= chunk
        own = f"CAST(pmod(xxhash64(_i), {tiles}) AS INT)"
        low = bits.selectExpr("*", f"{own} AS _ci", f"explode(sequence({own}, {tiles - 1})) AS _cj")
        high = bits.selectExpr("*", f"explode(sequence(0, {own})) AS _ci", f"{own} AS _cj")
        keys += ["_ci", "_cj"]
        within = "_ci < _cj OR _x < _y"
    else:
        low = high = bits
        within = "_x < _y"
    low, high = (side.repartition(parts, *keys) for side in (low, high))
    left = low.selectExpr(*keys, "_i AS _x", "_f AS _fx", *[f"{w} AS _l{w}" for w in words])
    right = high.selectExpr(*keys, "_i AS _y", "_f AS _fy", *[f"{w} AS _r{w}" for w in words])
    common = " + ".join(f"bit_count(_l{w} & _r{w})" for w in words)
    met = left.join(right.hint("merge"), keys).where(within).selectExpr("_x", "_y", "_fx", "_fy", f"{common} AS _c").where("_c > 0")
    ordered = met.selectExpr(
        "least(_x, _y) AS _a", "greatest(_x, _y) AS _b", "_c", "if(_x < _y, _fx, _fy) AS _fa", "if(_x < _y, _fy, _fx) AS _fb"
    )
    return _summed(ordered, F.sum("_c"))


def _summed(pairs: DataFrame, n) -> DataFrame:
    return pairs.groupBy("_a", "_b").agg(n.alias("_n"), F.max("_fa").alias("_fa"), F.max("_fb").alias("_fb"))


def split_pair_counts(
    memb: Members,
    freq: DataFrame,
    group_col: str,
    item_col: str,
    *,
    n_groups: int,
    share: float = DENSE_SHARE,
    tile_rows: int | None = DEFAULT_TILE_ROWS,
    a_col: str = "item_a",
    b_col: str = "item_b",
    count_col: str = "n",
) -> DataFrame:
    """(a, b, n, _fa, _fb) for every a < b that share a group: dense pairs by bit arrays, others by the self-join.

    ``memb`` is a :func:`~kinspark.operators.pairs.split_members` result in set form, ``freq`` its (item, freq).
    One small job counts the dense items, which sets partitions and tiles.
    """
    least = share * n_groups
    own = with_frequency(memb, freq, item_col)
    n_dense = freq.where(F.col("freq") >= F.lit(float(least))).count()
    dense = f"_f >= CAST({float(least)!r} AS DOUBLE)"
    counts = listed_counts(own, group_col, item_col, True, True, below=float(least) if n_dense else None)
    counts = ordered_pairs(counts, "_a", "_b", "_n")
    if n_dense > 1:
        bits = group_bits(own.all().where(dense), group_col, item_col, n_groups)
        slots = freq.sparkSession.sparkContext.defaultParallelism
        counts = counts.unionByName(dense_pair_counts(bits, n_groups, n_dense, tile_rows or DEFAULT_TILE_ROWS, slots))
    return counts.select(F.col("_a").alias(a_col), F.col("_b").alias(b_col), F.col("_n").alias(count_col), "_fa", "_fb")


def split_few_counts(
    rows: DataFrame,
    freq: DataFrame,
    group_col: str,
    item_col: str,
    *,
    n_items: int,
    n_rows: int,
    n_groups: int,
    share: float = DENSE_SHARE,
    tile_rows: int | None = DEFAULT_TILE_ROWS,
) -> DataFrame:
    """(_x, _y, _n, _fx, _fy) as :func:`split_pair_counts` counts them, where few items are left: dense pairs by bit arrays, others by matrix products.

    ``rows`` is a (group, item, _w) table in set form of the ``n_items`` items in ``freq``.  No group is tiled, as none has more
    than ``n_items`` members.
    """
    least = float(share * n_groups)
    common = freq.where(F.col("freq") >= F.lit(least))
    n_dense = common.count()
    if n_dense < 2:
        return few_pair_counts(rows, freq, group_col, item_col, n_items=n_items, n_rows=n_rows)
    held = rows.join(F.broadcast(common.withColumnRenamed("freq", "_f")), item_col)
    bits = group_bits(held, group_col, item_col, n_groups)
    slots = freq.sparkSession.sparkContext.defaultParallelism
    counts = dense_pair_counts(bits, n_groups, n_dense, tile_rows or DEFAULT_TILE_ROWS, slots)
    counts = counts.selectExpr("_a AS _x", "_b AS _y", "_n", "_fa AS _fx", "_fb AS _fy")
    if n_dense == n_items:
        return counts
    rest = few_pair_counts(rows, freq, group_col, item_col, n_items=n_items, n_rows=n_rows, dense=least, n_dense=n_dense)
    return rest.unionByName(counts)

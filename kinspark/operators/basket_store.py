"""Basket store: baskets shuffled once, when written; every pair problem over them reads them in place.

A store is a folder with four Parquet tables:

* ``baskets``  (trans_id, item, w, set_freq, bag_freq, bag_most), bucketed by trans_id, one sorted file
  a bucket: one row per basket and item with its repeats ``w``, and what the item counts over
  the whole store (see :func:`kinspark.operators.pairs.item_bounds`);
* ``hot``      the same rows of baskets above the tile size, with their number of chunks; no bucket holds one;
* ``items``    (item, set_freq, bag_freq, bag_most), one row per item;
* ``facts``    one row: baskets, buckets, partitions by pair work, schema.

The self-join is on the bucket key, so both its sides are scans without an exchange.  Frequencies
lie in the rows, so rules need no join by item, which would move every row twice where items are too
many to broadcast.  A least count is a filter on a stored integer, which Parquet evaluates in the scan.

Buckets follow the pair work and the number of rows, whichever asks for more; no bucket is opened for less than ``LEAST_PER_BUCKET`` rows.  Set and bag form come from one store.

A table in the catalog names the buckets; :func:`open_baskets` registers a folder written by an
earlier session.  ``forget`` drops the name and leaves the files.

Defined results: rows with a NULL id are dropped; a basket without an item counts as a basket only; an
empty input gives a store without baskets; further columns are ignored.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspark.operators.pairs import (
    DEFAULT_TILE_ROWS,
    LIST_PAIRS,
    PAIRS_PER_COUNT,
    PAIRS_PER_TASK,
    Members,
    group_work,
    item_bounds,
    mirror,
    ordered_pairs,
    pair_counts,
    pair_rows,
    row_counts,
    split_members,
)
from kinspark.operators.products import FEW_ITEMS, few_pair_counts
from kinspark.operators.rules import rules_from_counts
from kinspark.session import stage

#: Rows that a bucket is meant to hold at most, hot baskets aside.
ROWS_PER_BUCKET = 4_000_000

#: Rows below which pair work alone opens no further bucket: a bucket is a file and a task of every read, also of pruned ones.
LEAST_PER_BUCKET = 100_000

_COUNTS = ["set_freq", "bag_freq", "bag_most"]
_FACTS = "n_baskets bigint, buckets int, parts int, has_hot boolean, fields string"


def least_count(share: float, n: int) -> int:
    """The least count c with c / n >= share, as doubles are divided."""
    if n == 0:
        return 0
    c = max(0, math.ceil(share * n) - 2)
    while c / n < share:
        c += 1
    return c


@dataclass
class BasketStore:
    spark: SparkSession
    path: str
    name: str  # of the bucketed table in the catalog
    n_baskets: int
    buckets: int
    parts: int
    has_hot: bool

    def items(self) -> DataFrame:
        """(item, set_freq, bag_freq, bag_most)."""
        return self.spark.read.parquet(f"{self.path}/items")

    def members(self, dedupe: bool = True, least: int | None = None, frequency: bool = False) -> Members:
        """The stored rows for the pair engine, of items that a pair counting ``least`` may hold; with ``frequency``, their item's ``_f``."""
        w = F.lit(1).cast("long") if dedupe else F.col("w")
        own = [F.col("set_freq" if dedupe else "bag_freq").alias("_f")] if frequency else []

        def side(rows: DataFrame, *more: str) -> DataFrame:
            if least is not None:
                rows = rows.where(F.col("set_freq" if dedupe else "bag_most") >= F.lit(least).cast("long"))
            return rows.select("trans_id", "item", w.alias("_w"), *more, *own)

        hot = side(self.spark.read.parquet(f"{self.path}/hot"), "_nt") if self.has_hot else None
        return Members(side(self.spark.table(self.name)), hot, self.n_baskets, self.parts)

    def basket_count(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/facts").select("n_baskets")

    def item_frequency(self, dedupe: bool = True) -> DataFrame:
        """(item, freq), read as it was counted when the store was written."""
        return self.items().select("item", F.col("set_freq" if dedupe else "bag_freq").alias("freq"))

    def item_support(self, dedupe: bool = True, n_baskets: int | Column | None = None) -> DataFrame:
        """(item, support)."""
        n = self._n(n_baskets)
        return self.item_frequency(dedupe).select("item", (F.col("freq").cast("double") / n).alias("support"))

    def basket_pairs(self, dedupe: bool = False) -> DataFrame:
        """Per basket, every ordered pair of different items: (trans_id, antecedent, consequent, n)."""
        rows = pair_rows(self.members(dedupe), "trans_id", "item", a_col="antecedent", b_col="consequent")
        return mirror(rows.withColumnRenamed("_w", "n"), "antecedent", "consequent", ["trans_id", "n"]).select(
            "trans_id", "antecedent", "consequent", "n"
        )

    def pair_frequency(self, dedupe: bool = True, min_count: int | None = None) -> DataFrame:
        """(antecedent, consequent, n), both directions; with ``min_count``, of pairs that count as much."""
        half = self._half(dedupe, min_count, False, "n")
        if min_count is not None:
            half = half.where(F.col("n") >= F.lit(int(min_count)))
        return mirror(half, "antecedent", "consequent", ["n"])

    def rules(
        self, dedupe: bool = True, min_support: float | None = None, n_baskets: int | None = None
    ) -> DataFrame:
        """The association rules of the stored baskets (see :func:`kinspark.operators.rules.association_rules`)."""
        n = self.n_baskets if n_baskets is None else int(n_baskets)
        least = None if min_support is None else least_count(float(min_support), n)
        return rules_from_counts(self._half(dedupe, least, True, "_n"), n, min_support=min_support)

    def forget(self) -> None:
        """Drop the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _n(self, n_baskets: int | Column | None) -> Column:
        if isinstance(n_baskets, Column):
            return n_baskets
        return F.lit(self.n_baskets if n_baskets is None else int(n_baskets))

    def _half(self, dedupe: bool, least: int | None, frequency: bool, count_col: str) -> DataFrame:
        memb = self.members(dedupe, least, frequency=True)
        items = self.items()
        if least is not None:
            items = items.where(F.col("set_freq" if dedupe else "bag_most") >= F.lit(least).cast("long"))
        found = items.agg(F.sum("set_freq").alias("rows"), F.count(F.lit(1)).alias("n")).first()
        freq = items.select("item", F.col("set_freq" if dedupe else "bag_freq").alias("freq"))
        if least is not None and 0 < found["n"] <= FEW_ITEMS:
            work = group_work(memb.all().groupBy("trans_id").agg(F.count(F.lit(1)).alias("_m")))
            if work.pairs > LIST_PAIRS * work.rows:
                rows = memb.all().drop("_f")
                counts = few_pair_counts(rows, freq, "trans_id", "item", n_items=found["n"], n_rows=work.rows)
                return ordered_pairs(counts, "antecedent", "consequent", count_col, frequency)
        # a partition's counts are of different pairs, of which few items have few
        most = min(self.parts * (PAIRS_PER_TASK // PAIRS_PER_COUNT), math.ceil(found["n"] ** 2 / 2 / PAIRS_PER_COUNT))
        counters = max(most, min(self.parts, self.spark.sparkContext.defaultParallelism))
        memb = replace(memb, rows=int(found["rows"] or 0), counters=counters, freq=freq, pruned=least is not None)
        counts = pair_counts(
            memb.normal,
            "trans_id",
            "item",
            dedupe=dedupe,
            ordered=False,
            a_col="antecedent",
            b_col="consequent",
            count_col=count_col,
            memb=memb,
        )
        return counts if frequency else counts.drop("_fa", "_fb")


def _item_counts(rows: DataFrame) -> DataFrame:
    """(item, set_freq, bag_freq, bag_most) of (trans_id, item, _w) rows of whole baskets."""
    bounds = item_bounds(rows, "trans_id", "item").withColumnsRenamed({"freq": "bag_freq", "most": "bag_most"})
    return rows.groupBy("item").agg(F.count(F.lit(1)).alias("set_freq")).join(bounds, "item")


def write_baskets(
    flat: DataFrame,
    path: str,
    trans_col: str = "trans_id",
    item_col: str = "item",
    *,
    name: str | None = None,
    buckets: int | None = None,
    tile_rows: int = DEFAULT_TILE_ROWS,
) -> BasketStore:
    """Write (transaction, item) rows as a store under ``path``, a folder all executors share."""
    spark = flat.sparkSession
    flat = flat.select(F.col(trans_col).alias("trans_id"), F.col(item_col).alias("item"))
    sizes = stage(row_counts(flat, "trans_id", "item"), "basket-sizes")
    work = group_work(sizes)
    parts = work.partitions(spark.sparkContext.defaultParallelism)
    if buckets is None:
        rows = sum(m * n for m, n, _ in work.classes if m <= tile_rows)
        buckets = max(min(parts, math.ceil(rows / LEAST_PER_BUCKET)), math.ceil(rows / ROWS_PER_BUCKET), 1)
        buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))
    memb = split_members(flat, "trans_id", "item", dedupe=False, tile_rows=tile_rows, sizes=sizes, deal=buckets)
    normal = stage(memb.normal, "basket-rows")
    hot = stage(memb.hot, "hot-basket-rows") if memb.hot is not None else None
    counts = _item_counts(normal if hot is None else normal.unionByName(hot.drop("_nt")))
    counts.select("item", *_COUNTS).write.parquet(f"{path}/items")
    counts = spark.read.parquet(f"{path}/items")
    columns = ["trans_id", "item", F.col("_w").alias("w"), *_COUNTS]
    stored = normal.join(counts, "item").select(*columns).repartition(buckets, "trans_id")
    # one task, hence one sorted file, for each bucket
    name = name or f"baskets_{uuid.uuid4().hex}"
    writer = stored.write.format("parquet").bucketBy(buckets, "trans_id").sortBy("trans_id", "item")
    writer.option("path", f"{path}/baskets").saveAsTable(name)
    if hot is not None:
        hot.join(counts, "item").select(*columns, "_nt").write.parquet(f"{path}/hot")
    fields = T.StructType(stored.schema.fields).json()
    facts = (work.groups, buckets, memb.parts, hot is not None, fields)
    spark.createDataFrame([facts], _FACTS).write.parquet(f"{path}/facts")
    return BasketStore(spark, path, name, *facts[:4])


def open_baskets(spark: SparkSession, path: str, name: str | None = None) -> BasketStore:
    """A store that was written before, perhaps by another session: its buckets get a name in this session's catalog."""
    facts = spark.read.parquet(f"{path}/facts").first()
    name = name or f"baskets_{uuid.uuid4().hex}"
    schema = T.StructType.fromJson(json.loads(facts["fields"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (trans_id) SORTED BY (trans_id, item) "
        f"INTO {facts['buckets']} BUCKETS LOCATION '{where}/baskets'"
    )
    return BasketStore(spark, path, name, facts["n_baskets"], facts["buckets"], facts["parts"], facts["has_hot"])

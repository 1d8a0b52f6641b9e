"""Test views: the operator input shapes, derived from the driver's tables.

Every view is a Spark plan over the parquet tables in ``sf_dir``, so its size
grows with them.  The ``*_text`` helpers write a view in one of the original
line formats into a fresh folder under the shared checkpoint folder, for
reader round trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.session import shared_path, table


def flat_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trans_id, item) = (l_orderkey, l_partkey), repeats kept."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("trans_id"), F.col("l_partkey").alias("item")
    )


def word_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trans_id, item) = (doc_id, word) of the documents cut at blanks, repeats kept: few common and many rare items."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("trans_id"), F.explode(F.split("text", " ")).alias("item")).where("item <> ''")


def listed_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trans_id string, items array<string>): one row per order, its items sorted."""
    li = table(spark, sf_dir, "lineitem")
    return (
        li.groupBy("l_orderkey")
        .agg(F.array_sort(F.collect_list(F.col("l_partkey").cast("string"))).alias("items"))
        .select(F.col("l_orderkey").cast("string").alias("trans_id"), "items")
    )


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail lines from lineitem, orders, part, customer and nation: orders meet their customers before the many
    lines meet orders, which is the last join, so that an invoice's lines lie together."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    placed = orders.join(cust.join(nation, cust.c_nationkey == nation.n_nationkey), orders.o_custkey == cust.c_custkey)
    j = li.join(part, li.l_partkey == part.p_partkey).join(placed, li.l_orderkey == orders.o_orderkey)
    return j.select(
        F.col("l_orderkey").cast("string").alias("invoice"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        F.col("p_name").alias("description"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("o_orderdate").alias("invoice_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("n_name").alias("country"),
    )


def rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId int, itemId int, rating float, timestamp bigint), one row per
    (customer, part): mean quantity / 10, last order day in epoch seconds."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    days = F.datediff(F.to_date(F.col("o_orderdate")), F.lit("1970-01-01").cast("date"))
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey)
        .groupBy("o_custkey", "l_partkey")
        .agg(F.avg("l_quantity").alias("_q"), F.max(days).alias("_d"))
        .select(
            F.col("o_custkey").cast("int").alias("userId"),
            F.col("l_partkey").cast("int").alias("itemId"),
            (F.col("_q") / F.lit(10.0)).cast("float").alias("rating"),
            (F.col("_d").cast("bigint") * F.lit(86400)).alias("timestamp"),
        )
    )


def implicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item) = (o_custkey, l_partkey) per line item, repeats kept."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")
    )


def item_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, title, features): sorted distinct words of p_name plus p_type."""
    part = table(spark, sf_dir, "part")
    words = F.concat(F.split(F.col("p_name"), " "), F.array(F.col("p_type")))
    return part.select(
        F.col("p_partkey").alias("item"),
        F.col("p_name").alias("title"),
        F.array_sort(F.array_distinct(words)).alias("features"),
    )


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item, features) = (l_orderkey, its parts): many distinct sets over many features."""
    li = table(spark, sf_dir, "lineitem")
    parts = F.array_sort(F.collect_set("l_partkey")).alias("features")
    return li.groupBy(F.col("l_orderkey").alias("item")).agg(parts)


# ---------------------------------------------------------------- text files


def _write_text(lines: DataFrame, spark: SparkSession, name: str) -> str:
    path = shared_path(spark, name)
    lines.write.mode("errorifexists").text(path)
    return path


def listed_basket_text(spark: SparkSession, sf_dir: str) -> str:
    """``tid,a|b|c`` lines."""
    lb = listed_basket(spark, sf_dir)
    return _write_text(lb.select(F.concat_ws(",", "trans_id", F.array_join("items", "|"))), spark, "listed")


def flat_basket_text(spark: SparkSession, sf_dir: str) -> str:
    """``tid,item`` lines."""
    fb = flat_basket(spark, sf_dir)
    return _write_text(fb.select(F.concat_ws(",", "trans_id", "item")), spark, "flat")


def retail_csv(spark: SparkSession, sf_dir: str) -> str:
    """Retail lines as CSV with a header (quoted where needed)."""
    path = shared_path(spark, "retail")
    retail(spark, sf_dir).write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return path


def retail_naive_text(spark: SparkSession, sf_dir: str) -> str:
    """Retail lines with plain commas: no quoting, no header."""
    r = retail(spark, sf_dir)
    day = F.date_format("invoice_date", "yyyy-MM-dd HH:mm:ss")
    fields = [day if c == "invoice_date" else F.col(c).cast("string") for c in r.columns]
    return _write_text(r.select(F.concat_ws(",", *fields)), spark, "retail-naive")


def items_text(spark: SparkSession, sf_dir: str) -> str:
    """``id::title::f1|f2`` lines."""
    it = item_features(spark, sf_dir)
    return _write_text(it.select(F.concat_ws("::", "item", "title", F.array_join("features", "|"))), spark, "items")


def ratings_dat_text(spark: SparkSession, sf_dir: str) -> str:
    """``user::item::rating::ts`` lines."""
    r = rating(spark, sf_dir)
    return _write_text(r.select(F.concat_ws("::", "userId", "itemId", "rating", "timestamp")), spark, "ratings-dat")


def ratings_tsv_text(spark: SparkSession, sf_dir: str) -> str:
    """Tab-separated ``user item rating ts`` lines."""
    r = rating(spark, sf_dir)
    return _write_text(r.select(F.concat_ws("\t", "userId", "itemId", "rating", "timestamp")), spark, "ratings-tsv")

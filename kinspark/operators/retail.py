"""Retail line operators: summary, countries, item catalogue, baskets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: description written for an item without one.
MISSING_DESCRIPTION = "NA"


def retail_summary(lines: DataFrame) -> DataFrame:
    """One row: n_lines and distinct invoices, items, descriptions, customers.

    A NULL (an empty CSV field) is no description or customer; the original
    counted the empty string as one.  The lines are read once: a row becomes one
    (column, value) row per counted column inside the scan's stage, whose partial
    aggregate sends each distinct value of a task once.
    """
    counts = {"n_invoices": "invoice", "n_items": "stock_code", "n_descriptions": "description", "n_customers": "customer_id"}
    distinct = [F.count_distinct(c).alias(name) for name, c in counts.items()]
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), *distinct)


def distinct_countries(lines: DataFrame) -> DataFrame:
    """(country): every country once."""
    return lines.select("country").distinct()


def _description() -> F.Column:
    d = F.col("description")
    return F.when(d.isNull() | (d == F.lit("")), F.lit(MISSING_DESCRIPTION)).otherwise(d)


def item_catalog(lines: DataFrame) -> DataFrame:
    """(stock_code, description): every distinct pair; empty description -> NA."""
    return lines.select("stock_code", _description().alias("description")).distinct()


def item_descriptions(lines: DataFrame) -> DataFrame:
    """(stock_code, description): one row per item, the smallest description."""
    return lines.groupBy("stock_code").agg(F.min(_description()).alias("description"))


def retail_baskets(lines: DataFrame) -> DataFrame:
    """(trans_id, item) = (invoice, stock_code) for rule mining."""
    return lines.select(F.col("invoice").alias("trans_id"), F.col("stock_code").alias("item"))

"""Typed readers.

Line formats are parsed with Spark expressions only (no Python per row).
Field splitting follows Java's ``String.split`` (see ``java_split``); a line
with too few fields or a bad number fails the job, as the original parse
did, whatever the session's ANSI setting.  Fields beyond those a format
names are ignored.  Spark's text and CSV readers split lines on LF, CRLF and
CR and drop a leading UTF-8 byte order mark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspark.functions.text import bind, java_split

# The delimiters of the input formats.
FIELD_DELIM = ","
ITEM_DELIM = "[|]"
DAT_DELIM = "::"
TSV_DELIM = "\t"

RETAIL_SCHEMA = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

RATING_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("itemId", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


def _field(tokens: Column, i: int) -> Column:
    """Token i (from 0); fails on a line with fewer."""
    short = F.concat(F.lit(f"a line has fewer than {i + 1} fields: "), F.array_join(tokens, " | "))
    return F.when(F.size(tokens) > i, F.get(tokens, F.lit(i))).otherwise(F.raise_error(short))


def _number(text: Column, kind: str) -> Column:
    """The text as a number; fails on anything else."""
    bad = F.concat(F.lit(f"not a {kind}: "), text)
    return F.coalesce(text.try_cast(kind), F.raise_error(bad).cast(kind))


def _read_fields(spark: SparkSession, path: str, delim: str, fields: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """Lines split once each, and the named fields made of their tokens."""

    def row(tokens: Column) -> Column:
        return F.struct(*[c.alias(name) for name, c in fields(tokens).items()])

    return spark.read.text(path).select(bind(java_split("value", delim), row).alias("row")).select("row.*")


def read_listed_baskets(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``tid,a|b|c`` -> (trans_id string, items array<string>).

    Fields after the second are ignored; inner and leading empty items stay,
    trailing empty ones are dropped (Java split).
    """
    return _read_fields(
        spark,
        path,
        FIELD_DELIM,
        lambda t: {"trans_id": _field(t, 0), "items": java_split(_field(t, 1), ITEM_DELIM)},
    )


def read_flat_baskets(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``tid,item`` -> (trans_id string, item string); extra fields ignored."""
    return _read_fields(spark, path, FIELD_DELIM, lambda t: {"trans_id": _field(t, 0), "item": _field(t, 1)})


def read_retail_lines(
    spark: SparkSession,
    path: str,
    header: bool = True,
    naive_split: bool = False,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Retail CSV -> invoice, stock_code, description, quantity int,
    invoice_date timestamp_ntz, price double, customer_id, country.

    CSV quoting is honoured and the header skipped; an empty field is NULL.
    ``naive_split=True`` splits every line on commas with no quoting and no
    header handling, all eight fields as strings.  There an empty field is
    the empty string, which counts as a value (also in ``retail_summary``).
    """
    if naive_split:
        names = RETAIL_SCHEMA.fieldNames()
        return _read_fields(spark, path, FIELD_DELIM, lambda t: {n: _field(t, i) for i, n in enumerate(names)})
    reader = spark.read.schema(RETAIL_SCHEMA).option("header", header).option("mode", "FAILFAST")
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``id::title::f1|f2`` -> (item int, title string, features array<string>)."""
    return _read_fields(
        spark,
        path,
        DAT_DELIM,
        lambda t: {
            "item": _number(_field(t, 0), "int"),
            "title": _field(t, 1),
            "features": java_split(_field(t, 2), ITEM_DELIM),
        },
    )


def read_ratings_dat(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``user::item::rating::ts`` -> (user int, item int); the rest dropped."""
    return _read_fields(
        spark,
        path,
        DAT_DELIM,
        lambda t: {"user": _number(_field(t, 0), "int"), "item": _number(_field(t, 1), "int")},
    )


def read_ratings_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``user item rating ts`` -> (userId int, itemId int, rating float, timestamp bigint)."""
    return _read_fields(
        spark,
        path,
        TSV_DELIM,
        lambda t: {f.name: _number(_field(t, i), f.dataType.simpleString()) for i, f in enumerate(RATING_SCHEMA)},
    )

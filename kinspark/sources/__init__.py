"""Readers for the text formats of the original programs, and sinks."""

from kinspark.sources.readers import (
    read_flat_baskets,
    read_items,
    read_listed_baskets,
    read_ratings_dat,
    read_ratings_tsv,
    read_retail_lines,
)
from kinspark.sources.sinks import rule_lines, to_lines, write_table

__all__ = [
    "read_listed_baskets",
    "read_flat_baskets",
    "read_retail_lines",
    "read_items",
    "read_ratings_dat",
    "read_ratings_tsv",
    "write_table",
    "rule_lines",
    "to_lines",
]

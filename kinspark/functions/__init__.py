"""Column expressions shared by the operators."""

from kinspark.functions.text import java_split
from kinspark.functions.measures import (
    containment,
    cosine,
    euclid,
    jaccard,
    one_sided_euclid,
)

__all__ = [
    "java_split",
    "jaccard",
    "euclid",
    "cosine",
    "containment",
    "one_sided_euclid",
]

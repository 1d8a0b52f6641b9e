"""java_split equals a model of Java's String.split(regex) on random strings, in linear time."""

import random
import re
import time

import pytest

from kinspark.functions.text import java_split


def java_split_model(s: str, pattern: str) -> list[str]:
    """Java String.split(regex) with limit 0, written from its documented contract."""
    if s == "":
        return [""]
    parts = re.split(pattern, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@pytest.mark.parametrize("seed", range(3))
def test_java_split_matches_model(spark, seed):
    rng = random.Random(seed)
    lines = ["".join(rng.choice("ab|:, ") for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    assert sum(x == "" for x in lines) < 500
    df = spark.createDataFrame([(x,) for x in lines], "s string").coalesce(2)
    patterns = ("[|]", "::", ",")
    rows = df.select(*[java_split("s", p).alias(f"p{i}") for i, p in enumerate(patterns)]).collect()
    for i, pattern in enumerate(patterns):
        assert [r[i] for r in rows] == [java_split_model(x, pattern) for x in lines], pattern


def test_cost_per_item_does_not_grow_with_the_line(spark):
    def seconds(per_line):
        df = spark.range(40_000 // per_line).selectExpr(f"array_join(transform(sequence(1, {per_line}), i -> 'item'), '|') AS s")
        df = df.coalesce(1).cache()
        df.count()
        took = []
        for _ in range(3):
            t = time.perf_counter()
            df.select(java_split("s", "[|]").alias("p")).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t)
        return min(took)

    seconds(20)
    assert seconds(4000) < 3 * seconds(20) + 0.5

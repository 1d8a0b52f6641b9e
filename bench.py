"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  After a warm-up pass (JIT, codegen) over sf0.01, each
query runs $BENCH_RUNS times (default 3) and the median is reported (the
minimum and every run are in the JSON too).  A run covers building the plan,
the query and a write of every column of its output that goes nowhere and counts
the rows (``rows`` in the JSON).  ``control`` is one plain Spark aggregate, timed
alike and not part of the total: it tells the pace of the machine.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from kinspark.operators.collab import collaborative_similarity  # noqa: E402
from kinspark.operators.content import content_set_similarity, content_similarity, cross_pair_summary  # noqa: E402
from kinspark.operators.rules import association_rules  # noqa: E402
from kinspark.plans import views as V  # noqa: E402
from kinspark.plans.pipelines import evaluate_als, retail_rules  # noqa: E402
from kinspark.session import local_session  # noqa: E402
from kinspark.sources.readers import read_listed_baskets, read_ratings_dat  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_DIR = "/root/testdata/sf0.01"
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _rules(s, d):
    return association_rules(V.flat_basket(s, d))


def _rules_bag(s, d):
    return association_rules(V.flat_basket(s, d), dedupe=False)


def _collab(s, d):
    return collaborative_similarity(V.implicit(s, d))


def _content_sets(s, d):
    return content_set_similarity(V.item_features(s, d))


def _content_summary(s, d):
    return cross_pair_summary(V.item_features(s, d))


def _content_top(s, d):
    # item-level pairs above a score: the expansion after the set-level filter
    return content_similarity(V.item_features(s, d), min_score=0.5)


def _retail(s, d):
    return retail_rules(V.retail(s, d)).top_lift


def _als(s, d):
    return evaluate_als(V.rating(s, d), seed=42).metrics


QUERIES = {
    "association_rules": _rules,
    "association_rules_bag": _rules_bag,
    "collab_similarity": _collab,
    "content_set_similarity": _content_sets,
    "content_cross_summary": _content_summary,
    "content_similarity_min05": _content_top,
    "retail_rules": _retail,
    "als_fit_predict_eval": _als,
    "read_listed_baskets": lambda s, d: read_listed_baskets(s, STAGED[d]["listed"]),
    "read_ratings_dat": lambda s, d: read_ratings_dat(s, STAGED[d]["ratings"]),
    "content_top_k": lambda s, d: content_similarity(V.item_features(s, d), top_k=10),
}


#: Text inputs of the reader queries, by data folder; writing them is not timed.
STAGED: dict[str, dict[str, str]] = {}


def _stage_text(s, d):
    STAGED[d] = {"listed": V.listed_basket_text(s, d), "ratings": V.ratings_dat_text(s, d)}


def _touch(df: DataFrame) -> int:
    """Compute every column of every row (a write that goes nowhere); the rows are counted by the write itself."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
    return seen.get.get("n", 0)


def _control(s, d) -> DataFrame:
    """Plain Spark, none of this library: its time tells the pace of the machine."""
    return s.read.parquet(f"{d}/lineitem.parquet").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"), F.max("l_orderkey").alias("o"))


def main() -> None:
    spark = local_session(CPUS, app="kinspark-bench", memory=os.environ.get("BENCH_MEMORY", "16g"))
    for d in (WARM_DIR, SF_DIR):
        _stage_text(spark, d)
    for fn in (*QUERIES.values(), _control):  # warm-up: JIT, class loading, codegen caches
        _touch(fn(spark, WARM_DIR))
    times, best, runs, rows = {}, {}, {}, {}
    for name, fn in (*QUERIES.items(), ("control", _control)):
        samples = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            rows[name] = _touch(fn(spark, SF_DIR))
            samples.append(round(time.perf_counter() - t0, 3))
        runs[name] = samples
        times[name] = statistics.median(samples)
        best[name] = min(samples)
    control = times.pop("control")
    m = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "min": best,
        "runs": runs,
        "rows": rows,
        "control": control,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": int(CPUS),
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Pair counts by bit arrays equal the self-join on both sides of the dense share; top lists, observed statistics, pair classes, ALS audit."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from kinspark.operators import bitmaps as BM
from kinspark.operators.collab import collaborative_similarity, cooccurrence_count
from kinspark.operators.content import content_set_similarity, cross_pair_classes
from kinspark.operators.ratings import factor_residuals, fit_als, predict, recompute_predictions
from kinspark.operators.retail import retail_summary
from kinspark.operators.rules import association_rules, rule_stats, top_lists, top_rules
from kinspark.plans.pipelines import write_rules
from kinspark.plans.views import flat_basket, implicit, rating


def ratings_of(seed, n_users=60, n_items=14):
    """Items from one that nearly all users rated to ones that few did, with repeats."""
    rng = random.Random(seed)
    rows = [(u, i) for u in range(n_users) for i in range(n_items) if rng.random() < 1 / (1 + i)]
    return rows + rows[:25]


def brute(rows):
    users = {}
    for u, i in rows:
        users.setdefault(u, set()).add(i)
    n = Counter()
    for held in users.values():
        for a, b in combinations(sorted(held), 2):
            n[a, b] += 1
            n[b, a] += 1
        for a in held:
            n[a, a] += 1
    return n


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0, 1.5])
@pytest.mark.parametrize("tile_rows", [2, 10_000])
def test_counts_on_both_sides_of_the_share(spark, monkeypatch, share, tile_rows):
    # several buckets, more groups in a bucket than a block has places, and hot groups
    monkeypatch.setattr(BM, "FILL", 25)
    monkeypatch.setattr(BM, "PLACES", 16)
    rows = ratings_of(int(share * 10))
    df = spark.createDataFrame(rows + [(None, 1), (3, None)], "user int, item int")
    got = cooccurrence_count(df, tile_rows=tile_rows, dense_share=share).collect()
    assert len({(r["item_a"], r["item_b"]) for r in got}) == len(got)
    assert {(r["item_a"], r["item_b"]): r["n"] for r in got} == brute(rows)


@pytest.mark.parametrize("n_users", [1, 511, 512, 513, 1500])
def test_every_place_of_a_block_counts(spark, n_users):
    df = spark.range(n_users).select(F.col("id").alias("user"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("item"))
    got = {(r["item_a"], r["item_b"]): r["n"] for r in cooccurrence_count(df, dense_share=BM.DENSE_SHARE).collect()}
    assert got == {p: n_users for p in [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")]}


def test_scores_and_rules_are_those_of_the_self_join(spark):
    df = spark.createDataFrame(ratings_of(7), "user int, item int")
    for least in (None, 4):
        plain = collaborative_similarity(df, min_count=least).collect()
        bits = collaborative_similarity(df, min_count=least, dense_share=0.3).collect()
        assert sorted(map(tuple, bits)) == sorted(map(tuple, plain))
    for support in (None, 0.1):
        plain = association_rules(df, "user", "item", min_support=support).collect()
        bits = association_rules(df, "user", "item", min_support=support, dense_share=0.3).collect()
        assert plain and sorted(map(tuple, bits)) == sorted(map(tuple, plain))


def test_bits_edges(spark):
    empty = spark.createDataFrame([], "user int, item int")
    assert cooccurrence_count(empty, dense_share=0.1).count() == 0
    assert collaborative_similarity(empty, dense_share=0.1).count() == 0
    for call in (cooccurrence_count, collaborative_similarity):
        with pytest.raises(ValueError):
            call(empty, dedupe=False, dense_share=0.1)
    with pytest.raises(ValueError):
        association_rules(empty, "user", "item", dedupe=False, dense_share=0.1)


def test_dense_items_do_not_meet_in_the_self_join(spark):
    n_users, items = 600, 12
    df = spark.range(n_users).select(F.col("id").alias("user"), F.explode(F.sequence(F.lit(1), F.lit(items))).alias("item"))
    counts = cooccurrence_count(df, dense_share=0.5)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_count" in plan and "bit_or" in plan
    blocks = BM.group_bits(
        df.distinct().withColumn("_f", F.lit(n_users)), "user", "item", n_users
    ).groupBy("_bucket", "_chunk").count()
    met = sum(r["count"] ** 2 for r in blocks.collect())
    assert met <= 4 * items**2 < n_users * items**2 / 100


def test_sparse_pairs_are_shuffled_as_lists(spark):
    """beside the dense pairs, one int per pair is shuffled, no row with both items and frequencies."""
    counts = cooccurrence_count(implicit(spark, SF_SMALL), dense_share=0.5)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    shuffled = plan.index("RepartitionByExpression [_x#")
    assert "posexplode" in plan[:shuffled] and "posexplode" not in plan[shuffled:]


def test_top_lists_are_the_three_lists(spark):
    rules = association_rules(flat_basket(spark, SF_SMALL))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "50")
    try:
        for k in (7, 60):  # by the window group limit alone, and salted first
            lists = top_lists(rules, k).collect()
            for metric in ("support", "confidence", "lift"):
                got = [tuple(r)[2:] for r in sorted((r for r in lists if r["metric"] == metric), key=lambda r: r["place"])]
                assert got == [tuple(r) for r in top_rules(rules, metric, k).collect()]
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    with pytest.raises(ValueError):
        top_lists(rules, 3, ("price",))


def test_top_lists_scan_the_rules_once(spark, tmp_path):
    path = str(tmp_path / "rules")
    association_rules(flat_basket(spark, SF_SMALL)).write.parquet(path)
    plan = top_lists(spark.read.parquet(path), 10)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan parquet") == 1
    assert "WindowGroupLimit" in plan


def test_written_rules_leave_their_statistics(spark, tmp_path):
    rules = association_rules(flat_basket(spark, SF_SMALL))
    got, want = write_rules(rules, str(tmp_path / "rules")).collect()[0], rule_stats(rules).collect()[0]
    assert got.asDict() == pytest.approx(want.asDict())
    assert spark.read.parquet(str(tmp_path / "rules")).count() == got["n_rules"]


def test_no_rules_leave_a_count_of_none(spark, tmp_path):
    none = association_rules(spark.createDataFrame([(1, 1)], "trans_id int, item int"))
    assert write_rules(none, str(tmp_path / "none")).collect() == rule_stats(none).collect()


def test_summary_scans_the_lines_once(spark, tmp_path):
    rows = [("i1", "a", "x", "c1"), ("i1", "b", None, None), ("i2", "a", "x", "c1"), ("i3", "a", "y", "c2")]
    spark.createDataFrame(rows, "invoice string, stock_code string, description string, customer_id string").write.parquet(
        str(tmp_path / "lines")
    )
    summary = retail_summary(spark.read.parquet(str(tmp_path / "lines")))
    assert tuple(summary.collect()[0]) == (4, 3, 2, 2, 2)
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and "scalar-subquery" not in plan


def test_pair_classes_sum_to_the_product(spark):
    rng = random.Random(4)
    items = [(i, rng.sample("abcdef", rng.randrange(5))) for i in range(40)] + [(40, None), (41, ["a", "a", "b"])]
    df = spark.createDataFrame(items, "item int, features array<string>")
    got = cross_pair_classes(df).collect()
    sets = [frozenset(f or ()) for _, f in items]
    want = Counter((len(x), len(y), len(x & y)) for x in sets for y in sets)
    assert {(r["size_a"], r["size_b"], r["m11"]): r["n_pairs"] for r in got} == want
    assert sum(r["n_pairs"] for r in got) == len(items) ** 2
    scored = {(r["size_a"], r["size_b"], r["m11"]): tuple(r)[4:] for r in got}
    columns = ["size_a", "size_b", "m11", "jaccard", "euclid", "cosine", "containment", "one_sided_euclid"]
    for r in content_set_similarity(df).select(*columns).distinct().collect():
        assert scored[tuple(r)[:3]] == tuple(r)[3:]
    assert cross_pair_classes(df.limit(0)).count() == 0


def test_fit_is_audited(spark):
    train = rating(spark, SF_SMALL)
    model = fit_als(train, max_iter=3)
    solved = factor_residuals(model, train).collect()
    assert len(solved) == train.select("userId").distinct().count()
    assert sum(r["n_ratings"] for r in solved) == train.count()
    assert max(r["residual"] for r in solved) < 1e-4
    # ratings that the fit has not seen do not solve the equations
    moved = train.withColumn("rating", F.col("rating") + F.col("itemId") % 3)
    assert sorted(r["residual"] for r in factor_residuals(model, moved).collect())[len(solved) // 2] > 1e-2
    pairs = spark.createDataFrame([(-5, -5, 1.0)], "userId int, itemId int, rating float").unionByName(
        train.select("userId", "itemId", F.col("rating").cast("float").alias("rating"))
    )
    both = recompute_predictions(model, predict(model, pairs)).collect()
    assert len(both) == pairs.count()
    for r in both:
        assert r["recomputed"] == pytest.approx(r["prediction"], rel=1e-4, abs=1e-4, nan_ok=True)

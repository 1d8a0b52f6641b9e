"""Basket store: same results as without one, no exchange below the self-join, counts as filters in the scan."""

import random

import pytest

from helpers import SF_SMALL
from kinspark.operators import basket_store as BS
from kinspark.operators.baskets import basket_pairs, item_frequency, item_support, pair_frequency
from kinspark.operators.rules import association_rules
from kinspark.plans.views import flat_basket
from kinspark.session import shared_path


def rows_of(seed, n=90):
    rng = random.Random(seed)
    return [(min(rng.randrange(14), rng.randrange(14)), min(rng.randrange(12), rng.randrange(12))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "trans_id int, item int")


def store(spark, df, **options):
    return BS.write_baskets(df, shared_path(spark, "store"), **options)


def same(got, want):
    assert got.columns == want.columns
    got, want = sorted(map(tuple, got.collect()), key=str), sorted(map(tuple, want.collect()), key=str)
    assert want and got == want


def final_plan(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("tile_rows", [4, 10_000])
def test_same_as_without_a_store(spark, tile_rows):
    df = frame(spark, rows_of(tile_rows) + [(3, None), (99, None)])
    s = store(spark, df.union(frame(spark, [(None, 1), (None, None)])), tile_rows=tile_rows, buckets=3)
    assert s.has_hot == (tile_rows == 4) and s.basket_count().first().n_baskets == s.n_baskets
    for dedupe in (True, False):
        same(s.item_frequency(dedupe), item_frequency(df, dedupe=dedupe))
        same(s.item_support(dedupe), item_support(df, dedupe=dedupe))
        same(s.basket_pairs(dedupe), basket_pairs(df, dedupe=dedupe))
        same(s.pair_frequency(dedupe), pair_frequency(df, dedupe=dedupe))
        same(s.pair_frequency(dedupe, min_count=3), pair_frequency(df, dedupe=dedupe, min_count=3))
        same(s.rules(dedupe), association_rules(df, dedupe=dedupe))
        same(s.rules(dedupe, min_support=0.2), association_rules(df, dedupe=dedupe, min_support=0.2))
        same(s.rules(dedupe, n_baskets=40), association_rules(df, dedupe=dedupe, n_baskets=40))


def test_opened_again(spark):
    df = spark.createDataFrame([("b'1", "x y", 0), ("b'1", "ü", 1), ("b2", "x y", 2), ("b2", "ü", 3)], "who string, what string, w int")
    s = BS.write_baskets(df, shared_path(spark, "it's a store"), "who", "what", name="my_baskets")
    s.forget()
    again = BS.open_baskets(spark, s.path)
    assert again.name != "my_baskets" and (again.n_baskets, again.buckets) == (2, s.buckets)
    same(again.rules(), association_rules(df, "who", "what"))
    again.forget()
    assert not spark.catalog.tableExists(again.name)


def test_empty(spark):
    s = BS.open_baskets(spark, store(spark, frame(spark, [])).path)
    assert s.n_baskets == 0 and s.basket_count().first().n_baskets == 0
    for df in (s.items(), s.rules(), s.rules(min_support=0.5), s.basket_pairs(), s.pair_frequency(min_count=1)):
        assert df.count() == 0


def test_no_exchange_below_the_self_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        s = store(spark, flat_basket(spark, SF_SMALL), buckets=4)
        assert not s.has_hot
        for df in (s.rules(), s.rules(False), s.pair_frequency(), s.rules(min_support=0.002)):
            plan = final_plan(df)
            below = plan[plan.index("SortMergeJoin") :]
            assert "Exchange" not in below and below.count("SelectedBucketsCount: 4 out of 4") == 2, plan
            assert plan.count("Exchange hashpartitioning") == 1, plan  # that of the pair table
        assert "Exchange" not in final_plan(s.basket_pairs())
        assert "Exchange" not in final_plan(s.item_support())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_least_counts_reach_the_scan(spark):
    s = store(spark, flat_basket(spark, SF_SMALL))
    plan = final_plan(s.rules(min_support=38 / s.n_baskets))
    assert "GreaterThanOrEqual(set_freq,38)" in plan
    plan = final_plan(s.rules(False, min_support=50 / s.n_baskets))
    assert "GreaterThanOrEqual(bag_most,50)" in plan


def test_one_hot_basket_leaves_the_buckets(spark):
    df = frame(spark, [(0, i) for i in range(200)] + [(b, i) for b in range(1, 100) for i in range(4)])
    s = store(spark, df, tile_rows=20, buckets=4)
    assert spark.table(s.name).where("trans_id = 0").count() == 0
    assert s.has_hot and s.members().hot.count() == 200
    same(s.rules(), association_rules(df))


def test_least_count():
    rng = random.Random(5)
    for _ in range(3000):
        n, share = rng.randrange(1, 10**rng.randrange(1, 9)), rng.random() * rng.choice([1e-6, 0.01, 1, 3])
        share = rng.choice([share, rng.randrange(n + 1) / n])
        c = BS.least_count(share, n)
        assert c / n >= share and (c == 0 or (c - 1) / n < share)
    assert BS.least_count(0.5, 0) == 0

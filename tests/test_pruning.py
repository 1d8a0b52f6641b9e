"""Least counts pushed below the self-join, and partitions cut by pair work."""

import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL
from kinspark.operators import pairs as PR
from kinspark.operators.baskets import pair_frequency
from kinspark.operators.collab import collaborative_similarity
from kinspark.operators.rules import association_rules
from kinspark.plans.views import flat_basket


def random_rows(seed):
    """Baskets of uneven size over items of uneven frequency, with repeats."""
    rng = random.Random(seed)
    return [(min(rng.randrange(9), rng.randrange(9)), min(rng.randrange(12), rng.randrange(12))) for _ in range(70)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "trans_id int, item int")


def counts(rows, dedupe):
    groups = defaultdict(Counter)
    for g, i in rows:
        groups[g][i] = 1 if dedupe else groups[g][i] + 1
    n = Counter()
    for c in groups.values():
        for a, b in combinations(sorted(c), 2):
            n[a, b] += c[a] * c[b]
    return groups, n


@pytest.mark.parametrize("dedupe, tile_rows, least", [(True, 3, 0.25), (True, 10_000, 1 / 3), (False, 3, 1.0), (False, 10_000, 2 / 3)])
def test_no_rule_is_lost(spark, dedupe, tile_rows, least):
    df = frame(spark, random_rows(int(9 * least) + tile_rows) + [(0, None), (None, 1)])
    every = association_rules(df, dedupe=dedupe, tile_rows=tile_rows).where(F.col("support") >= least).collect()
    pruned = association_rules(df, dedupe=dedupe, tile_rows=tile_rows, min_support=least)
    assert every and sorted(map(tuple, pruned.collect())) == sorted(map(tuple, every))


@pytest.mark.parametrize("dedupe, least", [(True, 2), (False, 5)])
def test_no_pair_is_lost(spark, dedupe, least):
    rows = random_rows(least)
    df = frame(spark, rows)
    _, n = counts(rows, dedupe)
    want = sorted((*p, c) for (a, b), c in n.items() if c >= least for p in ((a, b), (b, a)))
    assert want and sorted(map(tuple, pair_frequency(df, dedupe=dedupe, min_count=least).collect())) == want
    near = collaborative_similarity(df, "trans_id", "item", dedupe=dedupe, min_count=least)
    whole = collaborative_similarity(df, "trans_id", "item", dedupe=dedupe).where(F.col("n") >= least)
    assert sorted(map(str, near.collect())) == sorted(map(str, whole.collect()))


def test_bounds_are_bounds_and_tighter_than_totals(spark):
    rows = [(g, i) for g in range(6) for i in range(5) for _ in range(1 + (g * i) % 4)] + [(9, 4)] * 50
    df = frame(spark, rows)
    groups, n = counts(rows, dedupe=False)
    bounds = PR.item_bounds(PR.members(df, "trans_id", "item", False), "trans_id", "item")
    for r in bounds.collect():
        assert r.freq == sum(c[r.item] for c in groups.values())
        other = sum(c[r.item] * (sum(c.values()) - c[r.item]) for c in groups.values())
        assert max(c for p, c in n.items() if r.item in p) <= r.most <= other
    assert {r.item: r.most for r in bounds.collect()}[4] < sum(c[4] for c in groups.values()) ** 2


def test_items_leave_below_the_self_join(spark):
    df = flat_basket(spark, SF_SMALL)
    n = df.select("trans_id").distinct().count()
    rules = association_rules(df, min_support=38 / n)
    plan = rules._jdf.queryExecution().optimizedPlan().toString()
    below = plan[re.search(r"Join Inner, .*_g#", plan).start() :]
    assert below.count("LeftSemi") >= 2 and len(re.findall(r"Filter .*freq#.* >= ", below)) >= 2, plan  # on both sides of the self-join
    memb = PR.split_members(df, "trans_id", "item")
    left = PR.reaching(df, "trans_id", "item", True, F.lit(38))
    pruned = PR.split_members(PR.rows_of(df, "trans_id", "item", left), "trans_id", "item")
    assert PR.pair_rows(pruned, "trans_id", "item").count() * 4 < PR.pair_rows(memb, "trans_id", "item").count()


def test_groups_are_sized_without_the_pruned_items(spark):
    """One basket of 3,000 rare items and a few common ones: nothing of it is hot once the rare ones are gone."""
    rows = [(0, i) for i in range(3000)] + [(b, i) for b in range(1, 40) for i in range(4)]
    df = frame(spark, rows)
    freq = PR.reaching(df, "trans_id", "item", True, F.lit(10))
    assert {r.item: r.freq for r in freq.collect()} == {i: 40 for i in range(4)}
    memb = PR.split_members(PR.rows_of(df, "trans_id", "item", freq), "trans_id", "item", tile_rows=5)
    assert memb.hot is None and memb.all().count() == 160


def test_partitions_by_pair_work(spark, monkeypatch):
    """Zipf-like group sizes: bytes say little about the pairs, the largest task stays within twice the mean."""
    monkeypatch.setattr(PR, "PAIRS_PER_TASK", 400_000)
    monkeypatch.setattr(PR, "MIN_TILE_ROWS", 32)
    sizes = [2400, 900, 880, 700] + [400] * 6 + [60] * 200 + [5] * 3000
    rows = spark.createDataFrame(list(enumerate(sizes)), "g int, m int").selectExpr("g AS trans_id", "explode(sequence(1, m)) AS item")
    memb = PR.split_members(rows, "trans_id", "item")
    assert memb.parts == -(-sum(m * m for m in sizes) // 800_000) and memb.hot is not None
    pairs = PR.pair_rows(memb, "trans_id", "item")
    per = {}
    for side in (memb.normal, memb.hot):
        only = PR.replace(memb, normal=side.drop("_nt"), hot=None) if side is memb.normal else PR.replace(memb, normal=memb.normal.limit(0))
        found = PR.pair_rows(only, "trans_id", "item").groupBy(F.spark_partition_id().alias("p")).count().collect()
        if side is memb.hot:
            per = [r["count"] for r in found]
    assert pairs.count() == sum(m * (m - 1) // 2 for m in sizes)
    assert max(per) < 2 * sum(per) / memb.parts, (max(per), sum(per) / memb.parts)


def test_work_histogram():
    work = PR.Work([(10, 5, 500.0), (1000, 2, 2_000_000.0)])
    assert work.groups == 7 and work.pairs == 1_000_250 and work.above(9) == 7 and work.above(10) == 2
    assert work.partitions(8) == 1 and work.tile_rows(1, 10_000) == PR.MIN_TILE_ROWS
    big = PR.Work([(5000, 400, 400 * 5000.0**2)])
    assert big.partitions(8) == 250 and big.tile_rows(250, 10_000) == 1118 and big.tile_rows(250, 700) == 700
    assert PR.Work([]).partitions(8) == 1 and PR.Work([]).groups == 0

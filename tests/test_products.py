"""where a least support leaves few items, pairs are counted by matrix products, exactly, and without a self-join."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kinspark.operators import basket_store as BS
from kinspark.operators import products as PD
from kinspark.operators import rules as R
from kinspark.operators.pairs import item_totals, members
from kinspark.operators.products import few_pair_counts


def plain(rows):
    groups = {}
    for g, i, w in rows:
        groups.setdefault(g, {})[i] = w
    n = Counter()
    for held in groups.values():
        for a, b in combinations(sorted(held), 2):
            n[a, b] += held[a] * held[b]
    return n


@pytest.mark.parametrize("weights", [[1], [1, 2, 7], [1, 3_000, 70_000], [1, 300_000_007]])
@pytest.mark.parametrize("cells", [1, 40, 4_000_000])
def test_counts_are_exact(spark, monkeypatch, weights, cells):
    monkeypatch.setattr(PD, "CELLS", cells)
    monkeypatch.setattr(PD, "ROWS_PER_PRODUCT", 100)
    rng = random.Random(cells)
    rows = [(g, f"i{i}", rng.choice(weights)) for g in range(40) for i in rng.sample(range(13), rng.randrange(1, 13))]
    df = spark.createDataFrame(rows, "g int, i string, _w long")
    freq = item_totals(df, "i")
    got = few_pair_counts(df, freq, "g", "i", n_items=13, n_rows=len(rows)).collect()
    assert {tuple(sorted((r._x, r._y))): r._n for r in got} == plain(rows) and len(got) == len(plain(rows))
    seen = {r.i: r.freq for r in freq.collect()}
    assert all((r._fx, r._fy) == (seen[r._x], seen[r._y]) for r in got)


@pytest.mark.parametrize("form", [{}, {"dedupe": False}, {"dense_share": 0.0}, {"dense_share": 0.5}, {"dense_share": 2.0}])
@pytest.mark.parametrize("least", [0.05, 0.3])
def test_rules_of_few_items(spark, monkeypatch, form, least):
    rng = random.Random(7)
    rows = [(g, i) for g in range(50) for i in range(9) if rng.random() < 1 / (1 + i)]
    df = spark.createDataFrame(rows + rows[:30] + [(None, 1), (60, None)], "trans_id int, item int")
    monkeypatch.setattr(R, "LIST_PAIRS", 0)
    few = sorted(map(tuple, R.association_rules(df, min_support=least, **form).collect()))
    monkeypatch.setattr(R, "FEW_ITEMS", 0)
    assert few and few == sorted(map(tuple, R.association_rules(df, min_support=least, **form).collect()))


@pytest.mark.parametrize("form", [{}, {"dedupe": False}, {"dense_share": 0.9}])
def test_no_pair_row_per_group(spark, form):
    """A basket of all items makes no row for each of its pairs, and the partitions don't follow the pairs."""
    rows = spark.range(64).select(F.col("id").alias("trans_id"), F.explode(F.sequence(F.lit(1), F.lit(150))).alias("item"))
    rows = rows.where("(trans_id + item) % 4 > 0")  # every item in three quarters of the baskets
    found = R.association_rules(rows, min_support=0.1, **form)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "posexplode" not in plan and "SortMergeJoin" not in plan
    assert found.count() == 150 * 149


def test_store_counts_few_items(spark, tmp_path):
    rows = spark.range(30).select(F.col("id").alias("trans_id"), F.explode(F.sequence(F.lit(1), F.lit(60))).alias("item"))
    rows = rows.where("(trans_id + item) % 4 > 0")
    rows = rows.unionByName(rows.where("item % 7 = trans_id % 7"))  # repeats
    store = BS.write_baskets(rows, str(tmp_path / "s"))
    for dedupe in (True, False):
        found = store.rules(dedupe, min_support=0.1)
        assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
        want = R.association_rules(rows, dedupe=dedupe).where("support >= 0.1")
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_members_are_weighed_once(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "g int, i int")
    rows = members(df, "g", "i", dedupe=False)
    got = few_pair_counts(rows, item_totals(rows, "i"), "g", "i", n_items=2, n_rows=4).collect()
    assert [tuple(r) for r in got] == [(1, 2, 2, 3, 1)]

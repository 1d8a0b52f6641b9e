"""Pairs counted from lists: same counts whichever way an item's pairs take, nothing wider than a list is shuffled, tasks bounded by rows."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

import __spark_entry__ as se
from helpers import SF_SMALL
from kinspark.operators import basket_store as BS
from kinspark.operators import pairs as PR
from kinspark.operators.baskets import item_support
from kinspark.operators.collab import collaborative_similarity, cooccurrence_count
from kinspark.operators.content import content_similarity
from kinspark.operators.rules import association_rules, described_rules, rules_with_descriptions
from kinspark.plans.views import implicit


def plain(rows, dedupe):
    n = Counter()
    for g in {g for g, _ in rows}:
        items = Counter(i for h, i in rows if h == g and i is not None)
        for a, b in permutations(items, 2):
            n[a, b] += 1 if dedupe else items[a] * items[b]
    return dict(n)


@pytest.mark.parametrize("kind", ["int", "string"])
@pytest.mark.parametrize("tile", [10_000, 3])
def test_often_seldom_and_mixed_items(spark, monkeypatch, kind, tile):
    rng = random.Random(tile)
    rows = [(g, i) for g in range(60) for i in rng.sample(range(6), 3) + rng.choices(range(6, 200), k=4)] + [(3, None), (99, None)]
    rows += rng.choices(rows, k=40)
    df = spark.createDataFrame(rows, "g int, i int").selectExpr("g", f"CAST(i AS {kind}) AS i")
    conv = str if kind == "string" else int
    for least in (1, 15, 10_000):  # all items combined first, the six common ones, none
        monkeypatch.setattr(PR, "MIN_OFTEN", least)
        monkeypatch.setattr(PR, "LIST_PAIRS", 0)
        monkeypatch.setattr(PR.math, "isqrt", lambda n: 0)
        for dedupe in (True, False):
            got = PR.pair_counts(df, "g", "i", dedupe=dedupe, tile_rows=tile).collect()
            want = {(conv(a), conv(b)): n for (a, b), n in plain(rows, dedupe).items()}
            assert len(got) == len(want) and {(r.item_a, r.item_b): r.n for r in got} == want
            half = PR.pair_counts(df, "g", "i", dedupe=dedupe, tile_rows=tile, ordered=False).collect()
            assert {(r.item_a, r.item_b): r.n for r in half} == {p: n for p, n in want.items() if p[0] < p[1]}


def test_rarer_item_lists(spark):
    """An item in every group lists no partner: its partition doesn't grow with the groups."""
    rows = [(g, 0) for g in range(50)] + [(g, 1 + g % 10) for g in range(50)]
    df = spark.createDataFrame(rows, "g int, i int")
    memb = PR.split_members(df, "g", "i")
    memb = PR.with_frequency(memb, PR.item_totals(memb.all(), "i"), "i")
    lists = PR.pair_lists(memb, "g", "i").collect()
    assert len(lists) == 50 and all(r["_x"] != 0 and r["_y"] == [0] for r in lists)


def test_no_pair_row_is_shuffled(spark):
    for df in (cooccurrence_count(implicit(spark, SF_SMALL)), collaborative_similarity(implicit(spark, SF_SMALL))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffle = plan.index("Exchange hashpartitioning(_x#")
        assert "posexplode" in plan[:shuffle] and not re.search(r"posexplode", plan[shuffle:])


def test_partitions_by_rows():
    """Many small groups have few pairs; their rows are dealt out all the same."""
    work = PR.Work([(4, 50_000_000, 50_000_000 * 16.0)])
    assert work.rows == 200_000_000 and work.partitions(8) == 200 and work.counters(8) == 400


def test_described_both_ways_at_once(spark):
    """joining the descriptions to one direction gives the rows of joining them to both."""
    rows = [(g, f"i{i % 7}") for g in range(30) for i in (g, g + 1, g * g)]
    rules = association_rules(spark.createDataFrame(rows, "trans_id int, item string"))
    catalog = spark.createDataFrame([(f"i{i}", f"item {i}") for i in range(5)], "stock_code string, description string")
    want = sorted(map(tuple, rules_with_descriptions(rules, catalog).collect()), key=repr)
    assert want and sorted(map(tuple, described_rules(rules, catalog).collect()), key=repr) == want


def test_buckets_hold_rows(spark, monkeypatch, tmp_path):
    """pair work alone doesn't cut a store into buckets of few rows."""
    monkeypatch.setattr(PR, "PAIRS_PER_TASK", 100)
    rows = [(g, i) for g in range(40) for i in range(30)]
    flat = spark.createDataFrame(rows, "trans_id int, item int")
    assert BS.write_baskets(flat, str(tmp_path / "s")).buckets == 1


def test_expansion_is_dealt_out(spark):
    """set pairs that many items hold are expanded by many tasks, however few bytes they are."""
    items = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["a", "c"]) for i in range(60)], "item int, features array<string>")
    found = content_similarity(items, min_score=0.1)
    assert found.count() == 3600
    assert found.rdd.getNumPartitions() > 1


@pytest.mark.parametrize(
    "kind, items",
    [
        ("int", [-(2**31), -5, 0, 3, 2**31 - 1]),
        ("bigint", [-(2**40), -1, 0, 7, 2**40]),
        ("bigint", [-(2**63), -1, 0, 7, 2**63 - 1]),  # no room for a frequency beside them
        ("smallint", [-(2**15), 0, 1, 2, 2**15 - 1]),
        ("string", ["a", "b", "", "d", "e"]),
    ],
)
@pytest.mark.parametrize("tile", [10_000, 3])
def test_codes_stand_for_items(spark, monkeypatch, kind, items, tile):
    """Items at the ends of their types come back from their codes, with their frequencies."""
    monkeypatch.setattr(PR, "LIST_PAIRS", 0)
    rng = random.Random(5)
    rows = [(g, i) for g in range(20) for i in rng.choices(items, k=4)] + [(77, None)]
    df = spark.createDataFrame(rows, f"g int, i {kind}")
    for dedupe in (True, False):
        want = plain(rows, dedupe)
        assert {(r.item_a, r.item_b): r.n for r in PR.pair_counts(df, "g", "i", dedupe=dedupe, tile_rows=tile).collect()} == want
        memb = PR.split_members(df, "g", "i", dedupe, tile)
        freq = PR.item_totals(memb.all(), "i")
        seen = {r.i: r.freq for r in freq.collect()}
        half = PR.pair_counts(df, "g", "i", dedupe=dedupe, ordered=False, memb=PR.with_frequency(memb, freq, "i"))
        assert half.schema["item_a"].dataType == df.schema["i"].dataType
        assert sorted(map(tuple, half.collect())) == sorted((a, b, n, seen[a], seen[b]) for (a, b), n in want.items() if a < b)


def test_lists_are_one_int_per_pair(spark):
    """What a pair costs the shuffle is one int: item and frequency share it."""
    plan = collaborative_similarity(implicit(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "RepartitionByExpression" or "_x" not in plan.output().apply(0).name():
        found = [plan.children().apply(i) for i in range(plan.children().size())]
        plan = next(c for c in found if "RepartitionByExpression" in c.toString())
    assert [plan.output().apply(i).dataType().catalogString() for i in range(plan.output().size())] == ["int", "array<int>"]


def test_descriptions_bring_the_supports(spark):
    """F2, F16: what a rule takes to the catalogue is its two items and its support."""
    rows = [(g, f"i{i % 7}") for g in range(30) for i in (g, g + 1, g * g)]
    flat = spark.createDataFrame(rows, "trans_id int, item string")
    rules = association_rules(flat)
    catalog = spark.createDataFrame([(f"i{i}", f"item {i}") for i in range(5)], "stock_code string, description string")
    want = sorted(map(tuple, rules_with_descriptions(rules, catalog).collect()), key=repr)
    found = described_rules(rules, catalog, supports=item_support(flat))
    assert want and sorted(map(tuple, found.collect()), key=repr) == want


@pytest.mark.parametrize("name", ["rules_with_desc", "collab_euclid", "cooccurrence_count", "cooccurrence_count_bitmaps", "user_similarity"])
def test_tables_are_joined_once(spark, name):
    """Sizes, frequencies and pairs read the joined rows, not the tables again."""
    files = se.queries()[name](spark, SF_SMALL).inputFiles()
    assert files and not [f for f in files if "lineitem" in f or "orders" in f]


def test_members_go_back_to_their_groups_once(spark):
    """Both sides of the lists' join are one shuffle of plain rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = collaborative_similarity(implicit(spark, SF_SMALL))
        df._jdf.queryExecution().toRdd().count()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    to_groups = [line for line in plan.splitlines() if "Exchange hashpartitioning(_g#" in line]
    assert len(to_groups) == 2 and sum("ReusedExchange" in line for line in to_groups) == 1, plan

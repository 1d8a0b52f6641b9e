"""Association rules: golden fixture, bag vs set, tiling, properties, edges."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, write_lines
from kinspark.operators.baskets import basket_count, basket_pairs, item_support, flatten_baskets, item_frequency, pair_frequency
from kinspark.operators.rules import association_rules, rule_stats, rules_per_antecedent, top_rules
from kinspark.plans.pipelines import basket_rules, run_basket_rules
from kinspark.plans.views import flat_basket
from kinspark.sources.readers import read_flat_baskets, read_listed_baskets
from kinspark.sources.sinks import rule_lines

# The twenty baskets of the golden fixture.
BASKETS = [
    "1,A|B", "2,A|B|C", "3,A|C", "4,C|D", "5,A|C|E", "6,B|C|D", "7,D|E", "8,A|D|E", "9,B|D|E", "10,B|E",
    "11,A|B|C|D", "12,A|C|D|E", "13,B|C|D|E", "14,A|E", "15,B|D", "16,C|E", "17,A|C|D", "18,A|B|E",
    "19,B|C|D", "20,A|D|E",
]

# (a, b, n, ant, cons, support, confidence, lift) from the 20-basket fixture
GOLDEN = [
    ("A", "B", 4, 0.55, 0.5, 0.2, 0.36363636363636365, 0.7272727272727273),
    ("A", "C", 6, 0.55, 0.55, 0.3, 0.5454545454545454, 0.9917355371900825),
    ("A", "D", 5, 0.55, 0.6, 0.25, 0.45454545454545453, 0.7575757575757576),
    ("A", "E", 6, 0.55, 0.55, 0.3, 0.5454545454545454, 0.9917355371900825),
    ("B", "A", 4, 0.5, 0.55, 0.2, 0.4, 0.7272727272727273),
    ("B", "C", 5, 0.5, 0.55, 0.25, 0.5, 0.9090909090909091),
    ("B", "D", 6, 0.5, 0.6, 0.3, 0.6, 1.0),
    ("B", "E", 4, 0.5, 0.55, 0.2, 0.4, 0.7272727272727273),
    ("C", "A", 6, 0.55, 0.55, 0.3, 0.5454545454545454, 0.9917355371900825),
    ("C", "B", 5, 0.55, 0.5, 0.25, 0.45454545454545453, 0.9090909090909091),
    ("C", "D", 7, 0.55, 0.6, 0.35, 0.6363636363636362, 1.0606060606060606),
    ("C", "E", 4, 0.55, 0.55, 0.2, 0.36363636363636365, 0.6611570247933883),
    ("D", "A", 5, 0.6, 0.55, 0.25, 0.4166666666666667, 0.7575757575757576),
    ("D", "B", 6, 0.6, 0.5, 0.3, 0.5, 1.0),
    ("D", "C", 7, 0.6, 0.55, 0.35, 0.5833333333333334, 1.0606060606060606),
    ("D", "E", 6, 0.6, 0.55, 0.3, 0.5, 0.9090909090909091),
    ("E", "A", 6, 0.55, 0.55, 0.3, 0.5454545454545454, 0.9917355371900825),
    ("E", "B", 4, 0.55, 0.5, 0.2, 0.36363636363636365, 0.7272727272727273),
    ("E", "C", 4, 0.55, 0.55, 0.2, 0.36363636363636365, 0.6611570247933883),
    ("E", "D", 6, 0.55, 0.6, 0.3, 0.5454545454545454, 0.9090909090909091),
]


@pytest.fixture(scope="module")
def listed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("arm") / "transactions.csv"
    write_lines(path, BASKETS, bom=True, crlf=True)
    return read_listed_baskets(spark, str(path))


def test_golden_rules(listed):
    res = basket_rules(listed, listed=True)
    got = {(r.antecedent, r.consequent): r for r in res.rules.collect()}
    assert len(got) == 20
    for a, b, _, ant, cons, sup, conf, lift in GOLDEN:
        r = got[(a, b)]
        assert (r.ant_support, r.cons_support, r.support, r.confidence, r.lift) == (ant, cons, sup, conf, lift)
    assert sorted((r.antecedent, r.n_rules) for r in res.per_antecedent.collect()) == [
        (x, 4) for x in "ABCDE"
    ]


def test_golden_stats(listed):
    s = basket_rules(listed, listed=True).stats.collect()[0]
    assert s.n_rules == 20
    assert (s.min_support, s.max_support) == (0.2, 0.35)
    assert s.mean_support == pytest.approx(0.265, abs=1e-15)
    assert (s.min_confidence, s.max_confidence) == (0.36363636363636365, 0.6363636363636362)
    assert s.mean_confidence == pytest.approx(0.4813636363636363, abs=1e-15)
    assert (s.min_lift, s.max_lift) == (0.6611570247933883, 1.0606060606060606)
    assert s.mean_lift == pytest.approx(0.8735537190082644, abs=1e-15)


def test_bom_and_crlf_stripped(listed):
    rows = {r.trans_id: r.items for r in listed.collect()}
    assert rows["1"] == ["A", "B"]
    assert rows["20"] == ["A", "D", "E"]


def test_pair_counts_golden(listed):
    flat = flatten_baskets(listed)
    got = {(r.antecedent, r.consequent): r.n for r in pair_frequency(flat).collect()}
    assert got == {(a, b): n for a, b, n, *_ in GOLDEN}


def test_flat_form_bag_vs_set(spark, tmp_path):
    path = write_lines(tmp_path / "flat.csv", ["1,a", "1,a", "1,b", "2,a", "2,c"])
    flat = read_flat_baskets(spark, path)
    bag = {(r.antecedent, r.consequent): r.n for r in pair_frequency(flat, dedupe=False).collect()}
    st = {(r.antecedent, r.consequent): r.n for r in pair_frequency(flat, dedupe=True).collect()}
    assert bag[("a", "b")] == bag[("b", "a")] == 2
    assert st[("a", "b")] == st[("b", "a")] == 1
    freq_bag = {r.item: r.freq for r in item_frequency(flat, dedupe=False).collect()}
    assert freq_bag == {"a": 3, "b": 1, "c": 1}
    rules = {(r.antecedent, r.consequent): r for r in association_rules(flat, dedupe=False).collect()}
    # bag semantics: support of a is 3 / 2 baskets, above 1
    assert rules[("a", "b")].ant_support == 1.5


def test_basket_pairs_bag_rows(spark):
    df = spark.createDataFrame([("t", "a"), ("t", "a"), ("t", "b")], "trans_id string, item string")
    rows = sorted((r.antecedent, r.consequent, r.n) for r in basket_pairs(df, dedupe=False).collect())
    assert rows == [("a", "b", 2), ("b", "a", 2)]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_tiling_equals_plain(spark):
    flat = flat_basket(spark, SF_SMALL)
    plain = association_rules(flat, tile_rows=None)
    tiled = association_rules(flat, tile_rows=2)
    assert _rows(plain) == _rows(tiled)
    bag_plain = pair_frequency(flat, dedupe=False, tile_rows=None)
    bag_tiled = pair_frequency(flat, dedupe=False, tile_rows=3)
    assert _rows(bag_plain) == _rows(bag_tiled)


def test_one_hot_basket_is_tiled(spark):
    # one basket holding most rows: tiles must cover every pair exactly once
    rows = [("hot", f"i{k:03d}") for k in range(120)] + [("b", "i001"), ("b", "i002")]
    flat = spark.createDataFrame(rows, "trans_id string, item string")
    tiled = pair_frequency(flat, tile_rows=7)
    got = {(r.antecedent, r.consequent): r.n for r in tiled.collect()}
    assert len(got) == 120 * 119
    assert got[("i001", "i002")] == 2 and got[("i002", "i001")] == 2
    assert got[("i003", "i100")] == 1


def test_pair_total_property(spark):
    flat = flat_basket(spark, SF_SMALL)
    sizes = flat.distinct().groupBy("trans_id").count()
    expected = sizes.agg(F.sum(F.col("count") * (F.col("count") - 1))).collect()[0][0]
    got = pair_frequency(flat).agg(F.sum("n")).collect()[0][0]
    assert got == expected


def test_support_and_lift_symmetric(spark):
    rules = association_rules(flat_basket(spark, SF_SMALL))
    r = rules.alias("r").join(
        rules.alias("s"),
        (F.col("r.antecedent") == F.col("s.consequent")) & (F.col("r.consequent") == F.col("s.antecedent")),
    )
    bad = r.where((F.col("r.support") != F.col("s.support")) | (F.abs(F.col("r.lift") - F.col("s.lift")) > 1e-12))
    assert bad.count() == 0
    assert r.count() == rules.count()


def test_bag_equals_set_without_repeats(spark):
    flat = flat_basket(spark, SF_SMALL).distinct()
    assert _rows(association_rules(flat, dedupe=True)) == _rows(association_rules(flat, dedupe=False))


def test_top_rules_order_and_ties(listed):
    rules = basket_rules(listed, listed=True).rules
    top = top_rules(rules, "support", 3).collect()
    assert [(r.antecedent, r.consequent) for r in top] == [("C", "D"), ("D", "C"), ("A", "C")]
    with pytest.raises(ValueError):
        top_rules(rules, "nope")


def test_min_support(listed):
    flat = flatten_baskets(listed)
    rules = association_rules(flat, n_baskets=20, min_support=0.3)
    assert rules.count() == sum(1 for g in GOLDEN if g[5] >= 0.3)


def test_empty_input(spark):
    empty = spark.createDataFrame([], "trans_id string, item string")
    rules = association_rules(empty)
    assert rules.count() == 0
    s = rule_stats(rules).collect()[0]
    assert s.n_rules == 0 and s.min_support is None and s.mean_lift is None
    assert rules_per_antecedent(rules).count() == 0


def test_one_meaning_of_n_with_null_items(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, None), (None, "a")], "trans_id int, item string")
    assert basket_count(df).first().n_baskets == 3
    assert {r.item: r.support for r in item_support(df).collect()} == {"a": 2 / 3, "b": 2 / 3}
    for tile_rows in (1, None, 100):
        rules = association_rules(df, tile_rows=tile_rows).collect()
        assert {(r.antecedent, r.consequent, r.support) for r in rules} == {("a", "b", 2 / 3), ("b", "a", 2 / 3)}
        assert all(r.cons_support == 2 / 3 for r in rules if r.consequent == "b")


def test_run_basket_rules_writes_every_output(spark, listed, tmp_path):
    out = str(tmp_path / "out")
    run_basket_rules(spark, listed, out, listed=True)
    assert sorted(os.listdir(out)) == ["per_antecedent", "rules", "stats"]
    assert spark.read.parquet(f"{out}/stats").first().n_rules == 20


def test_single_item_baskets(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "trans_id string, item string")
    assert association_rules(df).count() == 0


def test_rule_lines_layout(listed):
    rules = basket_rules(listed, listed=True).rules.where("antecedent = 'A' AND consequent = 'B'")
    assert rule_lines(rules).collect()[0].value == (
        "A, B, 0.55, 0.5, 0.2, 0.36363636363636365, 0.7272727272727273"
    )


def test_hot_table_above_broadcast_limit(spark, monkeypatch):
    # more hot groups than the broadcast limit: the hot-group table is shuffle-joined
    import kinspark.operators.pairs as P

    monkeypatch.setattr(P, "HOT_BROADCAST_ROWS", 0)
    flat = flat_basket(spark, SF_SMALL)
    assert _rows(association_rules(flat, tile_rows=2)) == _rows(association_rules(flat, tile_rows=None))

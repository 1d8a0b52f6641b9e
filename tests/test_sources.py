"""Readers, Java-style split, retail data, sinks."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import write_lines
from kinspark.functions.text import java_split
from kinspark.operators.retail import (
    distinct_countries,
    item_catalog,
    item_descriptions,
    retail_baskets,
    retail_summary,
)
from kinspark.plans.pipelines import retail_rules, run_retail_rules
from kinspark.sources.readers import (
    read_flat_baskets,
    read_items,
    read_listed_baskets,
    read_ratings_dat,
    read_ratings_tsv,
    read_retail_lines,
)
from kinspark.sources.sinks import rule_lines, to_lines, write_table

SPLIT_CASES = [
    ("A|B", ["A", "B"]),
    ("A||", ["A"]),
    ("|A", ["", "A"]),
    ("A||B", ["A", "", "B"]),
    ("", [""]),
    ("||", []),
    ("A", ["A"]),
    (None, None),
]


def test_java_split(spark):
    df = spark.createDataFrame([(x,) for x, _ in SPLIT_CASES], "s string")
    got = [r.p for r in df.select(java_split("s", "[|]").alias("p")).collect()]
    assert got == [e for _, e in SPLIT_CASES]


def test_java_split_multichar(spark):
    df = spark.createDataFrame([("1::a::",), (":::",), ("a::::b",)], "s string")
    got = [r.p for r in df.select(java_split("s", "::").alias("p")).collect()]
    assert got == [["1", "a"], ["", ":"], ["a", "", "b"]]


def test_listed_edges(spark, tmp_path):
    path = write_lines(tmp_path / "t.csv", ["1,A|B|", "2,|C", "3,D,extra", "3,E"])
    got = [(r.trans_id, r.items) for r in read_listed_baskets(spark, path).collect()]
    assert got == [("1", ["A", "B"]), ("2", ["", "C"]), ("3", ["D"]), ("3", ["E"])]


def test_listed_missing_field_fails(spark, tmp_path):
    path = write_lines(tmp_path / "t.csv", ["1,A|B", "2"])
    with pytest.raises(Exception):
        read_listed_baskets(spark, path).collect()


def test_flat_reader(spark, tmp_path):
    path = write_lines(tmp_path / "f.csv", ["t1,a,ignored", "t1,b"], crlf=True)
    assert [tuple(r) for r in read_flat_baskets(spark, path).collect()] == [("t1", "a"), ("t1", "b")]


def test_items_reader(spark, tmp_path):
    path = write_lines(tmp_path / "m.dat", ["7::Title, with comma::A|B", "8::T::|"])
    rows = read_items(spark, path).collect()
    assert (rows[0].item, rows[0].title, rows[0].features) == (7, "Title, with comma", ["A", "B"])
    assert rows[1].features == []
    # a bad id, and an empty last field (Java's split drops it: too few fields)
    for i, line in enumerate(["x::T::A", "8::T::"]):
        bad = write_lines(tmp_path / f"bad{i}.dat", [line])
        with pytest.raises(Exception):
            read_items(spark, bad).collect()


@pytest.fixture
def no_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("ansi", [True, False])
def test_bad_lines_fail_whatever_the_ansi_setting(spark, tmp_path, ansi, request):
    if not ansi:
        request.getfixturevalue("no_ansi")
    for i, (read, line) in enumerate(
        [(read_ratings_dat, "x::2::3::4"), (read_ratings_dat, "5"), (read_items, "1::a"), (read_items, "q::a::b"),
         (read_flat_baskets, "1"), (read_listed_baskets, "1"), (read_ratings_tsv, "1\t2\tx\t4"), (read_ratings_tsv, "1\t2\t3.5")]
    ):
        path = write_lines(tmp_path / f"{i}.txt", [line])
        with pytest.raises(Exception, match="not a|fewer than"):
            read(spark, path).collect()


def test_ratings_tsv_ignores_more_fields(spark, tmp_path):
    path = write_lines(tmp_path / "r.tsv", ["1\t2\t3.5\t100\tmore\tand more"])
    assert [tuple(r) for r in read_ratings_tsv(spark, path).collect()] == [(1, 2, 3.5, 100)]


def test_cluster_needs_a_named_folder(monkeypatch):
    import kinspark.session as S

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_root(Session())


def test_ratings_dat(spark, tmp_path):
    path = write_lines(tmp_path / "r.dat", ["1::10::5::978300760", "2::20::3::978302109"])
    assert [tuple(r) for r in read_ratings_dat(spark, path).collect()] == [(1, 10), (2, 20)]


RETAIL = [
    "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country",
    '489434,85048,"LIGHT, BLUE",12,2009-12-01 07:45:00,6.95,13085,United Kingdom',
    "489434,79323P,,12,2009-12-01 07:45:00,6.75,13085,United Kingdom",
    "489435,22350,CAT_BOWL,12,2009-12-01 07:46:00,2.1,13085,France",
    "489435,85048,A LIGHT,6,2009-12-01 07:46:00,6.95,13086,France",
    "489436,79323P,,3,2009-12-01 07:47:00,6.75,,France",
]


@pytest.fixture(scope="module")
def retail(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("retail") / "retail.csv"
    write_lines(path, RETAIL)
    return read_retail_lines(spark, str(path))


def test_retail_reader(retail):
    rows = retail.collect()
    assert len(rows) == 5
    assert rows[0].description == "LIGHT, BLUE" and rows[0].quantity == 12 and rows[0].price == 6.95
    assert rows[0].invoice_date.hour == 7 and rows[1].description is None
    assert rows[4].customer_id is None


def test_retail_summary(retail):
    s = retail_summary(retail).collect()[0]
    assert (s.n_lines, s.n_invoices, s.n_items, s.n_descriptions, s.n_customers) == (5, 3, 3, 3, 2)
    assert sorted(r.country for r in distinct_countries(retail).collect()) == ["France", "United Kingdom"]


def test_retail_catalog(retail):
    cat = sorted(tuple(r) for r in item_catalog(retail).collect())
    assert cat == [("22350", "CAT_BOWL"), ("79323P", "NA"), ("85048", "A LIGHT"), ("85048", "LIGHT, BLUE")]
    one = {r.stock_code: r.description for r in item_descriptions(retail).collect()}
    assert one == {"22350": "CAT_BOWL", "79323P": "NA", "85048": "A LIGHT"}


def test_retail_rules_pipeline(spark, retail, tmp_path):
    res = retail_rules(retail)
    rules = {(r.antecedent, r.consequent): r for r in res.rules_with_descriptions.collect()}
    assert rules[("85048", "22350")].ant_description == "A LIGHT"
    assert rules[("85048", "22350")].cons_description == "CAT_BOWL"
    assert rules[("85048", "79323P")].support == pytest.approx(1 / 3)
    assert res.top_lift.count() == len(rules)
    out = str(tmp_path / "out")
    run_retail_rules(spark, retail, out)
    assert sorted(os.listdir(out)) == [
        "countries", "item_support", "items_map", "per_antecedent", "rules", "rules_with_item_desc", "stats", "summary",
        "top_confidence", "top_lift", "top_support",
    ]
    assert spark.read.parquet(f"{out}/stats").first().n_rules == len(rules)
    lines = spark.read.text(os.path.join(out, "rules_with_item_desc")).collect()
    assert len(lines) == len(rules) and all(line.value.count(",") == 8 for line in lines)


def test_described_rules_are_gzipped(spark, retail, tmp_path):
    """the lines of text are most of what a run writes."""
    out = str(tmp_path / "out")
    res = run_retail_rules(spark, retail, out)
    parts = [f for f in os.listdir(f"{out}/rules_with_item_desc") if f.startswith("part-")]
    assert parts and all(f.endswith(".gz") for f in parts)
    want = rule_lines(retail_rules(retail).rules_with_descriptions, with_descriptions=True).collect()
    assert sorted(r.value for r in spark.read.text(f"{out}/rules_with_item_desc").collect()) == sorted(r.value for r in want)
    assert sorted(map(tuple, res.item_support.collect())) == sorted(map(tuple, retail_rules(retail).item_support.collect()))


def test_naive_split_counts_header(spark, tmp_path):
    path = write_lines(tmp_path / "r.csv", RETAIL[:1] + RETAIL[3:5])
    df = read_retail_lines(spark, path, naive_split=True)
    rows = df.collect()
    assert len(rows) == 3 and rows[0].invoice == "Invoice" and rows[1].description == "CAT_BOWL"
    assert retail_baskets(df).count() == 3


def test_write_table_roundtrip_and_exists(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    path = str(tmp_path / "t")
    write_table(df, path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception):
        write_table(df, path)
    write_table(to_lines(df, ["k", "v"]), str(tmp_path / "txt"), fmt="text")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "txt")).collect()) == ["1, a", "2, b"]


def test_rule_lines_with_missing_description(spark):
    df = spark.createDataFrame(
        [("a", "b", 0.5, 0.25, 0.25, 0.5, 2.0, "x", None)],
        "antecedent string, consequent string, ant_support double, cons_support double, support double,"
        " confidence double, lift double, ant_description string, cons_description string",
    )
    assert rule_lines(df, with_descriptions=True).collect()[0].value == "a, b, 0.5, 0.25, 0.25, 0.5, 2.0,x,null"
    small = df.withColumn("support", F.lit(1e-4))
    assert "1.0E-4" in rule_lines(small).collect()[0].value

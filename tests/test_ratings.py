"""ALS, splits and error metrics."""

import math

import pytest
from pyspark.sql import functions as F

from helpers import write_lines
from kinspark.operators.ratings import (
    error_metrics,
    evaluate_builtin,
    fit_als,
    hash_split,
    item_mean_predictions,
    predict,
    split_ratings,
)
from kinspark.plans.pipelines import evaluate_als
from kinspark.sources.readers import read_ratings_tsv


@pytest.fixture(scope="module")
def train(spark, tmp_path_factory):
    rows = [f"{u}\t{i}\t{1 + (u * i) % 5}\t{880000000 + u * 10 + i}" for u in range(1, 9) for i in range(1, 7)]
    path = tmp_path_factory.mktemp("als") / "u.data"
    write_lines(path, rows)
    return read_ratings_tsv(spark, str(path))


def test_tsv_types(train):
    assert [f.dataType.simpleString() for f in train.schema.fields] == ["int", "int", "float", "bigint"]
    assert train.count() == 48


def test_cold_start_nan(spark, train):
    test = spark.createDataFrame(
        [(1, 1, 2.0), (2, 3, 2.0), (99, 1, 3.0), (1, 77, 3.0)], "userId int, itemId int, rating float"
    )
    pred = predict(fit_als(train, seed=7), test).collect()
    assert len(pred) == 4
    nan = {(r.userId, r.itemId) for r in pred if math.isnan(r.prediction)}
    assert nan == {(99, 1), (1, 77)}
    m = error_metrics(predict(fit_als(train, seed=7), test)).collect()[0]
    assert (m.n_rows, m.n_valid) == (4, 2)


def test_metrics_equal_regression_evaluator(spark, train):
    pred = predict(fit_als(train, seed=3), train)
    m = error_metrics(pred).collect()[0]
    ref = evaluate_builtin(pred)
    assert m.n_valid == m.n_rows == 48
    assert m.rmse == pytest.approx(ref["rmse"], rel=1e-9)
    assert m.mae == pytest.approx(ref["mae"], rel=1e-9)


def test_error_metrics_by_hand(spark):
    df = spark.createDataFrame(
        [(3.0, 1.0), (1.0, 2.0), (2.0, float("nan"))], "rating double, prediction double"
    )
    m = error_metrics(df).collect()[0]
    assert (m.n_rows, m.n_valid) == (3, 2)
    assert m.rmse == pytest.approx(math.sqrt((4 + 1) / 2))
    assert m.mae == pytest.approx(1.5)


def test_als_beats_constant_on_low_rank(spark):
    # planted rank-2 ratings: u.v with u, v in {0.5 .. 2}
    rows = []
    for u in range(1, 41):
        for i in range(1, 31):
            a = (0.5 + (u % 4) * 0.5, 0.5 + (u % 3) * 0.5)
            b = (0.5 + (i % 5) * 0.4, 0.5 + (i % 2) * 0.7)
            rows.append((u, i, float(a[0] * b[0] + a[1] * b[1])))
    df = spark.createDataFrame(rows, "userId int, itemId int, rating float")
    train, test = hash_split(df)
    ev = evaluate_als(df, train=train, test=test, seed=11, rank=4, max_iter=10)
    m = ev.metrics.collect()[0]
    mean = train.agg(F.avg("rating")).collect()[0][0]
    const = test.select(F.col("rating"), F.lit(mean).alias("prediction"))
    c = error_metrics(const).collect()[0]
    assert m.n_valid == m.n_rows
    assert m.rmse < 0.5 * c.rmse


def test_hash_split_covers_every_row_once(spark):
    df = spark.range(0, 2000).select(
        (F.col("id") % 97).cast("int").alias("userId"), (F.col("id") % 89).cast("int").alias("itemId")
    ).distinct()
    train, test = hash_split(df)
    assert train.count() + test.count() == df.count()
    assert train.intersect(test).count() == 0
    frac = test.count() / df.count()
    assert 0.1 < frac < 0.3


def test_factor_blocks_follow_the_setting(spark, train):
    model = fit_als(train, num_blocks=3)
    assert model.userFactors.rdd.getNumPartitions() == 3 and model.itemFactors.rdd.getNumPartitions() == 3


def test_random_split_is_seeded(spark, train):
    a1, b1 = split_ratings(train, seed=5)
    a2, b2 = split_ratings(train, seed=5)
    assert sorted(map(tuple, a1.collect())) == sorted(map(tuple, a2.collect()))
    assert a1.count() + b1.count() == 48


def test_item_mean_predictions_nan_for_unseen(spark):
    train = spark.createDataFrame([(1, 1, 2.0), (2, 1, 4.0)], "userId int, itemId int, rating double")
    test = spark.createDataFrame([(3, 1, 3.0), (3, 2, 3.0)], "userId int, itemId int, rating double")
    got = {r.itemId: r.prediction for r in item_mean_predictions(train, test).collect()}
    assert got[1] == 3.0 and math.isnan(got[2])


def test_bad_number_fails(spark, tmp_path):
    path = write_lines(tmp_path / "bad.data", ["1\t2\t3.5\t100", "x\t2\t3.5\t100"])
    with pytest.raises(Exception):
        read_ratings_tsv(spark, path).collect()

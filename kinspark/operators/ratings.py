"""Rating prediction with Spark ML ALS, and its error metrics.

ALS itself is Spark ML's blocked alternating least squares (its shuffles and
checkpoints are Spark's).  Metrics stay in DataFrames: one aggregate gives
row counts, RMSE and MAE, in double precision.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's ALS settings (the rest are Spark defaults).
ALS_MAX_ITER = 5
ALS_REG_PARAM = 0.01
ALS_RANK = 10
SPLIT_WEIGHTS = (0.8, 0.2)

ALS_LEAST_BLOCKS = 10  # Spark ML's own default


def split_ratings(df: DataFrame, weights=SPLIT_WEIGHTS, seed: int = 42) -> list[DataFrame]:
    """Random split.  It repeats only if ``df`` comes in the same partitions and order each time, so
    write df first; :func:`hash_split` has no such condition."""
    return df.randomSplit(list(weights), seed)


def hash_split(
    df: DataFrame,
    user_col: str = "userId",
    item_col: str = "itemId",
    buckets: int = 10,
    test_buckets: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Deterministic (train, test) split on a hash of the (user, item) key.

    Every row lands in exactly one part; bucket = the first eight hex digits
    of md5("user:item") mod ``buckets``, test when bucket < ``test_buckets``.
    Any SQL engine can repeat it.  A NULL id counts as the text ``null``.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (user_col, item_col)])
    digits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    bucket = digits % F.lit(buckets)
    return df.where(bucket >= test_buckets), df.where(bucket < test_buckets)


def fit_als(
    train: DataFrame,
    user_col: str = "userId",
    item_col: str = "itemId",
    rating_col: str = "rating",
    *,
    rank: int = ALS_RANK,
    max_iter: int = ALS_MAX_ITER,
    reg_param: float = ALS_REG_PARAM,
    seed: int = 42,
    cold_start: str = "nan",
    implicit: bool = False,
    cache_input: bool = True,
    num_blocks: int | None = None,
) -> ALSModel:
    """Explicit-feedback ALS (maxIter 5, regParam 0.01, rank 10 by default).

    Factors are updated in ``num_blocks`` user and item blocks, one task each
    (default: the session's parallelism, at least Spark ML's 10).  Spark ML
    checkpoints every 10 iterations into the session's checkpoint dir, so the
    default 5 iterations run without a checkpoint.  The fit reads
    its input more than once, so with ``cache_input`` the three used columns
    are persisted (memory and disk) for the duration of the fit only; the
    model's factors are kept by Spark ML itself.
    """
    blocks = num_blocks or max(ALS_LEAST_BLOCKS, train.sparkSession.sparkContext.defaultParallelism)
    als = ALS(
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        userCol=user_col,
        itemCol=item_col,
        ratingCol=rating_col,
        coldStartStrategy=cold_start,
        implicitPrefs=implicit,
        seed=seed,
    )
    if not cache_input:
        return als.fit(train)
    data = train.select(user_col, item_col, rating_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return als.fit(data)
    finally:
        data.unpersist()


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """Adds ``prediction``; NaN for a user or item unseen in training."""
    return model.transform(test)


_DOT = "aggregate(zip_with({}, {}, (p, q) -> CAST(p AS DOUBLE) * q), 0D, (s, x) -> s + x)"


def recompute_predictions(model: ALSModel, pred: DataFrame, user_col: str = "userId", item_col: str = "itemId") -> DataFrame:
    """``pred`` with ``recomputed``: the dot product of the two factor rows in double, NaN where one is missing.

    Spark ML's own prediction sums floats; the two agree to float precision.
    """
    users = model.userFactors.select(F.col("id").alias(user_col), F.col("features").alias("_x"))
    items = model.itemFactors.select(F.col("id").alias(item_col), F.col("features").alias("_y"))
    both = pred.join(users, user_col, "left").join(items, item_col, "left")
    dot = F.coalesce(F.expr(_DOT.format("_x", "_y")), F.lit(float("nan")))
    return both.select(*[F.col(c) for c in pred.columns], dot.alias("recomputed"))


def factor_residuals(
    model: ALSModel,
    train: DataFrame,
    user_col: str = "userId",
    item_col: str = "itemId",
    rating_col: str = "rating",
    *,
    reg_param: float = ALS_REG_PARAM,
) -> DataFrame:
    """(user, n_ratings, residual): how far each user's factor row is from solving its normal equations.

    ALS ends with the user side, so row x of a user with ratings r of items with rows y solves
    ``sum((x.y - r) y) + reg * n * x = 0``.  ``residual`` is the length of the left side over that of
    ``sum(r y)`` (0.0 where both are 0); a solved row shows the rounding of floats only, one that missed a
    rating does not.  Item rows solve the equations of the user rows before the last step, which are gone.
    Explicit feedback only; a user with a third of all ratings is partial sums of rank numbers per task.
    """
    rank = model.rank
    users = model.userFactors.select(F.col("id").alias(user_col), F.col("features").alias("_x"))
    items = model.itemFactors.select(F.col("id").alias(item_col), F.col("features").alias("_y"))
    rated = train.select(user_col, item_col, F.col(rating_col).cast("double").alias("_r"))
    rows = rated.join(items, item_col).join(users, user_col)
    rows = rows.select(user_col, "_r", "_y", (F.expr(_DOT.format("_x", "_y")) - F.col("_r")).alias("_e"))
    sums = [F.sum(F.expr(f"_e * _y[{k}]")).alias(f"_g{k}") for k in range(rank)]
    sums += [F.sum(F.expr(f"_r * _y[{k}]")).alias(f"_b{k}") for k in range(rank)]
    found = rows.groupBy(user_col).agg(F.count(F.lit(1)).alias("n_ratings"), *sums).join(users, user_col)
    left = " + ".join(f"power(_g{k} + {reg_param!r}D * n_ratings * _x[{k}], 2)" for k in range(rank))
    right = " + ".join(f"_b{k} * _b{k}" for k in range(rank))
    residual = f"CASE WHEN ({left}) = 0 THEN 0D ELSE sqrt(({left}) / ({right})) END"
    return found.select(user_col, "n_ratings", F.expr(residual).alias("residual"))


def error_metrics(pred: DataFrame, label_col: str = "rating", pred_col: str = "prediction") -> DataFrame:
    """One row: n_rows, n_valid (non-NaN errors), rmse and mae over the valid rows.

    NULL metrics when no row is valid.
    """
    err = F.col(label_col).cast("double") - F.col(pred_col).cast("double")
    valid = err.isNotNull() & ~F.isnan(err)
    e = F.when(valid, err)
    return pred.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(e).alias("n_valid"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
    )


def evaluate_builtin(pred: DataFrame, label_col: str = "rating", pred_col: str = "prediction") -> dict[str, float]:
    """RMSE and MAE from Spark ML's RegressionEvaluator (NaN rows not dropped)."""
    out = {}
    for metric in ("rmse", "mae"):
        ev = RegressionEvaluator(metricName=metric, labelCol=label_col, predictionCol=pred_col)
        out[metric] = ev.evaluate(pred)
    return out


def item_mean_predictions(
    train: DataFrame,
    test: DataFrame,
    item_col: str = "itemId",
    rating_col: str = "rating",
    pred_col: str = "prediction",
) -> DataFrame:
    """Test rows with the item's mean training rating as ``prediction``.

    A SQL-repeatable predictor for checking the metrics; items unseen in
    training get NaN, like ALS's cold start.
    """
    means = train.groupBy(item_col).agg(F.avg(F.col(rating_col).cast("double")).alias("_mean"))
    out = test.join(means, item_col, "left")
    return out.withColumn(pred_col, F.coalesce(F.col("_mean"), F.lit(float("nan")))).drop("_mean")

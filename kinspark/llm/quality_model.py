"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

1. ``statistics``: a fixed number of statistics of every whole text (lengths,
   shares of symbols, capitals, digits and repeated words, line shapes), staged.
2. Random Fourier features cos(w x + b) of the standardised statistics
   approximate a Gaussian kernel.  Every task sums its normal equations; the
   sums (a matrix whose size depends on the number of features alone) are added
   up by row and solved.
3. A calibration part of the training rows, not used in step 2, is scored; the
   raw scores are counted in ``BINS`` bins, pooled to a non-decreasing step
   function (pool adjacent violators), and read by interpolation.

All labelled training rows are used; no sample is taken.  What reaches the
driver has a fixed size: moments, normal equations, bins.

Defined results: null and empty texts get the score of all-zero counts; rows
without doc_id or quality teach nothing; without rows of both classes all scores
are the mean of what labels there are (0.5 without any); several labels of one
document all count; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm.common import documents, stage
from kinspark.llm.language_id import fold
from kinspark.session import table

FEATURES = 192
GAMMA = 0.15  # of the kernel exp(-gamma |x - y|^2) over standardised statistics
RIDGE = 1.0
SEED = 7
BINS = 2000
#: One in so many training rows calibrates instead of fitting.
CALIBRATION = 4

NAMES = (
    "log_words", "word_length", "log_lines", "line_words", "symbols", "digits", "capitals", "exclamations",
    "punctuation", "distinct_words", "repeated_neighbours", "distinct_pairs", "distinct_lines", "long_words",
    "capital_words", "non_ascii",
)

_SYMBOLS = re.compile(rb"[#*$%&|<>@^~=_+{}\[\]\\/]")
_DIGITS = re.compile(rb"[0-9]")
_CAPITALS = re.compile(rb"[A-Z]")
_MARKS = re.compile(rb"[.,;:?!'\"()-]")


def text_statistics(text: str | None) -> list[float]:
    """The statistics named in NAMES, over the whole text."""
    raw = (text or "").encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, chars = len(words), max(1, len(raw) - raw.count(b" ") - raw.count(b"\n"))
    per, rows = max(1, n), max(1, len(lines))
    share = lambda pattern: len(pattern.findall(raw)) / chars
    neighbours = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        np.log1p(n),
        chars / per if n else 0.0,
        np.log1p(len(lines)),
        np.log1p(n / rows),
        share(_SYMBOLS),
        share(_DIGITS),
        share(_CAPITALS),
        raw.count(b"!") / chars,
        share(_MARKS),
        len(set(words)) / per,
        neighbours / per,
        len(set(zip(words, words[1:], strict=False))) / per,
        len(set(lines)) / rows,
        sum(len(w) > 20 for w in words) / per,
        sum(w.isupper() for w in words) / per,
        (len(raw) - len(text or "")) / chars,
    ]


def statistics(docs: DataFrame) -> DataFrame:
    """Staged (doc_id, x array<double>) of rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [text_statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return stage(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>"), "text-statistics")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.empty((0, len(NAMES)))


class Model:
    """Standardisation, random features, ridge weights and calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = FEATURES):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0.0, np.sqrt(2 * GAMMA), (len(mean), features))
        self.b = rng.uniform(0.0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.steps: tuple[np.ndarray, np.ndarray] = (np.array([0.0]), np.array([0.5]))

    def transform(self, x: np.ndarray) -> np.ndarray:
        """Random features and a constant."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        f = np.cos(z @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.hstack([f, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.transform(x) @ self.weights

    def bins(self, x: np.ndarray) -> np.ndarray:
        """Raw scores from -0.5 to 1.5 in equal bins, the rest in the outer ones."""
        return np.clip(np.floor((self.raw(x) + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.steps), 0.0, 1.0)


def _moments(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each statistic (a constant one gets spread 1)."""
    aggs = []
    for i in range(len(NAMES)):
        aggs += [F.avg(F.col("x")[i]).alias(f"m{i}"), F.stddev_pop(F.col("x")[i]).alias(f"s{i}")]
    r = labelled.agg(*aggs).first()
    mean = np.array([r[f"m{i}"] or 0.0 for i in range(len(NAMES))])
    spread = np.array([r[f"s{i}"] or 0.0 for i in range(len(NAMES))])
    return mean, np.where(spread > 1e-9, spread, 1.0)


def _normal_equations(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y: one partial sum per task, added up by matrix row."""
    shared, size = labelled.sparkSession.sparkContext.broadcast(model), len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((size, size + 1)), False
        for batch in batches:
            z = shared.value.transform(_matrix(batch.column(0)))
            total += z.T @ np.hstack([z, batch.column(1).to_numpy()[:, None]])
            seen = seen or len(z) > 0
        if seen:
            i, j = np.divmod(np.arange(total.size), size + 1)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "v"])

    cells = labelled.select("x", "y").mapInArrow(run, "i long, j long, v double")
    rows = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()  # (features + 1)(features + 2) cells
    out = np.zeros((size, size + 1))
    out[rows["i"].to_numpy(), rows["j"].to_numpy()] = rows["v"].to_numpy()
    return out[:, :-1], out[:, -1]


def isotonic(x: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares means of points x (ascending) with n rows summing to total: (centre, mean) a block."""
    blocks: list[list[float]] = []
    for xi, ni, ti in zip(x, n, total, strict=True):
        blocks.append([xi * ni, ni, ti])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 1], b[:, 2] / b[:, 1]


def _calibrate(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shared.value.bins(_matrix(batch.column(0)))), batch.column(1)], names=["bin", "y"])

    binned = rows.select("x", "y").mapInArrow(run, "bin long, y double")
    got = binned.groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("t")).orderBy("bin").collect()  # BINS rows
    bins, n, total = (np.array([r[i] for r in got], dtype=float) for i in range(3))
    prior = total.sum() / n.sum()  # one row's worth of the mean keeps the ends off 0 and 1
    return isotonic((bins + 0.5) / BINS * 2 - 0.5, n + 0.01, total + 0.01 * prior)


def fit(labelled: DataFrame) -> Model:
    """A model of rows (x, y double, calibrates boolean)."""
    mean, scale = _moments(labelled)
    model = Model(mean, scale)
    fitting = labelled.where("NOT calibrates")
    a, b = _normal_equations(fitting, model)
    n, ones = a[-1, -1], b[-1]
    held = labelled.where("calibrates")
    if n == 0 or ones in (0, n) or held.isEmpty():
        y = labelled.agg(F.avg("y")).first()[0]
        model.steps = (np.array([0.0]), np.array([0.5 if y is None else y]))
        return model
    penalty = np.full(len(b), RIDGE)
    penalty[-1] = 1e-9
    model.weights = np.linalg.solve(a + np.diag(penalty), b)
    model.steps = _calibrate(held, model)
    return model


def score_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; labels teach only where the fold (of 3) is not 1."""
    x = statistics(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    y = labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    y = y.where("y IS NOT NULL AND doc_id IS NOT NULL").where(fold(F.col("doc_id"), 3) != 1)
    calibrates = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0
    labelled = stage(x.join(y, "doc_id").select("x", "y", calibrates.alias("calibrates")), "labelled")
    shared = docs.sparkSession.sparkContext.broadcast(fit(labelled))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(_matrix(batch.column(2)))
            new = [pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], names=["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return x.select("doc_id", held_out, "x").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op10_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))

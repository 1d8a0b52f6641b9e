"""Centroid clustering with Ptolemaic pivots.

Lloyd rounds over integer vectors.  The start vectors double as pivots: a
vector's distances to all of them are taken once and stored beside it.  Every
centroid has ``PAIRS`` fixed pivot pairs (its own start vector p with later
ones q), and by Ptolemy's inequality

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

so a round needs only the centroids' own distances to the pivots to bound
every (vector, centroid) distance from below.  A vector is first compared with
the centroid of least bound; of the others only those whose bound does not pass
that distance are compared.  All comparisons are sums of integer squares, so the
bound decides what is computed and never what wins.

Conservative rounding: stored distances are 32-bit floats, each off by at most
2^-24 of itself (and as much again for the root), so a bound is lowered by
``SLACK`` = 2^-21 of the two products it is the difference of, and a centroid
goes only if its squared bound, lowered by 2^-20 of itself once more, is above
the distance found.  Ties survive and go to the smaller number.

Spark's part: vectors and pivot distances are one staged table of fixed width;
a round is one pass over it with the centroids (clusters x width integers) as
the only thing broadcast.  Each task adds up its own sums, so clusters x tasks
short rows are shuffled whatever the size of a cluster, and a cluster holding a
third of all vectors is spread like any other.

Defined results: a vector counts if it has exactly ``width`` components, none
null, NaN or infinite; other rows are left out.  Scaled components beyond
+-2^26 are held there, which keeps every square exact in 64 bits.  Repeated
rows, equal vectors and null ids are rows of their own (a null id never starts
a centroid before those with one; among equal ids the smaller vector comes
first).  With fewer vectors than clusters there are as many centroids as
vectors.  Sums beyond a long are null.  An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm.common import stage
from kinspark.session import table

WIDTH = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = 2
PAIRS = 4
SLACK = 2.0**-21
_LOWER = 1 - 2.0**-20
_LIMIT = 1 << 26
_LONG = 2**63 - 1
#: Vectors bounded, and (vector, centroid) pairs compared, at a time.
_BLOCK, _EXACT = 8192, 65_536


def integer_vectors(
    rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every complete finite vector."""
    v = F.col(vec_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(F.least(F.greatest(x * scale, F.lit(-float(_LIMIT))), F.lit(float(_LIMIT)))).cast("int"))
    kept = rows.where((F.size(v) == width) & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col(id_col).cast("bigint").alias("vec_id"), whole.alias("v"))


def start_vectors(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors of least sha256(seed:id), in that order (clusters rows reach the driver)."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(h.asc_nulls_last(), "v").limit(clusters).select("v").collect()
    return np.array([r["v"] for r in first], dtype=np.int64)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of a to every row of b."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def _matrix(column: pa.ListArray, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(dtype)


def with_pivot_distances(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, pd): pd holds the distance to every pivot as a 32-bit float."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), np.int64)
            d = np.sqrt(_squares(v, pivots)).astype(np.float32) if len(v) else np.empty((0, len(pivots)), np.float32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(d.ravel()), len(pivots)).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["vec_id", "v", "pd"])

    return vectors.mapInArrow(run, "vec_id long, v array<int>, pd array<float>")


class Bounds:
    """Lower bounds of vector-centroid distances from pivot distances, for one round's centroids."""

    def __init__(self, pivots: np.ndarray, centroids: np.ndarray, pairs: int = PAIRS):
        k = len(pivots)
        self.centroids = centroids
        between, to_pivot = np.sqrt(_squares(pivots, pivots)), np.sqrt(_squares(centroids, pivots))
        own = np.arange(k)
        self.terms = []  # pivot numbers q, and d(c, q) / d(p, q), d(c, p) / d(p, q), for centroid and pivot p of one number
        for step in range(1, min(pairs, k - 1) + 1):
            q = (own + step * step) % k
            gap = between[own, q]
            scale = np.divide(1.0, gap, out=np.zeros(k), where=gap > 0)  # equal pivots: the bound is 0
            self.terms.append((q, to_pivot[own, q] * scale, to_pivot[own, own] * scale))

    def lower(self, pd: np.ndarray) -> np.ndarray:
        """Squared distances that no true one is below."""
        best = np.zeros(pd.shape)
        for q, to_q, to_p in self.terms:
            a, b = pd * to_q, pd[:, q] * to_p
            np.maximum(best, np.abs(a - b) - SLACK * (a + b), out=best)
        return best * best * _LOWER

    def nearest(self, v: np.ndarray, pd: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number of the nearest centroid, exact squared distance, distances computed); ties to the smaller number."""
        low, rows = self.lower(pd.astype(np.float64)), np.arange(len(v))
        first = low.argmin(axis=1)
        found = np.full(low.shape, np.iinfo(np.int64).max)
        found[rows, first] = ((v - self.centroids[first]) ** 2).sum(axis=1)
        left = low <= found[rows, first][:, None]
        left[rows, first] = False
        r, c = np.nonzero(left)
        for i in range(0, len(r), _EXACT):
            ri, ci = r[i : i + _EXACT], c[i : i + _EXACT]
            found[ri, ci] = ((v[ri] - self.centroids[ci]) ** 2).sum(axis=1)
        number = found.argmin(axis=1)
        return number, found[rows, number], len(rows) + len(r)


def _assigned(batches: Iterator[pa.RecordBatch], bounds: Bounds) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int]]:
    """(ids, vectors, numbers, squared distances, distances computed) of blocks of staged rows."""
    for batch in batches:
        for i in range(0, len(batch), _BLOCK):
            part = batch.slice(i, _BLOCK)
            v = _matrix(part.column(1), np.int64)
            yield part.column(0), v, *bounds.nearest(v, _matrix(part.column(2), np.float32))


def _moved(staged: DataFrame, bounds: Bounds) -> np.ndarray:
    """The centroids after one round: exact floored means, from one row of sums a task and cluster."""
    k, width = bounds.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), dtype=np.int64)
        for _, v, number, _, _ in _assigned(batches, bounds):
            order = number.argsort(kind="stable")
            held, at = np.unique(number[order], return_index=True)
            total[held, :width] += np.add.reduceat(v[order], at, axis=0)
            total[:, width] += np.bincount(number, minlength=k)
        c = np.flatnonzero(total[:, width])
        if len(c):
            cluster, part = np.repeat(c, width + 1), np.tile(np.arange(width + 1), len(c))
            columns = [pa.array(cluster), pa.array(part), pa.array(total[c].ravel())]
            yield pa.RecordBatch.from_arrays(columns, names=["cluster", "part", "total"])

    sums = staged.mapInArrow(run, "cluster long, part long, total long").groupBy("cluster", "part").agg(F.sum("total").alias("total"))
    out, cells = bounds.centroids.copy(), np.zeros((k, width + 1), dtype=np.int64)
    for r in sums.collect():  # clusters x (width + 1) numbers
        cells[r["cluster"], r["part"]] = r["total"]
    full = cells[:, width] > 0
    out[full] = cells[full, :width] // cells[full, width:]
    return out


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, pairs: int = PAIRS
) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector, final centroids) of rows (vec_id, v)."""
    spark = vectors.sparkSession
    vectors = stage(vectors, "vectors")
    pivots = start_vectors(vectors, clusters, seed)
    schema = "vec_id long, cluster int, distance long"
    if len(pivots) == 0:
        return spark.createDataFrame([], schema), pivots
    staged = stage(with_pivot_distances(vectors, pivots), "pivot-distances")
    centroids = pivots
    for _ in range(rounds):
        centroids = _moved(staged, Bounds(pivots, centroids, pairs))
    bounds = Bounds(pivots, centroids, pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, number, distance, _ in _assigned(batches, bounds):
            columns = [ids, pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return stage(staged.mapInArrow(run, schema), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assigned rows with their cluster's and the whole inertia and the digest of the cluster's centroid."""
    spark = assigned.sparkSession
    per = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.try_sum("distance").alias("s")).collect()}  # one row a cluster
    whole = None if None in per.values() or sum(per.values()) > _LONG else sum(per.values())
    digests = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = [(i, per[i], whole, digests[i]) for i in sorted(per)]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(named), "cluster").select("vec_id", *named.columns[:1], "distance", *named.columns[1:])


def op13_pivot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_inertia(*cluster(integer_vectors(table(spark, sf_dir, "embeddings"))))

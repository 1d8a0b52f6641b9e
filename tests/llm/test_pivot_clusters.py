from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinspark.llm import pivot_clusters as P


def model(ids, vectors, k=40, rounds=5, seed=2):
    """(cluster, distance) of each vector and the centroids, comparing everything with everything."""
    x = np.array(vectors, np.int64)
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, sha256(f"{seed}:{ids[i]}".encode()).hexdigest(), vectors[i]))
    c = x[order[:k]].copy()
    for last in range(rounds + 1):
        d = np.stack([((x - row) ** 2).sum(axis=1) for row in c], axis=1)
        a = d.argmin(axis=1)
        if last == rounds:
            return a, d[np.arange(len(x)), a], c
        for j in set(a.tolist()):
            c[j] = x[a == j].sum(axis=0) // (a == j).sum()


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids = [r.vec_id for r in rows]
    vectors = [np.floor(256 * np.array(r.embedding, np.float64)).astype(int).tolist() for r in rows]
    a, d, c = model(ids, vectors)
    got = {r.vec_id: r for r in P.op13_pivot_clusters(spark, "/root/testdata/sf0.01").collect()}
    digests = [sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    for i, j, e in zip(ids, a.tolist(), d.tolist(), strict=True):
        r = got[i]
        assert (r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) == (j, e, d[a == j].sum(), d.sum(), digests[j])


@pytest.mark.parametrize("spread", [1, 40, 1 << 26])
def test_bounds_hold_and_change_nothing(spread):
    rng = np.random.default_rng(spread)
    middle = rng.integers(-spread * 20, spread * 20 + 1, (9, 16)) if spread < 1 << 20 else rng.integers(-spread, spread + 1, (9, 16))
    x = np.concatenate([middle[rng.integers(0, 9, 400)] + rng.integers(-3, 4, (400, 16)), middle, middle])
    pivots = x[rng.choice(400, 12, replace=False)]
    pivots[5] = pivots[4]  # no distance between two pivots
    centroids = pivots + rng.integers(-2, 3, pivots.shape)
    centroids[3], centroids[7] = pivots[3], pivots[2]
    pd = np.sqrt(P._squares(x, pivots)).astype(np.float32)
    bounds, true = P.Bounds(pivots, centroids, 6), P._squares(x, centroids)
    assert (bounds.lower(pd.astype(np.float64)) <= true).all()
    number, distance, computed = bounds.nearest(x, pd)
    assert (number == true.argmin(axis=1)).all() and (distance == true.min(axis=1)).all()
    if spread == 40:
        assert computed < 0.5 * true.size  # clear clusters: most distances are never computed


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.integers(-3, 4, 4).tolist()) for i in range(60)]
    rows = [(i, [float(x) / 256 for x in v], 1, "x") for i, v in good]
    rows += rows[:9] + [(None, [0.0] * 4, 1, "y"), (70, [1e30, -1e30, 0.5, 0.0], 1, "z")]
    rows += [(80, None, 1, ""), (81, [], 1, ""), (82, [1.0] * 3, 1, ""), (83, [1.0, None, 1.0, 1.0], 1, "")]
    rows += [(84, [float("nan")] * 4, 1, ""), (85, [1.0, float("inf"), 1.0, 1.0], 1, ""), (86, [1.0] * 5, 1, "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int, distance string").repartition(5)
    kept = [(i, v) for i, v in good + good[:9]] + [(None, [0] * 4), (70, [1 << 26, -(1 << 26), 128, 0])]
    out, centroids = P.cluster(P.integer_vectors(df, width=4), clusters=12)
    a, d, c = model([i for i, _ in kept], [v for _, v in kept], 12)
    want = sorted((i or -1, int(j), int(e)) for (i, _), j, e in zip(kept, a, d, strict=True))
    assert sorted((r.vec_id or -1, r.cluster, r.distance) for r in out.collect()) == want
    assert (centroids == c).all()
    full = P.with_inertia(out, centroids)
    assert full.agg(F.max("inertia")).first()[0] == d.sum() and full.count() == len(kept)


def test_fewer_vectors_than_clusters_and_none(spark):
    df = spark.createDataFrame([(1, [0.1] * 64), (2, [0.2] * 64), (3, [0.2] * 64)], "vec_id long, embedding array<float>")
    out, centroids = P.cluster(P.integer_vectors(df))
    assert len(centroids) == 3 and sorted(r.distance for r in out.collect()) == [0, 0, 0]
    out, centroids = P.cluster(P.integer_vectors(df.where("vec_id > 9")))
    assert P.with_inertia(out, centroids).collect() == [] and len(centroids) == 0

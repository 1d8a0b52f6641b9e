"""SimHash near-dedup with covering locality-sensitive hashing.

For distance r, every one of the 64 bit positions gets a non-zero vector of
r + 1 bits, and every non-zero vector v gives a mask: the positions whose vector
has an odd overlap with v.  The vectors of r differing positions span at most r
dimensions, so some v is orthogonal to all of them and its mask keeps none of
the differing positions: any pair within r bits agrees in at least one of the
2^(r+1) - 1 tables.  No pair is missed.

Texts are reduced to distinct fingerprints first (copies cost nothing after
that), and only buckets with two or more fingerprints go on.  Inside a bucket no
pairs are emitted, only a path through the fingerprints found connected:

* up to ``HOT_BUCKET`` fingerprints: compared in one task, all against all;
* above: every fingerprint emits the values within ceil(r/2) flips of the
  positions the mask leaves free.  Two fingerprints are within r bits exactly if
  some value is within ceil(r/2) of one and floor(r/2) of the other, and all
  fingerprints around such a value belong together, so grouping by value
  finds every link.  A value has a bounded number of neighbours (466 for
  r = 3 and 30 free positions), whatever the bucket holds.

Components come from ``connected_components``.

Defined results: null, empty and white texts have fingerprint zero; repeated
rows and equal texts share a fingerprint and so a component; a row with null
doc_id is linked like any other but never names a component (which is null
if none of its rows has an id); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspark.llm.common import documents, stage
from kinspark.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HOT_BUCKET = 512
#: Shingles whose hashes are unpacked to bits at a time.
_BLOCK = 65_536


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if over half of the shingles' hashes have it."""
    words = (text or "").encode().lower().split()  # ASCII only: A-Z and the six ASCII white characters
    if not words:
        return 0
    if len(words) < shingle:
        words = [b" ".join(words)]
        shingle = 1
    grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    n = len(words) - shingle + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _BLOCK):
        block = hashes[i : i + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """docs (with a string column ``text``) plus ``fp``, the fingerprint as a signed long; text is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t.as_py(), shingle) for t in batch.column("text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], names=[*names, "fp"])

    names = docs.columns
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())]))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int = MAX_BITS) -> list[int]:
    """One signed 64-bit mask per non-zero vector of radius + 1 bits."""
    n = 2 ** (radius + 1) - 1
    vectors = [1 + i % n for i in range(64)]
    masks = [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, n + 1)]
    return [m - 2**64 if m >= 2**63 else m for m in masks]


def _path(values: np.ndarray) -> list[tuple[int, int]]:
    return list(zip(values[:-1].tolist(), values[1:].tolist(), strict=True))


def linked(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Paths through the groups that links of at most radius bits make of distinct values (int64)."""
    x = values.view(np.uint64)
    close = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    label = np.arange(len(x))
    while True:  # least label among neighbours, then its label, until nothing moves
        low = np.where(close, label[None, :], len(x)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    return [e for r in np.unique(label) for e in _path(values[label == r])]


_EDGES = "a long, b long"


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _link_buckets(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _edge_batch([e for v in batch.column(0) for e in linked(v.values.to_numpy(), radius)])

    return run


def _balls(radius: int, masks: list[int]):
    """Rows (bucket_table, fp) to (bucket_table, value, fp, inner): values around fp over the mask's free positions."""
    outer, inner = radius - radius // 2, radius // 2
    flips, near = {}, {}
    for t, mask in enumerate(masks):
        free = [i for i in range(64) if not (mask >> i) & 1]
        sets = [c for n in range(outer + 1) for c in combinations(free, n)]
        flips[t] = np.array([sum(1 << i for i in c) for c in sets], dtype=np.uint64)
        near[t] = np.array([len(c) <= inner for c in sets])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(), strict=True):
                value = (fp.view(np.uint64) ^ flips[t]).view(np.int64)
                n = len(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * n, pa.int32()), pa.array(value), pa.array(np.full(n, fp)), pa.array(near[t])],
                    names=["bucket_table", "value", "fp", "inner"],
                )

    return run


def _path_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _edge_batch([e for v in batch.column(0) for e in _path(np.unique(v.values.to_numpy()))])


def links(fps: DataFrame, radius: int = MAX_BITS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints fp whose components are those of all pairs within radius bits."""
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("bucket_table"), F.lit(m).alias("mask")) for t, m in enumerate(masks)])
    keyed = fps.select("fp", F.explode(tables).alias("t")).select(
        "fp", "t.bucket_table", F.col("fp").bitwiseAND(F.col("t.mask")).alias("bucket")
    )
    sizes = keyed.groupBy("bucket_table", "bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stage(keyed.join(sizes, ["bucket_table", "bucket"]), "buckets")
    small = members.where(F.col("size") <= hot_bucket).groupBy("bucket_table", "bucket")
    cold = small.agg(F.collect_list("fp").alias("fps")).select("fps").mapInArrow(_link_buckets(radius), _EDGES)
    balls = members.where(F.col("size") > hot_bucket).select("bucket_table", "fp").mapInArrow(
        _balls(radius, masks), "bucket_table int, value long, fp long, inner boolean"
    )
    around = balls.groupBy("bucket_table", "value").agg(F.max("inner").alias("inner"), F.collect_list("fp").alias("fps"))
    hot = around.where("inner AND size(fps) > 1").select("fps").mapInArrow(_path_batches, _EDGES)
    return cold.unionByName(hot)


def components(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = MAX_BITS,
    hot_bucket: int = HOT_BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id) per row of docs."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    prints = stage(fingerprints(plain, shingle), "fingerprints")
    fps = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = connected_components(links(fps.select("fp"), radius, hot_bucket)).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def one_per_component(docs: DataFrame, shingle: int = SHINGLE, radius: int = MAX_BITS) -> DataFrame:
    """The rows of docs (doc_id bigint, text string, ...) that stay, with their columns: one per component, of least doc_id.

    Rows that repeat both doc_id and fingerprint leave one.  Among rows without
    an id, each fingerprint of a component that has no id leaves one.
    """
    least = components(docs, shingle, radius).where("doc_id <=> component_id").groupBy("doc_id", "fp")
    stays = stage(least.agg(F.count("*").alias("n")), "staying")
    repeated = not stays.where("n > 1").isEmpty()
    stays = stays.select(F.col("doc_id").alias("stay_id"), F.col("fp").alias("stay_fp"))
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = [F.struct(*rest).alias("source_row")] if rest else []
    texts = with_fingerprint(docs.select("doc_id", "text", *row))
    same = F.col("doc_id").eqNullSafe(F.col("stay_id")) & (F.col("fp") == F.col("stay_fp"))
    kept = texts.join(stays, same)
    if repeated:  # without repeated rows there is nothing to drop, and texts need not move again
        kept = kept.dropDuplicates(["doc_id", "fp"])
    return kept.select(*[c if c in ("doc_id", "text") else F.col("source_row")[c].alias(c) for c in docs.columns])


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = components(documents(spark, sf_dir))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

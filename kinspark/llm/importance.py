"""Target-distribution importance resampling over hashed word n-grams.

A document's weight is the mean log ratio of its features' share in the target
texts to their share in all documents; Gumbel noise from a hash of the id turns
the highest sums into a draw without replacement.

**Array-scored weights.**  Features fall into a fixed number of buckets, so both
distributions and their log ratios are arrays.  The CRC-32 of "a b" is put
together from those of "a " and "b" (a CRC is linear: the first is carried over
the second's length by table look-ups), so all words and pairs of a block of
texts are hashed by a few numpy passes.  A task adds up its own
bucket counts; at most buckets x tasks short rows are shuffled.

**Parallel sorting by regular sampling.**  Scored rows are sorted in their
partitions and every run gives a regular sample (each ``step``-th row, the step
doubling as the run goes on, so that at most ``SAMPLES`` rows of a run, with
their weight, reach the driver however long it is).  Splitters are taken from
the sorted sample at equal weight; the key is (score, id, row), which no two
rows share, so equal scores and repeated rows are split like any others.  Each row
is sent to its segment's task, sorted there, and numbered from the count of all
rows in earlier segments: exact ranks, no task ever holding more than a
segment.  Segments wholly past the last draw keep null ranks and are not
exchanged.

Defined results: null, empty and wordless texts have no features, weight 0 and
are never drawn (fewer than ``min_words`` words); a null id is hashed as an
empty one and loses ties to any other; repeated rows count, score and rank as rows of their
own; an empty corpus gives no rows and an empty target only smoothed shares;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm.common import documents, pick, stage
from kinspark.session import table

BUCKETS = 10_000
SMOOTH = 10_000
SEED = 7
PERCENT = 25
MIN_WORDS = 20
SAMPLES = 64
#: Rows a segment is meant to hold.
SEGMENT_ROWS = 1_000_000
#: Bytes of whole texts taken at a time (a longer text alone), and words of them hashed at a time.
_BLOCK, _WORDS = 1 << 22, 1 << 18
_BYTES = np.arange(256, dtype=np.uint8)
_LOWERED = np.frombuffer(_BYTES.tobytes().lower(), np.uint8).astype(np.uint32)  # bytes: A-Z only
_IS_WORD = np.array([chr(b).isalnum() or b > 127 for b in range(256)])


def _carry_tables() -> list[np.ndarray]:
    """For each k, four tables of 256 that carry a CRC-32 over 2^k zero bytes, a byte of the CRC each."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    byte = np.arange(256, dtype=np.uint32)
    one = [step] + [(byte << np.uint32(8 * (i - 1))).astype(np.uint32) for i in (1, 2, 3)]
    tables = [np.stack(one)]
    for _ in range(31):
        tables.append(np.stack([_look_up(tables[-1], part) for part in tables[-1]]))
    return tables


def _look_up(t: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return t[0][crc & 255] ^ t[1][(crc >> 8) & 255] ^ t[2][(crc >> 16) & 255] ^ t[3][crc >> 24]


_CARRY = _carry_tables()


def _short_table() -> np.ndarray:
    """The same for every length below ``_SHORT`` bytes, flat: length, byte of the CRC, its value."""
    byte = np.arange(256, dtype=np.uint32)
    rows = [np.stack([byte << np.uint32(8 * i) for i in range(4)])]
    for _ in range(_SHORT - 1):
        rows.append(np.stack([_look_up(_CARRY[0], part) for part in rows[-1]]))
    return np.concatenate(rows).ravel()


_SHORT = 32
_SHORT_CARRY = _short_table()


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of concatenations (longs): from those of the two parts and the byte length of the second."""
    at = np.minimum(length, _SHORT - 1) << 10
    out = _SHORT_CARRY[at + (first & 255)]
    out ^= _SHORT_CARRY[at + ((first >> 8) & 255 | 256)]
    out ^= _SHORT_CARRY[at + ((first >> 16) & 255 | 512)]
    out ^= _SHORT_CARRY[at + (first >> 24 | 768)]
    long = np.flatnonzero(length >= _SHORT)
    if len(long):
        crc, size = first[long].astype(np.uint32), length[long]
        for k in range(int(size.max()).bit_length()):
            some = np.flatnonzero((size >> k) & 1)
            crc[some] = _look_up(_CARRY[k], crc[some])
        out[long] = crc
    return out.astype(np.int64) ^ second


def _stepped(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _CARRY[0][0][(state ^ byte) & 255] ^ (state >> np.uint32(8))


def word_crcs(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of the lower-cased words of a byte buffer: byte by byte for all words at once, long ones apart."""
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    at = np.flatnonzero(size < _SHORT)
    place, left, crc = start[at], size[at], state[at]
    j = 0
    while len(at):
        crc = _stepped(crc, _LOWERED[data[place + j]])
        j += 1
        ended = left == j
        if ended.any():
            state[at[ended]] = crc[ended]
            go = ~ended
            at, place, left, crc = at[go], place[go], left[go], crc[go]
    out = ~state
    for i in np.flatnonzero(size >= _SHORT).tolist():
        out[i] = crc32(data[start[i] : start[i] + size[i]].tobytes().lower())
    return out.astype(np.int64)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, text number) of the words of texts that lie one after another, cut at ``bounds``."""
    inside = _IS_WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    before[cut] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[cut - 1] = False
    size = np.flatnonzero(inside & ~after) + 1 - start
    return start, size, np.searchsorted(bounds, start, side="right") - 1


def feature_blocks(column: pa.Array, buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, text number within them, bucket) of all features, in blocks of whole and of parts of texts."""
    texts = column.cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + _BLOCK, side="right")) - 1)
        data, bounds = whole[at[first] : at[last]], at[first : last + 1] - at[first]
        start, size, text = word_spans(data, bounds)
        for i in range(0, len(start), _WORDS):
            part = slice(i, i + _WORDS + 1)  # one more: the block's last pair
            n, text_, size_ = min(_WORDS, len(start) - i), text[part], size[part]
            crc = word_crcs(data, start[part], size_)
            blank = (~_stepped(~crc[:-1].astype(np.uint32), np.uint32(32))).astype(np.int64)
            pair = joined_crc(blank, crc[1:], size_[1:])
            same = text_[1:] == text_[:-1]
            found = np.concatenate([crc[:n], pair[same]])
            yield first, last - first, np.concatenate([text_[:n], text_[:-1][same]]), found % buckets
        if not len(start):
            yield first, last - first, np.empty(0, np.int64), np.empty(0, np.int64)
        first = last


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all texts of rows (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, bucket in feature_blocks(batch.column(0), buckets):
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    counted = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, smooth: int = SMOOTH) -> np.ndarray:
    """floor(1000 ln) of the smoothed target share over the smoothed corpus share, a bucket."""
    a, b = float(corpus.sum() + smooth), float(target.sum() + smooth)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([floor(1000 * log(((t + 1.0) * a) / ((s + 1.0) * b))) for s, t in pairs], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """floor(1000 x a standard Gumbel value) that the id alone decides."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def score_rows(rows: DataFrame, gain: np.ndarray, seed: int = SEED, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_features, weight, score, drawable) of rows (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, total = batch.column(0).to_pylist(), np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for first, rows_, text, bucket in feature_blocks(batch.column(1), len(gain)):
                n[first : first + rows_] += np.bincount(text, minlength=rows_)
                total[first : first + rows_] += np.bincount(text, gain[bucket], rows_).astype(np.int64)  # whole numbers below 2^53
            weight = np.floor_divide(total, np.maximum(n, 1))
            score = weight + np.array([noise(i, seed) for i in ids], np.int64)
            new = [pa.array(x) for x in (n, weight, score, n >= 2 * min_words - 1)]  # w words have 2w - 1 features
            yield pa.RecordBatch.from_arrays([batch.column(0), *new], names=names)

    names = ["doc_id", "n_features", "weight", "score", "drawable"]
    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, n_features long, weight long, score long, drawable boolean")


# ------------------------------------------------ sorting by regular sampling

_KEY = ["down", "id_key", "row"]


def _thinned(keys: list[tuple], step: int, seen: int, batch: np.ndarray, most: int) -> tuple[list[tuple], int]:
    """The run's rows at multiples of step, step doubled while they are too many."""
    at = np.arange(-seen % step, len(batch), step)
    keys += [tuple(k) for k in batch[at].tolist()]
    while len(keys) > most:
        keys, step = keys[::2], step * 2
    return keys, step


def _key_matrix(batch: pa.RecordBatch, first: int = 0) -> np.ndarray:
    return np.stack([batch.column(first + i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)


def regular_samples(keyed: DataFrame, most: int = SAMPLES) -> list[tuple]:
    """(key..., rows it stands for) of each sorted run, sorted: at most ``most`` rows a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, step, seen = [], 1, 0
        for batch in batches:
            keys, step = _thinned(keys, step, seen, _key_matrix(batch), most)
            seen += len(batch)
        columns = [pa.array([k[i] for k in keys], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([step] * len(keys), pa.int64())], names=[*_KEY, "stands_for"])

    sampled = keyed.select(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(run, "down long, id_key long, row long, stands_for long")
    return sorted(tuple(r) for r in sampled.collect())


def splitters(samples: list[tuple], segments: int) -> np.ndarray:
    """Up to segments - 1 keys that cut the sample into parts of equal weight."""
    if not samples:
        return np.empty((0, 3), np.int64)
    weight = np.cumsum([s[3] for s in samples])
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, segments) / segments)
    return np.array([samples[i][:3] for i in np.unique(cuts)], np.int64).reshape(-1, 3)


def segment_of(keys: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many cuts are at or below each key, by binary search over whole keys."""
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(cuts), np.int64)
    while len(cuts) and (open_ := low < high).any():
        mid = np.minimum((low + high) // 2, len(cuts) - 1)
        c = cuts[mid]
        less = keys[:, 2] < c[:, 2]
        for i in (1, 0):
            less = (keys[:, i] < c[:, i]) | ((keys[:, i] == c[:, i]) & less)
        high = np.where(open_ & less, mid, high)
        low = np.where(open_ & ~less, mid + 1, low)
    return low


def _with_segment(keyed: DataFrame, cuts: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment_of(_key_matrix(batch), cuts))], names=names)

    names = [*keyed.columns, "segment"]
    return keyed.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in keyed.dtypes) + ", segment long")


def _numbered(before: dict[int, int], last: int):
    """Rank of rows that come sorted: rows of earlier segments, then the place in its own; null past ``last``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_rank = {s: n + 1 for s, n in before.items()}
        for batch in batches:
            segment = batch.column(0).to_numpy()
            rank = np.empty(len(segment), np.int64)
            for s in np.unique(segment).tolist():
                at = np.flatnonzero(segment == s)
                rank[at] = next_rank[s] + np.arange(len(at))
                next_rank[s] += len(at)
            ranks = pa.array(rank, mask=rank > last)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], ranks], names=["doc_id", "n_features", "weight", "score", "rank"])

    return run


_OUT = "doc_id long, n_features long, weight long, score long, rank long"


def ranked(scored: DataFrame, percent: int = PERCENT, segment_rows: int = SEGMENT_ROWS, samples: int = SAMPLES) -> DataFrame:
    """Scored rows with ``rank``: 1, 2, ... for the drawn (highest scores, then smaller ids), null for the others."""
    spark = scored.sparkSession
    id_key = F.coalesce("doc_id", F.lit(2**63 - 1))
    keys = [(-F.col("score")).alias("down"), id_key.alias("id_key"), F.monotonically_increasing_id().alias("row")]
    keyed = stage(scored.select(*keys, *scored.columns), "scored")  # the row number stays as it was written
    drawable = keyed.where("drawable")
    n = drawable.count()
    last = percent * n // 100
    segments = max(spark.sparkContext.defaultParallelism, -(-n // segment_rows))
    cuts = splitters(regular_samples(drawable, samples), segments)
    placed = stage(_with_segment(drawable, cuts), "segments")
    sizes = {r["segment"]: r["count"] for r in placed.groupBy("segment").count().collect()}  # one row a segment
    before, total = {}, 0
    for s in sorted(sizes):
        before[s], total = total, total + sizes[s]
    reached = max((s for s in before if before[s] < last), default=-1)
    out = ["doc_id", "n_features", "weight", "score"]
    drawn = placed.where(F.col("segment") <= reached)
    dealt = drawn.repartitionById(max(reached + 1, 1), F.col("segment").cast("int")).sortWithinPartitions("segment", *_KEY)
    first = dealt.select("segment", *out).mapInArrow(_numbered(before, last), _OUT)
    null = F.lit(None).cast("bigint").alias("rank")
    late = placed.where(F.col("segment") > reached).select(*out, null)
    return first.unionByName(late).unionByName(keyed.where("NOT drawable").select(*out, null))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs, drawn towards the target's texts."""
    rows = pick(docs, id_col, text_col)
    wanted = target.select(F.col(target_text_col).cast("string").alias("text"))
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
    return ranked(score_rows(rows, gain, seed, min_words), percent)


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))

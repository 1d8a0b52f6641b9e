"""Line dedup over levelled sorted runs of line hashes.

State is a set of *runs* in shared storage: Parquet tables sorted by line hash,
one row (hash, documents holding the line, largest such doc_id) per line, each line in one run only.  A
batch of documents is hashed once, reduced to one row per line and merge-anti-joined with every
run (``LineRuns.unseen``): lines that no run has become the batch's own run of level 0.  The batch's counts of lines
that runs already have are kept as updates beside the runs, as a line is dropped for how many documents hold it.
When a level holds ``fanout`` runs, they are merged in pairs, by full outer merge joins, into one run of the
next level (with the updates, if no other run is left), so n
batches leave O(fanout * log n) runs and each row is rewritten O(log n) times.  Runs and updates are written
partitioned and sorted by hash, every step shuffles by hash, and a line that a third of all documents share is one
row per task before it moves.

``dedup_lines`` deals a table into batches, builds the runs and applies them: a
line of at least ``min_chars`` code points held by at least ``min_docs``
documents is dropped everywhere but in the largest doc_id that holds it.

Defined results: a null or empty text has one empty line; a row with null
doc_id keeps its lines and counts for nothing; rows that repeat a doc_id are one
document for the counts, and each loses the lines that the document loses; an
empty table gives no rows; other columns are ignored or carried as one struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinspark.llm.common import WHITE, documents, stage

MIN_CHARS = 40
MIN_DOCS = 5
#: Batches that one call over a whole table is dealt into, and runs of a level that are merged.
BATCHES = 4
FANOUT = 2
#: Hashes don't compress, and many small files would each hold native buffers of a codec.
_CODEC = "uncompressed"


def line_key(line: str) -> str:
    """The line without white space at both ends (A-Z are lower-cased by key_hash)."""
    return line.strip(WHITE)


def key_hash(key: str) -> bytes:
    """128 bits of the key with A-Z lower-cased (bytes.lower changes ASCII only)."""
    return xxhash.xxh3_128_digest(key.encode().lower())


def hashed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h): the distinct long lines of each row (doc_id, text) that has both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, digests = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys = (line_key(x) for x in text.as_py().split("\n"))
                own = {key_hash(k) for k in keys if len(k) >= min_chars}
                ids += [doc_id] * len(own)
                digests += own
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "h": pa.array(digests, pa.binary())})

    real = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    return real.mapInArrow(run, "doc_id long, h binary")


def _merge_two(a: DataFrame, b: DataFrame) -> DataFrame:
    b = b.select("h", F.col("n_docs").alias("more"), F.col("max_doc").alias("other"))
    both = a.join(b.hint("merge"), "h", "full_outer")
    n = F.coalesce("n_docs", F.lit(0)) + F.coalesce("more", F.lit(0))
    return both.select("h", n.alias("n_docs"), F.greatest("max_doc", "other").alias("max_doc"))


class LineRuns:
    """Levelled sorted runs in shared storage; ``levels[i]`` lists the run tables of level i, oldest first."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.updates: list[DataFrame] = []  # counts of lines that were in a run already

    @staticmethod
    def _merged(tables: list[DataFrame]) -> DataFrame:
        """Tables of one row a line, merged in pairs, then the pairs, and so on: each step is a full outer merge join."""
        while len(tables) > 1:
            rest = tables[len(tables) // 2 * 2 :]
            tables = [_merge_two(a, b) for a, b in zip(tables[::2], tables[1::2])] + rest
        return tables[0]

    @staticmethod
    def _batch(lines: DataFrame) -> DataFrame:
        return lines.distinct().groupBy("h").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows (h, ...) whose hash no run holds: one merge anti join per run."""
        for run in self.runs():
            lines = lines.join(run.select("h").hint("merge"), "h", "left_anti")
        return lines

    def add(self, lines: DataFrame) -> None:
        """Add a batch (doc_id, h): its new lines as a run of level 0, its other lines as updates; all rows of a document belong to one batch."""
        batch = self._batch(lines).sortWithinPartitions("h")
        if not self.runs():
            return self._push(stage(batch, "line-run-0", _CODEC), 0)
        batch = stage(batch, "line-batch", _CODEC)
        new = stage(self.unseen(batch).sortWithinPartitions("h"), "line-run-0", _CODEC)
        known = batch.join(new.select("h").hint("merge"), "h", "left_anti")
        self.updates.append(stage(known.sortWithinPartitions("h"), "line-updates", _CODEC))
        self._push(new, 0)

    def _push(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            if not self.runs():  # nothing else is left that the updates could belong to
                full, self.updates = full + self.updates, []
            merged = self._merged(full).sortWithinPartitions("h")
            self._push(stage(merged, f"line-run-{level + 1}", _CODEC), level + 1)

    def counts(self) -> DataFrame:
        """One row (h, n_docs, max_doc) per line over all runs and updates."""
        tables = self.runs() + self.updates
        return tables[0] if len(tables) == 1 else self._merged(tables)


def _drop_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """Rows (..., text, drops) to (..., n_lines, n_dropped, kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, drops in zip(batch.column("text"), batch.column("drops"), strict=True):
                lines = left = (text.as_py() or "").split("\n")
                if gone := set(drops.as_py() or ()):
                    left = [x for x in lines if len(k := line_key(x)) < min_chars or key_hash(k) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                kept.append("\n".join(left))
            rest = [batch.column(c) for c in carried]
            new = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(rest + new, names=[*carried, "n_lines", "n_dropped", "kept"])

    carried = [c for c in rows.columns if c not in ("text", "drops")]
    fields = [f for f in rows.schema.fields if f.name in carried]
    out = T.StructType(fields).add("n_lines", "long").add("n_dropped", "long").add("kept", "string")
    return rows.mapInArrow(run, out)


def dedup_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) per row of docs; with carry, those columns in the struct ``source_row``."""
    row = F.struct(*[F.col(c) for c in carry]).alias("source_row")
    text = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *([row] if carry else []),
    )
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    lines = stage(hashed_lines(text, min_chars).select("h", "doc_id", batch), "line-hashes")
    runs = LineRuns(fanout)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).select("h", "doc_id"))
    # written, so that the join with a line's many rows has plain sides and adaptive execution can split it
    shared = stage(runs.counts().where(F.col("n_docs") >= min_docs).select("h", "max_doc"), "shared-lines")
    lost = lines.select("h", "doc_id").join(shared, "h").where("doc_id <> max_doc")
    drops = lost.groupBy("doc_id").agg(F.collect_set("h").alias("drops"))
    return _drop_lines(text.join(drops, "doc_id", "left"), min_chars)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))

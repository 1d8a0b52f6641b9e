"""Language ID by rank-order profiles.

A language's profile is the list of its most frequent character n-grams (1 to
``MAX_N`` letters, words padded with a blank), a document's profile likewise; the
out-of-place distance adds up how far each of the document's n-grams stands from
its place in the language's list (``top`` if it is not there), and the nearest
language wins.

Counting is a numpy pass per document; a task merges its counts by language
before they are shuffled, so what moves is one row per (language, n-gram) and
task.  Profiles have ``top`` entries a language, and only they are broadcast.

Defined results: null text or a text without letters gives ``und`` with score
0; with nothing to learn from, so does every text; equal distances go to the
smaller language value; languages are learned only from rows with text, lang and
doc_id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinspark.llm.common import documents

MAX_N = 3
TOP = 400
UNKNOWN = "und"
#: Distinct (language, n-gram) pairs that a task gathers before it hands them on.
FLUSH = 400_000
_BITS = 21  # a code point; three fit into a long


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> np.ndarray:
    """Lower-cased letters; every run of anything else is one blank, also before and after."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    codes = np.where(_letters()[codes], codes, 32).astype(np.int64)
    codes = np.concatenate(([32], codes, [32]))
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def ngram_counts(text: str, max_n: int = MAX_N) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as sorted longs, counts).  A long holds the code points; a lone blank doesn't count."""
    codes = _codes(text)
    if len(codes) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys = []
    for n in range(1, max_n + 1):
        key = codes[: len(codes) - n + 1].copy()
        inner = np.ones(len(key), dtype=bool)
        for i in range(1, n):
            key = (key << _BITS) | codes[i : len(codes) - n + 1 + i]
            if i < n - 1:
                inner &= codes[i : len(codes) - n + 1 + i] != 32  # no blank inside
        keys.append(key[inner & (key != 32)])
    return np.unique(np.concatenate(keys), return_counts=True)


def _top(keys: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, best first; equal counts by n-gram."""
    if len(keys) > top:
        floor = np.partition(counts, len(counts) - top)[len(counts) - top]
        few = counts >= floor
        keys, counts = keys[few], counts[few]
    return keys[np.lexsort((keys, -counts))][:top]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([c for _, c in parts]), minlength=len(keys)).astype(np.int64)


def _count_languages(max_n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def merged() -> int:
            for lang, parts in held.items():
                held[lang] = [_merge(parts)]
            return sum(len(p[0][0]) for p in held.values())

        def handed() -> Iterator[pa.RecordBatch]:
            for lang, [(keys, counts)] in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "gram", "n"])
            held.clear()

        size = 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                own = ngram_counts(text.as_py(), max_n)
                size += len(own[0])
                if len(own[0]):
                    held.setdefault(lang.as_py(), []).append(own)
                if size > 2 * FLUSH:
                    size = merged()
                    if size > FLUSH:
                        yield from handed()
                        size = 0
        merged()
        yield from handed()

    return run


def profiles(labelled: DataFrame, max_n: int = MAX_N, top: int = TOP) -> DataFrame:
    """(lang, gram, place) of the top n-grams of each language, from rows (text, lang)."""
    real = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counted = real.mapInArrow(_count_languages(max_n), "lang string, gram long, n long")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return total.withColumn("place", place).where(F.col("place") <= top).select("lang", "gram", "place")


class ProfileTable:
    """Profiles of all languages as one array: places[i, l] of n-gram grams[i] in language l, ``top`` if absent."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int = TOP):
        self.top = top
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[1] for r in rows}), dtype=np.int64)
        self.places = np.full((len(self.grams) + 1, len(self.langs)), top, dtype=np.int64)
        column = {x: i for i, x in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.places[np.searchsorted(self.grams, gram), column[lang]] = place - 1

    def predict(self, text: str | None, max_n: int = MAX_N) -> tuple[str, float]:
        """(language, closeness from 0 to 1)."""
        own = _top(*ngram_counts(text or "", max_n), self.top)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        known = self.grams[np.minimum(at, len(self.grams) - 1)] == own
        places = self.places[np.where(known, at, len(self.grams))]
        here = np.arange(len(own))[:, None]
        far = np.where(places < self.top, np.abs(places - here), self.top).sum(axis=0)
        best = int(far.argmin())
        return self.langs[best], float(1 - far[best] / (self.top * len(own)))


def predict(docs: DataFrame, table: ProfileTable, max_n: int = MAX_N) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of rows (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.predict(t.as_py(), max_n) for t in batch.column(2)]
            new = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal digits, modulo n (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % n


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """Learn from the rows whose fold (of 4) is not 2, predict all rows."""
    held_out = F.coalesce(fold(F.col(id_col), 4) == 2, F.lit(False))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        held_out.alias("held_out"),
    )
    learned = profiles(rows.where("NOT held_out AND doc_id IS NOT NULL"), top=top).collect()  # top rows a language
    return predict(rows, ProfileTable([tuple(r) for r in learned], top))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))

"""Packing: concatenate and cut.

All documents form one stream of token ids, each document closed by an end id,
and the stream is cut every ``seq_len`` tokens; only the last sequence needs
padding.

1. Tokenise once; every task adds up its own tokens, so each document has a
   start within its task.  The ids go to shared storage (2 or 4 bytes each).
2. Task totals give each task's global start by a prefix sum.  Only these
   totals (one number per task of step 1) reach the driver.
3. A document's global start fixes every cut.  ``pieces`` lists them; it needs
   no shuffle.  ``sequences`` joins them up: windows that lie wholly in one
   read task are complete there, the others leave it as boundary records (at
   most two per contiguous run of documents) and are put together by sequence.

Defined results: a null text counts as empty and has just the end id; rows with
equal or null doc_id are separate documents; an empty table gives no rows;
other columns are ignored.  The order of documents is that of the scan.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm.common import documents, pick, stage

SEQ_LEN = 1024
END_ID = 0
#: Entries of a task's memo of encoded chunks; when full it starts afresh.
MEMO_ENTRIES = 500_000
#: Bytes of text or ids that a task handles at a time.
SLICE_BYTES = 4 << 20

# Fixed value: the white space of the tokenizer's pattern (Unicode White_Space).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACE_RE2 = re.sub(r"\\(?:u(....)|x(..))", lambda m: rf"\x{{{m[1] or m[2]}}}", _SPACE)
#: The tokenizer never joins two chunks: a run of white space gives its last blank to the word after it.
_CHUNK = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# Fixed value: the splitting pattern of byte-level BPE tokenizers.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """The byte that a character of a byte-level vocabulary stands for: printable Latin-1 itself, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_engine(path: str):
    """tiktoken over the vocabulary of a tokenizer file, or None if the file is no plain byte-level BPE.

    Merges by rank equal the file's merges if its ids follow their order.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model["vocab"]
    in_order = all(vocab.get("".join(m)) == 256 + i for i, m in enumerate(merges))
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if model["type"] != "BPE" or not (merges and in_order and plain) or spec.get("normalizer"):
        return None
    added = {t["content"] for t in spec.get("added_tokens", [])}
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in added}
    return tiktoken.Encoding("chunks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    """Token ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    The byte-level BPE pattern splits at white space before any merge, so a
    text's ids are its chunks' ids in turn, and each distinct chunk is encoded
    once, by tiktoken where the file's vocabulary lets it (a few times faster
    and the same ids), else by the tokenizer.  ``encode_all`` splits most texts at blanks in Arrow and gathers ids
    in numpy; a text where a blank follows other white space is chunked by
    ``_CHUNK``, one that names a special token is encoded whole.
    """

    def __init__(self, path: str, memo_entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, special)) or "$^"
        self.odd = rf"[{_SPACE_RE2}] |{self.special}"
        self.engine = merge_engine(path)
        self.memo: dict[str, bytes] = {}
        self.memo_entries = memo_entries

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        memo = self.memo
        if len(memo) > self.memo_entries:
            memo.clear()
        new = list({c for c in chunks if c not in memo})
        if self.engine:
            encode = self.engine.encode_ordinary
            for c in new:
                memo[c] = array("I", encode(c)).tobytes()
        elif new:
            for c, e in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False), strict=True):
                memo[c] = array("I", e.ids).tobytes()
        return [memo[c] for c in chunks]

    def __call__(self, text: str) -> bytes:
        if re.search(self.special, text):
            return self._encode(text)
        return b"".join(self._chunks(_CHUNK.findall(text)))

    def encode_all(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each closed by end_id; tokens of each text)."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts)
        split = pc.split_pattern(plain, " ")
        parts = split.flatten().dictionary_encode()
        ends = split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]
        firsts = np.concatenate(([0], ends[:-1]))
        index = parts.indices.to_numpy().astype(np.int64)
        known = parts.dictionary.to_pylist()
        # a text's first part has no blank before it; an odd text is one entry of its own
        heads = [p.as_py() for p in parts.take(pa.array(firsts))]
        of_heads = self._chunks(heads)
        of_odd = [self(t.as_py()) for t in texts.filter(pa.array(odd))]
        entries = self._chunks([" " + p for p in known]) + of_heads + of_odd + [end_id.to_bytes(4, "little")]
        heads_at = len(known) + np.arange(len(heads))
        heads_at[odd] = len(known) + len(heads) + np.arange(len(of_odd))
        index[firsts] = heads_at
        index = np.insert(index, ends, len(entries) - 1)
        sizes = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // 4
        begins = np.cumsum(sizes) - sizes
        count = sizes[index]
        stops = np.cumsum(count)
        at = np.repeat(begins[index] - (stops - count), count) + np.arange(stops[-1])
        ids = np.frombuffer(b"".join(entries), dtype="<u4")[at]
        return ids, np.diff(stops[ends + np.arange(len(ends))], prepend=0)


_ENCODERS: dict[str, ChunkEncoder] = {}


def _encoder(path: str) -> ChunkEncoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def _slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each (a longer text is alone)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
    start = 0
    while start < len(size):
        before = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _ids_array(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary array of each text's ids."""
    offsets = np.concatenate(([0], np.cumsum(counts * 4)))
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids.tobytes())]
    ).cast(pa.binary())


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Staged rows (doc_id, part, local_start, doc_tokens, ids): ids as little-endian uint32 bytes with the end id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in (x for b in batches for x in _slices(b, 1, SLICE_BYTES)):
            ids, n = encoder.encode_all(pc.fill_null(batch.column(1), ""), end_id)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(starts), pa.array(n), _ids_array(ids, n)],
                names=["doc_id", "part", "local_start", "doc_tokens", "ids"],
            )

    out = "doc_id long, part int, local_start long, doc_tokens long, ids binary"
    return stage(docs.select("doc_id", "text").mapInArrow(run, out), "token-ids")


def part_starts(tokens: DataFrame) -> dict[int, int]:
    """Global start of each part: an exclusive prefix sum over the parts' totals (one number per task)."""
    totals = tokens.groupBy("part").agg(F.sum("doc_tokens").alias("n")).collect()
    at, starts = 0, {}
    for r in sorted(totals, key=lambda r: r["part"]):
        starts[r["part"]] = at
        at += r["n"]
    return starts


def _pieces(start: int, n: int, seq_len: int) -> Iterator[tuple[int, int]]:
    """(first token within the document, length) between the cuts of a document at a global start."""
    at = 0
    while at < n:
        size = min(n - at, seq_len - (start + at) % seq_len)
        yield at, size
        at += size


def pieces(tokens: DataFrame, seq_len: int = SEQ_LEN) -> DataFrame:
    """Every piece of every document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    bases = tokens.sparkSession.sparkContext.broadcast(part_starts(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, part, local, n, ids in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                first = bases.value[part] + local
                for at, size in _pieces(first, n, seq_len):
                    crc = zlib.crc32(ids[4 * at : 4 * (at + size)])
                    rows.append((doc_id, at, size, crc, n, (first + at) // seq_len, (first + at) % seq_len))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 7
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    plain = tokens.select("doc_id", "part", "local_start", "doc_tokens", "ids")
    return plain.mapInArrow(run, ", ".join(f"`{c}` long" for c in names))


def sequences(tokens: DataFrame, seq_len: int = SEQ_LEN, pad_id: int = END_ID) -> DataFrame:
    """The packed sequences: sequence_id, tokens (array<int>, padded to seq_len), n_tokens, doc_ids.

    doc_ids lists the documents with a piece in the sequence, in order.
    """
    bases = tokens.sparkSession.sparkContext.broadcast(part_starts(tokens))
    plain = tokens.select("doc_id", "part", "local_start", "doc_tokens", "ids")

    def cut(complete: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[tuple[int, int, bytes, list]] = []
            window, begin, docs, expect = b"", 0, [], None  # the open window: ids from global position begin on

            def close() -> None:
                if window and (len(window) == 4 * seq_len) == complete:
                    out.append((begin // seq_len, begin % seq_len, window, docs))

            for batch in (x for b in batches for x in _slices(b, 4, SLICE_BYTES)):
                for doc_id, part, local, n, ids in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
                    first = bases.value[part] + local
                    if first != expect:  # this task reads another stretch of the stream now
                        close()
                        window, begin, docs = b"", first, []
                    for at, size in _pieces(first, n, seq_len):
                        if (first + at) % seq_len == 0:
                            close()
                            window, begin, docs = b"", first + at, []
                        window += ids[4 * at : 4 * (at + size)]
                        docs = [*docs, doc_id]
                    expect = first + n
                yield emit(out)
                out.clear()
            close()
            yield emit(out)

        emit = (lambda rows: _padded(_records(rows), seq_len, pad_id)) if complete else _records
        return run

    whole = plain.mapInArrow(cut(True), _SEQUENCE)
    edges = plain.mapInArrow(cut(False), "sequence_id long, at int, ids binary, doc_ids array<long>").groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("at", "ids", "doc_ids"))).alias("edges")  # at most seq_len ids in all
    )
    edges = edges.select(
        "sequence_id",
        F.lit(0).alias("at"),
        F.expr("unhex(array_join(transform(edges, x -> hex(x.ids)), ''))").alias("ids"),
        F.flatten(F.col("edges.doc_ids")).alias("doc_ids"),
    )

    def pad(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _padded(batch, seq_len, pad_id)

    return whole.unionByName(edges.mapInArrow(pad, _SEQUENCE))


_SEQUENCE = "sequence_id long, tokens array<int>, n_tokens int, doc_ids array<long>"


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["sequence_id", "at", "ids", "doc_ids"])


def _padded(batch: pa.RecordBatch, seq_len: int, pad_id: int) -> pa.RecordBatch:
    """Records of whole sequences, with their ids as a list padded to seq_len."""
    ids = [np.frombuffer(x.as_py(), dtype="<u4") for x in batch.column("ids")]
    flat = np.full((len(ids), seq_len), pad_id, dtype=np.int32)
    for row, x in zip(flat, ids, strict=True):
        row[: len(x)] = x
    offsets = pa.array(np.arange(0, flat.size + 1, seq_len), pa.int32())
    tokens = pa.ListArray.from_arrays(offsets, pa.array(flat.ravel(), pa.int32()))
    n = pa.array([len(x) for x in ids], pa.int32())
    names = ["sequence_id", "tokens", "n_tokens", "doc_ids"]
    return pa.RecordBatch.from_arrays([batch.column("sequence_id"), tokens, n, batch.column("doc_ids")], names=names)


def tokenised_documents(
    docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    return tokenised(pick(docs, id_col, text_col), tokenizer_path or default_tokenizer_path())


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(tokenised_documents(documents(spark, sf_dir)))

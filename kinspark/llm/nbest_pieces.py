"""SentencePiece encoding and decoding with exact N-best segmentations.

A text becomes pieces over the vocabulary of a SentencePiece model.  The lattice
has a node between any two code points and an edge for every piece; a code point
that no piece covers has one edge of its UTF-8 byte pieces.  Forward Viterbi
gives the best score from the start to each node.  The N best segmentations are
found by A-star from the end: what a partial path still lacks is exactly the
forward score of its node, so paths come out in order of their total.

A blank is written as the block sign, with one in front; a block sign of the text
itself is always its three byte pieces, so decoding tells the two apart.  No piece has a
block sign after another character (checked when the model is loaded), so no
segmentation crosses the start of a run of signs: the lattice falls apart
into blocks, mostly words.  For the blocks that a task meets anew, edges, forward scores and
the search's first result are made for all of them at once (``learn``): the
search goes from the end along edges that lose nothing, and the best of the
other edges it has put on its open list by then tells what the second best lacks.  The N best of the text
come from the N - 1 blocks that lack least; only there the search goes on (``search``).

Decoding is block by block from the ids: a text's segmentations differ in at
most N - 1 blocks, so a block's text is made once and joined.

The public vocabulary holds merge ranks, not probabilities.  A piece at rank r
scores -log(1 + r) (Zipf's law), runs of blanks as the last rank, byte pieces
``BYTE_PENALTY`` below that.  Scores are integers in units of 1e-6, so sums and
ties are exact; of equal segmentations the order is fixed by the search.

Defined results: null stays null (no segmentation, decoded null); the empty text
has the one empty segmentation; any other text decodes to itself from each of
its segmentations; rows with equal or null doc_id are separate; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm.common import documents, pick

SIGN = "▁"
N_BEST = 4
BYTE_PENALTY = 10.0
UNIT = 1_000_000
#: Blocks that a task remembers; when full it starts afresh.
MEMO_ENTRIES = 600_000
#: Stands in the lattice for a block sign of the text itself; no text has it, as it is half a surrogate.
LITERAL = "\ud800"
#: Bytes of segmentations, or characters of texts, after which a task hands a batch on.
OUT_BYTES = 4_000_000
_SEGMENTATIONS = "array<struct<score: double, ids: array<int>>>"
_DECODED = f"doc_id long, segmentations {_SEGMENTATIONS}, decodings array<string>"

_BLOCK = re.compile(f"{SIGN}+[^{SIGN}]*|[^{SIGN}]+")


def _raw(char: str) -> bytes:
    """The UTF-8 bytes of a character of the lattice."""
    return (SIGN if char == LITERAL else char).encode()


Edge = tuple[int, int, bytes]  # (start node, score, ids as little-endian uint16)


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _ids_of(rest: tuple | None) -> bytes:
    """The pieces of a chain (piece, rest of the text's pieces), joined."""
    parts = []
    while rest:
        parts.append(rest[0])
        rest = rest[1]
    return b"".join(parts)


_NONE = np.iinfo(np.int64).max
#: Characters of blocks that are searched at a time; blocks of up to as many characters as the second go together.
_CHARS, _SHORT = 200_000, 24


def _by_size(blocks: list[str]) -> Iterator[list[str]]:
    """Blocks (sorted by length) in parts of about ``_CHARS`` characters, short and long ones apart."""
    part, held, short = [], 0, True
    for b in blocks:
        if part and (held + len(b) > _CHARS or (short and len(b) > _SHORT)):
            yield part
            part, held = [], 0
        part.append(b)
        held, short = held + len(b), len(b) <= _SHORT
    if part:
        yield part


class Trie:
    """Beginnings of pieces as numbered nodes (0: the empty one), with sorted steps (node, character) to the next."""

    def __init__(self, ids: dict[str, tuple[int, bytes]]):
        number = {"": 0}
        for p in ids:
            for i in range(1, len(p) + 1):
                number.setdefault(p[:i], len(number))
        names = list(number)[1:]
        keys = np.array([number[x[:-1]] << 21 | ord(x[-1]) for x in names])
        order = keys.argsort()
        self.keys, self.target = keys[order], np.arange(1, len(number))[order]
        found = [ids.get(x) for x in number]
        self.score = np.array([0 if f is None else f[0] for f in found])
        self.piece = np.array([-1 if f is None else int.from_bytes(f[1], "little") for f in found])


class Pieces:
    """Vocabulary, lattice search and the memo of a worker."""

    def __init__(self, path: str, n_best: int = N_BEST, memo_entries: int = MEMO_ENTRIES):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.n_best, self.memo_entries = n_best, memo_entries
        size = model.get_piece_size()
        self.ids: dict[str, tuple[int, bytes]] = {}
        self.bytes: dict[int, bytes] = {}
        self.texts: list[str | int | None] = [None] * size
        worst = -math.log(1 + size)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i.to_bytes(2, "little")
                self.texts[i] = int(piece[3:5], 16)
            elif not (model.is_control(i) or model.is_unknown(i)):
                rank = -model.get_score(i)
                score = worst if rank > size else -math.log(1 + rank)
                self.ids[piece] = (round(score * UNIT), i.to_bytes(2, "little"))
                self.texts[i] = piece
        self.byte_score = round((worst - BYTE_PENALTY) * UNIT)
        self.longest = max(map(len, self.ids))
        self.trie = Trie(self.ids)
        raw = [b"" if t is None else bytes([t]) if isinstance(t, int) else t.replace(SIGN, " ").encode() for t in self.texts]
        self.raw = np.array(raw, object)
        if SIGN not in self.ids or any(SIGN in p.lstrip(SIGN) for p in self.ids) or size > 65_535:
            raise ValueError("the vocabulary joins words, has no block sign, or has too many pieces")
        self.memo: dict[str, tuple[bytes, int, int | None, bytes]] = {}  # what learn finds
        self.lists: dict[str, list[tuple[int, bytes, bytes]]] = {}  # (score, ids, decoded bytes) of the n best

    def edges(self, block: str) -> list[list[Edge]]:
        """Edges by their end node."""
        out: list[list[Edge]] = [[] for _ in range(len(block) + 1)]
        for i in range(len(block)):
            for j in range(i + 1, min(len(block), i + self.longest) + 1):
                if known := self.ids.get(block[i:j]):
                    out[j].append((i, *known))
            if block[i] not in self.ids:
                raw = _raw(block[i])
                out[i + 1].append((i, self.byte_score * len(raw), b"".join(self.bytes[b] for b in raw)))
        return out

    @staticmethod
    def forward(edges: list[list[Edge]]) -> tuple[list[int], list[Edge | None]]:
        """Best score from the start to each node, and the edge it ends with."""
        best, last = [0], [None]
        for into in edges[1:]:
            top = max(into, key=lambda e: best[e[0]] + e[1])
            best.append(best[top[0]] + top[1])
            last.append(top)
        return best, last

    def search(self, block: str, n: int) -> list[tuple[int, bytes]]:
        """The n best (score, ids) of a block, best first: A-star from the end with the forward scores."""
        edges = self.edges(block)
        best, _ = self.forward(edges)
        # (-total, -order of arrival, node, score so far, pieces so far as a chain): of equal totals
        # the newest goes on, so ties are followed to the start one after the other, not side by side
        heap: list[tuple] = [(-best[-1], 0, len(block), 0, None)]
        out, tick = [], 0
        while heap and len(out) < n:
            _, _, node, done, pieces = heapq.heappop(heap)
            if node == 0:
                out.append((done, _ids_of(pieces)))
                continue
            for start, score, piece in edges[node]:
                tick -= 1
                heapq.heappush(heap, (-(done + score + best[start]), tick, start, done + score, (piece, pieces)))
        return out

    def learn(self, blocks: list[str]) -> None:
        """Remembers (ids, score, what the second best lacks or None, decoded bytes) of blocks, all searched at once.

        Nodes, edges and paths of all blocks lie in one array each; a loop step handles one length, end
        position or path step for every block.
        """
        for few in _by_size(blocks):
            lens = np.array([len(b) for b in few])
            codes = np.frombuffer("".join(few).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
            begin = np.cumsum(lens) - lens
            local = np.arange(len(codes)) - np.repeat(begin, lens)
            base = np.repeat(begin + np.arange(len(few)), lens)  # a block's first node
            start, size, score, own = self._lattice(codes, np.repeat(lens, lens) - local)
            edges = np.lexsort((start, local[start] + size))  # by end position; the longest piece first
            start, size, score, own = start[edges], size[edges], score[edges], own[edges]
            tail, head = base[start] + local[start], base[start] + local[start] + size
            best = np.full(len(codes) + len(few), np.iinfo(np.int64).min // 2)
            best[begin + np.arange(len(few))] = 0
            cuts = np.searchsorted(local[start] + size, np.arange(1, int(lens.max()) + 2))
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                np.maximum.at(best, head[i:j], best[tail[i:j]] + score[i:j])
            lost = best[head] - best[tail] - score
            into = np.full(len(best), -1)
            free = np.flatnonzero(lost == 0)[::-1]
            into[head[free]] = free  # of several the first
            other = np.full(len(best), _NONE)
            rest = np.ones(len(lost), bool)
            rest[into[into >= 0]] = False
            np.minimum.at(other, head[rest], lost[rest])
            self._keep(few, begin + np.arange(len(few)) + lens, best, tail, into, other, own)

    def _lattice(self, codes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Edges (start, size, score, id, or -1 - character for the bytes of a character) over all positions at once."""
        t, out = self.trie, []
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for d in range(self.longest):
            go = room[at] > d
            at, node = at[go], node[go]
            key = node << 21 | codes[at + d]
            k = np.minimum(np.searchsorted(t.keys, key), len(t.keys) - 1)
            known = t.keys[k] == key
            single = d == 0
            at, node = at[known], t.target[k[known]]
            piece = t.piece[node] >= 0
            if single:
                bare = np.ones(len(codes), bool)
                bare[at[piece]] = False
                bare = np.flatnonzero(bare)
                chars = np.where(codes[bare] == ord(LITERAL), ord(SIGN), codes[bare])
                n = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
                out.append((bare, np.ones(len(bare), np.int64), n * self.byte_score, -1 - chars))
            out.append((at[piece], np.full(int(piece.sum()), d + 1), t.score[node[piece]], t.piece[node[piece]]))
            if not len(at):
                break
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    def _keep(self, few: list[str], ends: np.ndarray, best: np.ndarray, tail: np.ndarray, into: np.ndarray, other: np.ndarray, own: np.ndarray) -> None:
        """Follows all blocks' best paths from their ends and puts what was found into the memo."""
        block, node, lack, steps = np.arange(len(few)), ends, np.full(len(few), _NONE), []
        while len(block):
            lack[block] = np.minimum(lack[block], other[node])
            edge = into[node]
            steps.append((block, own[edge]))
            node = tail[edge]
            more = into[node] >= 0
            block, node = block[more], node[more]
        which = np.concatenate([b for b, _ in reversed(steps)])
        order = which.argsort(kind="stable")
        path, counts = np.concatenate([x for _, x in reversed(steps)])[order], np.bincount(which, minlength=len(few))
        if (path < 0).any():
            lists = [[x] if x >= 0 else [int.from_bytes(self.bytes[b], "little") for b in chr(-1 - x).encode()] for x in path.tolist()]
            n = np.array([len(x) for x in lists])
            counts = np.bincount(np.repeat(np.arange(len(few)), counts), n, len(few)).astype(np.int64)
            path = np.array([i for x in lists for i in x])
        ids, cut = path.astype("<u2").tobytes(), (2 * np.cumsum([0, *counts])).tolist()
        raw = self.raw[path].tolist()
        joined, size = b"".join(raw), np.cumsum([0, *map(len, raw)])
        text = size[np.cumsum([0, *counts])].tolist()
        facts = zip(few, best[ends].tolist(), lack.tolist(), strict=True)
        for i, (name, score, low) in enumerate(facts):
            self.memo[name] = (ids[cut[i] : cut[i + 1]], score, None if low == _NONE else low, joined[text[i] : text[i + 1]])

    def blocks(self, text: str) -> list[str]:
        return _BLOCK.findall(SIGN + text.replace(SIGN, LITERAL).replace(" ", SIGN)) if text else []

    def meet(self, texts: list[str]) -> list[list[str]]:
        """The blocks of each text, all in the memo afterwards."""
        if len(self.memo) > self.memo_entries:
            self.memo.clear()
            self.lists.clear()
        blocks = [self.blocks(t) for t in texts]
        self.learn(sorted((b for b in set(chain.from_iterable(blocks)) if b not in self.memo), key=len))
        return blocks

    def _choices(self, blocks: list[str], lacks: list[int | None]) -> list[tuple[int, tuple]]:
        """The n least (total lack, ((block index, rank), ...)): only the n - 1 blocks that lack least can differ."""
        n = self.n_best
        left = [_NONE if x is None else x for x in lacks]
        out: list[tuple[int, tuple]] = [(0, ())]
        for _ in range(min(n - 1, len(left))):
            least = min(left)
            if least == _NONE:
                break
            i = left.index(least)
            left[i] = _NONE
            own = self.lists.get(blocks[i])
            if own is None:  # the first result is kept as first, also where others have the same total
                best, score, _, raw = self.memo[blocks[i]]
                rest = [x for x in self.search(blocks[i], n) if x[1] != best]
                decoded = [b"".join(self.raw[np.frombuffer(x, "<u2")].tolist()) for _, x in rest]
                own = self.lists[blocks[i]] = [(score, best, raw), *[(*x, d) for x, d in zip(rest, decoded, strict=True)][: n - 1]]
            lost = [(own[0][0] - x[0], k) for k, x in enumerate(own)]
            out = heapq.nsmallest(n, [(a + b, (*c, (i, k)) if k else c) for a, c in out for b, k in lost])
        return out

    def segmentations(self, blocks: list[str]) -> list[tuple[int, bytes, str]]:
        """The n best (score, ids, decoded text) of the text with these blocks, which are in the memo."""
        if not blocks:
            return [(0, b"", "")]
        best, scores, lacks, raw = zip(*map(self.memo.__getitem__, blocks), strict=True)
        total, out = sum(scores), []
        whole = b"".join(raw).decode()[1:]
        for lack, other in self._choices(blocks, lacks):
            parts, decoded = list(best), whole
            for i, k in other:
                parts[i] = self.lists[blocks[i]][k][1]
            if any(self.lists[blocks[i]][k][2] != raw[i] for i, k in other):
                texts = list(raw)
                for i, k in other:
                    texts[i] = self.lists[blocks[i]][k][2]
                decoded = b"".join(texts).decode()[1:]
            out.append((total - lack, b"".join(parts), decoded))
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of a segmentation: signs as blanks, byte pieces as UTF-8, without the first blank."""
        raw = b"".join(self.raw[ids].tolist())
        return raw.decode()[1:]


_LOADED: dict[tuple, Pieces] = {}


def _pieces(path: str, n_best: int) -> Pieces:
    if (path, n_best) not in _LOADED:
        _LOADED[path, n_best] = Pieces(path, n_best)
    return _LOADED[path, n_best]


def _segmented(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[tuple[list, list]]:
    """(doc_ids, segmentations or None each) of batches (doc_id, text), in parts of about ``OUT_BYTES``."""
    for batch in batches:
        first, column = 0, batch.column(1)
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy()
        ends = np.cumsum(sizes)
        while first < len(batch):
            most = (ends[first - 1] if first else 0) + OUT_BYTES // (2 * pieces.n_best)
            last = max(first + 1, int(np.searchsorted(ends, most, side="right")))
            texts = column.slice(first, last - first).to_pylist()
            blocks = iter(pieces.meet([t for t in texts if t is not None]))
            got = [None if t is None else pieces.segmentations(next(blocks)) for t in texts]
            yield batch.column(0).slice(first, last - first), got
            first = last


def _lists(got: list) -> pa.ListArray:
    """Segmentations as a column."""
    each = [x for g in got if g is not None for x in g]
    flat = pa.array(np.frombuffer(b"".join([x[1] for x in each]), "<u2").astype(np.int32))
    ends = np.cumsum([0] + [len(x[1]) // 2 for x in each])
    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
    scores = pa.array([x[0] / UNIT for x in each], pa.float64())
    ends = np.cumsum([0] + [0 if g is None else len(g) for g in got])
    offsets = pa.array(ends, pa.int32(), mask=np.array([g is None for g in got] + [False]))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([scores, ids], ["score", "ids"]))


def _decoded(batches: Iterator[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    """(doc_id, segmentations, decodings) of batches (doc_id, segmentations), in batches of about ``OUT_BYTES``."""
    for batch in batches:
        start, held, rows = 0, 0, []
        for i, row in enumerate(batch.column(1)):
            rows.append([pieces.decode(x["ids"].values.to_numpy()) for x in row] if row.is_valid else None)
            held += sum(map(len, rows[-1] or ()))
            if held > OUT_BYTES or i + 1 == batch.num_rows:
                texts = pa.array(rows, pa.list_(pa.string()))
                names = ["doc_id", "segmentations", "decodings"]
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(rows)).columns, texts], names=names)
                start, held, rows = i + 1, 0, []


def _best(got: DataFrame, *more: str) -> DataFrame:
    ids, scores = F.get("segmentations", F.lit(0))["ids"], F.col("segmentations.score")
    return got.select("doc_id", ids.alias("ids"), scores.alias("scores"), "segmentations", *more)


def encode(docs: DataFrame, model_path: str, n_best: int = N_BEST) -> DataFrame:
    """(doc_id, ids, scores, segmentations) of rows (doc_id, text): the n best (score, ids), best first; ids are the best's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, got in _segmented(batches, _pieces(model_path, n_best)):
            yield pa.RecordBatch.from_arrays([ids, _lists(got)], names=["doc_id", "segmentations"])

    return _best(docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, segmentations {_SEGMENTATIONS}"))


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids, scores, segmentations, decodings, decoded) of ``encode``'s rows: the text of each, and of the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(batches, _pieces(model_path, N_BEST))

    got = encoded.select("doc_id", "segmentations").mapInArrow(run, _DECODED)
    return _best(got, "decodings").withColumn("decoded", F.get("decodings", F.lit(0)))


def round_trip(docs: DataFrame, model_path: str, n_best: int = N_BEST) -> DataFrame:
    """(doc_id, segmentations, decodings): ``encode`` and ``decode`` in one worker, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, got in _segmented(batches, _pieces(model_path, n_best)):
            texts = pa.array([None if g is None else [x[2] for x in g] for g in got], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([ids, _lists(got), texts], names=["doc_id", "segmentations", "decodings"])

    return docs.select("doc_id", "text").mapInArrow(run, _DECODED)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded and compared: n_pieces and hash of the best ids, scores of the n best, hash of the
    decoded text; and of each of the n best its score, n_pieces, hash of ids and hash of its decoded text."""
    path = default_model_path()
    docs = pick(documents(spark, sf_dir), "doc_id", "text")
    out = round_trip(docs, path)
    each = F.transform(
        F.arrays_zip("segmentations", "decodings"),
        lambda x: F.struct(
            x["segmentations"]["score"].alias("score"),
            F.size(x["segmentations"]["ids"]).cast("bigint").alias("n_pieces"),
            F.xxhash64(x["segmentations"]["ids"]).alias("ids_xxhash64"),
            F.sha2(x["decodings"], 256).alias("decoded_sha256"),
        ),
    )
    return out.select("doc_id", each.alias("n_best")).select(
        "doc_id",
        F.get("n_best", F.lit(0))["n_pieces"].alias("n_pieces"),
        F.get("n_best", F.lit(0))["ids_xxhash64"].alias("ids_xxhash64"),
        F.col("n_best.score").alias("scores"),
        F.get("n_best", F.lit(0))["decoded_sha256"].alias("decoded_sha256"),
        "n_best",
    )

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from kinspark.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_chunk_encoder_equals_tokenizer(tokenizer, awkward, small_docs):
    encode = P.ChunkEncoder(P.default_tokenizer_path(), memo_entries=50)
    texts = [r.text or "" for d in (awkward, small_docs) for r in d.collect()]
    texts += ["a  b\n\n c \n", "  ", "a <|endoftext|>  b", "x  <|endoftext|>", "it's we'LL 'd '", "a\x1cb   c　d\x85", " ᠎z"]
    every, n = encode.encode_all(pa.array(texts), 7)
    for t, own in zip(texts, np.split(every, np.cumsum(n)[:-1])):
        assert own.tolist() == ids_of(tokenizer, t)[:-1] + [7], t[:50]
        assert np.frombuffer(encode(t), "<u4").tolist() == ids_of(tokenizer, t)[:-1], t[:50]


@pytest.mark.parametrize("seq_len", [1024, 7])
def test_pieces_and_sequences(tokenizer, awkward, seq_len):
    tokens = P.tokenised_documents(awkward)
    rows = P.pieces(tokens, seq_len).collect()
    want = sorted((str(r.doc_id), ids_of(tokenizer, r.text)) for r in awkward.collect())
    by_place = sorted(rows, key=lambda r: (r.sequence_id, r.offset))
    docs, at = [], 0
    for r in by_place:  # gapless, no piece over a cut
        assert (r.sequence_id, r.offset) == divmod(at, seq_len) and r.offset + r.length <= seq_len
        at += r.length
        if r.start == 0:
            docs.append((str(r.doc_id), r.doc_tokens, []))
        docs[-1][2].append(r)
    stream = {r.sequence_id: r for r in P.sequences(tokens, seq_len).collect()}
    assert sorted(stream) == list(range(-(-at // seq_len)))
    flat = [x for k in sorted(stream) for x in stream[k].tokens[: stream[k].n_tokens]]
    assert all(len(r.tokens) == seq_len for r in stream.values()) and len(flat) == at
    got, pos = [], 0
    for i, n, parts in docs:
        ids = flat[pos : pos + n]
        pos += n
        assert [p.start for p in parts] == np.cumsum([0] + [p.length for p in parts])[:-1].tolist()
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
        got.append((i, ids))
    assert sorted(got) == want
    places = defaultdict(list)
    for r in by_place:
        places[r.sequence_id].append(r.doc_id)
    assert {k: v.doc_ids for k, v in stream.items()} == dict(places)


def test_empty(no_rows):
    tokens = P.tokenised_documents(no_rows)
    assert P.pieces(tokens).collect() == [] and P.sequences(tokens).collect() == []


def test_engine_and_tokenizer_agree(tokenizer, small_docs):
    fast, slow = (P.ChunkEncoder(P.default_tokenizer_path()) for _ in range(2))
    assert fast.engine is not None
    slow.engine = None
    odd = ["".join(chr(i) for i in range(j, j + 40)) for j in range(1, 0x3000, 40)]
    texts = pa.array([r.text for r in small_docs.collect()] + odd + ["it's 'LL x'd 12½ ²", "漢 字😀 ab"])
    ids, n = fast.encode_all(texts, 5)
    same, m = slow.encode_all(texts, 5)
    assert n.tolist() == m.tolist() and ids.tolist() == same.tolist()
    assert ids.tolist() == [x for t in texts.to_pylist() for x in tokenizer.encode(t, add_special_tokens=False).ids + [5]]

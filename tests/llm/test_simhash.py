import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from kinspark.llm import simhash as S
from kinspark.llm.components import connected_components


def components(nodes, pairs):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def model_print(text, k=3):
    w = [x for x in "".join(" " if c in "\t\n\x0b\x0c\r" else c.lower() if c < "\x80" else c for c in text or "").split(" ") if x]
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def test_fingerprint(awkward, small_docs):
    for text in [r.text for r in awkward.collect()] + [r.text for r in small_docs.limit(20).collect()]:
        assert S.simhash(text) == model_print(text)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair(radius):
    masks = [m % 2**64 for m in S.covering_masks(radius)]
    rng = random.Random(radius)
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = x
        for i in rng.sample(range(64), radius):
            y ^= 1 << i
        assert any(x & m == y & m for m in masks)


def clusters(seed, n):
    """Signed fingerprints: chains and dense balls around few centres, and loners."""
    rng = random.Random(seed)
    out = set()
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 40)):
            out.add(x)
            for i in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << i
        c = rng.getrandbits(64)
        for _ in range(25):
            out.add(c ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    return [v - 2**64 if v >= 2**63 else v for v in out]


@pytest.mark.parametrize("hot", [512, 3])
@pytest.mark.parametrize("radius", [2, 3])
def test_components_equal_all_pairs(spark, hot, radius):
    values = clusters(hot + radius, 6)
    x = np.array(values).view(np.uint64)
    close = np.argwhere(np.bitwise_count(x[:, None] ^ x[None, :]) <= radius)
    want = components(values, [(values[i], values[j]) for i, j in close])
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.root for r in connected_components(S.links(fps, radius, hot)).collect()}
    sides = defaultdict(set)
    for v in values:
        sides[got.get(v, v)].add(v)
    other = defaultdict(set)
    for v in values:
        other[want[v]].add(v)
    assert sorted(map(sorted, sides.values())) == sorted(map(sorted, other.values()))


def test_operator_on_documents(awkward, small_docs):
    for docs in (awkward, small_docs):
        rows = [(r.doc_id, S.simhash(r.text)) for r in docs.collect()]
        fps = sorted({f for _, f in rows})
        pairs = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
        root = components(fps, pairs)
        least = {}
        for i, f in rows:
            if i is not None:
                least[root[f]] = min(i, least.get(root[f], i))
        got = Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in S.components(docs).collect())
        assert got == Counter((i, f, least.get(root[f])) for i, f in rows)


def test_one_stays(awkward, no_rows):
    out = S.one_per_component(awkward)
    assert out.schema == awkward.schema
    rows = S.components(awkward).collect()
    stays = {(r.doc_id, r.fp) for r in rows if r.doc_id == r.component_id}
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, _ in stays)
    assert S.one_per_component(no_rows).collect() == [] and S.components(no_rows).collect() == []


def test_component_shapes(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(100)] + [(5, 5)]
    ring = [(3000 + i, 3000 + (i * 37 + 1) % 101) for i in range(101)]
    edges = chain + star + ring
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    for x in got:
        assert got[x] == want[x]
    assert set(got) == {x for e in edges for x in e if e[0] != e[1]}

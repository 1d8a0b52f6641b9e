"""Random small inputs against brute force in plain Python (set and bag forms, forced tiling)."""

import math
import random
from collections import Counter, defaultdict

import pytest

from kinspark.operators.collab import collaborative_similarity
from kinspark.operators.rules import association_rules


def _random_rows(seed, n_groups=12, n_items=9, max_rows=14):
    rng = random.Random(seed)
    rows = []
    for g in range(n_groups):
        # one group much larger than the rest, so tiling kicks in
        k = max_rows * 3 if g == 0 else rng.randint(1, max_rows)
        rows += [(f"g{g}", f"i{rng.randrange(n_items)}") for _ in range(k)]
    return rows


def _brute_rules(rows, dedupe):
    groups = defaultdict(Counter)
    for g, i in rows:
        groups[g][i] += 1
    if dedupe:
        groups = {g: Counter(set(c)) for g, c in groups.items()}
    n = len(groups)
    freq, pairs = Counter(), Counter()
    for c in groups.values():
        for a, wa in c.items():
            freq[a] += wa
            for b, wb in c.items():
                if a != b:
                    pairs[(a, b)] += wa * wb
    out = {}
    for (a, b), k in pairs.items():
        sup, ant, cons = k / n, freq[a] / n, freq[b] / n
        out[(a, b)] = (ant, cons, sup, sup / ant, sup / (ant * cons))
    return out


def _brute_collab(rows, dedupe):
    users = defaultdict(Counter)
    for u, i in rows:
        users[u][i] += 1
    if dedupe:
        users = {u: Counter(set(c)) for u, c in users.items()}
    freq, m = Counter(), Counter()
    for c in users.values():
        for a, wa in c.items():
            freq[a] += wa
            for b, wb in c.items():
                m[(a, b)] += wa * wb
    out = {}
    for (a, b), k in m.items():
        fa, fb = freq[a], freq[b]
        d = (fa - k) + (fb - k)
        union = (fa - k) + k + (fb - k)  # can be 0 in bag form; the library gives 0.0 then
        out[(a, b)] = (
            k,
            k / union if union != 0 else 0.0,
            1.0 / (1.0 + math.sqrt(d)) if d >= 0 else float("nan"),
            k / (math.sqrt(fa) * math.sqrt(fb)),
        )
    return out


def _close(x, y):
    if isinstance(x, float) and math.isnan(x):
        return isinstance(y, float) and math.isnan(y)
    return x == pytest.approx(y, rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("seed,dedupe,tile_rows", [(1, True, 5), (2, False, 4), (3, True, None), (4, False, 3)])
def test_rules_brute_force(spark, seed, dedupe, tile_rows):
    rows = _random_rows(seed)
    df = spark.createDataFrame(rows, "trans_id string, item string")
    got = {
        (r.antecedent, r.consequent): (r.ant_support, r.cons_support, r.support, r.confidence, r.lift)
        for r in association_rules(df, dedupe=dedupe, tile_rows=tile_rows).collect()
    }
    exp = _brute_rules(rows, dedupe)
    assert set(got) == set(exp)
    for key, vals in exp.items():
        assert all(_close(x, y) for x, y in zip(got[key], vals)), key


@pytest.mark.parametrize("seed,dedupe,tile_rows", [(5, True, 4), (6, False, 5)])
def test_collab_brute_force(spark, seed, dedupe, tile_rows):
    rows = _random_rows(seed)
    df = spark.createDataFrame(rows, "user string, item string")
    got = {
        (r.item_a, r.item_b): (r.n, r.jaccard, r.euclid, r.cosine)
        for r in collaborative_similarity(df, dedupe=dedupe, tile_rows=tile_rows).collect()
    }
    exp = _brute_collab(rows, dedupe)
    assert set(got) == set(exp)
    for key, vals in exp.items():
        assert all(_close(x, y) for x, y in zip(got[key], vals)), key

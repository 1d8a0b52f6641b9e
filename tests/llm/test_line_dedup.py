import hashlib
from collections import Counter, defaultdict

import pytest

from kinspark.llm import line_dedup as L

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def model(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for i, text in rows:
        if i is not None:
            for x in (text or "").split("\n"):
                if len(key(x)) >= min_chars:
                    holders[key(x)].add(i)
    often = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if i is None or often.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return Counter(out)


@pytest.mark.parametrize("batches,fanout,min_docs", [(1, 2, 2), (4, 2, 3), (5, 3, 5)])
def test_equals_model(awkward, small_docs, batches, fanout, min_docs):
    for docs in (awkward, small_docs):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        got = L.dedup_lines(docs, batches=batches, fanout=fanout, min_docs=min_docs)
        assert Counter(map(tuple, got.collect())) == model(rows, L.MIN_CHARS, min_docs)


def test_carry_and_empty(awkward, no_rows):
    out = L.dedup_lines(awkward, carry=("h", "words", "lang"))
    assert out.select("source_row.*").columns == ["h", "words", "lang"] and out.count() == awkward.count()
    assert L.dedup_lines(no_rows).collect() == []


def test_runs_merge_by_level(spark):
    runs = L.LineRuns(fanout=2)
    seen = set()
    for b in range(5):
        rows = [(10 * b + j, bytes([j])) for j in range(b + 1)] * 2
        lines = spark.createDataFrame(rows, "doc_id long, h binary").select("h", "doc_id")
        new = {bytes(r.h) for r in runs.unseen(lines).collect()}
        assert new == {bytes([j]) for j in range(b + 1)} - seen
        seen |= new
        runs.add(lines)
    assert [len(x) for x in runs.levels] == [1, 0, 1] and len(runs.updates) == 1
    held = Counter(bytes(r.h) for run in runs.runs() for r in run.collect())
    assert held == {bytes([j]): 1 for j in range(5)}  # a line is in the run of the batch that had it first
    got = {bytes(r.h): (r.n_docs, r.max_doc) for r in runs.counts().collect()}
    assert got == {bytes([j]): (5 - j, 40 + j) for j in range(5)}


def test_hash_is_of_lowered_key():
    assert L.key_hash("ABC É") == L.key_hash("abc É") != L.key_hash("abc é")
    assert len(L.key_hash("")) == 16 and hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_batches_go_through_the_anti_join(small_docs, monkeypatch):
    plans = []
    unseen = L.LineRuns.unseen

    def watched(self, lines):
        out = unseen(self, lines)
        plans.append((len(self.runs()), out._jdf.queryExecution().executedPlan().toString()))
        return out

    monkeypatch.setattr(L.LineRuns, "unseen", watched)
    got = L.dedup_lines(small_docs, batches=4, fanout=2, min_docs=2)
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert Counter(map(tuple, got.collect())) == model(rows, L.MIN_CHARS, 2)
    assert [n for n, _ in plans] == [1, 1, 2] and all(p.count("SortMergeJoin") == n and "LeftAnti" in p for n, p in plans)


def test_compaction_merges_sorted_tables(spark):
    tables, want = [], {}
    for t in range(5):
        rows = [(bytes([j]), j + t + 1, 100 * t - j) for j in range(t, 9, t + 1)]
        tables.append(spark.createDataFrame(rows, "h binary, n_docs long, max_doc long"))
        for h, n, d in rows:
            old = want.get(h, (0, d))
            want[h] = (old[0] + n, max(old[1], d))
    merged = L.LineRuns._merged(tables)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == plan.count("FullOuter") == 4 and "Aggregate" not in plan
    assert {bytes(r.h): (r.n_docs, r.max_doc) for r in merged.collect()} == want

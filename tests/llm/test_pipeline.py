import re
from collections import Counter

import corpus_pipeline as C
import pytest
from test_line_dedup import model as lines_model
from test_packing import ids_of
from test_simhash import components, model_print
from tokenizers import Tokenizer

from kinspark.llm import line_dedup, packing, quality_rules, secret_scan


def redacted(text):
    find, keys = secret_scan.matcher(secret_scan.RULES), {r.key for r in secret_scan.RULES}
    hit = [False] * (len(text) + 1)
    for _, a, b in find(text, keys):
        hit[a:b] = [True] * (b - a)
    return re.sub("\0+", secret_scan.REDACTED, "".join("\0" if h else c for c, h in zip(text, hit)))


def plain_stages(rows):
    """The stages on (doc_id, text) rows in plain Python, the quality verdict excepted."""
    out = [("lines", Counter((i, t) for (i, _, _, t), n in lines_model(rows, line_dedup.MIN_CHARS, line_dedup.MIN_DOCS).items() for _ in range(n)))]
    left = sorted(out[-1][1].elements())
    prints = [(i, t, model_print(t)) for i, t in left]
    fps = sorted({f for *_, f in prints})
    root = components(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for i, _, f in prints:
        least[root[f]] = min(i, least.get(root[f], i))
    out.append(("near", Counter({(i, t): 1 for i, t, f in prints if least[root[f]] == i})))
    out.append(("secrets", Counter((i, redacted(t)) for i, t in out[-1][1].elements())))
    return out


@pytest.fixture(scope="module")
def stages(spark, small_docs, tmp_path_factory):
    """Every stage's output, written and read again."""
    docs, out, where = small_docs, [], tmp_path_factory.mktemp("stages")
    for name, function in C.STAGES:
        function(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{where}/{name}")
        docs = spark.read.parquet(f"{where}/{name}")
        out.append(docs)
    return out


def test_stages_equal_plain_versions(spark, small_docs, stages):
    quality, lines, near, secrets, packed = stages
    verdict = {r.doc_id for r in quality_rules.quality_rules(small_docs).where("kept").collect()}
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    assert {r.doc_id: r.text for r in quality.collect()} == {i: texts[i] for i in verdict}
    want = plain_stages([(i, texts[i]) for i in sorted(verdict)])
    for got, (name, rows) in zip((lines, near, secrets), want):
        assert Counter((r.doc_id, r.text) for r in got.collect()) == rows, name
        assert all(r.n_chars == len(r.text) for r in got.collect()) and got.columns == list(C.COLUMNS)
    tokenizer = Tokenizer.from_file(packing.default_tokenizer_path())
    stream = [x for r in packed.orderBy("sequence_id").collect() for x in r.tokens[: r.n_tokens]]
    docs = {r.doc_id: ids_of(tokenizer, r.text) for r in secrets.collect()}
    at = 0
    for i in dict.fromkeys(i for r in packed.orderBy("sequence_id").collect() for i in r.doc_ids):
        assert stream[at : at + len(docs[i])] == docs[i]
        at += len(docs.pop(i))
    assert not docs and at == len(stream)


def test_clean_documents_stay(small_docs, spark, stages):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1")
    clean = {r.doc_id for r in quality_rules.quality_rules(small_docs).where("NOT base_failed").join(labels, "doc_id").collect()}
    assert clean <= {r.doc_id for r in stages[0].collect()}


def test_awkward_and_empty(spark, awkward, no_rows):
    for docs in (awkward, no_rows):
        for _, function in C.STAGES[:-1]:
            assert function(spark, docs, "").columns == list(C.COLUMNS)
            function(spark, docs, "").count()
        assert (C.packing_stage(spark, docs, "").count() > 0) == (docs is awkward)


def test_awkward_rows_have_their_stated_results(spark, awkward):
    """Nulls, ties, repeated rows, long texts and clashing columns, stage by stage."""
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]

    def found(function):
        return Counter((r.doc_id, r.text) for r in function(spark, awkward, "").collect())

    judged = quality_rules.quality_rules(awkward).where("kept").collect()
    quality = found(C.quality_stage)
    assert quality and quality <= Counter(rows) and all(t for _, t in quality)
    assert Counter(r.doc_id for r in judged) == Counter(i for i, _ in quality.elements())

    lines = lines_model(rows, line_dedup.MIN_CHARS, line_dedup.MIN_DOCS)
    assert found(C.line_stage) == Counter((i, t) for i, _, _, t in lines.elements())

    prints = {(i, model_print(t)) for i, t in rows}
    fps = sorted({f for _, f in prints})
    root = components(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3])
    least = {r: min((i for i, f in prints if root[f] == r and i is not None), default=None) for r in set(root.values())}
    near = found(C.near_copy_stage)
    assert near <= Counter(rows)
    assert Counter((i, model_print(t)) for i, t in near.elements()) == Counter((i, f) for i, f in prints if least[root[f]] == i)

    assert found(C.secret_stage) == Counter((i, t and redacted(t)) for i, t in rows)

    tokenizer = Tokenizer.from_file(packing.default_tokenizer_path())
    packed = C.packing_stage(spark, awkward, "").collect()
    assert sum(r.n_tokens for r in packed) == sum(len(ids_of(tokenizer, t)) for _, t in rows)
    assert {i for r in packed for i in r.doc_ids} == {i for i, _ in rows}

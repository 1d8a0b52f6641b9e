import hashlib
import random
import time
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from kinspark.llm import chat_format as C

PIECES = [*C.CONTROL, "\\", "\\\\", "\n", "a", " ", "<|", "[/INST", "é😀", "\\n"]
texts = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=600, deadline=None)
@given(role=texts, text=texts)
def test_turn_round_trip(role, text):
    segment, a, b = C.render_turn(role, text)
    assert C.parse_turn(segment) == (role, text)
    assert C.unescape(segment[a:b]) == text
    assert C.unescape(C.escape(text)) == text


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(whole), len(loss), sha(loss), sum(len(C.render_turn(*t)[0]) for t in turns)


def collect(df):
    return {r.conv_id: tuple(r)[1:] for r in C.conversation_digests(df).collect()}


def test_query_equals_table(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    want = defaultdict(list)
    for r in spark.read.parquet(f"{d}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want[r.conv_id].append((r.role, r.text))
    want[-1] = [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]
    got = {r.conv_id: tuple(r)[1:] for r in C.op6_chat_format(spark, d).collect()}
    assert got == {k: digest(v) for k, v in want.items()}


def test_awkward_turns(spark, awkward):
    rows = [(1, 0, None, None), (1, 1, "user", ""), (None, 0, "assistant", "x" * 5000), (2, None, "user", "first"), (2, 0, "tool\nx", "b"),
            (2, 0, "assistant", "<s>\\"), (3, 5, "assistant", "é" * 1024), (3, 7, "assistant", "\\</s>\\")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, seq string")
    got = collect(C.format_log(C.turns_as_log(turns.repartition(3))))
    want = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    assert got == {k: digest(v) for k, v in want.items()}
    assert C.conversation_digests(C.format_log(C.turns_as_log(turns.limit(0)))).collect() == []


def fold(events):
    messages = {}
    for _, kind, m, role, text in sorted(events, key=lambda e: e[0]):
        if kind == "regenerate":
            messages = {k: v for k, v in messages.items() if k < m}
        if kind in ("start", "regenerate"):
            messages[m] = [role or "", text or ""]
        elif kind == "edit":
            old = messages.setdefault(m, ["", ""])
            messages[m] = [old[0] if role is None else role, text or ""]
        else:
            messages.setdefault(m, ["", ""])[1] += text or ""
    return [tuple(messages[k]) for k in sorted(messages)]


def test_random_logs_equal_fold(spark):
    rng, rows, want = random.Random(9), [], {}
    for conv in range(60):
        events = []
        for seq in range(rng.randint(1, 40)):
            kind = rng.choice(["start", "delta", "delta", "delta", "edit", "regenerate"])
            role = rng.choice(["user", "assistant", None]) if kind != "delta" else None
            events.append((seq, kind, rng.randint(0, 5), role, rng.choice(["a", "<s>", "\\", "", None, "bc "])))
        rows += [(conv, *e) for e in events]
        if final := fold(events):
            want[conv] = digest(final)
    rng.shuffle(rows)
    log = spark.createDataFrame(rows, "conv_id long, seq long, kind string, message long, role string, text string")
    assert collect(C.format_log(log.repartition(5))) == want


def test_escapes_are_linear():
    for run in ("\\" * 100_000, "\\" * 100_000 + "<s>", ("\\" * 50 + "<s>") * 4_000, "<s>" * 60_000):
        start = time.time()
        segment, a, b = C.render_turn("assistant", run)
        assert C.parse_turn(segment) == ("assistant", run) and C.unescape(segment[a:b]) == run
        assert time.time() - start < 3


def test_long_turn_is_cut_in_one_pass(spark):
    text = "漢é😀\n" * 1_250_000
    turns = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    start = time.time()
    got = collect(C.format_log(C.turns_as_log(turns), together=True))
    assert got == {1: digest([("assistant", text)])} and time.time() - start < 60


def test_hot_conversation_is_spread_and_unchanged(spark):
    """One conversation with most events, edits and regenerations included, over many tasks."""
    rng, events = random.Random(4), []
    for seq in range(3_000):
        kind = rng.choice(["start", "delta", "delta", "edit"]) if seq % 500 else "regenerate"
        events.append((seq, kind, rng.randint(0, 400) if kind != "regenerate" else 200 + seq // 50, rng.choice(["user", "assistant"]), f"t{seq} <s>"))
    rows = [(None if seq % 2 else 7, *e) for e in events for seq in (0, 1)]
    log = spark.createDataFrame(rows, "conv_id long, seq long, kind string, message long, role string, text string").repartition(6)
    want = digest(fold(events))
    turns = C.format_log(log)
    assert collect(turns) == {7: want, None: want}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # rows this few would be merged into one task
    try:
        per = C.format_log(log).groupBy("conv_id", F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([r for r in per if r.conv_id == 7]) > 4


def test_query_plan_has_no_join_and_two_exchanges(spark):
    plan = C.op6_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange ") == 2

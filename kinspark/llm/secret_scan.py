"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger in shared storage remembers which rule versions have seen which blob;
a scan runs only the missing (blob, rule version) pairs, each blob once however
many paths or versions hold it, and appends first the findings, then the ledger
rows.  A job that dies in between scans those blobs again, and repeated findings
fall together when they are read.  Findings are joined back to all paths by
blob.

Defined results: a null text counts as empty; equal texts are one blob; rows
that repeat a path are all reported; a null path is a path; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinspark.llm.common import documents, stage
from kinspark.session import shared_path


class Rule(NamedTuple):
    """``hints``: one of these lower-case ASCII strings is in every lower-cased text that matches (none: always tried)."""

    kind: str
    version: int
    pattern: str
    flags: int = re.ASCII
    group: int = 0  # the group whose length counts
    least: int = 0
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_KINDS = ("assign", "access", "hex")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# The base patterns, and common public token formats.
RULES = (
    Rule(
        "assign",
        1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
        group=2,
        least=12,
        hints=_KEYWORDS,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", least=18, hints=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{16,}"),  # runs are maximal, so shorter ones need no look
    # to the END over any text but another BEGIN; without an END, header lines and key lines with plain or escaped breaks
    Rule(
        "private_key",
        2,
        r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
        r"(?:(?:(?!-----BEGIN )[\s\S])*?-----END [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
        r"|(?:(?:\s|\\+[rnt])*+[A-Za-z-]++:[^\n\\]*+)*+(?:\\+(?:[rnt/]|u[0-9A-Fa-f]{4})|[A-Za-z0-9+/=\s])*+)",
        hints=("private key",),
    ),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("url_login", 2, r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]++:[^\s/@]{3,}+@", hints=("://",)),
)


def matcher(rules: tuple[Rule, ...]) -> Callable[[str, set[str]], list[tuple[int, int, int]]]:
    """A function (text, rule keys to run) -> [(rule index, start, end)] in code points."""
    compiled = [(i, r, re.compile(r.pattern, r.flags), [h.encode() for h in r.hints]) for i, r in enumerate(rules)]

    def find(text: str, keys: set[str]) -> list[tuple[int, int, int]]:
        low, out = text.encode().lower(), []
        for i, rule, pattern, hints in compiled:
            if rule.key in keys and (not hints or any(h in low for h in hints)):
                for m in pattern.finditer(text):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        out.append((i, m.start(), m.end()))
        return out

    return find


class BlobLedger:
    """Ledger and findings under one root in shared storage."""

    SEEN = "blob binary, rules array<string>"
    FINDINGS = "blob binary, rule string, start int, end int"

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or shared_path(spark, "blob-ledger")
        for name, schema in (("seen", self.SEEN), ("findings", self.FINDINGS)):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.root}/{name}")

    def _read(self, name: str) -> DataFrame:
        schema = self.SEEN if name == "seen" else self.FINDINGS
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def unseen(self, paths: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """(blob, path, todo): per blob of paths (path, blob) one path and the rule keys that have not seen it."""
        every = F.array(*[F.lit(r.key) for r in rules])
        blobs = paths.groupBy("blob").agg(F.min("path").alias("path"))
        seen = self._read("seen").groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))  # a few keys a blob
        todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        return blobs.join(seen, "blob", "left").select("blob", "path", todo.alias("todo")).where("size(todo) > 0")

    def scan(self, versions: DataFrame, paths: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scan what is unseen of versions (path, text); paths is their staged (path, blob)."""
        todo = stage(self.unseen(paths, rules), "unseen-blobs")
        todo_keys = todo.select(F.col("blob").alias("b"), F.col("path").alias("p"), "todo")
        texts = versions.select("path", "text", blob_of(F.col("text")).alias("blob"))
        texts = texts.join(todo_keys, (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("p")))
        found = texts.select("blob", "text", "todo").mapInArrow(_scan_texts(rules), self.FINDINGS)
        found.write.mode("append").parquet(f"{self.root}/findings")
        todo.select("blob", F.col("todo").alias("rules")).write.mode("append").parquet(f"{self.root}/seen")

    def spans(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """(blob, spans): per blob with findings its distinct spans (start, ord, kind, end), by start, then rule order.

        Staged, so that a join with a blob's many paths has plain sides and adaptive execution can split it.
        """
        table = [F.struct(F.lit(r.key).alias("rule"), F.lit(i).alias("ord"), F.lit(r.kind).alias("kind")) for i, r in enumerate(rules)]
        named = self._read("findings").select("*", F.inline(F.array(*table)).alias("r", "ord", "kind")).where("rule = r")
        span = F.struct("start", "ord", "kind", "end")
        return stage(named.groupBy("blob").agg(F.sort_array(F.collect_set(span)).alias("spans")), "spans")


def _scan_texts(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = matcher(rules)
        for batch in batches:
            rows = []
            for blob, text, todo in zip(*[batch.column(i) for i in range(3)], strict=True):
                spans = find(text.as_py(), set(todo.as_py()))
                rows += [(blob.as_py(), rules[i].key, start, end) for i, start, end in spans]
            kinds = (pa.binary(), pa.string(), pa.int32(), pa.int32())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["blob", "rule", "start", "end"])

    return run


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("path"), text.alias("text"))


def scan_documents(
    docs: DataFrame,
    ledger: BlobLedger | None = None,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(path, blob, spans) per row of docs; spans is null where nothing was found."""
    ledger = ledger or BlobLedger(docs.sparkSession)
    versions = _versions(docs, id_col, text_col)
    paths = stage(versions.select("path", blob_of(F.col("text")).alias("blob")), "paths")
    ledger.scan(versions, paths, rules)
    return paths.join(ledger.spans(rules), "blob", "left").select("path", "blob", "spans")


REDACTED = "[REDACTED]"


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            text, at, parts = text.as_py(), 0, []
            for s in spans.as_py() or ():
                if s["start"] >= at:
                    parts += [text[at : s["start"]], REDACTED]
                at = max(at, s["end"])
            out.append("".join([*parts, text[at:]]) if text is not None else None)
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "clean"])


def redact(docs: DataFrame, ledger: BlobLedger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs (doc_id, text, ...) with all columns; every span, joined with those it overlaps, becomes ``REDACTED``."""
    ledger = ledger or BlobLedger(docs.sparkSession)
    versions = _versions(docs, "doc_id", "text")
    ledger.scan(versions, stage(versions.select("path", blob_of(F.col("text")).alias("blob")), "paths"), rules)
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select("text", F.struct(*rest).alias("row"), blob_of(F.coalesce("text", F.lit(""))).alias("blob"))
    rows = rows.join(ledger.spans(rules), "blob", "left").select("row", "text", "spans")
    row_type = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(_redact, f"row {row_type}, clean string")
    return out.select(*[F.col("clean").alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_documents(documents(spark, sf_dir))
    spans = F.coalesce("spans", F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>"))
    listed = lambda s: F.array_join(
        F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("s", lambda x: x["kind"].isin(*BASE_KINDS))
    return out.select(F.col("path").alias("doc_id"), spans.alias("s")).select(
        "doc_id",
        *[count(k) for k in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("s")).alias("spans"),
    )

"""Secret scans with an incremental blob ledger.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger
holds the findings of each (blob, rule version) pair scanned so far. A run
scans only the pairs the ledger lacks, one copy of each blob, and joins the
ledger's findings back to every path. A ledger kept between runs is a Parquet
folder, named by ``ledger`` or, without it, by the session's setting
``spark.ledgerline.secretLedger``: it is made where it is missing, and each run
appends what it scanned. A run that fails before its append leaves the ledger
as it was; blobs that two runs appended at the same time count once.

Kinds ``assign``, ``access`` and ``hex`` are the base rules; ``pem``,
``jwt``, ``github`` and ``slack`` are further formats. Matches are leftmost
and non-overlapping for each kind, and may overlap between kinds. ``pem``
spans the whole private key: from its BEGIN line through the first END line
of a private key, or, where the text or another BEGIN line comes first, over
what follows and can be of the key (its fields, lines of a single base64
piece, pieces of 16 or more on a line and a shorter one after them).

Defined results: null text is the empty blob, without findings; repeated
rows and copies each get the blob's findings; other columns pass through
``redacted`` unchanged and are ignored elsewhere.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

LEDGER = "blob string, rule_version string, findings array<struct<kind: string, start: bigint, end: bigint>>"
FINDINGS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

# The patterns to find; at equal starts, kinds rank in this order.
ASSIGN = (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
          re.ASCII | re.IGNORECASE)
PEM_BEGIN, PEM_END = r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----END [A-Z ]*PRIVATE KEY-----"
# Without an END line. Line breaks may be written as \\n, lines quoted or indented; possessive, so that time is linear.
_BREAK, _BETWEEN, _BASE64 = r"(?:[\r\n]|\\+[rn])", r"[\x20\t>#|*\"'`,]", r"(?:[A-Za-z0-9+/=]|\\/)"
_SPACE = rf"(?:{_BETWEEN}|{_BREAK})*+"
_FIELD = r"(?:(?:Proc-Type|DEK-Info|Key-Info):\x20*+[^\s\\]++|(?:Comment|Version):(?:(?!\\+[rn])[^\r\n])*+)"
_LONG = rf"{_SPACE}{_BASE64}{{16,}}+"
_LINE = rf"{_BETWEEN}*+{_BREAK}{_SPACE}{_BASE64}{{1,15}}+(?={_BETWEEN}*+(?:{_BREAK}|\Z))"
_LAST = rf"(?:{_BETWEEN}++{_BASE64}{{1,15}}+(?=[\s\\\"'`,-]|\Z))?+"
# Three runs with dots between, the first two from "eyJ" on; only the start of a run is tried, so that time is linear.
_RUN = r"[A-Za-z0-9_-]"
JWT = rf"(?<!{_RUN})(?:(?!eyJ{_RUN}){_RUN})*+(?P<span>eyJ{_RUN}++\.eyJ{_RUN}++\.{_RUN}++)"
PEM = rf"{PEM_BEGIN}(?:(?:(?!{PEM_BEGIN})[\s\S])*?{PEM_END}|(?:{_SPACE}{_FIELD})*+(?:(?:{_LINE})*+{_LONG}(?:{_LINE}|{_LONG})*+{_LAST}|(?:{_LINE})*+))"
RULES: dict[str, tuple[re.Pattern, object]] = {
    "assign": (re.compile(*ASSIGN), lambda m: len(m[2]) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    "pem": (re.compile(PEM), lambda m: True),
    "jwt": (re.compile(JWT), lambda m: True),
    "github": (re.compile(r"gh[pousr]_[A-Za-z0-9]+"), lambda m: len(m[0]) >= 40),
    "slack": (re.compile(r"xox[abprs]-[A-Za-z0-9-]+"), lambda m: len(m[0]) >= 20),
}
BASE = ("assign", "access", "hex")
LEDGER_SETTING = "spark.ledgerline.secretLedger"
RULE_VERSION = "1:" + hashlib.sha256(repr([(k, r.pattern, r.flags) for k, (r, _) in RULES.items()]).encode()).hexdigest()[:12]


def find(text: str) -> list[dict]:
    """All findings by start, then in the order of RULES; code points, end exclusive."""
    found = []
    for rank, (kind, (rx, ok)) in enumerate(RULES.items()):
        group = "span" if "span" in rx.groupindex else 0
        found += [(m.start(group), rank, kind, m.end(group)) for m in rx.finditer(text) if ok(m)]
    return [{"kind": kind, "start": start, "end": end} for start, _, kind, end in sorted(found)]


def blob_id(text="text"):
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)


def scan_blobs(blobs: DataFrame) -> DataFrame:
    """(blob, text) -> ledger rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [find(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([RULE_VERSION] * b.num_rows, pa.string()),
                                              pa.array(found, FINDINGS)], names=["blob", "rule_version", "findings"])

    return blobs.select("blob", "text").mapInArrow(run, LEDGER)


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger rows of the blobs in ``versions`` (doc_id, text) that ``ledger``
    lacks under the present rules, stored. Of the copies of a blob only the
    one with the smallest doc_id has its text moved and scanned."""
    keyed = versions.select(F.col("doc_id").cast("bigint").alias("path"), blob_id().alias("blob"))
    wanted = keyed.groupBy("blob").agg(F.min("path").alias("path"))
    if ledger is not None:
        seen = ledger.filter(F.col("rule_version") == RULE_VERSION).select("blob").distinct()
        wanted = wanted.join(seen, "blob", "left_anti")
    texts = versions.select(F.col("doc_id").cast("bigint").alias("path"), blob_id().alias("blob"),
                            F.col("text").cast("string").alias("text"))
    one = texts.alias("t").join(wanted.alias("w").hint("shuffle_hash"), (F.col("t.blob") == F.col("w.blob"))
                                & F.col("t.path").eqNullSafe(F.col("w.path"))).select("t.blob", "t.text")
    # A row repeated with the same doc_id is scanned again; the ledger keeps one.
    return stored(scan_blobs(one).groupBy("blob", "rule_version").agg(F.first("findings").alias("findings")), "ledger")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger kept at ``path`` as it is now, empty at first."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def hits_of(docs: DataFrame, ledger: DataFrame | str | None = None) -> DataFrame:
    """(blob, findings) of the blobs with findings, one row each, after the
    unseen blobs of ``docs`` were scanned. ``ledger``: its rows, which are only
    read, or its path, where the scanned blobs are appended."""
    spark = docs.sparkSession
    path = ledger if isinstance(ledger, str) else spark.conf.get(LEDGER_SETTING, None) if ledger is None else None
    if path:
        ledger = read_ledger(spark, path)
    new = update_ledger(docs, ledger)
    if path:
        new.write.mode("append").parquet(path)
    some = F.size("findings") > 0
    hits = new.filter(some).select("blob", "findings")
    if ledger is None:
        return hits
    old = ledger.filter((F.col("rule_version") == RULE_VERSION) & some)
    return hits.unionByName(old.select("blob", "findings").dropDuplicates(["blob"]))


def scan(docs: DataFrame, ledger: DataFrame | str | None = None) -> DataFrame:
    """(doc_id, blob, findings) of every row, through the ledger."""
    hits = hits_of(docs, ledger)
    paths = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), blob_id().alias("blob"))
    none = F.from_json(F.lit("[]"), "array<struct<kind: string, start: bigint, end: bigint>>")
    return paths.join(hits, "blob", "left").select("doc_id", "blob", F.coalesce("findings", none).alias("findings"))


MASK = "[SECRET]"


def masked(text: str, findings: list[dict]) -> str:
    """``text`` with every stretch that findings cover replaced by MASK."""
    out, at = [], 0
    for f in sorted(findings, key=lambda f: f["start"]):
        if f["start"] >= at:
            out += [text[at:f["start"]], MASK]
        at = max(at, f["end"])
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, ledger: DataFrame | str | None = None) -> DataFrame:
    """``docs`` with secrets masked in ``text`` and ``n_chars`` counted anew
    where a text changed; every row stays, all other columns unchanged."""
    hits = hits_of(docs, ledger)
    # The row travels as one struct, so no column of docs can clash.
    marked = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), blob_id().alias("key")).join(
        hits, F.col("key") == F.col("blob"), "left")

    @F.pandas_udf("string")
    def clean(text, findings):
        import pandas as pd

        return pd.Series([None if t is None else masked(t, list(f)) for t, f in zip(text, findings, strict=True)])

    hit = F.col("findings").isNotNull()
    row = F.col("row")
    # Only texts with findings travel to Python.
    out = marked.withColumn("clean", clean(F.when(hit, row["text"]), F.col("findings")))
    out = out.withColumn("clean", F.when(hit, F.col("clean")).otherwise(row["text"]))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(hit, F.char_length("clean").cast(kind)).otherwise(row["n_chars"])
    return out.select(*[changed.get(c, row[c]).alias(c) for c in docs.columns])

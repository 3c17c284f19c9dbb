"""Secret scans: spans of credentials, told apart by who owns them.

Rules find candidate credentials in every text. Their hashes are aggregated over
the corpus: a value that many owners or repositories share is an example that
people copy, one that stays with few is likely live. Spans of the base rules
always count; those of further kinds count unless they are copied examples.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from veinworks.llm.base import map_arrow, query, table, texts, written

# The base rules. Group 2 of an assignment is its value.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal: a match starts where its run starts
# Published shapes of further credentials.
FURTHER = {
    "github": re.compile(r"\bgh[pousr]_[A-Za-z0-9]{36,}|\bgithub_pat_[A-Za-z0-9_]{40,}"),
    "slack": re.compile(r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    "google": re.compile(r"\bAIza[A-Za-z0-9_-]{35}"),
    "stripe": re.compile(r"\b[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    "jwt": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    "key": re.compile(r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]{0,20}PRIVATE KEY-----"),
    "url": re.compile(r"\b[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/@]{6,128})@"),
    "bearer": re.compile(r"\b[Bb]earer\x20+([A-Za-z0-9+/_.~=-]{20,})"),
}
# What a text must hold for a pattern of the same kind to match.
HINTS = {
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_"), "slack": ("xox",), "google": ("AIza",),
    "stripe": ("k_live_", "k_test_"), "jwt": (".eyJ",), "key": ("PRIVATE KEY",), "url": ("://",), "bearer": ("earer ",),
}
KINDS = ("assign", "access", "hex", *FURTHER)
BASE = KINDS[:3]
FOUND = "array<struct<kind:int,start:long,end:long,hash:long>>"


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the base rules, leftmost and not overlapping within a kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    return out


def further_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of the further kinds."""
    return [
        (k, m.start(), m.end(), m[m.lastindex or 0])
        for k, kind in enumerate(FURTHER, len(BASE)) if any(h in text for h in HINTS[kind])
        for m in FURTHER[kind].finditer(text)
    ]


def value_hash(value: str) -> int:
    """Signed 64-bit hash of a candidate; the values themselves never leave the scan."""
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass"), 42) - (1 << 63)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, with ``found``: every candidate span of the whole text.

    Positions are code points, ends exclusive. A null text has no spans. A
    column named ``found`` is replaced.
    """
    kept = [c for c in docs.columns if c not in ("found", text_col)]
    rows = docs.select(*kept, F.col(text_col).alias("_whole_text"))
    schema = StructType([*rows.schema.fields[:-1], *StructType.fromDDL(f"found {FOUND}").fields])
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.int64())]))

    def run(batches):
        for batch in batches:
            found = [
                [{"kind": k, "start": a, "end": b, "hash": value_hash(v)} for k, a, b, v in sorted(base_spans(t) + further_spans(t), key=lambda s: (s[1], s[0]))]
                for t in texts(batch.column(len(kept)))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(found, kind)], schema.fieldNames())

    return map_arrow(rows, run, schema)


def ownership(rows: DataFrame, owner: Column, repository: Column, hashes: Column) -> DataFrame:
    """(hash, owners, repositories, uses) of every candidate in the array column ``hashes``.

    Rows are combined before each shuffle, so a value that half the corpus
    holds sends one row per task and repository. A null owner or repository is
    one of its own.
    """
    each = rows.select(
        F.coalesce(owner.cast("string"), F.lit("")).alias("owner"),
        F.coalesce(repository.cast("string"), F.lit("")).alias("repository"), F.explode(hashes).alias("hash"),
    )
    by_repository = each.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("k").alias("repositories"), F.sum("n").alias("uses")
    )


def copied_values(owned: DataFrame, owners: int, repositories: int) -> DataFrame:
    """(hash) of values that at least so many owners or repositories hold."""
    return owned.where((F.col("owners") >= owners) | (F.col("repositories") >= repositories)).select("hash")


def find_secrets(
    docs: DataFrame, owner: Column, repository: Column, example_owners: int = 3, example_repositories: int = 5,
    text_col: str = "text",
) -> DataFrame:
    """All columns of ``docs`` but the text, with ``spans``: kind, start, end and copied of each candidate.

    ``copied`` marks values that at least ``example_owners`` owners or
    ``example_repositories`` repositories hold (a repository belongs to one
    owner: the same name under two owners is two). Rows are matched to the
    verdicts by a row number, so ids may be null or repeated.
    """
    kept = [c for c in docs.columns if c not in ("found", "spans", text_col)]
    marked = docs.select(*kept, owner.alias("_owner"), repository.alias("_repository"), F.col(text_col).alias("_text"))
    scanned = scan(marked, "_text").withColumn("_row", F.monotonically_increasing_id())
    scanned = written(scanned, "secret-scan")
    owned = ownership(scanned, F.col("_owner"), F.col("_repository"), F.col("found.hash"))
    copied = copied_values(owned, example_owners, example_repositories)
    each = scanned.select("_row", F.explode("found").alias("s")).select("_row", "s.*")
    judged = each.join(copied.withColumn("copied", F.lit(True)), "hash", "left")
    span = F.struct("start", "kind", "end", F.coalesce("copied", F.lit(False)).alias("copied"))
    by_row = judged.groupBy("_row").agg(F.sort_array(F.collect_list(span)).alias("spans"))  # spans of one text
    empty = F.expr("cast(array() as array<struct<start:long,kind:int,end:long,copied:boolean>>)")
    return scanned.join(by_row, "_row", "left").select(*kept, F.coalesce("spans", empty).alias("spans"))


def counted(spans: Column) -> Column:
    """Spans that count: base rules, and further kinds unless copied."""
    return F.filter(spans, lambda s: (s["kind"] < len(BASE)) | ~s["copied"])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order of the array."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def hide(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with the spans replaced; overlapping spans become one mark."""
    out, end = [], 0
    for a, b in sorted(spans):
        if a >= end:
            out += [text[end:a], mark]
        end = max(end, b)
    return "".join([*out, text[end:]])


def mask(
    docs: DataFrame, owner: Column, repository: Column, text_col: str = "text", mark: str = "[secret]",
    example_owners: int = 3, example_repositories: int = 5,
) -> DataFrame:
    """The columns of ``docs`` with every counted span of the text replaced by ``mark``.

    Rows with base spans only are masked where they lie. The few with further
    candidates are written with a row number, matched to the verdicts of their
    values, and masked then. Texts without a span, null ones included, stay.
    """
    at, fields = docs.columns.index(text_col), docs.schema.fields
    longs = StructType.fromDDL("a array<long>")[0].dataType
    temporary = ("_further", "_copied", "_row", "_owner", "_repository")
    if set(temporary) & set(docs.columns):
        raise ValueError(f"columns may not be named {temporary}")

    def first(batches):
        for batch in batches:
            found, values = [], []
            for value in batch.column(at):
                text = value.as_py()
                further = [value_hash(v) for *_, v in further_spans(text)] if text else []
                spans = [(a, b) for _, a, b, _ in base_spans(text)] if text and not further else []
                found.append(hide(text, spans, mark) if spans else text)
                values.append(further)
            columns = [*batch.columns[:at], pa.array(found, pa.string()), *batch.columns[at + 1 :], pa.array(values, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "_further"])

    def second(batches):
        for batch in batches:
            found = []
            for text, copied in zip(batch.column(at).to_pylist(), batch.column(len(fields)).to_pylist(), strict=True):
                copied = set(copied or ())
                spans = [(a, b) for _, a, b, _ in base_spans(text)]
                spans += [(a, b) for _, a, b, v in further_spans(text) if value_hash(v) not in copied]
                found.append(hide(text, spans, mark))
            columns = [*batch.columns[:at], pa.array(found, pa.string()), *batch.columns[at + 1 : len(fields)]]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[: len(fields)])

    marked = map_arrow(docs, first, StructType(fields[:]).add("_further", longs))
    easy = marked.where(F.size("_further") == 0).drop("_further")
    hard = marked.where(F.size("_further") > 0).withColumn("_row", F.monotonically_increasing_id())
    hard = written(hard, "secret-rows")
    copied = copied_values(ownership(hard, owner, repository, F.col("_further")), example_owners, example_repositories)
    each = hard.select("_row", F.explode(F.array_distinct("_further")).alias("hash"))
    by_row = each.join(copied, "hash").groupBy("_row").agg(F.collect_list("hash").alias("_copied"))  # values of one text
    known = hard.join(by_row, "_row", "left").select(*docs.columns, "_copied")
    return easy.unionByName(map_arrow(known, second, docs.schema))


@query("op9_secret_scan")
def op9(spark, sf_dir):
    """Spans of secrets in every document; the source owns, source and language are the repository."""
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs.select("doc_id", "source", "lang", "text"), F.col("source"), F.concat_ws("/", "source", "lang"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(counted(F.col("spans"))).alias("spans"),
        F.size(F.filter("spans", lambda s: s["copied"])).cast("long").alias("n_copied"),
    )

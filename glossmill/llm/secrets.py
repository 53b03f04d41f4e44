"""Secret scans with corpus-wide ownership frequency (operator 5).

Candidates are found in whole texts by kinds of patterns, all linear in the text. The hash of a candidate's value is then
counted over the corpus by distinct repositories and distinct owners: a value that several owners have, or that is in very
many repositories, is a widely copied example; one that only an owner or two have, in a few repositories, looks like a live
credential of theirs.

Counting is two-phased and combines on the map side. The counts come back to the candidates by a join; values that make
up more than one in ``HOT_SHARE`` of all candidates, of which there can be HOT_SHARE at most, are joined by broadcast, so
that no hot value is one task.

Defined cases: a null text is empty and has no span; a null repository or owner counts as a repository or owner of its
own; repeated rows are rows of their own; texts are read whole; an empty table gives an empty table; extra columns are
kept, in ``judge`` but for those called like a result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrowtext, scratch

# Fixed patterns. Order is the order of kinds at one start; base kinds first. group: the secret's own part.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM_MARK = re.compile(r"-----(BEGIN|END) (?:[A-Z0-9]+ )*PRIVATE KEY-----")
_PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s:,\\-]*")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")
_PREFIXED = re.compile(r"(?<![A-Za-z0-9_])(?:gh[opsur]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{50,}|glpat-[A-Za-z0-9_-]{20,}|xox[abeoprs]-[A-Za-z0-9-]{20,}|sk_live_[A-Za-z0-9]{20,})")
_URL = re.compile(r"(?<=://)[A-Za-z0-9._~-]+:[^\s:@/'\"]{6,}(?=@[A-Za-z0-9])")
KINDS = ("assign", "access", "hex", "pem", "jwt", "prefixed", "url")
BASE = 3
#: Owners, and repositories of these, up to which a value counts as owner-specific.
OWNERS, REPOSITORIES = 2, 8
HOT_SHARE = 1000


def _pem(text: str) -> Iterator[tuple[int, int]]:
    """Spans from a BEGIN to the first END that only a key's characters part from it. Every character is looked at once."""
    begin, at = None, 0
    for m in _PEM_MARK.finditer(text):
        if begin is not None and not _PEM_BODY.fullmatch(text, at, m.start()):
            begin = None
        at = m.end()
        if m[1] == "BEGIN":
            begin = m.start() if begin is None else begin
        elif begin is not None:
            yield begin, at
            begin = None


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value) of all spans, by start and kind; code points, end exclusive."""
    spans = [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        spans += [(a, 3, b, text[a:b]) for a, b in _pem(text)]
    if "eyJ" in text:
        spans += [(m.start(), 4, m.end(), m[0]) for m in _JWT.finditer(text)]
    if "_" in text or "-" in text:
        spans += [(m.start(), 5, m.end(), m[0]) for m in _PREFIXED.finditer(text)]
    if "://" in text:
        spans += [(m.start(), 6, m.end(), m[0]) for m in _URL.finditer(text)]
    return sorted(spans)


def written(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans])


_SPAN = "array<struct<kind int, start int, end int, value string>>"


def scan(df: DataFrame, text: str = "text", result: str = "found") -> DataFrame:
    """df without its text, with the spans of each row; value is the SHA-256 of the candidate."""
    keep = [c for c in df.columns if c != text]
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, text):
            spans = [[{"kind": k, "start": a, "end": b, "value": hashlib.sha256(v.encode()).hexdigest()} for a, k, b, v in find(t)] for t in arrowtext.texts(batch, text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(spans, kind)], [*keep, result])

    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), f"`{result}` {_SPAN}"])
    return df.select(*keep, text).mapInArrow(run, schema)


def ownership(found: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """(value, seen, repositories, owners) of every candidate value of the corpus."""
    tell = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    each = found.select(tell(repository).alias("repository"), tell(owner).alias("owner"), F.explode("found.value").alias("value"))
    each = each.groupBy("value", "repository", "owner").agg(F.count(F.lit(1)).alias("seen"))  # a value's hot copies shrink here
    by_owner = each.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("r"), F.sum("seen").alias("seen"))
    counted = by_owner.groupBy("value").agg(F.sum("seen").alias("seen"), F.count(F.lit(1)).alias("owners"))
    repositories = each.groupBy("value", "repository").agg(F.count(F.lit(1)).alias("o")).groupBy("value").agg(F.count(F.lit(1)).alias("repositories"))
    return counted.join(repositories, "value")


def _with_counts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    total = counts.agg(F.coalesce(F.sum("seen"), F.lit(0)).alias("n")).first()["n"]
    hot = counts.where(F.col("seen") * HOT_SHARE > total)
    on_hot = candidates.join(F.broadcast(hot), "value", "left")
    cold = on_hot.where("seen is null").drop(*(c for c in counts.columns if c != "value"))
    return on_hot.where("seen is not null").unionByName(cold.join(counts, "value", "left"))


RESULTS = ("found", "live", "most_owners", "most_repositories")


def judge(df: DataFrame, repository: Column, owner: Column, text: str = "text", owners: int = OWNERS, repositories: int = REPOSITORIES, run: scratch.Run | None = None) -> DataFrame:
    """df's rows without text, with found (all spans) and live (their numbers in found that look owner-specific).

    Rows get a number of their own before the corpus is counted, so that no column needs to be unique.
    """
    run = run or scratch.Run(df.sparkSession)
    plain, names = scratch.shielded(df.select("*", repository.cast("string").alias("repository"), owner.cast("string").alias("owner")))
    names, repository, owner = names[:-2], F.col(f"c{len(names) - 2}"), F.col(f"c{len(names) - 1}")
    rows = run.keep(scan(plain, f"c{names.index(text)}").withColumn("_row", F.monotonically_increasing_id()), "secrets")
    counts = run.keep(ownership(rows, repository, owner), "owners")
    candidates = rows.select("_row", F.posexplode("found").alias("at", "span")).select("_row", "at", F.col("span.value").alias("value"))
    known = _with_counts(candidates, counts)
    specific = (F.col("owners") <= owners) & (F.col("repositories") <= repositories)
    of_row = known.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.when(specific, F.col("at")))).alias("live"),
        F.max("owners").cast("long").alias("most_owners"),
        F.max("repositories").cast("long").alias("most_repositories"),
    )
    out = rows.join(of_row, "_row", "left").withColumn("live", F.coalesce("live", F.array().cast("array<int>")))
    return out.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n != text and n not in RESULTS), *RESULTS)


def digests(judged: DataFrame, key: str) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, and what ownership says)."""
    names = F.array(*(F.lit(k) for k in KINDS))
    said = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = F.array_join(F.transform(F.filter("found", lambda s: s["kind"] < BASE), said), ",")
    return judged.select(
        key,
        *(count(k) for k in range(BASE)),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("found", said), ",").alias("spans"),
        F.size("live").cast("long").alias("n_owner_specific"),
        (F.size("found") - F.size("live")).cast("long").alias("n_widely_copied"),
        F.coalesce("most_owners", F.lit(0)).cast("long").alias("most_owners"),
        F.coalesce("most_repositories", F.lit(0)).cast("long").alias("most_repositories"),
    )


def masked(text: str, spans: list[tuple[int, int]], mask: str) -> str:
    """The text with each of the spans, overlapping ones together, replaced by the mask."""
    out, at, end = [], 0, -1
    for a, b in sorted(spans):
        if a >= end:
            out += [text[max(at, 0) : a], mask]
            at = end = b
        elif b > end:
            at = end = b
    return "".join([*out, text[at:]])


def mask_live(df: DataFrame, repository: Column, owner: Column, text: str = "text", owners: int = OWNERS, mask: str = "[secret]", run: scratch.Run | None = None) -> DataFrame:
    """df with every owner-specific candidate replaced by the mask; all rows stay, with all their columns.

    The set of owner-specific values is joined to the texts' spans, not to the texts: the rows are written once with
    their spans and read back for masking.
    """
    run = run or scratch.Run(df.sparkSession)
    plain, names = scratch.shielded(df.select("*", repository.alias("repository"), owner.alias("owner")))
    names, text = names[:-2], f"c{names.index(text)}"
    numbered = run.keep(plain.withColumn("_key", F.monotonically_increasing_id()), "masking")
    own = [F.col(f"c{len(names) + i}") for i in (0, 1)]
    judged = judge(numbered.select("_key", text, *own), *own, text, owners, run=run)
    live = judged.where(F.size("live") > 0).select(F.col("_key").alias("_r"), F.transform("live", lambda i: F.get("found", i)).alias("_spans"))
    joined = numbered.join(live, numbered["_key"] == live["_r"], "left")
    columns = [f"c{n}" for n in range(len(names))]
    i = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, text):
            spans = batch.column("_spans").to_pylist()
            texts = batch.column(text)
            if any(spans):
                fixed = [t if not s or t is None else masked(t, [(x["start"], x["end"]) for x in s], mask) for t, s in zip(texts.to_pylist(), spans)]
                texts = pa.array(fixed, texts.type)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns[:i]), texts, *(batch.column(c) for c in columns[i + 1 :])], columns)

    schema = numbered.select(*columns).schema
    return joined.select(*columns, "_spans").mapInArrow(run, schema).toDF(*names)

"""Operators on manifests: names, order, paths, validation, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schema import ALIASES, ORDER, REQUIRED

#: Suffixes of videos, in the order in which they are looked for.
SUFFIXES = (".mp4", ".webm", ".mkv", ".avi", ".mov")


def rename_aliases(df: DataFrame) -> DataFrame:
    """Older names become canonical ones where these are absent; of two older names of one column the first wins."""
    names, taken = {}, set(df.columns)
    for old, new in ALIASES.items():
        if old in taken and new not in taken:
            names[old] = new
            taken.add(new)
    return df.withColumnsRenamed(names) if names else df


def timing_columns(df: DataFrame) -> tuple[str, str]:
    for pair in (("START", "END"), ("START_REALIGNED", "END_REALIGNED")):
        if set(pair) <= set(df.columns):
            return pair
    raise ValueError(f"no timing columns among {df.columns}")


def in_order(df: DataFrame) -> DataFrame:
    """Known columns first, in the manifest's order, then all others as they are."""
    known = [c for c in ORDER if c in df.columns]
    return df.select(*known, *(c for c in df.columns if c not in known))


def passthrough(df: DataFrame, names: dict[str, str]) -> list[Column]:
    """Columns that are there, under new names."""
    return [F.col(old).alias(new) for old, new in names.items() if old in df.columns]


def keep_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*(c for c in names if c in df.columns))


def has_timing(df: DataFrame) -> DataFrame:
    """One row, has_timing: whether any row has both a start and an end."""
    if not {"START", "END"} <= set(df.columns):
        return df.sparkSession.createDataFrame([(False,)], "has_timing boolean")
    return df.agg(F.coalesce(F.bool_or(F.col("START").isNotNull() & F.col("END").isNotNull()), F.lit(False)).alias("has_timing"))


def relative_path(df: DataFrame) -> Column:
    """REL_PATH where present, else the name or id of the video with its usual suffix."""
    options = [tx.present(F.col("REL_PATH"))] if "REL_PATH" in df.columns else []
    options += [F.concat(tx.present(F.col(c)), F.lit(".mp4")) for c in ("VIDEO_NAME", "VIDEO_ID") if c in df.columns]
    return F.coalesce(*options)


def resolve_paths(df: DataFrame, listing: DataFrame, base: str) -> DataFrame:
    """df with VIDEO_PATH. listing has rel_path of the files under base; of a name's suffixes the first in order that is there wins."""
    name = F.coalesce(*(tx.present(F.col(c)) for c in ("VIDEO_NAME", "VIDEO_ID") if c in df.columns))
    rank = F.array_position(F.array(*(F.lit(s) for s in SUFFIXES)), F.lower(F.regexp_extract("rel_path", r"(\.[^./]*)$", 1)))
    best = listing.withColumn("_rank", rank).where("_rank > 0").groupBy(F.regexp_replace("rel_path", r"\.[^./]*$", "").alias("_stem")).agg(F.min_by("rel_path", "_rank").alias("_found"))
    given = tx.present(F.col("REL_PATH")) if "REL_PATH" in df.columns else F.lit(None).cast("string")
    named = df.withColumn("_name", name)
    out = named.join(best, named["_name"] == best["_stem"], "left")
    path = F.coalesce(given, F.col("_found"), F.concat("_name", F.lit(".mp4")))
    return out.withColumn("VIDEO_PATH", F.concat(F.lit(base.rstrip("/") + "/"), path)).drop("_name", "_stem", "_found")


def output_path(df: DataFrame) -> Column:
    """Where the result for a whole video goes: its relative path as .mp4, else its name, else its id."""
    cell = lambda c: F.when(~F.lower(F.trim(F.col(c))).isin("", "nan"), F.trim(F.col(c)))
    options = [F.concat(F.regexp_replace(cell("REL_PATH"), r"\.[^./]*$", ""), F.lit(".mp4"))] if "REL_PATH" in df.columns else []
    options += [F.concat(cell(c), F.lit(".mp4")) for c in ("VIDEO_NAME", "VIDEO_ID") if c in df.columns]
    if not options:
        raise ValueError("the manifest has no column that names a video")
    return F.coalesce(*options)


def first_of(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each group, all columns. Combines on the map side; no group is sorted in one task."""
    rest = [c for c in df.columns if c not in by]
    rows = df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return rows.select(*by, "_row.*").select(*df.columns)


def video_spans(df: DataFrame, order: list[str], drop: tuple[str, ...] = ("SAMPLE_ID", "START", "END", "TEXT", "GLOSS", "CLASS_ID")) -> DataFrame:
    """One row for each video: the first row's shared columns and the latest END as SPAN. Rows without a video go."""
    shared = [c for c in df.columns if c not in (*drop, "VIDEO_ID")]
    found = df.where("VIDEO_ID is not null").groupBy("VIDEO_ID").agg(F.max("END").alias("SPAN"), *([F.min_by(F.struct(*shared), F.struct(*order)).alias("_row")] if shared else []))
    return found.select("VIDEO_ID", "SPAN", *(["_row.*"] if shared else []))


def windowed(spans: DataFrame, size: float, stride: float, least: float, even: bool = False) -> DataFrame:
    """Windows of each video's span 0 .. SPAN as segments ``<video>_w000``. Videos without a span have none."""
    from ..functions import intervals

    make = intervals.even_windows if even else intervals.windows
    rows = spans.where("SPAN is not null").select("*", F.explode(make(F.lit(0.0), F.col("SPAN"), size, stride, least)).alias("_w"))
    sample = F.concat("VIDEO_ID", F.lit("_w"), tx.padded(F.col("_w.idx"), 3))
    return rows.select(sample.alias("SAMPLE_ID"), *(c for c in spans.columns if c != "SPAN"), F.round("_w.start", 6).alias("START"), F.round("_w.end", 6).alias("END"))


def validate(df: DataFrame) -> DataFrame:
    """(issue, rows, ids, examples): missing columns, only one of START and END, repeated SAMPLE_ID. Empty when all is well."""
    spark, found = df.sparkSession, []
    schema = "issue string, rows bigint, ids bigint, examples array<string>"
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        found.append(spark.createDataFrame([(f"missing columns: {', '.join(missing)}", None, None, None)], schema))
    if ("START" in df.columns) != ("END" in df.columns):
        found.append(spark.createDataFrame([("only one of START and END", None, None, None)], schema))
    if "SAMPLE_ID" in df.columns:
        repeated = df.groupBy("SAMPLE_ID").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        # the first five in order, by bounded partial lists
        firsts = F.slice(F.sort_array(F.collect_set(F.when(F.col("_r") <= 5, F.col("SAMPLE_ID").cast("string")))), 1, 5)
        top = repeated.orderBy("SAMPLE_ID").limit(5).select("SAMPLE_ID", F.lit(1).alias("_r"))
        counted = repeated.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("ids"), F.lit(None).cast("array<string>").alias("examples"))
        named = top.agg(F.lit(None).cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("ids"), firsts.alias("examples"))
        marked = counted.unionByName(named).agg(*(F.max(c).alias(c) for c in ("rows", "ids", "examples")))
        found.append(marked.where("ids > 0").select(F.lit("duplicate SAMPLE_ID").alias("issue"), "rows", "ids", "examples"))
    out = found[0] if found else spark.createDataFrame([], schema)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def counts(df: DataFrame) -> DataFrame:
    """Segments, videos, classes, signers and splits of a manifest."""
    # One narrow aggregation for each column, not one that repeats every row for each of them; each gives one row.
    splits = F.array_join(F.sort_array(F.collect_set("SPLIT")), ",") if "SPLIT" in df.columns else F.lit(None).cast("string")
    parts, names = [df.agg(F.lit("segments").alias("name"), F.count(F.lit(1)).alias("n"), splits.alias("splits"))], ["segments"]
    for c, name in (("VIDEO_ID", "videos"), ("CLASS_ID", "classes"), ("SIGNER_ID", "signers")):
        if c in df.columns:
            parts.append(df.select(c).distinct().agg(F.lit(name).alias("name"), F.count(c).alias("n"), F.lit(None).cast("string").alias("splits")))
            names.append(name)
    out = reduce(DataFrame.unionByName, parts).agg(*(F.max(F.when(F.col("name") == x, F.col("n"))).alias(x) for x in names), F.max("splits").alias("splits"))
    return out if "SPLIT" in df.columns else out.drop("splits")


def stage_counters(df: DataFrame, status: str) -> DataFrame:
    """total, processed, skipped and errors of rows with a status."""
    return df.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col(status) == s).alias(n) for s, n in (("ok", "processed"), ("skipped", "skipped"), ("error", "errors"))))


def content_hash(df: DataFrame, digits: int = 4) -> DataFrame:
    """content_hash of all rows, whatever their order: a tree of SHA-256.

    Rows are hashed as JSON. Row hashes with the same first ``digits`` hex digits make a leaf, which is the hash of them all
    in order; the root is the hash of the leaves in order, 16 ** digits of them at most.
    """
    row = F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)
    leaves = df.select(row.alias("d")).groupBy(F.substring("d", 1, digits).alias("leaf")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list("d")), ""), 256).alias("h"))
    root = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("leaf", "h"))), lambda x: x["h"]), "")
    return leaves.agg(F.sha2(F.concat(F.lit(",".join(df.columns) + ":"), root), 256).alias("content_hash"))


def sample_metadata(processor: str) -> Column:
    """What is stored beside a sample."""
    return F.to_json(F.struct(F.col("VIDEO_ID").alias("video_id"), F.col("SAMPLE_ID").alias("sample_id"), F.col("START").alias("start"), F.col("END").alias("end"), F.lit(processor).alias("processor")))


def running_index(df: DataFrame, by: str, order: str, name: str = "idx") -> DataFrame:
    """Numbers from 0 inside each group, by order."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1)


def dense_classes(df: DataFrame, label: str, name: str = "CLASS_ID") -> DataFrame:
    """Numbers from 0 of the distinct labels, by code point. The distinct labels, far fewer than the rows, are numbered and
    joined back; a null label has no number."""
    labels = df.select(label).where(F.col(label).isNotNull()).distinct()
    numbered = labels.select(F.col(label).alias("_label"), (F.dense_rank().over(Window.orderBy(label)) - 1).cast("long").alias(name))
    return df.join(numbered, F.col(label) == F.col("_label"), "left").drop("_label")

"""Joins of manifests with class maps, boxes, corpora and artifacts.

No join forces a broadcast: class maps are small, so that Spark broadcasts them below its threshold on the size that it
sees, and joins them by shuffle beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import boxes
from ..session import spread


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """df, or an error that names repeated keys."""
    repeated = df.groupBy(key).count().where("count > 1").orderBy(key).limit(5).collect()  # five names at most
    if repeated:
        raise ValueError(f"{key} repeats: {[r[key] for r in repeated]}")
    return df


def class_map(df: DataFrame, classes: DataFrame, key: str = "CLASS_ID", extras: tuple[str, ...] = ("GLOSS",), checked: bool = True) -> DataFrame:
    """df with columns of its class; classes that aren't in the map leave them null."""
    names = unique_by(classes, key) if checked else classes
    return df.join(names.select(key, *extras), key, "left")


def unmapped(df: DataFrame, column: str = "GLOSS") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("unmapped"))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, as a dictionary would keep it."""
    rest = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(*(F.max_by(c, order).alias(c) for c in rest))


def lookup(df: DataFrame, table: DataFrame, key: str, default: str = "") -> DataFrame:
    """Left join whose misses become a default."""
    values = [c for c in table.columns if c != key]
    out = df.join(table, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(default)) for c in values})


def boxes_by_sample(df: DataFrame, found: DataFrame) -> DataFrame:
    """df with BBOX_* and PERSON_DETECTED from (SAMPLE_ID, box); a sample without a box isn't detected."""
    out = df.join(found.select("SAMPLE_ID", F.col("box").alias("_box")), "SAMPLE_ID", "left")
    side = {f"BBOX_{c.upper()}": F.col(f"_box.{c}") for c in ("x1", "y1", "x2", "y2")}
    return out.withColumns({**side, "PERSON_DETECTED": F.col("_box").isNotNull()}).drop("_box")


def boxes_from_json(rows: DataFrame) -> DataFrame:
    """(SAMPLE_ID, box) from one JSON map of samples to boxes in column value; the first of equal names wins."""
    cells = rows.select(F.explode(F.from_json("value", "map<string,string>")).alias("SAMPLE_ID", "cell"))
    return cells.select("SAMPLE_ID", boxes.from_json_cell(F.col("cell")).alias("box")).where("box is not null")


#: Pairs of a sentence and its videos that one task is to make, and copies of a video that travel together.
_PAIRS, _COPIES = 2_000_000, 256


def corpus_videos(corpus: DataFrame, videos: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Sentences with their videos, all of them. Signer 0 stands for any signer. Sentences without a video stay.

    The result has a row for each pair, however many there are, so that only the work beside it can be saved and dealt out. A
    video is offered under its signer and under any signer, which makes the join one by equality, without pairs that it
    drops. Equal videos travel once, with their number. Where a sentence and signer have many pairs, their videos are dealt
    over parts, by their contents, and their sentences go to every part. Columns ``also`` of videos come along.
    """
    key, carried = ["_sentence", "_signer"], ["rel_path", "variation", *also]
    c = corpus.withColumns({"_sentence": F.col("sentence"), "_signer": F.col("signer")})
    offered = F.array_compact(F.array(F.lit(0), F.nullif(F.col("signer"), F.lit(0))))
    kinds = videos.groupBy("sentence", "signer", *carried).agg(F.count(F.lit(1)).alias("_n"))
    last = F.floor((F.col("_n") - 1) / _COPIES).cast("int")
    v = kinds.select(F.col("sentence").alias("_sentence"), F.explode(offered).alias("_signer"), F.col("signer").alias("_of"), *carried, "_n").withColumn("_i", F.explode(F.sequence(F.lit(0), last)))
    v = v.withColumn("_n", F.least(F.lit(_COPIES), F.col("_n") - F.col("_i") * _COPIES))
    parts = F.greatest(F.lit(1), F.ceil(F.col("_a").cast("double") * F.col("_b") / _PAIRS)).cast("int").alias("_parts")
    many = c.groupBy(*key).agg(F.count(F.lit(1)).alias("_a")).join(v.groupBy(*key).agg(F.sum("_n").alias("_b")), key).select(*key, parts)
    sides = c.join(many, key).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))), v.join(many, key).withColumn("_part", F.pmod(F.xxhash64("_of", "rel_path", "variation", "_i"), "_parts"))
    left, right = (spread(df.drop("_parts"), *key, "_part") for df in sides)
    met = left.join(right.drop("_of", "_i"), [*key, "_part"])
    met = met.select(*corpus.columns, *carried, F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy")).drop("_copy")
    alone = c.join(many, key, "left_anti").select(*corpus.columns, *(F.lit(None).cast(videos.schema[x].dataType).alias(x) for x in carried))
    return met.unionByName(alone)


def artifacts(manifest: DataFrame, normalised: DataFrame, raw: DataFrame) -> DataFrame:
    """manifest with ARTIFACT, the normalised result before the raw one, or null."""
    n = normalised.select(F.col("SAMPLE_ID"), F.col("path").alias("_n"))
    r = raw.select(F.col("SAMPLE_ID"), F.col("path").alias("_r"))
    return manifest.join(n, "SAMPLE_ID", "left").join(r, "SAMPLE_ID", "left").withColumn("ARTIFACT", F.coalesce("_n", "_r")).drop("_n", "_r")

"""Annotation files as DataFrames. Every scan has an explicit schema; identifiers are strings."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators.manifest import rename_aliases
from ..schema import struct


def header(spark: SparkSession, path: str, sep: str) -> list[str]:
    """The names in the first line of a file."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} is empty")
    return [c.strip().strip('"') for c in first["value"].lstrip("﻿").rstrip("\r").split(sep)]


def delimited(spark: SparkSession, path: str, sep: str, need: tuple[str, ...] = (), schema=None) -> DataFrame:
    """A delimited file with a header; quotes are doubled inside quotes. Missing columns are an error that names the first.
    Lines with too many fields keep their first ones, short lines end in nulls."""
    names = header(spark, path, sep)
    for c in need:
        if c not in names:
            raise ValueError(f"{path} has no column {c}")
    return spark.read.option("sep", sep).option("header", True).option("escape", '"').option("mode", "PERMISSIVE").schema(schema or struct(names)).csv(path)


def manifest(spark: SparkSession, path: str, canonical: bool = True) -> DataFrame:
    """A manifest: tab-separated, older names become canonical."""
    df = delimited(spark, path, "\t")
    return rename_aliases(df) if canonical else df


def headerless(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    return spark.read.option("sep", sep).schema(", ".join(f"`{n}` string" for n in names)).csv(path)


def id_list(spark: SparkSession, path: str, name: str = "VIDEO_ID") -> DataFrame:
    """Distinct ids, one a line, without blanks."""
    return spark.read.text(path).select(tx.present(F.col("value")).alias(name)).where(F.col(name).isNotNull()).distinct()


def openasl(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, "\t", ("vid", "yid", "start", "end"), ", ".join(f"`{c}` string" for c in header(spark, path, "\t")))


def slovo(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, ",", ("attachment_id", "user_id", "text", "train"), ", ".join(f"`{c}` string" for c in header(spark, path, ",")))


def phoenix(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited; names in lower case; the id is column id, or else name."""
    names = [c.lower() for c in header(spark, path, "|")]
    key = "id" if "id" in names else "name"
    if key not in names:
        raise ValueError(f"{path} has neither id nor name")
    df = spark.read.option("sep", "|").option("header", True).option("quote", "").schema(", ".join(f"`{c}` string" for c in names)).csv(path)
    return df.withColumn("_id", F.col(key))


def csl_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(sentence, signer, text, line) of a corpus in text lines; ``#`` lines, blank and malformed ones are left out.

    Fields are parted by tabs if the first line of data has one, else by white space. With two fields there is no signer
    (0); with more, the second is the signer where it is a number, else part of the text.
    """
    lines = spark.read.text(path).select("value").withColumn("line", F.monotonically_increasing_id())
    data = lines.where((F.trim("value") != "") & ~F.ltrim("value").startswith("#"))
    first = data.orderBy("line").limit(1).collect()
    sep = "\t" if first and "\t" in first[0]["value"] else r"\s+"
    parts = F.filter(F.transform(F.split(F.trim("value"), sep), lambda p: F.trim(p)), lambda p: p != "")
    p = data.withColumn("p", parts).where(F.size("p") >= 2)
    sentence, signer = F.get("p", F.lit(0)).try_cast("int"), F.get("p", F.lit(1)).try_cast("int")
    three = F.size("p") >= 3
    tail = lambda n: F.array_join(F.slice("p", n, F.greatest(F.size("p") - n + 1, F.lit(0))), " ")
    return p.select(
        sentence.alias("sentence"),
        F.when(three & signer.isNotNull(), signer).otherwise(0).alias("signer"),
        F.when(three & signer.isNotNull(), tail(3)).otherwise(tail(2)).alias("text"),
        "line",
    ).where("sentence is not null")


def class_map(spark: SparkSession, path: str, extras: tuple[str, ...] = ()) -> DataFrame:
    """(CLASS_ID, GLOSS, extras that are there) of a class map; ids that are no numbers are null. Extras that are missing and ids
    that repeat are warned of."""
    names = header(spark, path, "\t")
    df = delimited(spark, path, "\t", ("CLASS_ID", "GLOSS"), ", ".join(f"`{c}` string" for c in names))
    missing = [c for c in extras if c not in names]
    if missing:
        warnings.warn(f"{path} has no columns {missing}", stacklevel=2)
    classes = df.select(tx.real(F.col("CLASS_ID")).cast("long").alias("CLASS_ID"), "GLOSS", *(c for c in extras if c in names))
    repeated = classes.groupBy("CLASS_ID").count().where("count > 1").orderBy("CLASS_ID").limit(10).collect()  # ten at most
    if repeated:
        warnings.warn(f"{path} repeats classes {[r['CLASS_ID'] for r in repeated]}", stacklevel=2)
    return classes


def split_spec(spark: SparkSession, path: str) -> DataFrame:
    """(SAMPLE_ID, SPLIT); the last line of a sample wins."""
    from ..operators.joins import last_wins

    rows = headerless(spark, path, ["SAMPLE_ID", "SPLIT"], "\t").withColumn("line", F.monotonically_increasing_id())
    return last_wins(rows, "SAMPLE_ID", "line")

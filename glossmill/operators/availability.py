"""Which segments have their video, and what to do about the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schema import POLICIES


class Unavailable(RuntimeError):
    """Videos are missing and the policy is to stop."""


def _apply(df: DataFrame, key: Column, there: DataFrame, policy: str, in_row_order: bool) -> DataFrame:
    if policy not in POLICIES:
        raise ValueError(f"no availability policy {policy!r}; there are {POLICIES}")
    names = there.toDF("_there").distinct()
    keyed = df.withColumn("_key", key)
    if policy == "drop_unavailable":
        return keyed.join(names, F.col("_key") == F.col("_there"), "left_semi").drop("_key")
    if policy == "mark_unavailable":
        return keyed.join(names, F.col("_key") == F.col("_there"), "left").withColumn("AVAILABLE", F.col("_there").isNotNull()).drop("_key", "_there")
    gone = keyed.join(names, F.col("_key") == F.col("_there"), "left_anti").select("_key")
    examples = (gone if in_row_order else gone.distinct().orderBy("_key")).limit(5).collect()  # five names at most
    if examples:
        raise Unavailable(f"videos are missing, such as {[r['_key'] for r in examples]}")
    return df


def by_id(df: DataFrame, there: DataFrame, policy: str, column: str = "VIDEO_ID") -> DataFrame:
    """The policy applied by video id; ``there`` has one column of ids."""
    return _apply(df, F.col(column), there, policy, in_row_order=False)


def by_path(df: DataFrame, there: DataFrame, policy: str) -> DataFrame:
    """The policy applied by REL_PATH, a missing or blank one being unavailable; by id where there is no such column."""
    if "REL_PATH" not in df.columns:
        return by_id(df, there.select(tx.stem(F.col(there.columns[0]))), policy)
    return _apply(df, tx.present(F.col("REL_PATH")), there, policy, in_row_order=True)


def only_available(df: DataFrame) -> DataFrame:
    return df.where("AVAILABLE") if "AVAILABLE" in df.columns else df


def missing(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """Distinct ids that aren't there, in order: what is to be fetched."""
    key = wanted.columns[0]
    return wanted.where(F.col(key).isNotNull()).distinct().join(there.toDF("_there").distinct(), F.col(key) == F.col("_there"), "left_anti").orderBy(key)


def missing_counts(df: DataFrame, there: DataFrame, column: str) -> DataFrame:
    """How many rows and how many distinct ids aren't there."""
    gone = df.join(there.toDF("_there").distinct(), F.col(column) == F.col("_there"), "left_anti")
    return gone.agg(F.count(F.lit(1)).alias("missing_rows"), F.count_distinct(column).alias("missing_ids"))


def not_done(df: DataFrame, done: DataFrame, column: str = "SAMPLE_ID", force: bool = False) -> DataFrame:
    """Rows whose result isn't there yet; all rows when forced."""
    return df if force else df.join(done.toDF("_done").distinct(), F.col(column) == F.col("_done"), "left_anti")

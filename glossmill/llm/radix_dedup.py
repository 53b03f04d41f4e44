"""Exact dedup by distributed MSD radix partitioning (operator 6).

Texts are compared after every run of white space became one space. Groups are split by successive chunks of the text,
short ones first and each later one eight times as long, until a group is a single row or its texts have ended. Two rows
stay together only if all their chunks are equal, so equality needs no digest.

One level: count the pairs (group, next chunk); the pairs with two rows or more become the next groups and get a number,
which is fixed by writing that small table; a left join brings it to the rows. Counting combines on the map side. The join
is a plain one whose large partitions Spark splits, so a hot chunk isn't one task, and it streams rows, it collects none.

Defined cases: a null text counts as empty; of rows with equal text the smallest doc_id stays, a null doc_id only if all
are null; of repeated rows with that doc_id exactly one stays; extra columns are kept, those called like a result are replaced
by it (``drop_copies`` keeps them all); an empty table gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import scratch

SPACE = r"[\x20\x09-\x0D]+"
RESULTS = ("keep_id", "group_size", "kept")


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _next_groups(rows: DataFrame, run: scratch.Run) -> DataFrame:
    """Pairs (group, chunk) of two rows or more, numbered, with the row that stays and whether the texts have ended."""
    counted = rows.groupBy("_group", "_chunk").agg(F.count(F.lit(1)).alias("_size"), F.min(F.struct(F.isnull("_id").alias("no_id"), F.col("_id").alias("id"), F.col("_uid").alias("uid"))).alias("_least"))
    counted = counted.where("_size > 1").withColumn("_next", F.monotonically_increasing_id())
    return run.keep(counted, "radix-groups")


def _level(rows: DataFrame, groups: DataFrame) -> DataFrame:
    g = groups.select(F.col("_group").alias("_g"), F.col("_chunk").alias("_c"), "_size", "_least", "_next")
    # One plan at every size: the groups are never broadcast, however few they are.
    return rows.join(g.hint("merge"), (rows["_group"] == g["_g"]) & (rows["_chunk"] == g["_c"]), "left").drop("_g", "_c", "_group", "_chunk")


def exact_dedup(df: DataFrame, text: str = "text", key: str = "doc_id", first: int = 64, growth: int = 8, drop_text: bool = False, run: scratch.Run | None = None) -> DataFrame:
    """df with keep_id, group_size and kept. With drop_text the text is null in the result and isn't carried further than needed.

    The number of levels grows with the logarithm of the longest text that has a copy: 64 bytes, then 512, 4 KB, ...
    """
    plain, names = scratch.shielded(df)
    out = _dedup(plain, f"c{names.index(text)}", f"c{names.index(key)}", first, growth, drop_text, run or scratch.Run(df.sparkSession))
    return out.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n not in RESULTS), *RESULTS)


def _dedup(df: DataFrame, text: str, key: str, first: int, growth: int, drop_text: bool, run: scratch.Run) -> DataFrame:
    norm = normalised(F.col(text))
    carried = df.columns
    rows = df.withColumn("_id", F.col(key)).withColumn("_uid", F.lit(0).cast("long"))
    rows = rows.withColumn("_group", F.lit(0).cast("long")).withColumn("_chunk", F.substring(norm, 1, first))
    done: list[DataFrame] = []
    start, length = 1, first
    while True:
        groups = _next_groups(rows, run)
        level = _level(rows, groups)
        # A group has ended when its chunk is shorter than asked for; a chunk that is filled may be followed by more text in some
        # rows and by none in others, so those go on with an empty one. At the first level rows have no number yet.
        ended = F.col("_next").isNotNull() & (F.length(norm) < start + length - 1) & F.lit(start > 1)
        level = level.withColumn("_state", F.when(F.col("_next").isNull(), 0).when(ended, 1).otherwise(2))
        if drop_text:
            level = level.withColumn(text, F.when(F.col("_state") == 2, F.col(text)))
        level = level.withColumn("_uid", F.when(F.lit(start == 1), F.monotonically_increasing_id()).otherwise(F.col("_uid")))
        level = run.keep(level, "radix-rows")
        run.drop(groups)
        single = level.where("_state = 0")
        done.append(single.select(*carried, F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")))
        if start > 1:
            whole = level.where("_state = 1")
            done.append(whole.select(*carried, F.col("_least.id").alias("keep_id"), F.col("_size").alias("group_size"), (F.col("_uid") == F.col("_least.uid")).alias("kept")))
        rest = level.where("_state = 2")
        if rest.isEmpty():
            break
        start, length = start + length, length * growth
        rows = rest.select(*carried, "_id", "_uid", F.col("_next").alias("_group"), F.substring(norm, start, length).alias("_chunk"))
    return reduce(DataFrame.unionByName, done)


def drop_copies(df: DataFrame, text: str = "text", key: str = "doc_id", run: scratch.Run | None = None) -> DataFrame:
    """The rows of df that stay, with df's columns."""
    plain, names = scratch.shielded(df)
    out = _dedup(plain, f"c{names.index(text)}", f"c{names.index(key)}", 64, 8, False, run or scratch.Run(df.sparkSession))
    return out.where("kept").select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))

"""Sharding by jump consistent hashing (operator 3, native).

The shard of a row follows from its key and the number of shards alone: there is no ring and no table. With one more
shard, a row stays or moves into the new shard. Everything is a Spark expression.

Defined cases: a null key counts as key 0; rows that share a key share a shard; an empty table gives an empty table;
other columns of the input are kept, and one called like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scratch

# Fixed values of the published jump hash: multiplier of its 64-bit generator.
MULTIPLIER = 2862933555777941757
#: Rows of a cell in which slots are numbered.
CELL_ROWS = 100_000


def _limbs(key: Column) -> list[Column]:
    return [F.shiftrightunsigned(key, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]


def _next(limbs: list[Column]) -> list[Column]:
    """key * MULTIPLIER + 1 modulo 2**64 in limbs of 16 bits, so that no product overflows a long."""
    m = [(MULTIPLIER >> (16 * i)) & 0xFFFF for i in range(4)]
    out, carry = [], F.lit(1).cast("long")
    for i in range(4):
        total = carry
        for j in range(i + 1):
            total = total + limbs[j] * F.lit(m[i - j])
        out.append(total.bitwiseAND(F.lit(0xFFFF)))
        carry = F.shiftright(total, 16)
    return out


def jump_hash(key: Column, n_shards: int) -> Column:
    """Shard 0 .. n_shards - 1 of a long key. The candidate grows with each step, so n_shards steps always suffice."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def state(b: Column, j: Column, limbs: list[Column]) -> Column:
        return F.struct(b.alias("b"), j.alias("j"), *(x.alias(f"k{i}") for i, x in enumerate(limbs)))

    def step(acc: Column, _: Column) -> Column:
        limbs = _next([acc[f"k{i}"] for i in range(4)])
        high = F.shiftleft(limbs[3], 15).bitwiseOR(F.shiftright(limbs[2], 1))  # the key's upper 31 bits
        jump = F.floor((acc["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (high + 1).cast("double")))
        return F.when(acc["j"] >= n_shards, acc).otherwise(state(acc["j"], jump, limbs))

    start = state(F.lit(-1).cast("long"), F.lit(0).cast("long"), _limbs(key))
    steps = F.sequence(F.lit(1), F.lit(n_shards + 1))
    return F.aggregate(steps, start, step, lambda acc: acc["b"].cast("int"))


def assign_shards(df: DataFrame, key: str, n_shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """df with its shard and, under the name ``grown``, the shard if there were one more."""
    results = {shard: jump_hash(F.col(key), n_shards)}
    if grown is not None:
        results[grown] = jump_hash(F.col(key), n_shards + 1)
    return df.withColumns(results)


def number_slots(df: DataFrame, shard: str, cell_rows: int = CELL_ROWS, slot: str = "slot", run: scratch.Run | None = None) -> DataFrame:
    """Gapless numbers from 0 in every shard; rows of df that are equal in all columns are interchangeable.

    No shard is sorted in one task. Its rows are dealt at random into cells, as many as give a cell about ``cell_rows``, and
    written; a cell numbers its own rows, from the sum of the cells before it. Neither a shard that has most of the rows nor
    a row that is repeated very often makes a large cell. The only shuffle of the rows is that into cells.
    """
    run = run or scratch.Run(df.sparkSession)
    plain, names = scratch.shielded(df)
    key = f"c{names.index(shard)}"
    most = plain.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    cells = max(1, -(-most // cell_rows))
    dealt = run.keep(plain.withColumn("cell", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells))), "slots")
    rows = dealt.groupBy(key, "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(key).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.select(key, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy(key, "cell").orderBy(*(c for c in plain.columns))
    out = dealt.withColumn("inside", F.row_number().over(inside)).join(before, [key, "cell"])
    return out.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names) if n != slot), (F.col("first") + F.col("inside") - 1).alias(slot))

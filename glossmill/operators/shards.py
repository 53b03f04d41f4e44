"""Shards of samples, bounded by count and by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import work_folder


def by_count(df: DataFrame, order: str, most: int, name: str = "shard_id") -> DataFrame:
    """Shard numbers of ``most`` rows each, in order; order must be unique.

    Ranges of the order are sorted, each row gets its place in its range, and that is written once, so that no task sorts
    all rows and the ranges are the same for their counts and for the rows.
    """
    places = df.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_place", F.monotonically_increasing_id())
    folder = work_folder(df.sparkSession, "ranges")
    places.write.parquet(folder)
    rows = df.sparkSession.read.schema(places.schema).parquet(folder)
    part, inside = F.shiftright("_place", 33).alias("_part"), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_part", before.alias("_before"))  # one row for each range
    out = rows.withColumns({"_part": F.shiftright("_place", 33), "_inside": inside}).join(F.broadcast(starts), "_part")
    return out.withColumn(name, F.floor((F.col("_before") + F.col("_inside")) / most).cast("long")).drop("_part", "_place", "_inside", "_before")


class Fold:
    """The ordered fold over a run of sizes: where shards begin. A null size makes the open shard's bytes unknown (minus infinity),
    so that it closes by count."""

    def __init__(self, sizes: np.ndarray, most: int, most_bytes: int):
        self.n, self.most, self.most_bytes = len(sizes), most, most_bytes
        unknown = np.isnan(sizes)
        self.sums = np.concatenate([[0.0], np.cumsum(np.where(unknown, 0.0, sizes))])
        self.unknown = np.append(np.flatnonzero(unknown), len(sizes))

    def _reached(self, start: np.ndarray, bytes_before: np.ndarray | float) -> np.ndarray:
        """The first row before which the rows from ``start`` on, with what was open before, reach the bytes."""
        with np.errstate(invalid="ignore"):
            at = np.searchsorted(self.sums, self.sums[start] + self.most_bytes - bytes_before)
        null = self.unknown[np.searchsorted(self.unknown, start)]
        return np.where((null < at) | np.isneginf(bytes_before), np.iinfo(np.int64).max, np.maximum(at, start))

    def next(self, start: np.ndarray) -> np.ndarray:
        """Where the shard after one that begins at ``start`` begins; at least n if that isn't in this run."""
        return np.maximum(np.minimum(start + self.most, self._reached(start, 0.0)), start + 1)

    def first(self, rows: int, size: float) -> int:
        """Where the first shard begins, if one of so many rows and bytes is open; 0 if none is."""
        if not rows:
            return 0
        return int(min(max(0, self.most - rows), self._reached(np.array([0]), np.array([size]))[0]))

    def left(self, start: int, rows: int = 0, size: float = 0.0) -> tuple[int, float]:
        """Rows and bytes of the shard that is open at the end, if it began at ``start`` or had so many before."""
        known = self.unknown[np.searchsorted(self.unknown, start)] == self.n
        return rows + self.n - start, size + self.sums[-1] - self.sums[start] if known else -np.inf


def _segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with the same keys, of sorted rows."""
    key, held = None, []
    for batch in batches:
        names = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if held and names[a] != key:
                    yield key, pa.Table.from_batches(held)
                    held = []
                key = names[a]
                held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _sizes(table: pa.Table) -> np.ndarray:
    return np.array([np.nan if x is None else float(x) for x in table.column("_bytes").to_pylist()])


_SUMMARY = "array<double>"


def by_count_and_bytes(df: DataFrame, order: str, size: str, most: int, most_bytes: int, group: str | None = None, name: str = "shard_id", ranges: int | None = None) -> DataFrame:
    """Shard numbers of an ordered fold: a new shard begins where the open one has ``most`` rows or ``most_bytes`` bytes.

    Where a shard begins follows from all rows before it. Yet a range of the order needs to know of them only how much is open
    when it begins; and as a shard has ``most`` rows at most, its first shard begins at one of its first ``most`` rows. So each
    range finds, for each of these, how many shards follow and what is open at its end. Those summaries are chained in order,
    one task for each group, and with what is open before it each range numbers its rows by itself. Rows are written once.

    Rows of equal order are taken by size, and every row comes back once. Null groups are a group.
    """
    names = df.columns
    plain = df.toDF(*(f"c{i}" for i in range(len(names))))
    column = lambda c: F.col(f"c{names.index(c)}")
    rows = plain.withColumns({"_group": column(group) if group else F.lit(0), "_bytes": column(size).cast("long")})
    key = F.col("_group"), column(order)
    ranged = rows.repartitionByRange(ranges, *key) if ranges else rows.repartitionByRange(*key)
    placed = ranged.sortWithinPartitions(*key, "_bytes").withColumn("_place", F.monotonically_increasing_id())
    folder = work_folder(df.sparkSession, "folds")
    placed.write.parquet(folder)
    table = df.sparkSession.read.schema(placed.schema).parquet(folder).withColumn("_part", F.shiftright("_place", 33))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, g), run in _segments(batches, ["_part", "_group"]):
            fold = Fold(_sizes(run), most, most_bytes)
            start = np.arange(min(most, fold.n - 1) + 1)
            last, shards, after = start.copy(), np.ones(len(start), np.int64), fold.next(start)
            while (on := after < fold.n).any():
                last[on], shards[on] = after[on], shards[on] + 1
                after[on] = fold.next(last[on])
            open_ = [fold.left(int(x)) for x in last]
            known = fold.unknown[0]
            yield pa.RecordBatch.from_arrays([
                pa.array([g], run.schema.field("_group").type), pa.array([part], pa.int64()), pa.array([[float(fold.n), float(known), fold.sums[-1]]]), pa.array([fold.sums[: len(start) + 1].tolist()]),
                pa.array([shards.astype(float).tolist()]), pa.array([[float(n) for n, _ in open_]]), pa.array([[b for _, b in open_]]),
            ], ["_group", "_part", "facts", "sums", "shards", "rows", "bytes"])

    kind = placed.schema["_group"].dataType.simpleString()
    lists = ", ".join(f"{c} {_SUMMARY}" for c in ("facts", "sums", "shards", "rows", "bytes"))
    sorted_ = table.select("_group", "_part", "_bytes", "_place").repartition("_part").sortWithinPartitions("_part", "_group", "_place")
    summaries = sorted_.mapInArrow(summarise, f"_group {kind}, _part long, {lists}")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, shard, rows, size = object(), 0, 0, 0.0
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                if x["_group"] != last:
                    last, shard, rows, size = x["_group"], -1, 0, 0.0
                out.append((shard, rows, size))
                n, known, total = x["facts"]
                fold = Fold(np.zeros(0), most, most_bytes)
                fold.n, fold.sums, fold.unknown = int(n), np.array(x["sums"]), np.array([int(known)])
                at = fold.first(rows, size)
                if at < n:
                    shard, rows, size = shard + int(x["shards"][at]), int(x["rows"][at]), x["bytes"][at]
                else:
                    rows, size = rows + int(n), size + total if known == n else -np.inf
            yield pa.RecordBatch.from_arrays([batch.column("_group"), batch.column("_part"), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64())))], ["_g", "_p", "_shard", "_rows", "_size"])

    entries = summaries.repartition("_group").sortWithinPartitions("_group", "_part").mapInArrow(chain, f"_g {kind}, _p long, _shard long, _rows long, _size double")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run in _segments(batches, ["_part", "_group"]):
            fold = Fold(_sizes(run), most, most_bytes)
            at, shard = fold.first(run.column("_rows")[0].as_py(), run.column("_size")[0].as_py()), run.column("_shard")[0].as_py()
            begins = np.zeros(fold.n, np.int64)
            while at < fold.n:
                begins[at] = 1
                at = int(fold.next(np.array([at]))[0])
            numbered = run.select([f"c{i}" for i in range(len(names))]).append_column("_id", pa.array(shard + np.cumsum(begins)))
            yield from numbered.combine_chunks().to_batches()

    entered = table.join(entries, (F.col("_part") == F.col("_p")) & F.col("_group").eqNullSafe(F.col("_g"))).drop("_g", "_p")
    entered = entered.repartition("_part").sortWithinPartitions("_part", "_group", "_place")
    out = entered.mapInArrow(number, StructType([*plain.schema.fields, StructField("_id", LongType())]))
    return out.toDF(*names, name)

"""Time windows and frame sampling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Frames of a run of the accumulator.
RUN = 256


def windows(start: Column, end: Column, size: float, stride: float, least: float) -> Column:
    """array<struct<idx, start, end>> of the sliding windows of a span.

    A window ends with the span at the latest; the first one that is shorter than ``least`` ends the list. Starts are sums
    of strides, added one by one, so that they carry the same rounding as a loop would.
    """
    if stride <= 0:
        raise ValueError("stride must be positive")
    none = F.array().cast("array<struct<idx:int,start:double,end:double>>")
    steps = F.ceil((end - start) / stride).cast("int") + 1
    state = F.struct(start.cast("double").alias("t"), F.lit(True).alias("on"), none.alias("out"))

    def step(acc: Column, _: Column) -> Column:
        last = F.least(acc["t"] + size, end.cast("double"))
        on = acc["on"] & (acc["t"] < end) & (last - acc["t"] >= least)
        row = F.struct(F.size(acc["out"]).alias("idx"), acc["t"].alias("start"), last.alias("end"))
        return F.struct((acc["t"] + stride).alias("t"), on.alias("on"), F.when(on, F.concat(acc["out"], F.array(row))).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(F.sequence(F.lit(1), steps), state, step, lambda acc: acc["out"])
    return F.when((end - start >= least) & (end > start), found).otherwise(none)


def even_windows(start: Column, end: Column, size: float, stride: float, least: float) -> Column:
    """As ``windows`` for strides that sums represent exactly (5.0, 0.25, ...): the starts are products, all in one go."""
    if stride <= 0:
        raise ValueError("stride must be positive")
    none = F.array().cast("array<struct<idx:int,start:double,end:double>>")
    starts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil((end - start) / stride).cast("int") - 1, F.lit(0))), lambda i: F.struct(i.alias("idx"), (start + i * F.lit(float(stride))).alias("start"), F.least(start + i * F.lit(float(stride)) + size, end.cast("double")).alias("end")))
    kept = F.filter(starts, lambda w: (w["start"] < end) & (w["end"] - w["start"] >= least))
    return F.when((end - start >= least) & (end > start) & (F.lit(size >= least)), kept).otherwise(none)


def frame_range(start: Column, end: Column, fps: Column) -> Column:
    """Frame numbers from start to end, both included; none where the end comes first."""
    a, b = (start * fps).cast("long"), (end * fps).cast("long")
    return F.when(b >= a, F.sequence(a, F.greatest(a, b))).otherwise(F.array().cast("array<bigint>"))


def effective_fps(rate: float | None, source_fps: Column) -> Column:
    """The rate of kept frames: none for no rate; a share of the source below 1; else a rate, at most the source's."""
    if rate is None:
        return F.lit(None).cast("double")
    if rate <= 0:
        raise ValueError("rate must be positive or none")
    if rate < 1:
        return F.when(source_fps > 0, source_fps * rate)
    return F.when(source_fps > 0, F.least(F.lit(float(rate)), source_fps)).otherwise(F.lit(float(rate)))


def sample_by_ratio(frames: Column, ratio: Column) -> Column:
    """The frames that an accumulator keeps: it gains ``ratio`` with each frame and pays 1 for each frame kept.

    Frames are taken in runs of ``RUN``, so that what is kept is appended to a short array, and this as one element to that
    of all runs.
    """
    none = F.array().cast("array<bigint>")

    def step(acc: Column, frame: Column) -> Column:
        total = acc["sum"] + ratio
        return F.when(total >= 1, F.struct((total - 1).alias("sum"), F.concat(acc["out"], F.array(frame.cast("long"))).alias("out"))).otherwise(F.struct(total.alias("sum"), acc["out"].alias("out")))

    def run(acc: Column, k: Column) -> Column:
        part = F.aggregate(F.slice(frames, k * RUN + 1, F.lit(RUN)), F.struct(acc["sum"].alias("sum"), none.alias("out")), step)
        return F.struct(part["sum"].alias("sum"), F.concat(acc["runs"], F.array(part["out"])).alias("runs"))

    runs = F.when(F.size(frames) > 0, F.sequence(F.lit(0), ((F.size(frames) - 1) / RUN).cast("int"))).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<array<bigint>>").alias("runs"))
    return F.aggregate(runs, start, run, lambda acc: F.flatten(acc["runs"]))


def sample_by_skip(frames: Column, every: int) -> Column:
    """Every n-th frame, from the first on."""
    return F.filter(frames, lambda x, i: i % every == 0)


def sample(frames: Column, source_fps: Column, target_fps: Column) -> Column:
    """Frames at the target rate; all of them where a rate is unknown."""
    ratio = F.least(target_fps / F.nullif(source_fps, F.lit(0.0)), F.lit(1.0))
    return F.when((source_fps > 0) & target_fps.isNotNull(), sample_by_ratio(frames, F.coalesce(ratio, F.lit(1.0)))).otherwise(F.transform(frames, lambda x: x.cast("long")))


def frame_time(frame: Column, fps: Column) -> Column:
    """Seconds of a frame number, or null without a rate."""
    return F.when(fps > 0, frame / fps)

"""Landmark clips. At rest a frame is array<struct<x, y, z, v>>; scaling works on the long form (clip, t, k, x, y, z, v)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING = -999.0
# Landmarks that flat clips may have, and which landmarks each preset takes, in order.
FLAT_SIZES = (85, 133, 543, 553)
MEDIAPIPE_POSE = [11, 12, 13, 14, 23, 24]
MEDIAPIPE_FACE = [33, 37, 46, 47, 50, 66, 70, 72, 79, 85, 88, 94, 97, 114, 115, 126, 166, 184, 185, 192, 205, 211, 214, 296, 302, 309, 315, 318, 324, 327, 344, 356, 395, 419, 430]
COCO_BODY = [5, 6, 7, 8, 11, 12]
COCO_FACE = [23, 25, 27, 29, 31, 33, 35, 37, 39, 40, 41, 42, 43, 44, 45, 46, 47, 48, 49, 52, 54, 56, 58, 71, 73, 75, 77, 79, 81, 83, 84, 85, 86, 87, 88, 89, 90]
PRESETS = {
    "mediapipe_553_to_85": [*MEDIAPIPE_POSE, *MEDIAPIPE_FACE, 501, 506, *range(511, 553)],
    "mediapipe_543_to_83": [*MEDIAPIPE_POSE, *MEDIAPIPE_FACE, *range(501, 543)],
    "mmpose_133_to_85": [*COCO_BODY, *COCO_FACE, *range(91, 133)],
}
MODES = ("isotropic_3d", "xy_isotropic_z_minmax")


def resolve_preset(preset: str | None = None, indices: list[int] | None = None) -> list[int] | None:
    """A preset's list before one given by hand, before none."""
    if preset is None:
        return None if indices is None else list(indices)
    if preset not in PRESETS:
        raise ValueError(f"no keypoint preset {preset!r}; there are {sorted(PRESETS)}")
    return list(PRESETS[preset])


def points(flat: Column, channels: int = 4) -> Column:
    """A flat frame x, y, z, v, x, ... as structs."""
    n = (F.size(flat) / channels).cast("int")
    at = lambda i, j: F.get(flat, i * channels + j)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(at(i, 0).alias("x"), at(i, 1).alias("y"), at(i, 2).alias("z"), at(i, 3).alias("v"))))


def check_flat(width: int) -> int:
    """The landmarks of flat frames of this width."""
    if width % 4 or width // 4 not in FLAT_SIZES:
        raise ValueError(f"frames of {width} numbers are no landmarks; expected 4 x one of {FLAT_SIZES}")
    return width // 4


def gather(frame: Column, indices: list[int], size: int | None = None) -> Column:
    """The landmarks of a list, in its order."""
    if not indices:
        raise ValueError("the list of landmarks is empty")
    if size is not None and max(indices) >= size:
        raise ValueError(f"landmark {max(indices)} isn't there: clips have {size}; check keypoint_preset")
    return F.transform(F.array(*(F.lit(i) for i in indices)), lambda i: F.get(frame, i))


def to_long(clips: DataFrame, clip: str, t: str, frame: str) -> DataFrame:
    """One row for each landmark."""
    return clips.select(F.col(clip).alias("clip"), F.col(t).alias("t"), F.posexplode(frame).alias("k", "p")).select("clip", "t", "k", "p.*")


def mask(long: DataFrame, empty_frames: bool = True, low_confidence: bool = False, threshold: float = 0.3) -> DataFrame:
    """x, y, z become null for frames that are zero throughout and, if asked, for landmarks that can't be seen; v goes."""
    zero = (F.col("x") == 0) & (F.col("y") == 0) & (F.col("z") == 0) & (F.col("v") == 0)
    bad = F.lit(False)
    if empty_frames:
        bad = bad | F.bool_and(zero).over(Window.partitionBy("clip", "t"))
    if low_confidence:
        bad = bad | (F.col("v") < threshold) | zero
    return long.withColumn("_bad", bad).select("clip", "t", "k", *(F.when(~F.col("_bad"), F.col(c)).alias(c) for c in "xyz"))


def scale(long: DataFrame, mode: str = "xy_isotropic_z_minmax") -> DataFrame:
    """Every clip moved to its minimum and divided by its range; null stays null, as does the sentinel by value.

    The ranges are a grouped aggregate with map-side combine that is joined back, so that a long clip is no single task.
    """
    if mode not in MODES:
        raise ValueError(f"no mode {mode!r}; there are {MODES}")
    sentinel = F.lit(MISSING).cast("float")
    real = F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull() & (F.col("x") != sentinel) & (F.col("y") != sentinel) & (F.col("z") != sentinel)
    long = long.select("clip", "t", "k", *(F.when(real, F.col(c).cast("float")).alias(c) for c in "xyz"))
    ends = long.groupBy("clip").agg(*(f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in (("lo", F.min), ("hi", F.max))))
    span = {c: F.col(f"{c}_hi") - F.col(f"{c}_lo") for c in "xyz"}
    if mode == "isotropic_3d":
        whole = F.greatest(*span.values())
        span = dict.fromkeys("xyz", whole)
    else:
        flat = F.greatest(span["x"], span["y"])
        span = {"x": flat, "y": flat, "z": span["z"]}
    moved = {c: F.col(c) - F.col(f"{c}_lo") for c in "xyz"}
    scaled = {c: F.when(F.col(c).isNull(), None).when(F.abs(span[c]) <= 1e-8, F.lit(0.0).cast("float")).otherwise((moved[c] / span[c]).cast("float")) for c in "xyz"}
    return long.join(ends, "clip").select("clip", "t", "k", *(v.alias(c) for c, v in scaled.items()))


def flatten(long: DataFrame, remove_z: bool = False, missing: float = MISSING, size: int | None = None) -> DataFrame:
    """(clip, t, values array<float>) with the landmarks in order and the sentinel for null. A frame that has fewer than ``size``
    landmarks is an error."""
    channels = "xy" if remove_z else "xyz"
    point = F.array(*(F.coalesce(F.col(c), F.lit(missing)).cast("float") for c in channels))
    rows = long.groupBy("clip", "t").agg(F.array_sort(F.collect_list(F.struct(F.col("k"), point.alias("p")))).alias("ps"))
    values = F.flatten(F.transform("ps", lambda p: p["p"]))
    if size is not None:
        short = F.raise_error(F.format_string(f"clip %s has no landmark for some of the {size} indices; check keypoint_preset", F.col("clip").cast("string")))
        values = F.when(F.size("ps") < size, short).otherwise(values)
    return rows.select("clip", "t", values.alias("values"))


def normalise(long: DataFrame, indices: list[int] | None = None, mode: str = "xy_isotropic_z_minmax", remove_z: bool = False, empty_frames: bool = True, low_confidence: bool = False, threshold: float = 0.3, missing: float = MISSING) -> DataFrame:
    """The whole recipe: gather, mask, scale, flatten."""
    masked_first = long
    if indices is not None:
        if not indices:
            raise ValueError("the list of landmarks is empty")
        spark = long.sparkSession
        wanted = spark.createDataFrame([(k, i) for i, k in enumerate(indices)], "k int, to int")
        masked_first = long.join(F.broadcast(wanted), "k").select("clip", "t", F.col("to").alias("k"), "x", "y", "z", "v")  # a preset is a few hundred rows
    return flatten(scale(mask(masked_first, empty_frames, low_confidence, threshold), mode), remove_z, missing, None if indices is None else len(indices))


def zero_frame(size: int) -> Column:
    zero = F.lit(0.0).cast("float")
    return F.array_repeat(F.struct(zero.alias("x"), zero.alias("y"), zero.alias("z"), zero.alias("v")), size)


def fill_failed(frame: Column, size: int) -> Column:
    """Frames whose extraction failed become zeros."""
    return F.coalesce(frame, zero_frame(size))


def holistic(pose: Column, face: Column, left: Column, right: Column, refined: bool = True) -> Column:
    """Pose, face and both hands in one frame; a missing group is zeros."""
    return F.concat(*(fill_failed(g, n) for g, n in ((pose, 33), (face, 478 if refined else 468), (left, 21), (right, 21))))


def from_pixels(point: Column, width: Column, height: Column) -> Column:
    """Pixel coordinates with a score as a landmark of a unit frame."""
    return F.struct((point["x"] / width).alias("x"), (point["y"] / height).alias("y"), point["z"].alias("z"), point["score"].alias("v"))


def packed(keypoints: Column, scores: Column, width: Column, height: Column) -> Column:
    """A model's key points (arrays x, y, z) and their scores as landmarks; null where either is missing or they don't match."""
    point = lambda k, s: F.struct(k[0].alias("x"), k[1].alias("y"), k[2].alias("z"), s.alias("score"))
    frame = F.zip_with(keypoints, scores, lambda k, s: from_pixels(point(k, s), width, height))
    return F.when(keypoints.isNotNull() & scores.isNotNull() & (F.size(keypoints) == F.size(scores)), frame)


def decode_bins(xs: Column, ys: Column, zs: Column, split: float, z_range: float, z_bins: int) -> Column:
    """A location from three lists of bin scores: the first highest bin of each; the lower of x's and y's maxima is the
    score, and without a positive one there is no location (-1)."""
    score = F.least(F.array_max(xs), F.array_max(ys))
    at = lambda a: (F.array_position(a, F.array_max(a)) - 1).cast("double")
    found = score > 0
    place = lambda a: F.when(found, at(a) / split).otherwise(F.lit(-1.0))
    depth = F.when(found, (at(zs) / (z_bins / 2) - 1) * z_range).otherwise(F.lit(-1.0))
    return F.struct(place(xs).alias("x"), place(ys).alias("y"), depth.alias("z"), score.alias("score"))


def encode_bins(mu: Column, bins: int, sigma: float) -> Column:
    """A Gaussian over bins around a location, cut at three sigma; zeros where the location is out of reach."""
    inside = (mu + 3 * sigma >= 0) & (mu - 3 * sigma < bins)
    return F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.when(inside & (F.abs(i - mu) <= 3 * sigma), F.exp(-F.pow(i - mu, 2) / (2 * sigma * sigma))).otherwise(0.0))


def to_camera(x: Column, y: Column, z: Column, centre: tuple[float, float], focal: tuple[float, float]) -> Column:
    """Image coordinates with a depth in the camera's space."""
    return F.struct(((x - centre[0]) / focal[0] * z).alias("x"), ((y - centre[1]) / focal[1] * z).alias("y"), z.alias("z"))


def joint_error(pred: Column, truth: Column, valid: Column) -> Column:
    """Mean distance of valid joints, as an aggregate."""
    square = lambda c: F.pow(pred[c] - truth[c], 2)
    return F.avg(F.when(valid, F.sqrt(square("x") + square("y") + square("z"))))

"""Bounding boxes: struct<x1, y1, x2, y2[, confidence]> and arrays of them, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.cast("double").alias("x1"), y1.cast("double").alias("y1"), x2.cast("double").alias("x2"), y2.cast("double").alias("y2"))


def area(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def keep_people(detections: Column, threshold: float, width: Column, height: Column, least_share: float) -> Column:
    """Detections of persons with enough confidence, whose area is a large enough share of the frame."""
    frame = width * height
    return F.filter(detections, lambda d: (d["label"] == 0) & (d["confidence"] >= threshold) & ((frame <= 0) | (area(d) / F.nullif(frame.cast("double"), F.lit(0.0)) >= least_share)))


def keep_label(detections: Column, label: int = 0) -> Column:
    return F.filter(detections, lambda d: d["label"] == label)


def from_landmarks(landmarks: Column, visible: float = 0.3) -> Column:
    """The box around the landmarks that can be seen, or null."""
    seen = F.filter(landmarks, lambda p: p["v"] > visible)
    xs, ys = F.transform(seen, lambda p: p["x"]), F.transform(seen, lambda p: p["y"])
    return F.when(F.size(seen) > 0, box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def single_person(frames: Column) -> Column:
    """Whether no frame has more than one detection; true for no frames."""
    return F.forall(frames, lambda f: F.size(f) <= 1)


def largest(detections: Column) -> Column:
    """The detection of the largest area; the first of equals; null for none."""
    return F.aggregate(detections, F.get(detections, F.lit(0)), lambda best, d: F.when(area(d) > area(best), d).otherwise(best))


def union(boxes: Column) -> Column:
    """The box around all boxes of an array; null for none."""
    boxes = F.filter(boxes, lambda b: b.isNotNull())
    side = lambda f, name: f(F.transform(boxes, lambda b: b[name]))
    return F.when(F.size(boxes) > 0, box(side(F.array_min, "x1"), side(F.array_min, "y1"), side(F.array_max, "x2"), side(F.array_max, "y2")))


def union_of_largest(frames: Column) -> Column:
    """The box around the largest detection of every frame."""
    return union(F.transform(frames, largest))


def pad(b: Column, share: float, width: Column, height: Column) -> Column:
    """A box grown by a share of its size on each side, in whole pixels towards zero, inside the frame."""
    px, py = (b["x2"] - b["x1"]) * share, (b["y2"] - b["y1"]) * share
    low = lambda x: F.greatest(F.lit(0), x.cast("int"))
    high = lambda x, most: F.least(most.cast("int"), x.cast("int"))
    return F.struct(low(b["x1"] - px).alias("x1"), low(b["y1"] - py).alias("y1"), high(b["x2"] + px, width).alias("x2"), high(b["y2"] + py, height).alias("y2"))


def for_pose(detections: Column, width: Column, height: Column) -> Column:
    """The first detection, or the whole frame."""
    first = F.get(detections, F.lit(0))
    whole = box(F.lit(0), F.lit(0), width, height)
    return F.when(first.isNotNull(), box(first["x1"], first["y1"], first["x2"], first["y2"])).otherwise(whole)


def full_frame(width: Column, height: Column) -> Column:
    """The detection of a detector that sees the whole frame as one person."""
    return F.array(F.struct(F.lit(0.0).alias("x1"), F.lit(0.0).alias("y1"), width.cast("double").alias("x2"), height.cast("double").alias("y2"), F.lit(1.0).alias("confidence")))


def crop_plan(b: Column, fps: Column, resize: tuple[int, int] | None = None) -> Column:
    """What a clip writer is told: size and place of the crop, rate and final size; null for a crop without area."""
    w, h = b["x2"] - b["x1"], b["y2"] - b["y1"]
    rw, rh = resize or (None, None)
    plan = F.struct(w.cast("int").alias("w"), h.cast("int").alias("h"), b["x1"].cast("int").alias("x"), b["y1"].cast("int").alias("y"), fps.cast("double").alias("fps"), F.lit(rw).cast("int").alias("to_w"), F.lit(rh).cast("int").alias("to_h"))
    return F.when((w > 0) & (h > 0), plan)


def from_json_cell(cell: Column) -> Column:
    """A box from JSON: a list of four numbers, or an object with it under ``bbox`` or else ``box``; else null."""
    v = F.try_parse_json(cell)
    numbers = F.coalesce(F.try_variant_get(v, "$", "array<double>"), F.try_variant_get(v, "$.bbox", "array<double>"), F.try_variant_get(v, "$.box", "array<double>"))
    at = lambda i: F.get(numbers, F.lit(i))
    return F.when(F.size(numbers) >= 4, box(at(0), at(1), at(2), at(3)))


def masks(faces: Column, width: Column, height: Column) -> Column:
    """Rectangles (x, y, w, h) cut to the frame, those without area left out."""
    cut = F.transform(faces, lambda f: F.struct(F.greatest(F.lit(0), f["x"]).alias("x"), F.greatest(F.lit(0), f["y"]).alias("y"), F.least(width, f["x"] + f["w"]).alias("x2"), F.least(height, f["y"] + f["h"]).alias("y2")))
    return F.transform(F.filter(cut, lambda c: (c["x2"] > c["x"]) & (c["y2"] > c["y"])), lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"), (c["x2"] - c["x"]).alias("w"), (c["y2"] - c["y"]).alias("h")))

"""Processing stages of jobs. Models, readers and writers come from tables by name; only those without a codec are built in.

A stage plans in expressions what each row needs (frames, boxes, crops), runs the model stage once, and returns rows with
a status. What is done already is left out before any model sees it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes, intervals, landmarks
from ..operators import availability, media, models
from ..operators import manifest as mf
from ..sinks import files
from ..sources import discovery, documents
from . import weights
from .runner import PROCESSORS, RECIPES, Run, pick, recorded, register

READERS: dict[str, Callable[[dict], models.FrameReader]] = {
    "fake": lambda o: models.FakeReader(o.get("width", 640), o.get("height", 480)),
    "ffmpeg": lambda o: media.FfmpegReader(o.get("ffmpeg", "ffmpeg"), o.get("ffprobe", "ffprobe")),
}
DETECTORS: dict[str, Callable[[dict], models.Detector]] = {"null": lambda o: models.WholeFrameDetector()}
#: What a detector's settings go through before its backend sees them.
SETTINGS: dict[str, Callable[[dict], dict]] = {"yolo": lambda o: {**o, "model": weights.resolve(o["model"], o["allow_download"], o["weights_dir"])}}
POSES: dict[str, Callable[[dict], models.PoseEstimator]] = {"fake": lambda o: models.FakePose(o.get("size", 133))}
WRITERS: dict[str, Callable[[dict], models.ClipWriter]] = {"ffmpeg": lambda o: media.FfmpegWriter(o.get("ffmpeg", "ffmpeg"), o.get("codec", "libx264"))}
DEFAULT_FPS = 30.0


def _folder(run: Run, *more: str) -> str:
    return "/".join([run.config["paths"]["output"], run.config["run_name"], *more])


def usable(df: DataFrame) -> DataFrame:
    """Rows that have a sample and all of their times."""
    return df.dropna(subset=[c for c in ("SAMPLE_ID", "START", "END") if c in df.columns])


def _planned(run: Run, rate: float | None, whole: bool = False) -> DataFrame:
    """The manifest's rows with VIDEO_PATH and the numbers of the frames to read."""
    df = run.manifest
    fps = F.coalesce(F.col("FPS"), F.lit(DEFAULT_FPS)) if "FPS" in df.columns else F.lit(DEFAULT_FPS)
    start = F.lit(0.0) if whole else F.col("START")
    frames = intervals.sample(intervals.frame_range(start, F.col("END"), fps), fps, intervals.effective_fps(rate, fps))
    videos = run.config["paths"]["videos"].rstrip("/")
    if discovery.is_folder(df.sparkSession, videos):
        df = mf.resolve_paths(df, documents.listing(df.sparkSession, videos), videos)
    else:
        df = df.withColumn("VIDEO_PATH", F.concat(F.lit(f"{videos}/"), mf.relative_path(df)))
    return df.withColumns({"frames": frames, "_fps": F.coalesce(intervals.effective_fps(rate, fps), fps)})


def _counted(run: Run, stage: str, done: DataFrame, **more) -> Run:
    """The run with the counters of what a stage did; one row comes to the driver."""
    counters = mf.stage_counters(done, "status").first().asDict()
    return Run(**{**run.__dict__, "stats": {**run.stats, stage: counters | more}})


def _backends(options: dict) -> tuple[Callable, Callable, int]:
    settings = SETTINGS.get(options["detection"], dict)(options.get("detection_config") or {})
    make_reader, make_detector = pick(READERS, options.get("reader", "fake")), pick(DETECTORS, options["detection"])
    return (lambda: make_reader(settings)), (lambda: make_detector(settings)), int(settings.get("batch_size", 16))


def _open(run: Run, rows: DataFrame, done: DataFrame | None, options: dict) -> DataFrame:
    return rows if done is None else availability.not_done(rows, done, force=bool(options.get("force_all")))


@register(PROCESSORS, "video2pose")
def video2pose(spark: SparkSession, run: Run, options: dict, done: DataFrame | None = None) -> tuple[Run, DataFrame]:
    """Landmarks of every segment with one person in it; a clip without any landmark isn't kept."""
    mf.timing_columns(run.manifest)
    reader, detector, batch = _backends(options)
    make_pose = pick(POSES, options["pose"])
    rows = _open(run, _planned(run, options.get("sample_rate")), done, options)
    found = models.run_pose(rows, reader, detector, lambda: make_pose(options.get("pose_config") or {}), batch)
    found = recorded(run.config, "poses", found.drop("detections"))
    frames = found.where("status = 'ok'").select(F.col("SAMPLE_ID").alias("sample"), F.posexplode("landmarks").alias("t", "frame"))
    seen = F.exists("frame", lambda p: (p["x"] != 0) | (p["y"] != 0) | (p["z"] != 0) | (p["v"] != 0))
    kept = frames.groupBy("sample").agg(F.bool_or(seen).alias("any")).where("any").select("sample")
    flat = F.flatten(F.transform("frame", lambda p: F.array(p["x"], p["y"], p["z"], p["v"])))
    written = files.write_arrays(frames.join(kept, "sample").select("sample", "t", flat.alias("values")), _folder(run, "landmarks"))
    return _counted(run, "video2pose", found), recorded(run.config, "landmarks", written).select("path")


def _crops(df: DataFrame, box, options: dict) -> DataFrame:
    video = options.get("video_config") or {}
    width, height = F.coalesce(F.col("SRC_WIDTH"), F.lit(640)), F.coalesce(F.col("SRC_HEIGHT"), F.lit(480))
    for c in ("SRC_WIDTH", "SRC_HEIGHT"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("long"))
    padded = boxes.pad(box, float(video.get("padding") or 0.0), width, height)
    return df.withColumn("crop", boxes.crop_plan(padded, F.col("_fps"), tuple(video["resize"]) if video.get("resize") else None))


def _write(run: Run, stage: str, rows: DataFrame, options: dict) -> tuple[Run, DataFrame]:
    make = pick(WRITERS, options.get("writer", "ffmpeg"))
    done = recorded(run.config, stage, models.run_clips(rows, lambda: make(options.get("video_config") or {})))
    return _counted(run, stage, done), done.where("status = 'ok'").select("path").distinct()


@register(PROCESSORS, "video2crop")
def video2crop(spark: SparkSession, run: Run, options: dict, done: DataFrame | None = None) -> tuple[Run, DataFrame]:
    """Each segment cropped to the box around its one person."""
    reader, detector, batch = _backends(options)
    rows = _open(run, _planned(run, options.get("sample_rate")), done, options)
    found = models.run_detection(rows, reader, detector, batch).where("status = 'ok'").where(boxes.single_person(F.col("detections")))
    boxed = rows.join(found.select("SAMPLE_ID", boxes.union_of_largest(F.col("detections")).alias("_box")), "SAMPLE_ID").where("_box is not null")
    target = F.concat(F.lit(_folder(run, "clips") + "/"), "SAMPLE_ID", F.lit(".mp4"))
    return _write(run, "video2crop", _crops(boxed, F.col("_box"), options).where("crop is not null").withColumn("TARGET", target), options)


@register(PROCESSORS, "video2compression")
def video2compression(spark: SparkSession, run: Run, options: dict) -> tuple[Run, DataFrame]:
    """Each video once, whole, cropped to the box around everything that was detected in it."""
    reader, detector, batch = _backends(options)
    spans = run.manifest.withColumn("_out", mf.output_path(run.manifest))
    ends = spans.groupBy("_out").agg(F.max("END").alias("END"))
    first = mf.first_of(spans.drop("END"), ["_out"], ["SAMPLE_ID"]).join(ends, "_out")
    rows = _planned(Run(run.config, first), options.get("sample_rate"), whole=True)
    found = models.run_detection(rows, reader, detector, batch).where("status = 'ok'")
    boxed = rows.join(found.select("SAMPLE_ID", boxes.union(F.flatten("detections")).alias("_box")), "SAMPLE_ID").where("_box is not null")
    target = F.concat(F.lit(_folder(run, "compressed") + "/"), "_out")
    return _write(run, "video2compression", _crops(boxed, F.col("_box"), options).where("crop is not null").withColumns({"TARGET": target, "START": F.lit(0.0)}), options)


@register(PROCESSORS, "clip_video")
def clip_video(spark: SparkSession, run: Run, options: dict) -> tuple[Run, DataFrame]:
    """Each timed segment as a clip of its own."""
    rows = usable(_planned(run, None))
    target = F.concat(F.lit(_folder(run, "clips") + "/"), "SAMPLE_ID", F.lit(".mp4"))
    return _write(run, "clip_video", rows.withColumns({"TARGET": target, "crop": F.lit(None).cast("struct<w:int,h:int,x:int,y:int,fps:double,to_w:int,to_h:int>")}), options)


@register(PROCESSORS, "obfuscate")
def obfuscate(spark: SparkSession, run: Run, options: dict) -> tuple[Run, DataFrame]:
    """Each video once, for a writer that blurs the faces it finds."""
    rows = _planned(run, None).withColumn("_out", mf.output_path(run.manifest))
    once = mf.first_of(rows.drop("frames"), ["_out"], ["SAMPLE_ID"])
    target = F.concat(F.lit(_folder(run, "obfuscated") + "/"), "_out")
    return _write(run, "obfuscate", once.withColumns({"TARGET": target, "crop": F.lit(None).cast("struct<w:int,h:int,x:int,y:int,fps:double,to_w:int,to_h:int>")}), {"writer": "obfuscate", **options})


@register(RECIPES, "normalize")
def normalize(spark: SparkSession, run: Run, options: dict) -> tuple[Run, DataFrame]:
    """The landmark files of this run, normalised; clips that are there already are left out, unless forced. A clip that can't
    be normalised is counted as an error, the others go on."""
    from .config import NORMALIZE_DEFAULTS

    o = {**NORMALIZE_DEFAULTS, **options}
    clips = documents.landmark_arrays(spark, _folder(run, "landmarks"))
    there = documents.artifacts(spark, _folder(run, "normalized"), "npy").select("SAMPLE_ID")
    clips = availability.not_done(clips, there, "sample", force=bool(options.get("force_all")))
    indices = landmarks.resolve_preset(o["keypoint_preset"], o["keypoint_indices"]) if o["select_keypoints"] else None
    status = clips.groupBy("sample").agg(F.min(F.size("frame")).alias("size"))
    if indices is not None:
        landmarks.gather(F.col("frame"), indices)  # an empty list is an error of the job
        status = status.withColumn("status", F.when(F.col("size") > max(indices), "ok").otherwise("error"))
    else:
        status = status.withColumn("status", F.lit("ok"))
    status = recorded(run.config, "normalisable", status)
    good = clips.join(status.where("status = 'ok'").select("sample"), "sample", "left_semi")
    out = landmarks.normalise(landmarks.to_long(good, "sample", "t", "frame"), indices, o["mode"], o["remove_z"], o["mask_empty_frames"], o["mask_low_confidence"], o["visibility_threshold"], o["missing_value"])
    written = files.write_arrays(out.withColumnRenamed("clip", "sample"), _folder(run, "normalized"))
    return _counted(run, "normalize", status, kept=there.count()), recorded(run.config, "normalized", written).select("path")

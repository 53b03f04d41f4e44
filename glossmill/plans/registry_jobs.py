"""Queries over whole stages: models with fakes, jobs, settings, acquisition, releases; and functions of boxes and landmarks."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes, intervals, landmarks
from ..functions import text as tx
from ..operators import acquire, availability, media, models
from ..operators import manifest as mf
from ..session import work_folder
from ..sinks import files
from ..sources import discovery, documents
from . import acquirers, adapters, processors, runner, weights
from . import config as cfg
from .registry import _BOX, ORACLES, Query, _boxes, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


def _text(c: str):
    return F.col(c).cast("string")


def _values(rows: list[tuple[str, str]], names: str) -> str:
    quoted = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {quoted}) t({names})"


class Crowd(models.WholeFrameDetector):
    """Two persons where the path says so; no more than three frames at once."""

    def detect(self, frames: list) -> list[list[dict]]:
        if len(frames) > 3:
            raise models.OutOfMemory("at most three frames")
        return [d * 2 if "two" in f[0] else d for f, d in zip(frames, super().detect(frames))]


class Described(models.ClipWriter):
    """Writes the call that would make the clip in place of the clip."""

    def write(self, source: str, target: str, start: float, end: float, crop) -> bool:
        call = media.clip_command(os.path.basename(source), os.path.basename(target), start, end, crop if crop is None or isinstance(crop, dict) else crop.asDict())
        if call is not None:
            files._atomic(target, " ".join(call).encode())
        return call is not None


class Lengths(models.MediaProbe):
    """The length is the number in the file's name; a name without one can't be read."""

    def probe(self, path: str) -> tuple[float, float]:
        digits = "".join(c for c in os.path.splitext(os.path.basename(path))[0] if c.isdigit())
        return (25.0, float(int(digits) % 40)) if digits else (0.0, 0.0)


class Picky(acquire.Fetcher):
    """Fails for ids that end in 3."""

    def fetch(self, video_id: str) -> None:
        if video_id.endswith("3"):
            raise RuntimeError(f"{video_id} is private")


# ---- functions of boxes and landmarks


@query("SELECT vec_id, (vec_id % 3 = 0)::INTEGER + (vec_id % 2 = 0)::INTEGER AS persons FROM embeddings")
def keep_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections of persons only, whatever their score."""
    one = lambda flag: F.struct(F.lit(0.01).alias("confidence"), F.when(flag, 0).otherwise(7).alias("label"))
    found = F.array(one(F.col("vec_id") % 3 == 0), one(F.col("vec_id") % 2 == 0))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(boxes.keep_label(found)).alias("persons"))


_POINTS = "SELECT vec_id, unnest([{'x': embedding[4*i+1], 'y': embedding[4*i+2], 'v': embedding[4*i+4]} for i in range(16)]) AS p FROM embeddings"


@query(f"SELECT vec_id, min(p.x)::DOUBLE AS x1, min(p.y)::DOUBLE AS y1, max(p.x)::DOUBLE AS x2, max(p.y)::DOUBLE AS y2 FROM ({_POINTS}) WHERE p.v > 0.1::FLOAT GROUP BY vec_id")
def visible_box(spark, sf_dir):
    """The box around the landmarks that can be seen; frames without any have none."""
    box = boxes.from_landmarks(landmarks.points(F.col("embedding")), 0.1)
    return table(spark, sf_dir, "embeddings").select("vec_id", box.alias("b")).where("b is not null").select("vec_id", "b.*")


@query(f"""SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 0 ELSE x1 END AS x1, CASE WHEN vec_id % 3 = 0 THEN 0 ELSE y1 END AS y1, CASE WHEN vec_id % 3 = 0 THEN 640 ELSE x2 END AS x2, CASE WHEN vec_id % 3 = 0 THEN 480 ELSE y2 END AS y2 FROM ({_BOX})""")
def box_for_pose(spark, sf_dir):
    """The first detection of a frame, or the whole frame."""
    found = F.when(F.col("vec_id") % 3 == 0, F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double>>")).otherwise(F.array("box", boxes.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1))))
    return _boxes(spark, sf_dir).select("vec_id", boxes.for_pose(found, F.lit(640), F.lit(480)).alias("b")).select("vec_id", "b.*")


@query("SELECT c_custkey, c_custkey % 200 AS width, 1.0::DOUBLE AS confidence FROM customer")
def whole_frame(spark, sf_dir):
    """The detection of a detector that takes the whole frame for a person."""
    found = boxes.full_frame(F.col("c_custkey") % 200, F.lit(10))
    return table(spark, sf_dir, "customer").select("c_custkey", F.get(found, F.lit(0)).alias("d")).select("c_custkey", F.col("d.x2").cast("long").alias("width"), "d.confidence")


@query("""SELECT vec_id, greatest(0, x)::INTEGER AS x, greatest(0, y)::INTEGER AS y, (least(100, x + 30) - greatest(0, x))::INTEGER AS w, (least(80, y + 20) - greatest(0, y))::INTEGER AS h
    FROM (SELECT vec_id, vec_id % 160 - 40 AS x, vec_id % 120 - 30 AS y FROM embeddings) WHERE least(100, x + 30) > greatest(0, x) AND least(80, y + 20) > greatest(0, y)""")
def face_masks(spark, sf_dir):
    """Rectangles cut to the frame; those outside go."""
    face = F.struct((F.col("vec_id") % 160 - 40).cast("int").alias("x"), (F.col("vec_id") % 120 - 30).cast("int").alias("y"), F.lit(30).alias("w"), F.lit(20).alias("h"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.explode(boxes.masks(F.array(face), F.lit(100), F.lit(80))).alias("m")).select("vec_id", "m.*")


@query("""SELECT label AS clip, vec_id AS t, k::INTEGER AS k, CASE WHEN vec_id % 5 > 0 THEN embedding[4 * k + 1] END AS x, CASE WHEN vec_id % 5 > 0 THEN embedding[4 * k + 2] END AS y, CASE WHEN vec_id % 5 > 0 THEN embedding[4 * k + 3] END AS z FROM embeddings, range(0, 16) r(k)""")
def mask_empty_frames(spark, sf_dir):
    """Every fifth frame is zero throughout, so all its points are missing."""
    flat = F.transform("embedding", lambda x: F.when(F.col("vec_id") % 5 == 0, F.lit(0.0).cast("float")).otherwise(x))
    clips = table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), F.col("vec_id").alias("t"), landmarks.points(flat).alias("frame"))
    return landmarks.mask(landmarks.to_long(clips, "clip", "t", "frame"))


@query("""WITH l AS (SELECT label AS clip, vec_id AS t, k, CASE WHEN (vec_id + k) % 4 > 0 THEN embedding[4 * k + 1] END AS x, embedding[4 * k + 2] AS y, embedding[4 * k + 3] AS z FROM embeddings, range(0, 16) r(k)),
    e AS (SELECT clip, min(x) AS x0, max(x) - min(x) AS xr, min(y) AS y0, max(y) - min(y) AS yr, min(z) AS z0, max(z) - min(z) AS zr FROM l WHERE x IS NOT NULL GROUP BY clip)
    SELECT clip, t, k::INTEGER AS k, round(coalesce(((x - x0)::DOUBLE / greatest(xr, yr, zr))::FLOAT, -999)::DOUBLE, 5) AS x, round(CASE WHEN x IS NULL THEN -999 ELSE ((y - y0)::DOUBLE / greatest(xr, yr, zr))::FLOAT END::DOUBLE, 5) AS y FROM l JOIN e USING (clip)""")
def scale_around_missing(spark, sf_dir):
    """Missing points, by sentinel, take no part in a clip's range and stay missing."""
    clips = table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), F.col("vec_id").alias("t"), landmarks.points(F.col("embedding")).alias("frame"))
    long = landmarks.to_long(clips, "clip", "t", "frame")
    gone = (F.col("t") + F.col("k")) % 4 == 0
    out = landmarks.scale(long.withColumn("x", F.when(gone, F.lit(landmarks.MISSING).cast("float")).otherwise(F.col("x"))), "isotropic_3d")
    shown = lambda c: F.round(F.coalesce(F.col(c), F.lit(landmarks.MISSING)).cast("double"), 5).alias(c)
    return out.select("clip", "t", "k", shown("x"), shown("y"))


_PRESET = landmarks.PRESETS["mmpose_133_to_85"]


@query(f"SELECT vec_id, (i - 1)::INTEGER AS i, embedding[(list_extract({_PRESET}, i) * 4) % 64 + 1] AS x FROM embeddings, range(1, {len(_PRESET) + 1}) r(i)")
def preset_gather(spark, sf_dir):
    """The landmarks of a preset, in its order, from frames of 133."""
    wide = F.slice(F.flatten(F.array_repeat(landmarks.points(F.col("embedding")), 9)), 1, 133)
    taken = landmarks.gather(wide, landmarks.resolve_preset("mmpose_133_to_85", [1, 2]), 133)
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(taken).alias("i", "p")).select("vec_id", "i", "p.x")


@query("""SELECT vec_id, 543::INTEGER AS size, CASE WHEN vec_id % 2 = 0 THEN embedding[1] ELSE 0 END::FLOAT AS first, CASE WHEN vec_id % 3 = 0 THEN embedding[1] ELSE 0 END::FLOAT AS hand FROM embeddings""")
def holistic_frames(spark, sf_dir):
    """Pose, face and hands in one frame; what failed is zeros."""
    first = F.get(landmarks.points(F.col("embedding")), F.lit(0))
    group = lambda n, there: F.when(there, F.array_repeat(first, n))
    frame = landmarks.holistic(group(33, F.col("vec_id") % 2 == 0), group(468, F.lit(False)), group(21, F.col("vec_id") % 3 == 0), group(21, F.lit(True)), refined=False)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", frame.alias("f"))
    return rows.select("vec_id", F.size("f").alias("size"), F.get("f", F.lit(0))["x"].alias("first"), F.get("f", F.lit(501))["x"].alias("hand"))


@query("SELECT vec_id, k::INTEGER AS k, CASE WHEN vec_id % 4 = 0 THEN 0 ELSE embedding[4 * k + 1] END::FLOAT AS x, CASE WHEN vec_id % 4 = 0 THEN 0 ELSE embedding[4 * k + 4] END::FLOAT AS v FROM embeddings, range(0, 16) r(k)")
def failed_frames(spark, sf_dir):
    """Frames whose extraction failed are zeros of the usual size."""
    frame = F.when(F.col("vec_id") % 4 > 0, landmarks.points(F.col("embedding")))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(landmarks.fill_failed(frame, 16)).alias("k", "p")).select("vec_id", "k", "p.x", "p.v")


@query("SELECT vec_id, round(embedding[1] / 640::DOUBLE, 9) AS x, round(embedding[2] / 480::DOUBLE, 9) AS y, round((embedding[1] - 320::DOUBLE) / 500 * embedding[3], 6) AS cx, round((embedding[2] - 240::DOUBLE) / 400 * embedding[3], 6) AS cy FROM embeddings")
def pixels_and_camera(spark, sf_dir):
    """Pixels as shares of the frame, and image coordinates in the camera's space."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    point = F.struct(at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), at(3).alias("score"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", landmarks.from_pixels(point, F.lit(640), F.lit(480)).alias("p"), landmarks.to_camera(at(0), at(1), at(2), (320.0, 240.0), (500.0, 400.0)).alias("c"))
    return rows.select("vec_id", F.round("p.x", 9).alias("x"), F.round("p.y", 9).alias("y"), F.round("c.x", 6).alias("cx"), F.round("c.y", 6).alias("cy"))


@query("SELECT p_partkey, i::INTEGER AS i, round(CASE WHEN p_size - 20 + 6 >= 0 AND p_size - 20 - 6 < 24 AND abs(i - (p_size - 20)) <= 6 THEN exp(-power(i - (p_size - 20), 2) / 8.0) ELSE 0 END, 9) AS v FROM part, range(0, 24) r(i)")
def encoded_bins(spark, sf_dir):
    """A location as a bell over bins, cut at three sigma; nothing for one that is out of reach."""
    bins = landmarks.encode_bins((F.col("p_size") - 20).cast("double"), 24, 2.0)
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(bins).alias("i", "v")).select("p_partkey", "i", F.round("v", 9).alias("v"))


@query("SELECT vec_id, k::INTEGER AS k, embedding[k + 1] / 640::DOUBLE AS x, embedding[k + 21]::DOUBLE AS v FROM embeddings, range(0, 10) r(k) WHERE vec_id % 3 > 0")
def packed_keypoints(spark, sf_dir):
    """Key points and scores of a model as landmarks; a frame that lacks either has none."""
    at = lambda i: F.get("embedding", i).cast("double")
    keypoints = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.array(at(k), at(k + 10), F.lit(0.0)))
    scores = F.when(F.col("vec_id") % 3 > 0, F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: at(k + 20)))
    frame = landmarks.packed(keypoints, scores, F.lit(640), F.lit(480))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(frame).alias("k", "p")).select("vec_id", "k", "p.x", "p.v")


@query("SELECT p_partkey, p_size / 2.0::DOUBLE AS real, CASE WHEN p_size % 2 = 0 THEN p_size::BIGINT END AS whole FROM part")
def safe_numbers(spark, sf_dir):
    """Numbers out of cells, null where there is none."""
    p = table(spark, sf_dir, "part")
    real = tx.real(F.concat(F.lit(" "), (F.col("p_size") / 2.0).cast("string"), F.lit(" ")))
    whole = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit(" "), _text("p_size"))).otherwise(F.concat(_text("p_size"), F.lit("x")))
    none = F.coalesce(tx.real(F.lit("nan")), tx.real(F.lit("x")), tx.whole(F.lit("1.5")).cast("double"))
    return p.select("p_partkey", F.coalesce(none, real).alias("real"), tx.whole(whole).alias("whole"))


@query('SELECT s_suppkey AS SAMPLE_ID, s_acctbal AS START, s_name AS SIGNER_ID FROM supplier WHERE s_suppkey % 3 > 0 AND s_nationkey % 4 > 0')
def pruned_columns(spark, sf_dir):
    """Columns that are there are kept or renamed, others aren't missed; rows without a key or a time go."""
    s = table(spark, sf_dir, "supplier").select("s_name", F.when(F.col("s_suppkey") % 3 > 0, F.col("s_suppkey")).alias("SAMPLE_ID"), F.when(F.col("s_nationkey") % 4 > 0, F.col("s_acctbal")).alias("START"))
    named = s.select("SAMPLE_ID", "START", *mf.passthrough(s, {"s_name": "SIGNER_ID", "absent": "SPLIT"}))
    return processors.usable(mf.keep_columns(named, ["SAMPLE_ID", "START", "END", "SIGNER_ID"]))


# ---- stages with models


@query("""WITH f AS (SELECT p_partkey, p_size + i AS f, i, k FROM part, range(0, 4) a(i), range(0, 6) b(k))
    SELECT p_partkey::VARCHAR AS SAMPLE_ID, CASE WHEN p_partkey % 7 = 0 THEN 'skipped' ELSE 'ok' END AS status, CASE WHEN p_partkey % 7 > 0 THEN i END::INTEGER AS t, CASE WHEN p_partkey % 7 > 0 THEN k END::INTEGER AS k,
        CASE WHEN p_partkey % 7 > 0 THEN CASE WHEN f % 5 = 0 THEN 0 ELSE ((f + k) % 7 / 7.0)::FLOAT END END::FLOAT AS x, CASE WHEN p_partkey % 7 > 0 THEN CASE WHEN f % 5 = 0 THEN 0 ELSE 1 END END::FLOAT AS v FROM f WHERE p_partkey % 7 > 0 OR (i = 0 AND k = 0)""")
def pose_stage(spark, sf_dir):
    """Landmarks of every frame; segments with two persons are skipped, frames that fail are zeros, batches fit the device."""
    rows = table(spark, sf_dir, "part").select(_text("p_partkey").alias("SAMPLE_ID"), F.when(F.col("p_partkey") % 7 == 0, "two").otherwise("one").alias("VIDEO_PATH"), F.sequence(F.col("p_size"), F.col("p_size") + 3).alias("frames"))
    found = models.run_pose(rows, models.FakeReader, Crowd, lambda: models.FakePose(6, fails=5), 16)
    frames = found.select("SAMPLE_ID", "status", F.posexplode_outer("landmarks").alias("t", "frame"))
    return frames.select("SAMPLE_ID", "status", "t", F.posexplode_outer("frame").alias("k", "p")).select("SAMPLE_ID", "status", "t", "k", "p.x", "p.v")


@query("SELECT s_suppkey::VARCHAR AS SAMPLE_ID, 'ok' AS status, (s_suppkey % 9)::INTEGER AS frames, (CASE WHEN s_suppkey % 5 = 0 THEN 2 ELSE 1 END * (s_suppkey % 9))::INTEGER AS persons FROM supplier")
def detection_stage(spark, sf_dir):
    """Detections by a detector whose batches are too large at first and are halved until they fit."""
    n = (F.col("s_suppkey") % 9).cast("int")
    frames = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    rows = table(spark, sf_dir, "supplier").select(_text("s_suppkey").alias("SAMPLE_ID"), F.when(F.col("s_suppkey") % 5 == 0, "two").otherwise("one").alias("VIDEO_PATH"), frames.alias("frames"))
    found = models.run_detection(rows, models.FakeReader, Crowd, 16)
    return found.select("SAMPLE_ID", "status", F.size("detections").alias("frames"), F.coalesce(F.aggregate("detections", F.lit(0), lambda a, d: a + F.size(d)), F.lit(0)).alias("persons"))


@query("SELECT n_name AS VIDEO_PATH, CASE WHEN n_nationkey % 2 = 0 THEN 25 ELSE 0 END::DOUBLE AS fps, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey % 40 ELSE 0 END::DOUBLE AS duration FROM (SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'v/clip' || n_nationkey || '.mp4' ELSE 'v/none.mov' END AS n_name, n_nationkey FROM nation)")
def probed_videos(spark, sf_dir):
    """Rates and lengths by a probe; files that can't be read have zeros."""
    path = F.when(F.col("n_nationkey") % 2 == 0, F.format_string("v/clip%d.mp4", "n_nationkey")).otherwise("v/none.mov")
    return models.run_probe(table(spark, sf_dir, "nation").select(path.alias("VIDEO_PATH")), Lengths).select("VIDEO_PATH", "fps", "duration")


def _job(spark: SparkSession, sf_dir: str, name: str, processor: str) -> runner.Run:
    """A run over the suppliers as segments of half a second of the nations' videos, with files for the videos."""
    folder = work_folder(spark, name)
    config = cfg.check({"dataset": "how2sign", "processing": {"processor": "video2crop"}})
    config["processing"]["processor"] = processor
    config["paths"] |= {"root": folder, "videos": f"{folder}/videos", "output": f"{folder}/out", "webdataset": f"{folder}/tars"}
    s = table(spark, sf_dir, "supplier")
    stem = F.format_string("v%d", "s_nationkey")
    videos = s.select(F.concat(stem, F.when(F.col("s_nationkey") % 2 == 0, ".mp4").otherwise(".webm")).alias("name"), F.lit("x").alias("payload")).distinct()
    files.write_blobs(videos, f"{folder}/videos").write.format("noop").mode("overwrite").save()
    start = (F.col("s_suppkey") % 3).cast("double")
    return runner.Run(config, s.select(_text("s_suppkey").alias("SAMPLE_ID"), stem.alias("VIDEO_ID"), start.alias("START"), (start + 0.5).alias("END"), F.col("s_name").alias("TEXT")))


_META = """'{"video_id":"v' || s_nationkey || '","sample_id":"' || s_suppkey || '","start":' || (s_suppkey % 3)::DOUBLE || ',"end":' || (s_suppkey % 3 + 0.5)::DOUBLE || ',"processor":"video2pose"}'"""


@query(f"""WITH n AS (SELECT *, (row_number() OVER (ORDER BY s_suppkey::VARCHAR) - 1) // 16 AS shard FROM supplier)
    SELECT printf('shard-%06d.tar', shard) AS shard, s_suppkey::VARCHAR AS key, unnest(['json', 'npy', 'txt']) AS ext, unnest([length({_META}), 128 + 8 * 170 * 4, length(s_name)])::INTEGER AS bytes FROM n""")
def job_poses(spark, sf_dir):
    """Poses of every segment, normalised to 85 landmarks without depth, in shards of 16 beside captions and facts."""
    run = _job(spark, sf_dir, "poses", "video2pose")
    run, _ = processors.video2pose(spark, run, {"detection": "null", "pose": "fake", "sample_rate": 0.5, "pose_config": {"size": 133}})
    run, _ = processors.normalize(spark, run, {"keypoint_preset": "mmpose_133_to_85", "remove_z": True})
    run, _ = runner.webdataset(spark, run, {"config": {"max_shard_count": 16}})
    return documents.tar_members(spark, run.config["paths"]["webdataset"]).select("shard", "key", "ext", F.octet_length("payload").alias("bytes"))


@query("""SELECT * FROM (SELECT 'video2pose' AS stage, count(*) AS total, count(*) AS processed, 0::BIGINT AS skipped, 0::BIGINT AS errors FROM supplier UNION ALL SELECT 'normalize', count(*), count(*), 0, 0 FROM supplier
    UNION ALL SELECT 'again', 0, 0, 0, 0 UNION ALL SELECT 'output', count(*), count(*), 0, 0 FROM supplier)""")
def job_counters(spark, sf_dir):
    """What the stages of a job count; what is done already isn't done again."""
    run = _job(spark, sf_dir, "counters", "video2pose")
    run, _ = processors.video2pose(spark, run, {"detection": "null", "pose": "fake", "sample_rate": 0.5, "pose_config": {"size": 133}})
    run, _ = processors.normalize(spark, run, {"keypoint_preset": "mmpose_133_to_85"})
    again, _ = processors.normalize(spark, run, {"keypoint_preset": "mmpose_133_to_85"})
    run, _ = runner.webdataset(spark, run, {"config": {"max_shard_size": 1000}})
    stats = run.stats | {"again": again.stats["normalize"]}
    rows = [(n, stats[n]["total"], stats[n]["processed"], stats[n]["skipped"], stats[n]["errors"]) for n in ("video2pose", "normalize", "again")]
    rows.append(("output", stats["output"]["written"] + stats["output"]["skipped"], stats["output"]["written"], stats["output"]["skipped"], 0))
    return spark.createDataFrame(rows, "stage string, total long, processed long, skipped long, errors long")


_CALL = "'ffmpeg -y -ss ' || {start} || ' -i v' || s_nationkey || CASE WHEN s_nationkey % 2 = 0 THEN '.mp4' ELSE '.webm' END || ' -t ' || {length} || '{filters} -c:v libx264 -preset medium -crf 15 -an -v error ' || {target} || '.mp4'"
_HALF = _CALL.format(start="(s_suppkey % 3)::DOUBLE", length="0.5", filters="{filters}", target="s_suppkey")
_WHOLE = _CALL.format(start="0.0", length="max((s_suppkey % 3)::DOUBLE + 0.5)", filters="{filters}", target="'v' || s_nationkey")


@query(f"""SELECT 'clip_video' AS stage, s_suppkey::VARCHAR AS name, {_HALF.format(filters="")} AS call FROM supplier
    UNION ALL SELECT 'video2crop', s_suppkey::VARCHAR, {_HALF.format(filters=" -vf fps=15.0,crop=640:480:0:0,scale=224:224")} FROM supplier
    UNION ALL SELECT 'video2compression', 'v' || s_nationkey, {_WHOLE.format(filters=" -vf fps=30.0,crop=640:480:0:0")} FROM supplier GROUP BY s_nationkey""")
def job_clips(spark, sf_dir):
    """The calls that make clips: of segments, of segments cropped to their person, and of whole videos, once each."""
    run = _job(spark, sf_dir, "clips", "video2crop")
    processors.WRITERS["described"] = lambda o: Described()
    options, out = {"detection": "null", "writer": "described"}, []
    stages = ("clip_video", processors.clip_video, {}, "clips"), ("video2crop", processors.video2crop, {"sample_rate": 0.5, "video_config": {"resize": [224, 224]}}, "cropped"), ("video2compression", processors.video2compression, {"sample_rate": None}, "compressed")
    for name, stage, more, kept in stages:
        config = {**run.config, "run_name": kept}
        stage(spark, runner.Run(config, run.manifest), options | more)
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").option("recursiveFileLookup", True).load(f"{run.config['paths']['output']}/{kept}")
        out.append(found.select(F.lit(name).alias("stage"), tx.stem(F.col("path")).alias("name"), F.col("content").cast("string").alias("call")))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""WITH v AS (SELECT s_nationkey, max((s_suppkey % 3)::DOUBLE + 0.5) AS e FROM supplier GROUP BY 1), d AS (SELECT s_nationkey, CASE WHEN s_nationkey % 40 > 0 THEN (s_nationkey % 40)::DOUBLE ELSE e END AS e FROM v),
    w AS (SELECT *, i * 3.0 AS a, least(i * 3.0 + 6, e) AS b FROM d, range(0, 100) r(i) WHERE i * 3.0 < e AND e >= 0.5)
    SELECT 'v' || s_nationkey || '_w' || printf('%03d', i) AS SAMPLE_ID, 'v' || s_nationkey AS VIDEO_ID, a::DOUBLE AS START, b::DOUBLE AS "END" FROM w WHERE b - a >= 0.5""")
def job_windows(spark, sf_dir):
    """Windows over videos as long as a probe says, or up to the last caption where it can't; written as a manifest and read."""
    run = _job(spark, sf_dir, "windows", "window_video")
    adapters.PROBES["lengths"] = lambda o: Lengths()
    run.config["dataset"]["source"]["probe"] = "lengths"
    _, written = runner.window_video(spark, run, {"window": {"size": 6, "stride": 3, "min": 0.5}})
    from ..sources import tables

    return tables.manifest(spark, written.first()["path"])


# ---- acquisition, releases, settings


@query("""WITH w AS (SELECT DISTINCT c_custkey::VARCHAR AS v FROM customer WHERE c_custkey % 4 > 0)
    SELECT 'wanted' AS name, count(*)::VARCHAR AS value FROM w UNION ALL SELECT 'downloaded', (count(*) FILTER (NOT v LIKE '%3'))::VARCHAR FROM w UNION ALL SELECT 'errors', (count(*) FILTER (v LIKE '%3'))::VARCHAR FROM w
    UNION ALL SELECT v, v || ' is private' FROM w WHERE v LIKE '%3'""")
def acquisition(spark, sf_dir):
    """Ids that aren't on disk are fetched in order; failures go to a report with their reasons."""
    folder = work_folder(spark, "acquire")
    c = table(spark, sf_dir, "customer").select(_text("c_custkey").alias("id"), "c_custkey")
    c.select("id").unionByName(c.select("id")).coalesce(1).write.text(f"{folder}/ids")
    there = c.where("c_custkey % 4 = 0").select(F.concat("id", F.lit(".mp4")).alias("name"), F.lit("x").alias("payload"))
    files.write_blobs(there, f"{folder}/videos").write.format("noop").mode("overwrite").save()
    acquirers.FETCHERS["picky"] = lambda o: Picky()
    config = cfg.check({"dataset": {"name": "youtube_asl", "source": {"video_ids_file": f"{folder}/ids", "fetcher": "picky", "pause": 0.0}}})
    config["paths"] |= {"root": folder, "videos": f"{folder}/videos", "transcripts": f"{folder}/transcripts"}
    stats = acquirers.acquire(spark, config)["videos"]
    report = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/acquire_report/missing_videos")
    counted = spark.createDataFrame([(n, str(stats[n])) for n in ("wanted", "downloaded", "errors")], "name string, value string")
    return counted.unionByName(report.select(F.col("VIDEO_ID").alias("name"), F.col("REASON").alias("value")))


@query("""SELECT 'openasl' AS dataset, c_nationkey::VARCHAR AS VIDEO_ID FROM customer WHERE c_nationkey > 0 GROUP BY 2 UNION ALL SELECT 'msasl', printf('%011d', user_id) FROM events GROUP BY 2
    UNION ALL SELECT 'wlasl', o_custkey::VARCHAR || '/' || max(o_orderkey) FROM orders WHERE o_orderkey % 3 > 0 GROUP BY o_custkey""")
def wanted_videos(spark, sf_dir):
    """The videos that each source wants: without blanks and repeats, from links, and with the last link of an id."""
    yid = F.when(F.col("c_nationkey") > 0, _text("c_nationkey")).otherwise(" ")
    a = acquire.wanted_openasl(table(spark, sf_dir, "customer").select(yid.alias("yid")))
    b = acquire.wanted_msasl(table(spark, sf_dir, "events").select(F.format_string("https://youtu.be/%011d?t=1", "user_id").alias("url")))
    o = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 > 0, _text("o_orderkey")).alias("url"), _text("o_custkey").alias("video_id"), F.col("o_orderkey").alias("i"), F.lit(0).alias("j"))
    c = acquire.wanted_wlasl(o).select(F.concat_ws("/", "VIDEO_ID", "url").alias("VIDEO_ID"))
    return a.select(F.lit("openasl").alias("dataset"), "VIDEO_ID").unionByName(b.select(F.lit("msasl").alias("dataset"), "VIDEO_ID")).unionByName(c.select(F.lit("wlasl").alias("dataset"), "VIDEO_ID"))


_RELEASES = [
    ("autsl", "validation/x.mp4 sub/SignList_ClassId.csv val_labels.csv", "sub/SignList_ClassId.csv", "val_labels.csv"), ("autsl", "train/x.mp4", "incomplete", "none"), ("csl", "sentences.txt color/a.mp4", "sentences.txt", "color"),
    ("csl", "other.txt", "incomplete", "."), ("lsa64", "001_002_003.mp4", "1", "-"), ("lsa64", "readme.txt", "incomplete", "-"), ("slovo", "annotations.csv", "annotations.csv", "-"), ("slovo", "x.csv", "incomplete", "-"),
    ("rwth_phoenix_weather", "b/PHOENIX-2014-T.dev.corpus.csv a/PHOENIX-2014-T.dev.corpus.csv", ".", "a/PHOENIX-2014-T.dev.corpus.csv"), ("msasl", "MSASL_train.json MSASL_val.json MSASL_test.json", ".", "-"), ("msasl", "MSASL_val.json", "incomplete", "-"), ("wlasl", "1.mp4", ".", "-"), ("how2sign", "1.mp4", ".", "-"),
]


@query(_values(_RELEASES, "dataset, files, validated, found"))
def releases(spark, sf_dir):
    """What validation and discovery say of releases that are whole, and of some that aren't."""
    out = []
    for name, listed, *_ in _RELEASES:
        root = work_folder(spark, name)
        blobs = spark.createDataFrame([(f, "x") for f in listed.split()], "name string, payload string")
        files.write_blobs(blobs, root).write.format("noop").mode("overwrite").save()
        source = {**cfg.SOURCE_DEFAULTS[name], "release_dir": root, "annotations_dir": root}
        config = {"dataset": {"name": name, "source": source}, "paths": {"videos": root}}
        short = lambda p: "none" if p is None else (p.split(f"{root.rsplit('/', 1)[-1]}", 1)[-1].strip("/") or ".")  # noqa: E731, B023
        try:
            said = discovery.validate(spark, config)
            validated = str(said.get("files") or short(next((said[k] for k in ("classes", "corpus", "annotations", "release", "videos") if k in said), root)))
        except discovery.Incomplete:
            validated = "incomplete"
        found = {"autsl": lambda: short(discovery.autsl_labels(spark, root, "val")), "csl": lambda: short(discovery.csl_videos(spark, root, "color")), "rwth_phoenix_weather": lambda: short(discovery.phoenix_corpora(spark, root, "dev")[0])}.get(name, lambda: "-")()
        out.append((name, listed, validated, found))
    return spark.createDataFrame(out, "dataset string, files string, validated string, found string")


_MODELS = [
    ("yolo11m", "yolo11m.pt"), (" yolov8n.pt ", "yolov8n.pt"), ("yolov9c", "yolov9c.pt"), ("yolov11m", "did you mean 'yolo11m.pt'"), ("yolov26x.pt", "did you mean 'yolo26x.pt'"), ("resnet", "families: yolov8, yolov9, yolo11, yolo26"),
    ("https://hub.ultralytics.com/models/abc", "https://hub.ultralytics.com/models/abc"), ("http://host:8000/v2/models/pose", "http://host:8000/v2/models/pose"), ("grpc://host/v2/models/pose", "grpc://host/v2/models/pose"), ("https://example.org/w/best.pth", "https://example.org/w/best.pth"),
]


@query(_values(_MODELS, "model, resolved"))
def model_names(spark, sf_dir):
    """What a detector's model name means: short names, slips of the pen, links, hubs and servers."""

    def said(model: str) -> str:
        try:
            return weights.resolve(model)
        except ValueError as e:
            return str(e).split("; ", 1)[1].rstrip("?")

    return spark.createDataFrame([(m, said(m)) for m, _ in _MODELS], "model string, resolved string")


# Fixed values, as the datasets' documentation has them.
_SETTINGS = [
    ("autsl", "allow_unlabeled", "false"), ("autsl", "availability_policy", '"fail_fast"'), ("autsl", "modality", '"rgb"'), ("autsl", "split", '"train"'),
    ("csl", "availability_policy", '"drop_unavailable"'), ("csl", "protocol", '"split_i"'), ("csl", "rgb_subdir", '"color"'), ("csl", "split", '"all"'),
    ("how2sign", "manifest_csv", '""'), ("how2sign", "split", '"all"'), ("lsa64", "availability_policy", '"fail_fast"'), ("lsa64", "split_strategy", '"none"'), ("lsa64", "variant", '"cut"'),
    ("msasl", "availability_policy", '"drop_unavailable"'), ("msasl", "download_mode", '"validate"'), ("msasl", "split", '"val"'), ("msasl", "subset", "1000"),
    ("openasl", "availability_policy", '"drop_unavailable"'), ("openasl", "text_column", '"en"'),
    ("rwth_phoenix_weather", "availability_policy", '"drop_unavailable"'), ("rwth_phoenix_weather", "fps", "25.0"), ("rwth_phoenix_weather", "prepare_mode", '"validate"'), ("rwth_phoenix_weather", "split", '"all"'),
    ("slovo", "availability_policy", '"fail_fast"'), ("slovo", "background_labels", '["no_event"]'), ("slovo", "class_map_mode", '"bundled"'), ("slovo", "include_background", "true"), ("slovo", "split", '"all"'),
    ("wlasl", "availability_policy", '"drop_unavailable"'), ("wlasl", "download_mode", '"validate"'), ("wlasl", "split", '"all"'), ("wlasl", "subset", "0"),
    ("youtube_asl", "availability_policy", '"drop_unavailable"'), ("youtube_asl", "languages", '["en", "ase", "en-US", "en-CA", "en-GB", "en-AU", "en-NZ", "en-IN", "en-ZA", "en-IE", "en-SG", "en-PH", "en-NG", "en-PK", "en-JM"]'), ("youtube_asl", "max_duration", "60.0"), ("youtube_asl", "max_text_length", "300"), ("youtube_asl", "min_duration", "0.2"), ("youtube_asl", "stop_on_transcript_block", "true"),
]


@query(_values(_SETTINGS, "dataset, name, value"))
def source_settings(spark, sf_dir):
    """Every dataset's settings, as a job gets them that names the dataset only."""
    rows = [(d, k, json.dumps(v)) for d in cfg.SOURCE_DEFAULTS for k, v in cfg.check({"dataset": d})["dataset"]["source"].items()]
    return spark.createDataFrame(rows, "dataset string, name string, value string")


_STAGES = [
    ("detection_config.batch_size", "16"), ("detection_config.confidence_threshold", "0.5"), ("detection_config.min_bbox_area", "0.05"), ("keypoint_preset", '"mmpose_133_to_85"'), ("mask_empty_frames", "true"), ("mask_low_confidence", "false"),
    ("missing_value", "-999.0"), ("mode", '"xy_isotropic_z_minmax"'), ("output.type", '"webdataset"'), ("path", '"/mnt/d/clips/a"'), ("pose_config.keypoint_threshold", "0.3"), ("run_name", '"over"'), ("sample_rate", "0.25"),
    ("source.subset", "50"), ("text.fix_encoding", "true"), ("text.lowercase", "false"), ("text.normalize_whitespace", "true"), ("text.strip_punctuation", "false"), ("video.codec", '"libx264"'), ("visibility_threshold", "0.3"),
]


@query(_values(_STAGES, "name, value"))
def job_settings(spark, sf_dir):
    """A job file that inherits, with overrides, an older key, and the defaults of its stages."""
    import warnings

    folder = work_folder(spark, "settings")
    files._atomic(f"{folder}/configs/base.yaml", b"dataset: wlasl\nrun_name: base\nprocessing: {processor: video2pose, detection: yolo, detection_config: {device: cpu}, pose: mmpose, pose_config: {}, frame_skip: 4}\n")
    files._atomic(f"{folder}/configs/jobs/job.yaml", b"base: ../base.yaml\ndataset: {name: wlasl, source: {subset: 20}}\npost_processing: {recipes: [normalize], normalize: {keypoint_preset: mmpose_133_to_85}}\n")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        c = cfg.load(f"{folder}/configs/jobs/job.yaml", ["dataset.source.subset=50", "run_name=over"])
    p, n = c["processing"], c["post_processing"]["normalize"]
    flat = {f"detection_config.{k}": p["detection_config"][k] for k in ("batch_size", "confidence_threshold", "min_bbox_area")} | {"pose_config.keypoint_threshold": p["pose_config"]["keypoint_threshold"], "sample_rate": p["sample_rate"], "run_name": c["run_name"], "source.subset": c["dataset"]["source"]["subset"], "output.type": c["output"]["type"]}
    flat |= {k: n[k] for k in ("keypoint_preset", "mask_empty_frames", "mask_low_confidence", "missing_value", "mode", "visibility_threshold")}
    flat |= {f"text.{k}": v for k, v in cfg.TEXT_DEFAULTS.items()} | {"video.codec": cfg.VIDEO_DEFAULTS["codec"], "path": cfg.plain_path("D:\\\\clips\\a".replace("\\\\", "\\"))}
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in flat.items()], "name string, value string")


@query("SELECT 'good' AS job, 'succeeded' AS status, 2 AS succeeded, 1 AS failed UNION ALL SELECT 'bad', 'failed', 2, 1 UNION ALL SELECT 'more', 'succeeded', 2, 1")
def experiment(spark, sf_dir):
    """Jobs of an experiment run one after another; one that fails doesn't stop the others."""
    folder = work_folder(spark, "experiment")
    rows = table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("SAMPLE_ID"), F.col("n_name").alias("VIDEO_ID"), F.lit(0.0).alias("START"), F.lit(1.0).alias("END"))
    files.write_manifest(rows, f"{folder}/manifest")
    os.makedirs(f"{folder}/videos", exist_ok=True)
    job = f"dataset: {{name: how2sign, source: {{manifest_csv: {folder}/manifest}}}}\npaths: {{root: {folder}, videos: videos}}\npost_processing: {{enabled: false}}\n"
    for name, text in (("good", job), ("bad", job.replace("/manifest}", "/none}")), ("more", job + "run_name: more\n")):
        files._atomic(f"{folder}/configs/jobs/{name}.yaml", text.encode())
    files._atomic(f"{folder}/configs/all.yaml", b"name: all\njobs: [configs/jobs/good.yaml, configs/jobs/bad.yaml, {job: configs/jobs/more.yaml, overrides: {output: {config: {max_shard_count: 7}}}}]\n")
    results = runner.run_experiment(spark, f"{folder}/configs/all.yaml")
    counted = runner.summary(results)
    rows = [(os.path.basename(r["config"]).removesuffix(".yaml"), r["status"], counted["succeeded"], counted["failed"]) for r in results]
    return spark.createDataFrame(rows, "job string, status string, succeeded int, failed int")


@query("SELECT o_orderkey, x AS frame FROM (SELECT o_orderkey, unnest(range((o_orderkey % 50)::BIGINT, (o_orderkey % 50 + 10)::BIGINT)) AS x FROM orders) WHERE o_orderkey % 2 = 1 OR (x - o_orderkey % 50) % 2 = 1")
def sampled_frames(spark, sf_dir):
    """Every frame where the rate isn't known, else every second one of 30 a second at a rate of 15."""
    n = F.col("o_orderkey") % 50
    fps = F.when(F.col("o_orderkey") % 2 == 0, 30.0).otherwise(0.0)
    kept = intervals.sample(F.sequence(n, n + 9), fps, intervals.effective_fps(15.0, fps))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.explode(kept).alias("frame"))


@query("SELECT 'v9' AS example UNION ALL SELECT 'v8' UNION ALL SELECT 'v7' UNION ALL SELECT 'v6' UNION ALL SELECT 'v5'")
def fail_fast_names(spark, sf_dir):
    """The policy that stops names five of the missing videos, in order."""
    n = table(spark, sf_dir, "nation").select(F.format_string("v%d", F.lit(9) - F.col("n_nationkey") % 5).alias("VIDEO_ID"))
    try:
        availability.by_id(n, spark.createDataFrame([("v1",)], "x string"), "fail_fast")
        names: list[str] = []
    except availability.Unavailable as e:
        names = sorted(x.strip("[] '") for x in str(e).split("[", 1)[1].split(","))
    return spark.createDataFrame([(x,) for x in names], "example string")


ORACLES.update(SQL)

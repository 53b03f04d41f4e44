"""Stages of jobs with fakes, and acquisition."""

import os

import numpy as np
import pytest

from glossmill.operators import acquire, models
from glossmill.plans import config, processors, runner


class TextWriter(models.ClipWriter):
    def write(self, source, target, start, end, crop):
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "w") as f:
            f.write(f"{source} {start} {end} {crop}")
        return True


class Twins(models.WholeFrameDetector):
    def detect(self, frames):
        return [d * 2 if "two" in f[0] else d for f, d in zip(frames, super().detect(frames))]


@pytest.fixture
def run(spark, tmp_path):
    processors.WRITERS["text"] = processors.WRITERS["obfuscate"] = lambda o: TextWriter()
    processors.DETECTORS["twins"] = lambda o: Twins()
    rows = [("s1", "v1", 0.0, 0.5), ("s2", "v1", 0.5, 1.0), ("s3", "two", 0.0, 0.5), ("s4", "v2", None, 1.0)]
    df = spark.createDataFrame(rows, "SAMPLE_ID string, VIDEO_ID string, START double, END double")
    c = config.check({"dataset": "how2sign", "processing": {"processor": "video2crop"}})
    c["paths"] |= {"videos": str(tmp_path / "videos"), "output": str(tmp_path / "out"), "webdataset": str(tmp_path / "web")}
    return runner.Run(c, df)


def listed(outputs):
    return sorted(r["path"] for r in outputs.collect())


def names(outputs):
    return [os.path.basename(p) for p in listed(outputs)]


def test_pose_then_normalise(spark, run):
    options = {"detection": "twins", "pose": "fake", "sample_rate": 0.5, "pose_config": {"size": 133}}
    after, paths = processors.video2pose(spark, runner.Run(run.config, run.manifest.where("START is not null")), options)
    assert names(paths) == ["s1.npy", "s2.npy"] and np.load(listed(paths)[0]).shape[1] == 532
    _, paths = processors.normalize(spark, after, {"keypoint_preset": "mmpose_133_to_85", "remove_z": True})
    clip = np.load(listed(paths)[0])
    assert clip.shape[1] == 170 and clip.max() <= 1
    done = spark.createDataFrame([("s1",)], "SAMPLE_ID string")
    _, paths = processors.video2pose(spark, runner.Run(run.config, run.manifest.where("START is not null")), options, done)
    assert names(paths) == ["s2.npy"]


def test_clips(spark, run):
    options = {"detection": "twins", "sample_rate": None, "writer": "text", "video_config": {"padding": 0.1, "resize": [64, 64]}}
    _, paths = processors.video2crop(spark, run, options)
    assert names(paths) == ["s1.mp4", "s2.mp4"] and "640" in open(listed(paths)[0]).read()
    _, paths = processors.video2compression(spark, run, options)
    assert names(paths) == ["two.mp4", "v1.mp4", "v2.mp4"]
    _, paths = processors.clip_video(spark, run, {"writer": "text"})
    assert names(paths) == ["s1.mp4", "s2.mp4", "s3.mp4"]
    _, paths = processors.obfuscate(spark, run, {})
    assert names(paths) == ["two.mp4", "v1.mp4", "v2.mp4"]
    with pytest.raises(ValueError):
        processors.video2crop(spark, run, {**options, "writer": "none"})


def test_acquire(spark):
    class Fake(acquire.Fetcher):
        def fetch(self, video_id):
            if video_id == "b":
                raise RuntimeError("gone")
            if video_id == "d":
                raise acquire.Blocked("too many")

    wanted = spark.createDataFrame([("d",), ("a",), ("b",), ("a",), ("e",), ("c",)], "VIDEO_ID string")
    there = spark.createDataFrame([("c",)], "stem string")
    pauses = []
    stats, missing = acquire.fetch_all(wanted, there, Fake(), sleep=pauses.append)
    assert stats == {"wanted": 3, "downloaded": 1, "errors": 2, "blocked": True} and missing == [("b", "gone"), ("d", "too many")]
    assert pauses == [0.2, pytest.approx(0.3)]
    with pytest.raises(RuntimeError):
        acquire.fetch_all(wanted, there, Fake(), "fail_fast", sleep=pauses.append)
    rows = spark.createDataFrame([("u1", "x", 0, 0), ("u2", "x", 0, 1), (None, "y", 0, 2)], "url string, video_id string, i int, j int")
    assert [tuple(r) for r in acquire.wanted_wlasl(rows).collect()] == [("x", "u2")]
    assert acquire.reasons(spark, missing).count() == 2

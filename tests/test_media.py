"""Calls of ffmpeg and ffprobe, with scripts that stand in for the programs, and names of models."""

import os
import stat

import pytest

from glossmill.operators import media, models
from glossmill.plans import weights


@pytest.fixture
def program(tmp_path):
    def make(name, body):
        path = tmp_path / name
        path.write_text("#!/bin/sh\n" + body)
        path.chmod(path.stat().st_mode | stat.S_IXUSR)
        return str(path)

    return make


PROBE = "echo width=4\necho height=2\necho r_frame_rate=30000/1001\necho duration=12.5\n"


def test_probe(program):
    assert media.FfprobeProbe(program("probe", PROBE)).probe("x.mp4") == (pytest.approx(29.97, abs=0.01), 12.5)
    assert media.FfprobeProbe(program("broken", "exit 1\n")).probe("x.mp4") == (0.0, 0.0)
    assert media.FfprobeProbe("/no/such/program").probe("x.mp4") == (0.0, 0.0)
    assert [media.rate(x) for x in ("25", "30/2", "1/0", "N/A", "")] == [25.0, 15.0, 0.0, 0.0, 0.0]


def test_frames(program):
    reader = media.FfmpegReader(program("ffmpeg", "head -c 75 /dev/zero\n"), program("ffprobe", PROBE))
    frames = reader.read("x.mp4", [5, 7])  # three whole frames of 24 bytes from number 5 on, and a part of one
    assert [f.shape for f in frames] == [(2, 4, 3)] * 2 and reader.read("x.mp4", []) == []
    with pytest.raises(RuntimeError, match="no codec"):
        media.FfmpegReader(program("bad", "echo no codec >&2\nexit 3\n"), program("ffprobe", PROBE)).read("x.mp4", [0])
    assert media.FfmpegReader("ffmpeg", program("none", "exit 1\n")).read("x.mp4", [0]) == []
    assert "select=between(n\\,5\\,7)" in media.frames_command("a", 5, 7)


def test_clips(program, tmp_path):
    writer = media.FfmpegWriter(program("ffmpeg", 'for last; do :; done\necho "$@" > "$last"\n'))
    target = str(tmp_path / "out" / "a.mp4")
    assert writer.write("in.mp4", target, 1.0, 3.5, {"w": 10, "h": 20, "x": 1, "y": 2, "fps": 15.0, "to_w": 5, "to_h": 6})
    said = open(target).read()
    assert "-ss 1.0 -i in.mp4 -t 2.5 -vf fps=15.0,crop=10:20:1:2,scale=5:6 -c:v libx264" in said and os.listdir(tmp_path / "out") == ["a.mp4"]
    assert not writer.write("in.mp4", str(tmp_path / "out" / "b.mp4"), 0, 1, {"w": 0, "h": 20, "x": 1, "y": 2})
    failing = media.FfmpegWriter(program("fails", 'for last; do :; done\ntouch "$last"\nexit 1\n'))
    assert not failing.write("in.mp4", str(tmp_path / "out" / "c.mp4"), 0, 1, None) and os.listdir(tmp_path / "out") == ["a.mp4"]


def test_pictures_become_a_video(program, tmp_path):
    ffmpeg, target = program("ffmpeg", 'for last; do :; done\ncat > "$last"\n'), str(tmp_path / "v" / "a.mp4")
    assert media.materialise(["/p/2.png", "/p/1.png"], target, 25.0, program=ffmpeg) == "written"
    assert open(target).read().split("\n") == ["file '/p/1.png'", "duration 0.040000", "file '/p/2.png'", "duration 0.040000"]
    assert media.materialise([], target, program=ffmpeg) == "kept"
    with pytest.raises(FileNotFoundError):
        media.materialise([], str(tmp_path / "b.mp4"), program=ffmpeg)
    with pytest.raises(RuntimeError):
        media.materialise(["/p/1.png"], target, overwrite=True, program=program("bad", "exit 1\n"))


def test_writers_run_in_a_stage(spark, program, tmp_path):
    ffmpeg = program("ffmpeg", 'for last; do :; done\necho x > "$last"\n')
    rows = spark.createDataFrame([("a", "v", str(tmp_path / "a.mp4"), 0.0, 1.0, None), ("b", "v", str(tmp_path / "b.mp4"), 0.0, 1.0, (0, 5, 0, 0, 25.0, None, None))], "SAMPLE_ID string, VIDEO_PATH string, TARGET string, START double, END double, crop struct<w:int,h:int,x:int,y:int,fps:double,to_w:int,to_h:int>")
    got = {r["SAMPLE_ID"]: r["status"] for r in models.run_clips(rows, lambda: media.FfmpegWriter(ffmpeg)).collect()}
    assert got == {"a": "ok", "b": "error"} and os.path.exists(tmp_path / "a.mp4")


def test_model_files(tmp_path):
    (tmp_path / "yolo11m.pt").write_text("w")
    assert weights.resolve(str(tmp_path / "yolo11m.pt")) == str(tmp_path / "yolo11m.pt")
    assert weights.resolve("yolo11m", download=False, folder=str(tmp_path)) == str(tmp_path / "yolo11m.pt")
    for model in ("yolo11l", "https://example.org/best.pt", "https://hub.ultralytics.com/models/x"):
        with pytest.raises(FileNotFoundError):
            weights.resolve(model, download=False)
    assert weights.resolve("http://h/v2/models/m", download=False) == "http://h/v2/models/m"


def test_devices_and_precision():
    assert [models.device(d) for d in ("cpu", "cuda", "cuda:1", " mps ")] == [("cpu", None), ("cuda", 0), ("cuda", 1), ("mps", None)]
    for bad in ("cuda:", "cuda:x", ""):
        with pytest.raises(ValueError):
            models.device(bad)
    made = []

    class Half(models.WholeFrameDetector):
        def __init__(self, half, breaks="kernel"):
            made.append(half)
            self.half, self.breaks = half, breaks

        def detect(self, frames):
            if self.half and (self.breaks == "kernel" or len(frames) > 2):
                raise RuntimeError("no kernel" if self.breaks == "kernel" else "CUDA out of memory")
            return super().detect(frames)

    frames = [("v", i, 8, 8) for i in range(5)]
    guarded = models.Guarded(Half, "cuda:0")
    assert len(guarded.detect(frames)) == 5 and made == [True, False] and len(guarded.detect(frames)) == 5 and len(made) == 2
    tight, ceiling = models.Guarded(lambda half: Half(half, "memory"), "cuda"), {"most": 16}
    assert len(models.halving(tight.detect, frames, 16, ceiling)) == 5 and ceiling["most"] == 2 and tight.half
    assert len(models.Guarded(Half, "cpu").detect(frames)) == 5

    class Broken(models.WholeFrameDetector):
        def detect(self, frames):
            raise ValueError("broken")

    with pytest.raises(RuntimeError, match="half precision: broken; in full precision: broken"):
        models.Guarded(lambda half: Broken(), "cuda").detect(frames)
    with pytest.raises(ValueError, match="broken"):
        models.halving(Broken().detect, frames, 4)

"""Interfaces for what reads pixels, with fakes that need no codec, and the stages that run them on executors.

A stage gets rows with the numbers of the frames to read and returns rows with results; pixels stay inside a task. A model
is made once for each partition. A row's failure is its status, not the job's end.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import spread


class OutOfMemory(RuntimeError):
    """A batch was too large for the device."""


def out_of_memory(error: BaseException) -> bool:
    """Whether an error says that a batch was too large, by its kind or, for backends that have none, by its words."""
    words = str(error).lower()
    return isinstance(error, OutOfMemory) or "out of memory" in words or "cuda oom" in words


def device(name: str) -> tuple[str, int | None]:
    """A device's kind and number: cuda is cuda:0, other kinds have no number unless one is given."""
    kind, colon, number = str(name).strip().partition(":")
    if not kind or (colon and not number.isdigit()):
        raise ValueError(f"no device {name!r}; examples: cpu, cuda, cuda:1")
    return kind, int(number) if colon else 0 if kind == "cuda" else None


class FrameReader(ABC):
    @abstractmethod
    def read(self, path: str, frames: list[int]) -> list:
        """The frames of these numbers."""


class Detector(ABC):
    @abstractmethod
    def detect(self, frames: list) -> list[list[dict]]:
        """Detections x1, y1, x2, y2, confidence, label of every frame."""

    def close(self) -> None:
        """Give back the device."""


class PoseEstimator(ABC):
    size = 133

    @abstractmethod
    def landmarks(self, frames: list, boxes: list) -> list:
        """A list of (x, y, z, v) for every frame, or None where it failed."""

    def close(self) -> None:
        """Give back the device."""


class MediaProbe(ABC):
    @abstractmethod
    def probe(self, path: str) -> tuple[float, float]:
        """Rate and duration; zeros where the file can't be read."""


class ClipWriter(ABC):
    @abstractmethod
    def write(self, source: str, target: str, start: float, end: float, crop: dict | None) -> bool:
        """Whether the clip was written."""


class FakeReader(FrameReader):
    """Frames are their own numbers and the size of the picture."""

    def __init__(self, width: int = 640, height: int = 480):
        self.width, self.height = width, height

    def read(self, path: str, frames: list[int]) -> list:
        return [(path, f, self.width, self.height) for f in frames]


class WholeFrameDetector(Detector):
    """Every frame is one person."""

    def detect(self, frames: list) -> list[list[dict]]:
        return [[{"x1": 0.0, "y1": 0.0, "x2": float(f[2]), "y2": float(f[3]), "confidence": 1.0, "label": 0}] for f in frames]


class FakePose(PoseEstimator):
    """Landmarks that follow from the frame's number; multiples of ``fails`` fail."""

    def __init__(self, size: int = 133, fails: int = 0):
        self.size, self.fails = size, fails

    def landmarks(self, frames: list, boxes: list) -> list:
        return [None if self.fails and f[1] % self.fails == 0 else [((f[1] + k) % 7 / 7, k % 5 / 5, 0.1, 1.0) for k in range(self.size)] for f in frames]


class Guarded(Detector):
    """A detector in half precision where its device has that, in full precision from the first failure on that isn't memory."""

    def __init__(self, make: Callable[[bool], Detector], on: str = "cpu"):
        self.make, self.half = make, device(on)[0] == "cuda"
        self.inner = make(self.half)

    def detect(self, frames: list) -> list[list[dict]]:
        if not self.half:
            return self.inner.detect(frames)
        try:
            return self.inner.detect(frames)
        except Exception as half:
            if out_of_memory(half) and len(frames) > 1:
                raise  # a smaller batch may do
            self.inner.close()
            self.inner, self.half = self.make(False), False
            try:
                return self.inner.detect(frames)
            except Exception as full:
                raise RuntimeError(f"in half precision: {half}; in full precision: {full}") from full

    def close(self) -> None:
        self.inner.close()


def halving(run: Callable[[list], list], items: list, batch: int, ceiling: dict | None = None) -> list:
    """Results in batches; a batch that is too large is halved, and what worked is the ceiling from then on. One item that
    is too large alone is an error."""
    ceiling = {"most": batch} if ceiling is None else ceiling
    out, at = [], 0
    while at < len(items):
        n = min(ceiling["most"], len(items) - at)
        try:
            out += run(items[at : at + n])
            at += n
        except Exception as e:
            if n == 1 or not out_of_memory(e):
                raise
            ceiling["most"] = max(1, n // 2)
    return out


DETECTIONS = "array<array<struct<x1:double,y1:double,x2:double,y2:double,confidence:double,label:int>>>"
LANDMARKS = "array<array<struct<x:float,y:float,z:float,v:float>>>"


#: Landmarks in a batch of results.
POINTS = 1 << 17


def _offsets(lengths: list[int | None]) -> pa.Array:
    """Offsets of lists of these lengths, null where there is no list."""
    from itertools import accumulate

    ends = [0, *accumulate(n or 0 for n in lengths)]
    return pa.array([*(None if n is None else a for n, a in zip(lengths, ends)), ends[-1]], pa.int32())


def _pose_batch(out: list[tuple]) -> pa.RecordBatch:
    """Results as Arrow. Landmarks become columns of numbers at once, since there are many; NaN is null."""
    import numpy as np

    samples, found, marks, status, message = zip(*out)
    box = pa.struct([*((c, pa.float64()) for c in ("x1", "y1", "x2", "y2", "confidence")), ("label", pa.int32())])
    frames = [f for m in marks if m is not None for f in m]
    points = [p for f in frames for p in f]
    if all(len(p) == 4 for p in points):
        columns = np.array(points, np.float64).reshape(len(points), 4).T.astype(np.float32)
        structs = pa.StructArray.from_arrays([pa.array(c, from_pandas=True) for c in columns], list("xyzv"))
    else:
        structs = pa.array([dict(zip("xyzv", p)) for p in points], pa.struct([(c, pa.float32()) for c in "xyzv"]), from_pandas=True)
    by_frame = pa.ListArray.from_arrays(_offsets([len(f) for f in frames]), structs)
    landmarks = pa.ListArray.from_arrays(_offsets([None if m is None else len(m) for m in marks]), by_frame)
    text = pa.string()
    return pa.RecordBatch.from_arrays([pa.array(samples, text), pa.array(found, pa.list_(pa.list_(box)), from_pandas=True), landmarks, pa.array(status, text), pa.array(message, text)], ["SAMPLE_ID", "detections", "landmarks", "status", "message"])


def run_pose(rows: DataFrame, reader: Callable[[], FrameReader], detector: Callable[[], Detector], pose: Callable[[], PoseEstimator], batch: int = 16) -> DataFrame:
    """(SAMPLE_ID, detections, landmarks, status, message) of rows (SAMPLE_ID, VIDEO_PATH, frames).

    A segment with more than one person in a frame is skipped; a frame whose estimation failed is zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, detect, estimate, most = reader(), detector(), pose(), {"most": batch}
        try:
            out, points = [], 0
            for rows in batches:
                for sample, path, numbers in zip(*(rows.column(i).to_pylist() for i in range(3))):
                    try:
                        frames = read.read(path, [int(f) for f in numbers])
                        found = halving(detect.detect, frames, batch, most)
                        if any(len(f) > 1 for f in found):
                            out.append((sample, found, None, "skipped", "several persons"))
                        else:
                            marks: list = []
                            for at in range(0, len(frames), batch):
                                part = frames[at : at + batch]
                                marks += estimate.landmarks(part, [f[0] if f else None for f in found[at : at + batch]])
                            zero = [(0.0, 0.0, 0.0, 0.0)] * estimate.size
                            out.append((sample, found, [m or zero for m in marks], "ok", None))
                    except Exception as e:  # a row's failure is its status
                        out.append((sample, None, None, "error", str(e)))
                    points += 1 + sum(map(len, out[-1][2] or ())) + sum(map(len, out[-1][1] or ()))
                    if points >= POINTS:
                        yield _pose_batch(out)
                        out, points = [], 0
            if out:
                yield _pose_batch(out)
        finally:
            detect.close()
            estimate.close()

    return spread(rows.select("SAMPLE_ID", "VIDEO_PATH", "frames"), "SAMPLE_ID").mapInArrow(run, f"SAMPLE_ID string, detections {DETECTIONS}, landmarks {LANDMARKS}, status string, message string")


def run_detection(rows: DataFrame, reader: Callable[[], FrameReader], detector: Callable[[], Detector], batch: int = 16) -> DataFrame:
    """(SAMPLE_ID, detections, status, message); boxes, padding and crops follow as expressions."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read, detect, most = reader(), detector(), {"most": batch}
        try:
            for pdf in pdfs:
                out = []
                for r in pdf.itertuples(index=False):
                    try:
                        out.append((r.SAMPLE_ID, halving(detect.detect, read.read(r.VIDEO_PATH, [int(f) for f in r.frames]), batch, most), "ok", None))
                    except Exception as e:
                        out.append((r.SAMPLE_ID, None, "error", str(e)))
                yield pd.DataFrame(out, columns=["SAMPLE_ID", "detections", "status", "message"])
        finally:
            detect.close()

    return spread(rows.select("SAMPLE_ID", "VIDEO_PATH", "frames"), "SAMPLE_ID").mapInPandas(run, f"SAMPLE_ID string, detections {DETECTIONS}, status string, message string")


def run_probe(rows: DataFrame, probe: Callable[[], MediaProbe], path: str = "VIDEO_PATH") -> DataFrame:
    """rows with fps and duration. Filter before this: it opens a file for each row."""
    from pyspark.sql import types as T

    names = rows.columns

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = probe()
        for pdf in pdfs:
            found = [p.probe(x) for x in pdf[path]]
            yield pdf.assign(fps=[f for f, _ in found], duration=[d for _, d in found])[[*names, "fps", "duration"]]

    return spread(rows, path).mapInPandas(run, T.StructType([*rows.schema.fields, T.StructField("fps", T.DoubleType()), T.StructField("duration", T.DoubleType())]))


def run_clips(rows: DataFrame, writer: Callable[[], ClipWriter]) -> DataFrame:
    """(SAMPLE_ID, path, status, message) of rows (SAMPLE_ID, VIDEO_PATH, TARGET, START, END, crop). Writers must write to another
    name and rename."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = writer()
        for pdf in pdfs:
            out = []
            for r in pdf.itertuples(index=False):
                try:
                    ok = w.write(r.VIDEO_PATH, r.TARGET, r.START, r.END, r.crop)
                    out.append((r.SAMPLE_ID, r.TARGET, "ok" if ok else "error", None if ok else "not written"))
                except Exception as e:
                    out.append((r.SAMPLE_ID, r.TARGET, "error", str(e)))
            yield pd.DataFrame(out, columns=["SAMPLE_ID", "path", "status", "message"])

    return spread(rows.select("SAMPLE_ID", "VIDEO_PATH", "TARGET", "START", "END", "crop"), "SAMPLE_ID").mapInPandas(run, "SAMPLE_ID string, path string, status string, message string")

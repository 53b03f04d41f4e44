"""Probes, frame readers and clip writers that run ffmpeg and ffprobe as child processes.

What is run is planned by plain functions, so that it can be looked at without the programs; these are named by a setting
and needn't be there until a task runs one. Every call has a time limit, and its failure is the row's, not the job's.
"""

from __future__ import annotations

import os
import subprocess
from collections.abc import Iterator

from .models import ClipWriter, FrameReader, MediaProbe

# Seconds that a call may take, and how clips are encoded.
PROBE_S, CLIP_S, ENCODE_S = 30, 120, 300
ENCODING = ("-preset", "medium", "-crf", "15", "-an")


def clip_command(source: str, target: str, start: float, end: float, crop: dict | None, codec: str = "libx264", program: str = "ffmpeg") -> list[str] | None:
    """The call that cuts, crops, scales and encodes a clip; None for a crop without area."""
    filters = []
    if crop is not None:
        if crop["w"] <= 0 or crop["h"] <= 0:
            return None
        if crop.get("fps"):
            filters.append(f"fps={crop['fps']}")
        filters.append(f"crop={crop['w']}:{crop['h']}:{crop['x']}:{crop['y']}")
        if crop.get("to_w") and crop.get("to_h"):
            filters.append(f"scale={crop['to_w']}:{crop['to_h']}")
    shape = ["-vf", ",".join(filters)] if filters else []
    return [program, "-y", "-ss", str(start), "-i", source, "-t", str(end - start), *shape, "-c:v", codec, *ENCODING, "-v", "error", target]


def frames_command(source: str, first: int, last: int, program: str = "ffmpeg") -> list[str]:
    """The call that writes the frames of these numbers, both included, as raw pixels to its output."""
    return [program, "-hide_banner", "-nostats", "-v", "error", "-i", source, "-vf", f"select=between(n\\,{first}\\,{last})", "-vsync", "0", "-f", "rawvideo", "-pix_fmt", "bgr24", "pipe:1"]


def probe_command(path: str, program: str = "ffprobe") -> list[str]:
    return [program, "-v", "quiet", "-select_streams", "v:0", "-show_entries", "stream=width,height,r_frame_rate:format=duration", "-of", "default=noprint_wrappers=1", path]


def encode_command(target: str, fps: float, codec: str = "libx264", overwrite: bool = False, program: str = "ffmpeg") -> list[str]:
    """The call that makes a video of a list of pictures on its input."""
    return [program, "-y" if overwrite else "-n", "-f", "concat", "-safe", "0", "-protocol_whitelist", "file,pipe", "-i", "pipe:0", "-r", str(fps), "-c:v", codec, "-pix_fmt", "yuv420p", target]


def picture_list(pictures: list[str], fps: float) -> str:
    """Pictures in order of their names, each as long as a frame."""
    return "\n".join(f"file '{p}'\nduration {1.0 / fps:.6f}" for p in sorted(pictures))


def rate(text: str) -> float:
    """A rate written as a number or as a fraction; 0 where it is neither."""
    top, _, bottom = text.partition("/")
    try:
        return float(top) / float(bottom or 1)
    except (ValueError, ZeroDivisionError):
        return 0.0


def probed(answer: str) -> dict[str, float]:
    """fps, duration, width and height from lines name=value; zeros for what isn't there."""
    lines = dict(line.split("=", 1) for line in answer.splitlines() if "=" in line)
    return {"fps": rate(lines.get("r_frame_rate", "")), "duration": rate(lines.get("duration", "")), "width": rate(lines.get("width", "")), "height": rate(lines.get("height", ""))}


def _ask(path: str, program: str) -> dict[str, float]:
    try:
        done = subprocess.run(probe_command(path, program), capture_output=True, text=True, timeout=PROBE_S)
    except (OSError, subprocess.TimeoutExpired):
        return probed("")
    return probed(done.stdout if done.returncode == 0 else "")


class FfprobeProbe(MediaProbe):
    def __init__(self, program: str = "ffprobe"):
        self.program = program

    def probe(self, path: str) -> tuple[float, float]:
        found = _ask(path, self.program)
        return found["fps"], found["duration"]


class FfmpegReader(FrameReader):
    """Frames as arrays (height, width, 3). A stretch of frames is decoded once and held a frame at a time."""

    def __init__(self, program: str = "ffmpeg", prober: str = "ffprobe"):
        self.program, self.prober = program, prober

    def frames(self, path: str, first: int, last: int) -> Iterator:
        import numpy as np

        size = _ask(path, self.prober)
        w, h = int(size["width"]), int(size["height"])
        if w <= 0 or h <= 0:
            return
        with subprocess.Popen(frames_command(path, first, last, self.program), stdout=subprocess.PIPE, stderr=subprocess.PIPE) as run:
            while len(raw := run.stdout.read(w * h * 3)) == w * h * 3:  # a last part of a frame is no frame
                yield np.frombuffer(raw, np.uint8).reshape(h, w, 3)
            said = run.stderr.read()
        if run.returncode:
            raise RuntimeError(f"{self.program} failed on {path}: {said[-200:].decode(errors='replace')}")

    def read(self, path: str, frames: list[int]) -> list:
        if not frames:
            return []
        wanted, first = set(frames), min(frames)
        return [f for i, f in enumerate(self.frames(path, first, max(frames)), first) if i in wanted]


class FfmpegWriter(ClipWriter):
    """Clips are encoded under another name and renamed when they are whole."""

    def __init__(self, program: str = "ffmpeg", codec: str = "libx264"):
        self.program, self.codec = program, codec

    def write(self, source: str, target: str, start: float, end: float, crop: dict | None) -> bool:
        folder, name = os.path.split(target)
        part = os.path.join(folder, f".part-{os.getpid()}-{name}")
        fields = crop if crop is None or isinstance(crop, dict) else crop.asDict()
        command = clip_command(source, part, start, end, fields, self.codec, self.program)
        if command is None:
            return False
        os.makedirs(folder, exist_ok=True)
        try:
            done = subprocess.run(command, capture_output=True, timeout=CLIP_S)
            if done.returncode == 0 and os.path.exists(part):
                os.replace(part, target)
                return True
            return False
        finally:
            if os.path.exists(part):
                os.remove(part)


def materialise(pictures: list[str], target: str, fps: float = 25.0, codec: str = "libx264", overwrite: bool = False, program: str = "ffmpeg") -> str:
    """A video of pictures, made once: "kept" if it is there already, else "written"."""
    if os.path.exists(target) and not overwrite:
        return "kept"
    if not pictures:
        raise FileNotFoundError(f"no pictures for {target}")
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    done = subprocess.run(encode_command(target, fps, codec, overwrite, program), input=picture_list(pictures, fps), capture_output=True, text=True, timeout=ENCODE_S)
    if done.returncode:
        raise RuntimeError(f"{program} failed for {target}: {done.stderr[-200:]}")
    return "written"

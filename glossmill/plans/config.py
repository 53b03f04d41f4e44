"""Job and experiment files: YAML with inheritance, overrides and checks. Plain Python on the driver; no data."""

from __future__ import annotations

import copy
import os
import re
import warnings
from pathlib import Path
from typing import Any

import yaml

from ..functions.landmarks import MODES, PRESETS

# What a job may name, and its defaults.
PROCESSORS = ("video2pose", "video2crop", "video2compression", "window_video", "clip_video", "obfuscate")
DETECTIONS = ("yolo", "mediapipe", "mmdet", "null")
POSES = ("mediapipe", "mmpose")
OUTPUTS = ("webdataset",)
PATHS = ("videos", "transcripts", "manifest", "output", "webdataset")
DEFAULTS: dict[str, Any] = {
    "run_name": "default",
    "processing": {"enabled": False, "processor": "video2pose", "detection": "null", "pose": None, "sample_rate": 0.5, "max_workers": 1},
    "post_processing": {"enabled": True, "recipes": [], "normalize": None},
    "output": {"enabled": True, "type": "webdataset", "config": {}},
    "paths": {"root": "", **dict.fromkeys(PATHS, "")},
}
DETECTION_DEFAULTS = {
    "yolo": {"model": "yolo11m.pt", "device": "cpu", "confidence_threshold": 0.5, "min_bbox_area": 0.05, "batch_size": 16, "allow_download": True, "weights_dir": None},
    "mmdet": {"device": "cuda:0", "batch_size": 16},
    "mediapipe": {"min_detection_confidence": 0.5},
}
POSE_DEFAULTS = {
    "mediapipe": {"model_complexity": 1, "min_detection_confidence": 0.5, "min_tracking_confidence": 0.5, "refine_face_landmarks": True, "batch_size": 16},
    "mmpose": {"device": "cuda:0", "bbox_threshold": 0.5, "keypoint_threshold": 0.3, "batch_size": 16},
}
VIDEO_DEFAULTS = {"codec": "libx264", "padding": 0.0, "resize": None}
NORMALIZE_DEFAULTS = {"mode": "xy_isotropic_z_minmax", "remove_z": False, "select_keypoints": True, "keypoint_preset": None, "keypoint_indices": None, "mask_empty_frames": True, "mask_low_confidence": False, "visibility_threshold": 0.3, "missing_value": -999.0}
TEXT_DEFAULTS = {"fix_encoding": True, "normalize_whitespace": True, "lowercase": False, "strip_punctuation": False}
LANGUAGES = ["en", "ase", "en-US", "en-CA", "en-GB", "en-AU", "en-NZ", "en-IN", "en-ZA", "en-IE", "en-SG", "en-PH", "en-NG", "en-PK", "en-JM"]
SOURCE_DEFAULTS: dict[str, dict[str, Any]] = {
    "youtube_asl": {"languages": LANGUAGES, "max_text_length": 300, "min_duration": 0.2, "max_duration": 60.0, "availability_policy": "drop_unavailable", "stop_on_transcript_block": True},
    "how2sign": {"split": "all", "manifest_csv": ""},
    "openasl": {"text_column": "en", "availability_policy": "drop_unavailable"},
    "autsl": {"split": "train", "modality": "rgb", "availability_policy": "fail_fast", "allow_unlabeled": False},
    "csl": {"protocol": "split_i", "split": "all", "availability_policy": "drop_unavailable", "rgb_subdir": "color"},
    "lsa64": {"variant": "cut", "split_strategy": "none", "availability_policy": "fail_fast"},
    "msasl": {"split": "val", "subset": 1000, "availability_policy": "drop_unavailable", "download_mode": "validate"},
    "slovo": {"split": "all", "class_map_mode": "bundled", "include_background": True, "background_labels": ["no_event"], "availability_policy": "fail_fast"},
    "wlasl": {"split": "all", "subset": 0, "availability_policy": "drop_unavailable", "download_mode": "validate"},
    "rwth_phoenix_weather": {"split": "all", "prepare_mode": "validate", "fps": 25.0, "availability_policy": "drop_unavailable"},
}
NEEDED = {"youtube_asl": ("video_ids_file",), "openasl": ("manifest_tsv",), "msasl": ("annotations_dir",), "wlasl": ("metadata_json",), "rwth_phoenix_weather": ("release_dir",)}


def merge(base: dict, over: dict) -> dict:
    """Nested mappings are merged; all else, lists too, is replaced."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def set_dotted(config: dict, dotted: str, value: Any) -> None:
    *path, last = dotted.split(".")
    for p in path:
        config = config.setdefault(p, {})
    config[last] = value


def flatten(config: dict, prefix: str = "") -> dict[str, Any]:
    out: dict[str, Any] = {}
    for k, v in config.items():
        out |= flatten(v, f"{prefix}{k}.") if isinstance(v, dict) and v else {f"{prefix}{k}": v}
    return out


def scalar(text: str) -> Any:
    """The value that a command-line word means."""
    low = text.lower()
    if low in ("true", "false"):
        return low == "true"
    if low in ("none", "null"):
        return None
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            continue
    return text


def plain_path(path: str) -> str:
    """A path with a drive letter as the mount that it has under Linux, with forward slashes."""
    m = re.match(r"^([A-Za-z]):[\\/](.*)$", path)
    return f"/mnt/{m[1].lower()}/{m[2]}".replace("\\", "/") if m else path


def root_of(path: str | Path) -> Path:
    """The parent of the nearest folder called configs; without one the file's own folder."""
    p = Path(path).resolve()
    return next((x.parent for x in p.parents if x.name == "configs"), p.parent)


def _read(path: Path, seen: tuple[Path, ...] = ()) -> dict:
    path = path.resolve()
    if path in seen:
        raise ValueError("configs inherit in a circle: " + " -> ".join(map(str, [*seen, path])))
    raw = yaml.safe_load(path.read_text()) or {}
    if not isinstance(raw, dict):
        raise ValueError(f"{path} is no mapping")
    bases = raw.pop("base", None) or []
    out: dict = {}
    for b in [bases] if isinstance(bases, str) else bases:
        out = merge(out, _read(path.parent / b, (*seen, path)))
    return merge(out, raw)


def migrate(processing: dict) -> dict:
    """Older sampling keys become sample_rate: frame_skip n is the share 1 / n, target_fps the rate itself and the stronger."""
    old = {k: processing[k] for k in ("frame_skip", "target_fps") if k in processing}
    if not old:
        return processing
    out = {k: v for k, v in processing.items() if k not in old}
    warnings.warn("processing.frame_skip and processing.target_fps are deprecated; use processing.sample_rate", FutureWarning, stacklevel=3)
    if "sample_rate" in processing:
        return out
    skip, fps = old.get("frame_skip"), old.get("target_fps")
    if skip is not None and int(skip) <= 0:
        raise ValueError("processing.frame_skip must be a positive integer")
    if fps is not None and fps <= 0:
        raise ValueError("processing.target_fps must be positive or null; use processing.sample_rate instead")
    out["sample_rate"] = float(fps) if fps is not None else None if skip is None or int(skip) == 1 else 1.0 / int(skip)
    return out


def check(config: dict) -> dict:
    """The config with defaults, or a ValueError that names what is wrong."""
    config = copy.deepcopy(config)
    data = config.get("dataset")
    if isinstance(data, str):
        data = {"name": data}
    if not isinstance(data, dict) or not data.get("name"):
        raise ValueError("a job needs dataset.name")
    if data["name"] not in SOURCE_DEFAULTS:
        raise ValueError(f"no dataset {data['name']!r}; there are {sorted(SOURCE_DEFAULTS)}")
    data = {"download": True, "manifest": True, **data}
    data["source"] = {**SOURCE_DEFAULTS[data["name"]], **(data.get("source") or {})}
    config["dataset"] = data
    if "processing" in config:
        config["processing"] = migrate(config["processing"] or {})
        config["processing"].setdefault("enabled", True)
    config = merge(DEFAULTS, config)
    p = config["processing"]
    if p["sample_rate"] is not None and p["sample_rate"] <= 0:
        raise ValueError("processing.sample_rate must be positive or null")
    for key, allowed in (("processor", PROCESSORS), ("detection", DETECTIONS)):
        if p[key] not in allowed:
            raise ValueError(f"processing.{key} is {p[key]!r}; allowed: {allowed}")
    if p["enabled"]:
        if p["detection"] != "null":
            if p.get("detection_config") is None:
                raise ValueError(f"processing.detection {p['detection']!r} requires detection_config")
            p["detection_config"] = {**DETECTION_DEFAULTS[p["detection"]], **p["detection_config"]}
            if p["detection_config"].get("batch_size", 1) <= 0:
                raise ValueError("batch_size must be positive")
        if p["processor"] == "video2pose":
            if p["pose"] not in POSES:
                raise ValueError("processing.pose is required for video2pose")
            if p.get("pose_config") is None:
                raise ValueError(f"processing.pose {p['pose']!r} requires pose_config")
            p["pose_config"] = {**POSE_DEFAULTS[p["pose"]], **p["pose_config"]}
        elif p["processor"] in ("video2crop", "video2compression"):
            p["video_config"] = {**VIDEO_DEFAULTS, **(p.get("video_config") or {})}
    n = config["post_processing"].get("normalize")
    if n is not None:
        n = config["post_processing"]["normalize"] = {**NORMALIZE_DEFAULTS, **n}
        if n["mode"] not in MODES:
            raise ValueError(f"normalize.mode is {n['mode']!r}; allowed: {MODES}")
        if n["keypoint_preset"] is not None and n["keypoint_preset"] not in PRESETS:
            raise ValueError(f"no keypoint preset {n['keypoint_preset']!r}; there are {sorted(PRESETS)}")
    if config["output"]["type"] not in OUTPUTS:
        raise ValueError(f"output.type is {config['output']['type']!r}; allowed: {OUTPUTS}")
    return config


def need_source(config: dict) -> None:
    """Keys that a dataset can't do without."""
    data = config["dataset"]
    for key in NEEDED.get(data["name"], ()):
        if not data["source"].get(key) and not (key == "release_dir" and config["paths"]["videos"]):
            raise ValueError(f"{data['name']} needs dataset.source.{key}")


def resolve(config: dict, root: Path) -> dict:
    """Paths below the root, where they aren't absolute."""
    paths = {k: plain_path(v) for k, v in config["paths"].items()}
    base = Path(paths["root"] or root)
    base = base if base.is_absolute() else root / base
    name = config["dataset"]["name"]
    usual = {"videos": f"data/{name}/videos", "transcripts": f"data/{name}/transcripts", "manifest": f"data/{name}/manifest.csv", "output": f"output/{name}", "webdataset": f"webdataset/{name}"}
    out = {k: str(base / (paths[k] or usual[k])) for k in PATHS}
    return {**config, "paths": {"root": str(base), **out}}


def load(path: str | os.PathLike, overrides: list[str] | None = None, values: dict[str, Any] | None = None) -> dict:
    """A job: its file with what it inherits, then words key=value, then values by dotted keys; checked and resolved."""
    raw = _read(Path(path))
    if isinstance(raw.get("dataset"), str):
        raw["dataset"] = {"name": raw["dataset"]}
    for word in overrides or []:
        key, equals, value = word.partition("=")
        if not equals:
            raise ValueError(f"an override is key=value, not {word!r}")
        set_dotted(raw, key, scalar(value))
    for key, value in (values or {}).items():
        set_dotted(raw, key, value)
    return resolve(check(raw), root_of(path))


def load_experiment(path: str | os.PathLike) -> dict:
    """name and jobs, each a job file below the root with overrides."""
    raw = _read(Path(path))
    if not raw.get("name") or not raw.get("jobs"):
        raise ValueError("an experiment needs a name and at least one job")
    root = root_of(path)
    jobs = [{"job": j} if isinstance(j, str) else j for j in raw["jobs"]]
    return {"name": raw["name"], "jobs": [{"path": str(root / j["job"]), "overrides": flatten(j.get("overrides") or {})} for j in jobs]}

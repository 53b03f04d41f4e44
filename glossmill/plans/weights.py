"""What a detector's model name means: a file, a model that a server or a hub has, weights behind a link, or a known short name."""

from __future__ import annotations

import difflib
import os
from urllib.parse import urlsplit

# The families of detectors and the sizes that each comes in; where models are published and served.
FAMILIES = {"yolov8": "nsmlx", "yolov9": "tsmce", "yolo11": "nsmlx", "yolo26": "nsmlx"}
HUB = "https://hub.ultralytics.com/models/"
SERVED = "/v2/models/"


def short_names() -> list[str]:
    return [f"{family}{size}.pt" for family, sizes in FAMILIES.items() for size in sizes]


def kind(model: str) -> str:
    """hub, served, link or name."""
    url = urlsplit(model)
    if model.startswith(HUB):
        return "hub"
    if url.scheme in ("http", "https", "grpc") and url.netloc and SERVED in url.path:
        return "served"
    if url.scheme in ("http", "https") and url.path.endswith((".pt", ".pth")):
        return "link"
    return "name"


def resolve(model: str, download: bool = True, folder: str | None = None) -> str:
    """What to load for a model's name. A file that is there comes first, then what is remote, then a file of that name in
    ``folder``, then the known names, which need a download."""
    model = model.strip()
    if os.path.isfile(model):
        return model
    what = kind(model)
    if what == "served" or (what != "name" and download):
        return model
    if what != "name":
        raise FileNotFoundError(f"{model!r} is a remote model; allow downloads or give a file")
    name = model if model.endswith(".pt") else f"{model}.pt"
    if folder and os.path.isfile(os.path.join(folder, name)):
        return os.path.join(folder, name)
    known = short_names()
    if name not in known:
        near = name.replace("yolov", "yolo") if name.replace("yolov", "yolo") in known else next(iter(difflib.get_close_matches(name, known, 1)), None)
        raise ValueError(f"no model {model!r}" + (f"; did you mean {near!r}?" if near else f"; families: {', '.join(FAMILIES)}"))
    if not download:
        raise FileNotFoundError(f"{name!r} is a known model, but downloads aren't allowed and no file is there")
    return name

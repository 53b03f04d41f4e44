"""Where a release keeps its files, and whether it is whole. Paths are asked of Hadoop's file systems, so that any store will do."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Other names of splits, patterns and names under which releases carry their files, in order of preference.
SPLIT_ALIASES = {"val": ("validation",), "validation": ("val",)}
CLASS_PATTERNS = ("SignList*.csv", "classId*.csv", "class_id*.csv", "*class*correspondence*.csv", "*sign_list*.csv")
CORPUS_NAMES = ("corpus.txt", "corpus.tsv", "sentences.txt", "sentences.tsv", "label.txt", "label.tsv")


class Incomplete(FileNotFoundError):
    """A release lacks what its dataset needs."""


def _status(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(target) if fs.exists(target) else None


def exists(spark: SparkSession, path: str) -> bool:
    return bool(path) and _status(spark, path) is not None


def is_folder(spark: SparkSession, path: str) -> bool:
    found = _status(spark, path) if path else None
    return found is not None and found.isDirectory()


def first_there(spark: SparkSession, paths: list[str]) -> str | None:
    """The first of some paths that exists."""
    return next((p for p in paths if exists(spark, p)), None)


def below(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """The first few files below a folder, at any depth, whose names match, in order of their paths."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder).select("path")
    return [r["path"] for r in found.orderBy("path").limit(100).collect()]  # annotation files, a handful in each release


def autsl_split(spark: SparkSession, root: str, split: str) -> str:
    """The folder of a split, under its name or another one that it has."""
    names = (split, *SPLIT_ALIASES.get(split, ()))
    for name in names:
        if is_folder(spark, f"{root}/{name}"):
            return f"{root}/{name}"
    raise Incomplete(f"{root} has none of the folders {names}")


def autsl_classes(spark: SparkSession, root: str, given: str = "") -> str | None:
    """The file of the class names: the one that is given, else the first that a pattern finds."""
    if given:
        return given
    for pattern in CLASS_PATTERNS:
        found = below(spark, root, pattern)
        if found:
            return found[0]
    return None


def autsl_labels(spark: SparkSession, root: str, split: str, given: str = "") -> str | None:
    """The labels of a split: the file that is given, if it is there, else one in the root, in the split's folder or in labels."""
    name = f"{split}_labels.csv"
    return first_there(spark, [given] if given else [f"{root}/{name}", f"{root}/{split}/{name}", f"{root}/labels/{name}"])


def csl_corpus(spark: SparkSession, root: str, given: str = "") -> str | None:
    """The corpus of sentences: the file that is given, if it is there, else one of the usual names."""
    return first_there(spark, [*([given] if given else []), *(f"{root}/{n}" for n in CORPUS_NAMES)])


def csl_videos(spark: SparkSession, root: str, subfolder: str) -> str:
    return f"{root}/{subfolder}" if subfolder and is_folder(spark, f"{root}/{subfolder}") else root


def phoenix_corpora(spark: SparkSession, root: str, split: str) -> list[str]:
    """The corpus files of a split, anywhere below the root."""
    return below(spark, root, f"PHOENIX-2014-T.{split}.corpus.csv")


def _need(spark: SparkSession, path: str, what: str, folder: bool = False) -> str:
    if not path:
        raise ValueError(f"{what} isn't set")
    if not (is_folder(spark, path) if folder else exists(spark, path)):
        raise Incomplete(f"{what} isn't there: {path}")
    return path


def validate(spark: SparkSession, config: dict) -> dict:
    """What of a release was found; Incomplete, or ValueError for a setting, names what is missing."""
    name, source, videos = config["dataset"]["name"], config["dataset"]["source"], config["paths"]["videos"]
    root = source.get("release_dir") or videos
    if name in ("how2sign", "wlasl"):
        return {"validated": True, "videos": _need(spark, videos, "paths.videos", True)}
    if name == "msasl":
        folder = _need(spark, source["annotations_dir"], "annotations_dir", True)
        for split in ("train", "val", "test"):
            _need(spark, f"{folder}/MSASL_{split}.json", f"the annotations of {split}")
        return {"validated": True, "videos": _need(spark, videos, "paths.videos", True)}
    if name in ("youtube_asl", "openasl"):
        return {"validated": True}
    _need(spark, root, "release_dir", True)
    if name == "lsa64":
        n = spark.read.format("binaryFile").option("pathGlobFilter", "*.mp4").load(root).select("path").agg(F.count(F.lit(1)).alias("n")).first()["n"]
        if not n:
            raise Incomplete(f"{root} has no .mp4 files")
        return {"validated": True, "videos": root, "files": n}
    if name == "autsl":
        split = next((s for s in ("train", "val", "validation", "test") if is_folder(spark, f"{root}/{s}")), None)
        if split is None:
            raise Incomplete(f"{root} has no folder of a split")
        classes = autsl_classes(spark, root, source.get("class_file") or "")
        return {"validated": True, "split": split, "classes": _need(spark, classes or f"{root}/{CLASS_PATTERNS[0]}", "the file of the classes")}
    if name == "csl":
        corpus = csl_corpus(spark, root, source.get("corpus_file") or "")
        if corpus is None:
            raise Incomplete(f"{root} has none of {CORPUS_NAMES}")
        return {"validated": True, "corpus": corpus}
    if name == "slovo":
        return {"validated": True, "annotations": _need(spark, source.get("annotations_file") or f"{root}/annotations.csv", "the annotations")}
    return {"validated": True, "release": root}

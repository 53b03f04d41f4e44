"""Datasets by name: their sources read from a job's settings, their builder, their availability policy."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import availability, media, models
from ..sources import discovery, documents, tables
from . import builders
from .runner import DATASETS, pick, register

#: Probes of videos by name; a source with ``probe`` gets its lengths and rates from one.
PROBES: dict[str, Callable[[dict], models.MediaProbe]] = {"ffprobe": lambda o: media.FfprobeProbe(o.get("ffprobe", "ffprobe"))}


def _root(config: dict) -> str:
    return (config["dataset"]["source"].get("release_dir") or config["paths"]["videos"]).rstrip("/")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """The videos below a folder; none where there is no such folder."""
    if not discovery.is_folder(spark, folder):
        return spark.createDataFrame([], "rel_path string, stem string")
    return documents.listing(spark, folder)


def _by_id(spark: SparkSession, config: dict, df: DataFrame) -> DataFrame:
    """The policy by video id. These datasets may be described before any video is there, so without a folder it doesn't apply."""
    folder = config["paths"]["videos"]
    if not discovery.is_folder(spark, folder):
        return df
    return availability.by_id(df, documents.stems(spark, folder), config["dataset"]["source"]["availability_policy"])


def _by_path(spark: SparkSession, config: dict, df: DataFrame, root: str) -> DataFrame:
    """The policy by relative path; without a folder nothing is there."""
    return availability.by_path(df, _listed(spark, root).select("rel_path"), config["dataset"]["source"]["availability_policy"])


def probed(spark: SparkSession, config: dict, root: str) -> DataFrame | None:
    """(VIDEO_ID, fps, duration) of the videos below a folder, if the source names a probe."""
    name = config["dataset"]["source"].get("probe")
    if not name:
        return None
    make = pick(PROBES, name)
    files = _listed(spark, root).select(F.col("stem").alias("VIDEO_ID"), F.concat(F.lit(f"{root}/"), "rel_path").alias("VIDEO_PATH"))
    return models.run_probe(files, lambda: make(config["dataset"]["source"])).where("duration > 0").dropDuplicates(["VIDEO_ID"])


@register(DATASETS, "youtube_asl")
def youtube_asl(spark: SparkSession, config: dict) -> DataFrame:
    s = config["dataset"]["source"]
    entries = documents.transcripts(spark, config["paths"]["transcripts"])
    return _by_id(spark, config, builders.youtube_asl(entries, s["max_text_length"], s["min_duration"], s["max_duration"]))


@register(DATASETS, "how2sign")
def how2sign(spark: SparkSession, config: dict) -> DataFrame:
    return builders.how2sign(spark, config["dataset"]["source"].get("manifest_csv") or config["paths"]["manifest"])


@register(DATASETS, "openasl")
def openasl(spark: SparkSession, config: dict) -> DataFrame:
    s = config["dataset"]["source"]
    found = documents.openasl_boxes(spark, s["bbox_json"]) if s.get("bbox_json") else None
    return _by_id(spark, config, builders.openasl(tables.openasl(spark, s["manifest_tsv"]), s["text_column"], found))


@register(DATASETS, "msasl")
def msasl(spark: SparkSession, config: dict) -> DataFrame:
    s = config["dataset"]["source"]
    names = ("train", "val", "test") if s["split"] == "all" else (s["split"],)
    return _by_id(spark, config, builders.msasl({n: documents.msasl(spark, f"{s['annotations_dir']}/MSASL_{n}.json") for n in names}, s["subset"]))


@register(DATASETS, "wlasl")
def wlasl(spark: SparkSession, config: dict) -> DataFrame:
    s = config["dataset"]["source"]
    return _by_id(spark, config, builders.wlasl(documents.wlasl(spark, s["metadata_json"]), s["subset"], s["split"], probed(spark, config, config["paths"]["videos"])))


@register(DATASETS, "lsa64")
def lsa64(spark: SparkSession, config: dict) -> DataFrame:
    s, root = config["dataset"]["source"], _root(config)
    classes = None
    if s.get("class_map_file") and discovery.exists(spark, s["class_map_file"]):
        classes = tables.class_map(spark, s["class_map_file"], ("HANDEDNESS",))
    elif not s.get("allow_missing_class_map"):
        raise discovery.Incomplete("LSA64 has no class map; set dataset.source.class_map_file, or allow_missing_class_map to go on without labels")
    facts = documents.name_facts(documents.listing(spark, root, ("mp4",)))
    if facts.isEmpty():
        raise RuntimeError(f"no video below {root} has a name of three numbers")
    signers = None if s["split_strategy"] == "none" else builders.LSA_SIGNERS
    return _by_path(spark, config, builders.lsa64(facts, classes, s["variant"], signers, s.get("split", "all")), root)


@register(DATASETS, "csl")
def csl(spark: SparkSession, config: dict) -> DataFrame:
    s, root = config["dataset"]["source"], _root(config)
    corpus = discovery.csl_corpus(spark, root, s.get("corpus_file") or "")
    if corpus is None:
        raise discovery.Incomplete(f"{root} has none of {discovery.CORPUS_NAMES}")
    folder = discovery.csl_videos(spark, root, s["rgb_subdir"])
    files = documents.listing(spark, folder, ("mp4", "avi", "mov", "mkv"))
    spec = tables.split_spec(spark, s["split_spec_file"]) if s.get("split_spec_file") else None
    return _by_path(spark, config, builders.csl(tables.csl_corpus(spark, corpus), documents.csl_videos(files), s["protocol"], s["split"], spec), folder)


@register(DATASETS, "autsl")
def autsl(spark: SparkSession, config: dict) -> DataFrame:
    """Splits whose labels aren't found are left out, or listed by their videos if that is allowed."""
    s, root = config["dataset"]["source"], _root(config)
    suffix, labels, folders = builders.AUTSL_SUFFIXES[s["modality"]], {}, {}
    for name in ("train", "val", "test") if s["split"] == "all" else (s["split"],):
        folder = discovery.autsl_split(spark, root, name)
        path = discovery.autsl_labels(spark, root, name, s.get(f"{name}_labels_file") or "")
        if path:
            labels[name] = tables.headerless(spark, path, ["sample_key", "label_id"])
        elif s["allow_unlabeled"]:
            named = documents.listing(spark, folder, ("mp4",)).where(F.col("stem").endswith(suffix))
            labels[name] = named.select(F.replace("stem", F.lit(suffix), F.lit("")).alias("sample_key"), F.lit(None).cast("string").alias("label_id"))
        else:
            warnings.warn(f"no labels for split {name} below {root}; it is left out", stacklevel=2)
            continue
        folders[name] = folder.rsplit("/", 1)[-1]
    classes = discovery.autsl_classes(spark, root, s.get("class_file") or "")
    if classes is None:
        raise discovery.Incomplete(f"{root} has no file of the classes")
    names = tables.headerless(spark, classes, ["CLASS_ID", "GLOSS_TR", "GLOSS_EN"])
    return _by_path(spark, config, builders.autsl(labels, names, s["modality"], durations=probed(spark, config, root), folders=folders), root)


@register(DATASETS, "slovo")
def slovo(spark: SparkSession, config: dict) -> DataFrame:
    s, root = config["dataset"]["source"], _root(config)
    classes = None
    if s["class_map_mode"] == "bundled":
        if s.get("class_map_file") and discovery.exists(spark, s["class_map_file"]):
            classes = tables.class_map(spark, s["class_map_file"]).select("GLOSS", "CLASS_ID")
        else:
            warnings.warn("no class map of SLoVo is there; rows have no CLASS_ID", stacklevel=2)
    background = () if s["include_background"] else tuple(s["background_labels"])
    rows = tables.slovo(spark, s.get("annotations_file") or f"{root}/annotations.csv")
    return _by_path(spark, config, builders.slovo(rows, s["split"], s["class_map_mode"], classes, background, probed(spark, config, root)), root)


@register(DATASETS, "rwth_phoenix_weather")
def phoenix(spark: SparkSession, config: dict) -> DataFrame:
    s, root = config["dataset"]["source"], _root(config)
    names = ("train", "dev", "test") if s["split"] == "all" else (s["split"],)
    found = [(n, p) for n in names for p in discovery.phoenix_corpora(spark, root, n)]
    if not found:
        raise discovery.Incomplete(f"{root} has no corpus of {names}")
    df = builders.stacked([builders.phoenix({n: tables.phoenix(spark, p)}) for n, p in found])
    if df.isEmpty():
        raise RuntimeError(f"the corpora below {root} have no rows")
    if not {"START", "END"} <= set(df.columns):
        df = df.withColumns({"START": F.lit(None).cast("double"), "END": F.lit(None).cast("double")})
    return _by_path(spark, config, df, config["paths"]["videos"].rstrip("/") or root)

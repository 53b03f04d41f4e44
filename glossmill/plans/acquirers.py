"""The first stage of a job: a release is validated, and what is missing is fetched where the source names a fetcher."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import acquire as acquisition
from ..sinks import files
from ..sources import discovery, documents, tables
from .builders import stacked
from .runner import pick

#: Fetchers by name; none is built in, as fetching needs a network.
FETCHERS: dict[str, Callable[[dict], acquisition.Fetcher]] = {}
MODES = ("validate", "download_missing")


def wanted(spark: SparkSession, config: dict) -> DataFrame | None:
    """The ids of the videos that a dataset wants, or None for datasets that come as a release."""
    name, s = config["dataset"]["name"], config["dataset"]["source"]
    if name == "youtube_asl":
        return tables.id_list(spark, s["video_ids_file"])
    if name == "openasl":
        return acquisition.wanted_openasl(tables.openasl(spark, s["manifest_tsv"]))
    if name == "msasl":
        splits = ("train", "val", "test") if s["split"] == "all" else (s["split"],)
        return acquisition.wanted_msasl(stacked([documents.msasl(spark, f"{s['annotations_dir']}/MSASL_{n}.json") for n in splits]))
    if name == "wlasl":
        return acquisition.wanted_wlasl(documents.wlasl(spark, s["metadata_json"]))
    return None


def _fetched(spark: SparkSession, config: dict, ids: DataFrame, there: DataFrame, fetcher: acquisition.Fetcher, folder: str) -> dict:
    """Fetch what isn't there. Failures go to a file as they come; the report is made from that."""
    s = config["dataset"]["source"]
    os.makedirs(folder, exist_ok=True)
    log = os.path.join(folder, "failures.jsonl")
    with open(log, "w") as out:
        stats, _ = acquisition.fetch_all(ids, there, fetcher, stop_on_block=s.get("stop_on_transcript_block", False), pause=s.get("pause", 0.2), log=lambda i, why: out.write(json.dumps({"VIDEO_ID": i, "REASON": why}) + "\n"))
    missing = spark.read.schema("VIDEO_ID string, REASON string").json(log)
    files.write_report(stats, missing, folder)
    if s["availability_policy"] == "fail_fast" and stats["errors"]:
        raise RuntimeError(f"{stats['errors']} videos couldn't be fetched; see {folder}")
    return stats


def acquire(spark: SparkSession, config: dict) -> dict:
    """What was validated, and what was fetched."""
    name, s = config["dataset"]["name"], config["dataset"]["source"]
    mode = s.get("download_mode", "validate" if not s.get("fetcher") else "download_missing")
    if mode not in MODES:
        raise ValueError(f"no download_mode {mode!r}; there are {MODES}")
    if mode == "validate" or not s.get("fetcher"):
        return discovery.validate(spark, config)
    fetcher, root, stats = pick(FETCHERS, s["fetcher"])(s), f"{config['paths']['root']}/acquire_report", {}
    ids = wanted(spark, config)
    if ids is None:
        return discovery.validate(spark, config)
    if name == "youtube_asl" and s.get("transcript_fetcher"):
        folder = config["paths"]["transcripts"]
        there = documents.artifacts(spark, folder, "json").select("SAMPLE_ID")
        stats["transcripts"] = _fetched(spark, config, ids, there, pick(FETCHERS, s["transcript_fetcher"])(s), f"{root}/transcripts")
    videos = config["paths"]["videos"]
    there = documents.stems(spark, videos) if discovery.is_folder(spark, videos) else spark.createDataFrame([], "stem string")
    stats["videos"] = _fetched(spark, config, ids.select(F.col(ids.columns[0])), there, fetcher, root)
    return stats

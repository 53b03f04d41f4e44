"""Jobs and experiments. A run is one lazy lineage from annotations to a sink; actions happen at sinks and markers only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import availability
from ..operators import manifest as mf
from ..sinks import files
from . import config as cfg

DATASETS: dict[str, Callable] = {}
PROCESSORS: dict[str, Callable] = {}
RECIPES: dict[str, Callable] = {}
SINKS: dict[str, Callable] = {}


def register(table: dict[str, Callable], name: str) -> Callable:
    """A decorator that puts a stage into one of the tables."""

    def put(f: Callable) -> Callable:
        table[name] = f
        return f

    return put


def pick(table: dict[str, Callable], name: str) -> Callable:
    if name not in table:
        raise ValueError(f"nothing is registered as {name!r}; there are {sorted(table)}")
    return table[name]


@dataclass(frozen=True)
class Run:
    """What a job has so far; every stage returns another one."""

    config: dict
    manifest: DataFrame | None = None
    artifacts: DataFrame | None = None
    done: tuple[str, ...] = ()
    stats: dict = field(default_factory=dict)

    def after(self, stage: str, **changes) -> Run:
        return Run(**{**self.__dict__, **changes, "done": (*self.done, stage)})


def _folder(config: dict, *more: str) -> str:
    return "/".join([config["paths"]["output"], config["run_name"], *more])


def run_job(spark: SparkSession, config: dict, resume: bool = True) -> Run:
    """Acquire, build the manifest, process, post-process, write. A stage whose marker holds is not run again."""
    from . import acquirers

    run = Run(config)
    data = config["dataset"]
    adapter = pick(DATASETS, data["name"])
    if data["download"]:
        cfg.need_source(config)
        run = run.after("acquire", stats={"acquire": acquirers.acquire(spark, config)})
    if data["manifest"]:
        cfg.need_source(config)
        manifest = adapter(spark, config)
    else:
        from ..sources import tables

        manifest = tables.manifest(spark, config["paths"]["manifest"])
    manifest = availability.only_available(manifest)
    run = run.after("manifest", manifest=manifest, stats={**run.stats, "manifest": mf.counts(manifest)})
    stages = []
    if config["processing"]["enabled"]:
        stages.append(("processing", pick(PROCESSORS, config["processing"]["processor"]), config["processing"]))
    if config["post_processing"]["enabled"]:
        stages += [(r, pick(RECIPES, r), config["post_processing"].get(r) or {}) for r in config["post_processing"]["recipes"]]
    if config["output"]["enabled"]:
        stages.append(("output", pick(SINKS, config["output"]["type"]), config["output"]))
    content, upstream = None, []
    for name, stage, options in stages:
        folder = _folder(config, name)
        if resume and files.read_marker(folder):
            content = content or mf.content_hash(manifest).first()["content_hash"]
            if files.marker_holds(folder, options, content, upstream):
                upstream.append(files.text_hash(files.read_marker(folder)["stage_config_hash"]))
                run = run.after(f"{name} (kept)")
                continue
        run, outputs = stage(spark, run, options)
        if outputs is not None and not outputs.isEmpty():
            content = content or mf.content_hash(manifest).first()["content_hash"]
            upstream.append(files.text_hash(files.write_marker(folder, name, options, content, upstream, outputs)["stage_config_hash"]))
        run = run.after(name)
    return run


def run_experiment(spark: SparkSession, path: str, resume: bool = True) -> list[dict]:
    """Every job of an experiment; one that fails doesn't stop the others."""
    results = []
    for job in cfg.load_experiment(path)["jobs"]:
        try:
            run = run_job(spark, cfg.load(job["path"], values=job["overrides"]), resume)
            results.append({"config": job["path"], "status": "succeeded", "stats": {"stages": list(run.done)}, "error": None})
        except Exception as e:  # the next job is to run all the same
            results.append({"config": job["path"], "status": "failed", "stats": {}, "error": f"{type(e).__name__}: {e}"})
    return results


def summary(results: list[dict]) -> dict[str, int]:
    return {s: sum(r["status"] == s for r in results) for s in ("succeeded", "failed")}


def recorded(config: dict, name: str, df: DataFrame) -> DataFrame:
    """What a stage did, one row for each result, run once and kept beside its results."""
    folder = _folder(config, "_done", name)
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: What each processor leaves for a sample: suffix, folder of the plain results, folder of those that go before them.
ARTIFACTS = {"video2pose": ("npy", "landmarks", "normalized"), "video2crop": ("mp4", "clips", None)}


@register(SINKS, "webdataset")
def webdataset(spark: SparkSession, run: Run, options: dict) -> tuple[Run, DataFrame]:
    """Tar shards of the manifest's samples: txt, json, and what the processor made of the sample; samples without that are
    skipped. Shards end by number of samples, and by bytes where ``max_shard_size`` is set."""
    from pyspark.sql import functions as F

    from ..operators import joins, shards
    from ..sources import documents

    if run.manifest is None or not {"START", "END"} <= set(run.manifest.columns):
        raise ValueError("shards need a manifest with timing")
    text = run.manifest if "TEXT" in run.manifest.columns else run.manifest.withColumn("TEXT", F.lit(""))
    processing, settings = run.config["processing"], options.get("config") or {}
    rows = text.withColumn("meta", mf.sample_metadata(processing["processor"])).select("SAMPLE_ID", F.coalesce("TEXT", F.lit("")).alias("TEXT"), "meta")
    ext, raw, before = ARTIFACTS.get(processing["processor"], (None, None, None)) if processing["enabled"] else (None, None, None)
    counts = {}
    if ext:
        plain = documents.artifacts(spark, _folder(run.config, raw), ext)
        better = documents.artifacts(spark, _folder(run.config, before), ext) if before else plain.limit(0)
        sizes = plain.unionByName(better).select(F.col("path").alias("ARTIFACT"), "bytes")
        rows = joins.artifacts(rows, better, plain).join(sizes, "ARTIFACT", "left")
        counts = {"skipped": rows.where("ARTIFACT is null").count()}
        rows = rows.where("ARTIFACT is not null")
    most, size = int(settings.get("max_shard_count", 10_000)), settings.get("max_shard_size")
    if size:
        payload = F.octet_length("TEXT") + F.octet_length("meta") + (F.coalesce("bytes", F.lit(0)) if ext else F.lit(0))
        rows = shards.by_count_and_bytes(rows.withColumn("_payload", payload.cast("long")), "SAMPLE_ID", "_payload", most, int(size))
    else:
        rows = shards.by_count(rows, "SAMPLE_ID", most)
    written = files.write_tar_shards(files.webdataset_members(rows, ext), f"{run.config['paths']['webdataset']}/{run.config['run_name']}")
    written = recorded(run.config, "output", written)
    total = written.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("members"), F.lit(0)).alias("m")).first()
    counts |= {"shards": total["n"], "written": total["m"] // (3 if ext else 2)}
    return Run(**{**run.__dict__, "stats": {**run.stats, "output": counts}}), written.select("path")


@register(PROCESSORS, "window_video")
def window_video(spark: SparkSession, run: Run, options: dict) -> tuple[Run, DataFrame | None]:
    """Windows over each video: as long as its probe says, or else up to its latest END; videos with neither are skipped. The
    windows are the manifest from then on, and are written as one."""
    import warnings

    from pyspark.sql import functions as F

    from . import adapters

    w = options.get("window") or {}
    size, stride, least = float(w.get("size", 10)), float(w.get("stride", 5)), float(w.get("min", 2))
    if size <= 0 or stride <= 0:
        raise ValueError("window.size and window.stride must be positive")
    if w.get("align_to_captions"):
        warnings.warn("window.align_to_captions isn't supported; windows have a fixed length", stacklevel=2)
    timed = run.manifest if {"START", "END"} <= set(run.manifest.columns) else run.manifest.withColumns({c: F.lit(None).cast("double") for c in ("START", "END")})
    spans = mf.video_spans(timed, ["SAMPLE_ID"])
    probed = adapters.probed(spark, run.config, run.config["paths"]["videos"])
    if probed is not None:
        known = probed.select("VIDEO_ID", "duration")
        spans = spans.join(known, "VIDEO_ID", "left").withColumn("SPAN", F.coalesce("duration", "SPAN")).drop("duration")
    skipped = spans.where("SPAN is null").count()
    windows = mf.windowed(spans, size, stride, least)
    folder = _folder(run.config, "window_video", "manifest")
    files.write_manifest(windows, folder)
    total = windows.count()
    if not total:
        raise RuntimeError(f"no windows: {skipped} videos have no length, or all are shorter than {least} s")
    stats = {"total": total, "source_rows": run.manifest.count(), "skipped_videos": skipped}
    done = Run(**{**run.__dict__, "manifest": windows, "stats": {**run.stats, "window_video": stats}})
    return done, spark.createDataFrame([(folder,)], "path string")

"""Sinks: manifests, reports, markers, arrays and tar shards."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import tarfile
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread


def write_manifest(df: DataFrame, path: str, quote_all: bool = False) -> None:
    """A manifest as tab-separated files in a folder, with headers; quotes are doubled inside quotes."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("escape", '"').option("emptyValue", "").option("quoteAll", quote_all).csv(path)


def write_report(stats: dict, missing: DataFrame, folder: str) -> None:
    """download_report.json and missing_videos (VIDEO_ID, REASON), the latter with a header even when nothing is missing."""
    os.makedirs(folder, exist_ok=True)
    _atomic(os.path.join(folder, "download_report.json"), json.dumps(stats, indent=2, sort_keys=True).encode())
    missing.select("VIDEO_ID", "REASON").coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(os.path.join(folder, "missing_videos"))


@contextmanager
def _apart(folder: str):
    """A folder of a task's own below ``folder``, for files that aren't whole yet. Tasks that make their files in one folder wait
    for each other, so that only the last step, the renaming, is done there. Listings pass over its name."""
    own = f"{folder}/.tmp{os.urandom(12).hex()}"
    os.makedirs(own)
    try:
        yield own
    finally:
        shutil.rmtree(own, ignore_errors=True)


@contextmanager
def _replacing(path: str, own: str | None = None):
    """A file under another name that takes its own when it is whole, so that a repeated or parallel attempt never leaves half a file."""
    handle, temporary = tempfile.mkstemp(dir=own or os.path.dirname(path) or ".")
    try:
        with os.fdopen(handle, "w+b") as f:
            yield f
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise


def _atomic(path: str, data: bytes, own: str | None = None) -> None:
    """As _replacing, with few calls of the system, as there may be a great many small files."""
    folder = os.path.dirname(path) or "."
    if own is None:
        os.makedirs(folder, exist_ok=True)
    temporary = f"{own or folder}/tmp{os.urandom(12).hex()}"
    handle = os.open(temporary, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o600)
    try:
        try:
            rest = memoryview(data)
            while rest:
                rest = rest[os.write(handle, rest) :]
        finally:
            os.close(handle)
        try:
            os.replace(temporary, path)
        except FileNotFoundError:
            os.makedirs(folder, exist_ok=True)
            os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[object, Iterator[pa.RecordBatch]]]:
    """Runs of rows with one value, of sorted rows; a run is read a batch at a time, before the next is asked for."""
    parts = ((names[a], b.slice(a, z - a)) for b in batches if b.num_rows for names in [b.column(column).to_pylist()] for cuts in [[0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]] for a, z in zip(cuts, cuts[1:]))
    ahead = next(parts, None)
    while ahead is not None:
        key = ahead[0]

        def run() -> Iterator[pa.RecordBatch]:
            nonlocal ahead
            while ahead is not None and ahead[0] == key:  # noqa: B023
                part, ahead = ahead[1], None
                yield part
                ahead = next(parts, None)

        yield key, run()


def write_arrays(clips: DataFrame, folder: str) -> DataFrame:
    """(sample, path, frames): one .npy for each sample of (sample, t, values array<float>); folder must be shared.

    A sample's frames come sorted and stream into its file. The header, which leaves room for any number of frames, gets
    theirs at the end.
    """

    def head(f, n: int, width: int) -> int:
        import numpy as np

        f.seek(0)
        np.lib.format.write_array_header_1_0(f, {"descr": "<f4", "fortran_order": False, "shape": (n, width)})
        return f.tell()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _apart(folder) as own:
            yield from each(batches, own)

    def each(batches: Iterator[pa.RecordBatch], own: str) -> Iterator[pa.RecordBatch]:
        for sample, parts in _runs(batches, "sample"):
            path, n, width, begin = f"{folder}/{sample}.npy", 0, None, 0
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with _replacing(path, own) as f:
                for part in parts:
                    values = part.column("values")
                    widths = set(values.value_lengths().to_pylist())
                    if width is None:
                        width = next(iter(widths)) or 0
                        begin = head(f, 0, width)
                    if widths != {width}:
                        raise ValueError(f"{sample}: frames of {sorted(widths | {width}, key=str)} numbers")
                    f.write(values.flatten().to_numpy(zero_copy_only=False).astype("<f4").tobytes())
                    n += len(part)
                if head(f, n, width) != begin:
                    raise ValueError(f"{path}: no room for {n} frames")
            yield pa.RecordBatch.from_arrays([pa.array([None if sample is None else str(sample)], pa.string()), pa.array([path], pa.string()), pa.array([n], pa.int64())], ["sample", "path", "frames"])

    rows = spread(clips.select("sample", "t", "values"), "sample").sortWithinPartitions(F.col("sample"), F.col("t").asc_nulls_last())
    return rows.mapInArrow(write, "sample string, path string, frames long")


def write_blobs(blobs: DataFrame, folder: str) -> DataFrame:
    """(path, bytes): one file for each row (name, payload) below a shared folder; a repeated attempt writes the same file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _apart(folder) as own:
            for batch in batches:
                paths, payloads = [f"{folder}/{n}" for n in batch.column("name").to_pylist()], batch.column("payload")
                for path, payload in zip(paths, payloads):
                    _atomic(path, payload.as_py(), own)
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pc.binary_length(payloads).cast(pa.int64())], ["path", "bytes"])

    return spread(blobs.select("name", F.col("payload").cast("binary").alias("payload")), "name").mapInArrow(run, "path string, bytes long")


#: Of a member's header: its length, the largest size that it holds in digits, and the whole of one without a name and contents.
_BLOCK, _MOST, _PLAIN = 512, 8**11, tarfile.TarInfo("").tobuf()
_SUM = sum(_PLAIN[:148]) + 8 * 32 + sum(_PLAIN[156:]) - sum(_PLAIN[124:135])


def _tar_head(name: str, size: int) -> bytes:
    """A member's header as tarfile makes it. Plain ones are filled in by hand, as there may be a great many."""
    if not name.isascii() or len(name) > 100 or size >= _MOST:
        info = tarfile.TarInfo(name)
        info.size = size
        return info.tobuf()
    raw, digits = name.encode(), b"%011o" % size
    return raw.ljust(100, b"\0") + _PLAIN[100:124] + digits + _PLAIN[135:148] + b"%06o\0 " % (_SUM + sum(raw) + sum(digits)) + _PLAIN[156:]


def write_tar_shards(members: DataFrame, folder: str, prefix: str = "shard") -> DataFrame:
    """(shard_id, path, members, bytes): one tar for each shard_id of (shard_id, key, ext, payload, source), members by key and ext.

    A member's bytes are its payload, or the contents of the file ``source``. Members come sorted and go into the tar one
    after another. They carry time 0: a repeated attempt writes the same bytes.
    """

    def put(out, name: str, payload: bytes | None, source: str | None) -> int:
        if payload is not None:
            out.write(_tar_head(name, len(payload)) + payload + bytes(-len(payload) % _BLOCK))
            return len(payload)
        with open(source, "rb", buffering=0) as f:
            size = left = os.fstat(f.fileno()).st_size
            out.write(_tar_head(name, size))
            while left:
                data = f.read(min(left, 1 << 20))
                if not data:
                    raise OSError(f"{source} ends early")
                out.write(data)
                left -= len(data)
        out.write(bytes(-size % _BLOCK))
        return size

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for shard, parts in _runs(batches, "shard_id"):
            path, n, total = f"{folder}/{prefix}-{shard:06d}.tar", 0, 0
            with _replacing(path) as out:
                for part in parts:
                    for key, ext, payload, source in zip(*(part.column(c).to_pylist() for c in ("key", "ext")), part.column("payload"), part.column("source").to_pylist()):
                        n, total = n + 1, total + put(out, f"{key}.{ext}", payload.as_py(), source)
                out.write(bytes(2 * _BLOCK))
                out.write(bytes(-out.tell() % tarfile.RECORDSIZE))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([path], pa.string()), pa.array([n], pa.int64()), pa.array([total], pa.int64())], ["shard_id", "path", "members", "bytes"])

    rows = members.select(F.col("shard_id").cast("long").alias("shard_id"), "key", "ext", "payload", "source")
    rows = spread(rows, "shard_id").sortWithinPartitions("shard_id", F.col("key").asc_nulls_last(), F.col("ext").asc_nulls_last())
    return rows.mapInArrow(write, "shard_id long, path string, members long, bytes long")


def webdataset_members(samples: DataFrame, artifact: str | None = None, source: str = "ARTIFACT") -> DataFrame:
    """(shard_id, key, ext, payload, source) from (shard_id, SAMPLE_ID, TEXT, meta): txt and json, and the file that the column
    ``source`` names, with the suffix ``artifact``, if any; samples without one are left out then."""
    none = F.lit(None).cast("string").alias("source")
    parts = [F.struct(F.lit("txt").alias("ext"), F.coalesce("TEXT", F.lit("")).cast("binary").alias("payload"), none), F.struct(F.lit("json").alias("ext"), F.col("meta").cast("binary").alias("payload"), none)]
    if artifact:
        parts.append(F.struct(F.lit(artifact).alias("ext"), F.lit(None).cast("binary").alias("payload"), F.col(source).alias("source")))
        samples = samples.where(F.col(source).isNotNull())
    return samples.select("shard_id", F.col("SAMPLE_ID").alias("key"), F.explode(F.array(*parts)).alias("m")).select("shard_id", "key", "m.*")


MARKER = "_SUCCESS.json"


def text_hash(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def write_marker(folder: str, stage: str, config: dict, manifest_hash: str, upstream: list[str], outputs: DataFrame | list[str]) -> dict:
    """The proof that a stage ended: what went in, what came out. Of outputs (path) only the number and five names are kept."""
    if isinstance(outputs, DataFrame):
        count, sample = outputs.count(), [r["path"] for r in outputs.orderBy("path").limit(5).collect()]
    else:
        count, sample = len(outputs), sorted(outputs)[:5]
    mark = {"stage": stage, "stage_config_hash": text_hash(config), "manifest_hash": manifest_hash, "upstream_success_hash": text_hash(sorted(upstream)), "output_count": count, "output_sample": sample, "timestamp": datetime.now(timezone.utc).isoformat()}
    os.makedirs(folder, exist_ok=True)
    _atomic(os.path.join(folder, MARKER), json.dumps(mark, indent=2).encode())
    return mark


def read_marker(folder: str) -> dict | None:
    try:
        with open(os.path.join(folder, MARKER), "rb") as f:
            return json.load(f)
    except (OSError, ValueError):
        return None


def marker_holds(folder: str, config: dict, manifest_hash: str, upstream: list[str]) -> bool:
    """Whether the stage ended with the same input and its results are still there."""
    mark = read_marker(folder)
    if not mark or mark.get("output_count", 0) <= 0:
        return False
    same = mark["stage_config_hash"] == text_hash(config) and mark["manifest_hash"] == manifest_hash and mark["upstream_success_hash"] == text_hash(sorted(upstream))
    return same and all(os.path.exists(p) for p in mark["output_sample"])


def job_results(spark: SparkSession, results: list[dict]) -> DataFrame:
    """(config, status, stats, error) of the jobs of an experiment."""
    rows = [(r["config"], r["status"], json.dumps(r.get("stats") or {}, sort_keys=True), r.get("error")) for r in results]
    return spark.createDataFrame(rows, "config string, status string, stats string, error string")

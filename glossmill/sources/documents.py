"""Annotations in JSON, and listings of files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import spread

VIDEO_SUFFIXES = ("mp4", "webm", "mkv", "avi", "mov")


def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """(VIDEO_ID, pos, text, start, duration) of a folder of transcripts, one JSON array a file, named like its video.

    Entries need the keys text, start and duration. A file that is no such array, or holds an entry whose value isn't of
    its kind, is left out as a whole.
    """
    entry = "array<struct<text:string,start:double,duration:double>>"
    raw = spark.read.option("wholetext", True).text(f"{folder}/*.json").select(tx.stem(F.col("_metadata.file_name")).alias("VIDEO_ID"), "value")
    cells = F.from_json("value", "array<string>")
    rows = raw.select("VIDEO_ID", F.from_json("value", entry, {"mode": "PERMISSIVE"}).alias("items"), cells.alias("cells")).where("items is not null")
    keys = F.array(F.lit("text"), F.lit("start"), F.lit("duration"))
    complete = F.transform("cells", lambda c: F.size(F.array_intersect(F.json_object_keys(c), keys)) == 3)
    rows = rows.withColumn("complete", complete)
    whole = F.forall(F.arrays_zip("items", "complete"), lambda z: ~F.coalesce(z["complete"], F.lit(False)) | (z["items"]["text"].isNotNull() & z["items"]["start"].isNotNull() & z["items"]["duration"].isNotNull()))
    good = rows.where(whole).select("VIDEO_ID", F.posexplode(F.arrays_zip("items", "complete")).alias("pos", "z"))
    return good.where("z.complete").select("VIDEO_ID", "pos", "z.items.*")


def openasl_boxes(spark: SparkSession, path: str) -> DataFrame:
    from ..operators.joins import boxes_from_json

    return boxes_from_json(spark.read.option("wholetext", True).text(path))


def msasl(spark: SparkSession, path: str) -> DataFrame:
    schema = "url string, text string, signer_id string, start_time double, end_time double, label bigint, fps double, box array<double>, clean_text string"
    return spark.read.option("multiLine", True).schema(schema).json(path)


def wlasl(spark: SparkSession, path: str) -> DataFrame:
    """(i, j, gloss, and the instance's fields as strings) of the nested file."""
    inner = "struct<video_id:string,fps:string,frame_start:string,frame_end:string,split:string,signer_id:string,url:string,variation_id:string>"
    rows = spark.read.option("wholetext", True).text(path).select(F.from_json("value", f"array<struct<gloss:string,instances:array<{inner}>>>").alias("v"))
    outer = rows.select(F.posexplode("v").alias("i", "e")).select("i", F.col("e.gloss").alias("gloss"), F.posexplode("e.instances").alias("j", "x"))
    return outer.select("i", "j", "gloss", "x.*")


def _local(spark: SparkSession, folder: str) -> str | None:
    """The folder's plain path if it is one of the ordinary files that driver and executors share."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file" or not fs.exists(target) or not fs.getFileStatus(target).isDirectory():
        return None
    return fs.makeQualified(target).toUri().getPath().rstrip("/")


def _walk(top: str, suffixes: tuple[str, ...], deep: bool) -> Iterator[tuple[str, int]]:
    """Paths and lengths of files. As Spark's own listing does, it passes over hidden names and files of no length."""
    import os

    ends, folders = tuple(f".{s}" for s in suffixes), [top]
    while folders:
        with os.scandir(folders.pop()) as entries:
            for e in entries:
                if e.name.startswith(".") or e.name.endswith("._COPYING_") or (e.name.startswith("_") and "=" not in e.name):
                    continue
                try:
                    if e.is_dir():
                        if deep:
                            folders.append(e.path)
                    elif e.name.endswith(ends) and (size := e.stat().st_size):
                        yield os.fsencode(e.path).decode(errors="replace"), size
                except FileNotFoundError:  # a link to nothing, or another task's temporary file
                    continue


def found(spark: SparkSession, folder: str, suffixes: tuple[str, ...], deep: bool = True) -> DataFrame:
    """(path, length) of files in a folder, and below it if ``deep``.

    A folder of ordinary files is walked by an executor and streams out of it, so that the driver holds no file of it. Of
    other stores Spark's own listing knows, which the driver holds. The walk begins at an RDD, whose size Spark doesn't guess:
    it would take a range of one row for a short listing and broadcast it through the driver, however long it turns out.
    """
    top = _local(spark, folder)
    if top is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", deep).option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").load(folder)
        return files.select(F.regexp_replace(F.expr("url_decode(replace(path, '+', '%2B'))"), r"^file:/*", "/").alias("path"), "length")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import batched

        for _ in batches:
            for some in batched(_walk(top, suffixes, deep), 10_000):
                paths, lengths = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(lengths, pa.int64())], ["path", "length"])

    return spark.createDataFrame(spark.sparkContext.parallelize([(0,)], 1), "id int").mapInArrow(walk, "path string, length long")


def listing(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = VIDEO_SUFFIXES) -> DataFrame:
    """(rel_path, stem) of files below a folder. Only names are read, no contents. Files of no length are left out."""
    base = F.lit((_local(spark, folder) or folder.rstrip("/")) + "/")
    rel = F.regexp_replace("path", r"^[a-z]+:/*", "/")
    return found(spark, folder, suffixes).select(F.replace(rel, base, F.lit("")).alias("rel_path")).withColumn("stem", tx.stem(F.col("rel_path")))


def stems(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = VIDEO_SUFFIXES) -> DataFrame:
    return listing(spark, folder, suffixes).select("stem").distinct()


def name_facts(files: DataFrame) -> DataFrame:
    """(rel_path, stem, class_id, signer, repetition) of names made of exactly three numbers; others are left out."""
    p = F.split("stem", "_")
    number = lambda i: F.get(p, F.lit(i)).try_cast("int")
    return files.where(F.size(p) == 3).select("rel_path", "stem", number(0).alias("class_id"), number(1).alias("signer"), number(2).alias("repetition")).where("class_id is not null and signer is not null and repetition is not null")


def csl_videos(files: DataFrame) -> DataFrame:
    """(rel_path, signer, sentence, variation) from names of one, two or three and more numbers."""
    p = F.split("stem", "_")
    n = lambda i: F.get(p, F.lit(i)).try_cast("int")
    zero = F.lit(0)
    many, two = F.size(p) >= 3, F.size(p) == 2
    rows = files.select(
        "rel_path",
        F.when(many | two, n(0)).otherwise(zero).alias("signer"),
        F.when(many | two, n(1)).otherwise(n(0)).alias("sentence"),
        F.when(many, n(2)).otherwise(zero).alias("variation"),
    )
    return rows.where("signer is not null and sentence is not null and variation is not null")


#: Bytes of a file that one task reads, and numbers in a batch of frames.
_PIECE, _NUMBERS = 64 << 20, 1 << 18


def _frames(path: str, name: str, at: int, a) -> pa.RecordBatch:
    """A batch (sample, t, frame) of frames from number ``at`` on; NaN is null."""
    import numpy as np

    from ..functions.landmarks import check_flat

    if a.ndim == 2:
        a = a.reshape(len(a), check_flat(a.shape[1]), 4)
    elif a.ndim != 3 or a.shape[2] != 4:
        raise ValueError(f"{path}: expected (frames, landmarks, 4), found {a.shape}")
    a = a.astype(np.float32)
    points = pa.StructArray.from_arrays([pa.array(a[:, :, i].ravel(), from_pandas=True) for i in range(4)], list("xyzv"))
    frames = pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), points)
    return pa.RecordBatch.from_arrays([pa.array([name] * len(a), pa.string()), pa.array(np.arange(at, at + len(a)), pa.int32()), frames], ["sample", "t", "frame"])


def _read_frames(path: str, source, piece: int, pieces: int) -> Iterator[pa.RecordBatch]:
    """Batches of one of the pieces into which the frames of a .npy are dealt. Of a file only a batch is in memory."""
    import numpy as np

    name, form = path.rsplit("/", 1)[-1].removesuffix(".npy"), np.lib.format
    version = form.read_magic(source)
    shape, by_column, kind = (form.read_array_header_1_0 if version == (1, 0) else form.read_array_header_2_0)(source)
    width, each = int(np.prod(shape[1:])), -(-shape[0] // pieces) if shape else 0
    begin, end = piece * each, min((piece + 1) * each, shape[0] if shape else 0)
    step = max(1, _NUMBERS // max(1, width))
    whole = None
    if by_column or kind.hasobject or len(shape) < 2 or version > (2, 0) or not width:  # none of our own
        source.seek(0)
        whole = np.load(source, allow_pickle=False)
        if whole.ndim < 2:
            _frames(path, name, 0, whole)
    else:
        source.seek(begin * width * kind.itemsize, 1)
    for at in range(begin, end, step):
        n = min(step, end - at)
        if whole is None:
            data = source.read(n * width * kind.itemsize)
            if len(data) < n * width * kind.itemsize:
                raise ValueError(f"{path} ends early")
            a = np.frombuffer(data, kind).reshape(n, *shape[1:])
        else:
            a = whole[at : at + n]
        yield _frames(path, name, at, a)


def landmark_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """(sample, t, frame array<struct<x, y, z, v>>) of .npy files below a folder, flat or of three dimensions. Large files are
    read by several tasks, and of each file a batch at a time is in memory; of another store than ordinary files the file is."""
    import io

    schema = "sample string, t int, frame array<struct<x:float,y:float,z:float,v:float>>"
    if _local(spark, folder) is None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, content in zip(batch.column("path"), batch.column("content")):
                    yield from _read_frames(path.as_py(), io.BytesIO(content.as_py()), 0, 1)

        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npy").load(folder)
        return files.select("path", "content").mapInArrow(run, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, numbers = [], 0
            for r in batch.to_pylist():
                with open(r["path"], "rb") as source:
                    for frames in _read_frames(r["path"], source, r["piece"], r["pieces"]):
                        held.append(frames)
                        numbers += 4 * len(frames.column("frame").flatten())
                        if numbers >= _NUMBERS:
                            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                            held, numbers = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    n = F.ceil(F.col("length") / _PIECE).cast("int")
    pieces = found(spark, folder, ("npy",)).select("path", n.alias("pieces"), F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    return spread(pieces, "path", "piece").mapInArrow(read, schema)


def artifacts(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(SAMPLE_ID, path, bytes) of the results of one kind in a folder; none where there is no such folder. Only names and sizes are read."""
    from . import discovery

    if not discovery.is_folder(spark, folder):
        return spark.createDataFrame([], "SAMPLE_ID string, path string, bytes long")
    return found(spark, folder, (suffix,), deep=False).select(tx.stem(F.col("path")).alias("SAMPLE_ID"), "path", F.col("length").alias("bytes"))


def _plain(head: bytes) -> int | None:
    """The size in a tar header of an ordinary file with a short name, or None for any other block and for a wrong sum."""
    digits, summed = head[124:136].rstrip(b" \0"), head[148:156].rstrip(b" \0")
    if head[156:157] != b"0" or head[257:263] != b"ustar\0" or any(head[345:500]) or not digits or not summed or (digits + summed).strip(b"01234567"):
        return None
    return int(digits, 8) if sum(head) - sum(head[148:156]) + 8 * 32 == int(summed, 8) else None


def tar_members(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, key, ext, payload) of the tar shards below a folder, some members at a time."""
    import io

    schema, most = "shard string, key string, ext string, payload binary", 8 << 20

    def members(path: str, source) -> Iterator[tuple]:
        """Plain headers, of which there may be a great many, are read by hand; from the first other one on, tarfile reads."""
        import tarfile

        shard, at, size = path.rsplit("/", 1)[-1], 0, tarfile.BLOCKSIZE
        while len(head := source.read(size)) == size and (length := _plain(head)) is not None:
            data = source.read(length + -length % size)
            if len(data) < length:
                raise tarfile.ReadError(f"{path}: unexpected end of data")
            at += size + len(data)
            key, ext = head[:100].split(b"\0", 1)[0].decode("utf-8", "surrogateescape").rsplit(".", 1)
            yield shard, key, ext, data[:length]
        if at and (len(head) < size or not any(head)):  # the end
            return
        source.seek(at)
        with tarfile.open(fileobj=source) as tar:
            for m in tar:
                key, ext = m.name.rsplit(".", 1)
                yield shard, key, ext, tar.extractfile(m).read()
                tar.members = []  # it would keep them all

    def grouped(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for r in rows:
            held.append(r)
            size += len(r[3]) + 200
            if size >= most:
                yield _columns(held)
                held, size = [], 0
        if held:
            yield _columns(held)

    def _columns(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.string(), pa.binary()))], ["shard", "key", "ext", "payload"])

    if _local(spark, folder) is None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from grouped(r for path, content in zip(batch.column("path"), batch.column("content")) for r in members(path.as_py(), io.BytesIO(content.as_py())))

        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tar").load(folder)
        return files.select("path", "content").mapInArrow(run, schema)

    def opened(path: str) -> Iterator[tuple]:
        with open(path, "rb") as source:
            yield from members(path, source)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grouped(r for batch in batches for path in batch.column("path").to_pylist() for r in opened(path))

    return spread(found(spark, folder, ("tar",)).select("path"), "path").mapInArrow(read, schema)

"""One builder for each of the ten datasets: annotations in, manifest out. Each is one lazy plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import availability, joins
from ..operators import manifest as mf

# Fixed values of the datasets' splits.
SPLIT_I = {"train": (1, 40), "test": (41, 50)}  # signers
SPLIT_II = {"train": (1, 94), "test": (95, 100)}  # sentences
LSA_SIGNERS = {"train": (1, 2, 3, 4, 5, 6, 7, 8), "val": (9,), "test": (10,)}
ALL_CLASSES = 1000
AUTSL_SUFFIXES = {"rgb": "_color", "depth": "_depth"}


def stacked(parts: list[DataFrame]) -> DataFrame:
    """All rows of the parts; columns that a part lacks are null in it."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def only_split(df: DataFrame, split: str) -> DataFrame:
    return df if split == "all" else df.where(F.col("SPLIT") == split)


def only_classes(df: DataFrame, n: int, active: bool) -> DataFrame:
    return df.where(F.col("CLASS_ID") < n) if active else df


def without_background(df: DataFrame, column: str, background: tuple[str, ...]) -> DataFrame:
    """Rows whose label isn't background; rows without a label stay."""
    return df.where(~F.coalesce(F.col(column).isin(*background), F.lit(False))) if background else df


def split_by_protocol(signer: Column, sentence: Column, protocol: str) -> Column:
    table = {"split_i": (signer, SPLIT_I), "split_ii": (sentence, SPLIT_II)}
    if protocol not in table:
        raise ValueError(f"no protocol {protocol!r}; there are {sorted(table)}")
    key, spans = table[protocol]
    return F.when(key.between(*spans["train"]), "train").when(key.between(*spans["test"]), "test").otherwise("unknown")


def split_by_signer(signer: Column, groups: dict[str, tuple[int, ...]]) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, members in groups.items():
        out = out.when(signer.isin(*members), name)
    return out.otherwise("unknown")


def youtube_asl(entries: DataFrame, most_chars: int = 300, least: float = 0.2, most: float = 60.0, **text_options) -> DataFrame:
    """Segments from transcript entries (VIDEO_ID, pos, text, start, duration)."""
    kept = entries.withColumn("TEXT", tx.normalise(F.col("text"), **text_options))
    kept = kept.where((F.col("TEXT") != "") & (F.length("TEXT") <= most_chars) & F.col("duration").between(least, most))
    rows = mf.running_index(kept.select("VIDEO_ID", "pos", "start", "duration", "TEXT"), "VIDEO_ID", "pos")
    return rows.select(F.concat("VIDEO_ID", F.lit("-"), tx.padded(F.col("idx"), 3)).alias("SAMPLE_ID"), "VIDEO_ID", F.col("start").alias("START"), (F.col("start") + F.col("duration")).alias("END"), "TEXT")


def how2sign(spark: SparkSession, path: str) -> DataFrame:
    from ..sources import tables

    return tables.manifest(spark, path)


def openasl(rows: DataFrame, text_column: str = "en", found: DataFrame | None = None) -> DataFrame:
    columns = [F.col("vid").alias("SAMPLE_ID"), F.col("yid").alias("VIDEO_ID"), tx.real(F.col("start")).alias("START"), tx.real(F.col("end")).alias("END")]
    if text_column in rows.columns:
        columns.append(F.coalesce(F.col(text_column), F.lit("")).alias("TEXT"))
    df = rows.select(*columns, *mf.passthrough(rows, {"split": "SPLIT", "signer_id": "SIGNER_ID"}))
    return df if found is None else joins.boxes_by_sample(df, found)


def autsl(splits: dict[str, DataFrame], classes: DataFrame, modality: str = "rgb", fps: float = 30.0, durations: DataFrame | None = None, folders: dict[str, str] | None = None) -> DataFrame:
    """Labels (sample_key, label_id) of each split with the class names (CLASS_ID, GLOSS_TR, GLOSS_EN). A split's
    folder is called like it, if ``folders`` doesn't say otherwise."""
    if not splits:
        raise ValueError("no split has labels")
    suffix = AUTSL_SUFFIXES[modality]
    rows = stacked([df.withColumns({"SPLIT": F.lit(name), "_folder": F.lit((folders or {}).get(name, name))}) for name, df in splits.items()])
    rows = rows.withColumn("CLASS_ID", tx.real(F.col("label_id")).cast("long"))
    names = joins.last_wins(classes.select(tx.real(F.col("CLASS_ID")).cast("long").alias("CLASS_ID"), "GLOSS_TR", "GLOSS_EN").withColumn("line", F.monotonically_increasing_id()), "CLASS_ID", "line")
    out = joins.lookup(rows, names, "CLASS_ID")
    video = F.concat("sample_key", F.lit(suffix))
    out = out.select(video.alias("SAMPLE_ID"), video.alias("VIDEO_ID"), F.concat("_folder", F.lit("/"), video, F.lit(".mp4")).alias("REL_PATH"), "SPLIT", "CLASS_ID", F.col("GLOSS_TR").alias("GLOSS"), F.coalesce(tx.present(F.col("GLOSS_EN")), F.col("GLOSS_TR")).alias("TEXT"), tx.signer_number(F.col("sample_key")).alias("SIGNER_ID"), F.lit(fps).alias("FPS"), F.lit(0.0).alias("START"))
    if durations is None:
        return out.withColumn("END", F.lit(0.0))
    return out.join(durations.select("VIDEO_ID", F.col("duration").alias("_d")), "VIDEO_ID", "left").withColumn("END", F.coalesce("_d", F.lit(0.0))).drop("_d")


def csl(corpus: DataFrame, videos: DataFrame, protocol: str = "split_i", split: str = "all", spec: DataFrame | None = None, fps: float = 30.0) -> DataFrame:
    # What follows from a sentence or a video alone is made before they meet, as there are many more pairs than either.
    variation = F.coalesce("variation", F.lit(0))
    said = corpus.withColumns({"_prefix": F.format_string("%03d_%03d_", "signer", "sentence"), "_signer_id": F.col("signer").cast("string")})
    if spec is None:
        said = said.withColumn("SPLIT", split_by_protocol(F.col("signer"), F.col("sentence"), protocol))
    seen = videos.withColumns({"_video": tx.stem(F.col("rel_path")), "_two": F.format_string("%02d", variation), "_variation_id": variation.cast("string")})
    rows = joins.corpus_videos(said, seen, ("_video", "_two", "_variation_id"))
    rows = rows.withColumns({"rel_path": F.coalesce("rel_path", F.lit("")), "SAMPLE_ID": F.concat("_prefix", F.coalesce("_two", F.lit("00")))})
    if spec is not None:
        rows = joins.lookup(rows, spec.select("SAMPLE_ID", "SPLIT"), "SAMPLE_ID", "unknown")
    out = rows.select("SAMPLE_ID", F.when(F.col("rel_path") == "", F.col("SAMPLE_ID")).otherwise(F.col("_video")).alias("VIDEO_ID"), F.col("rel_path").alias("REL_PATH"), "SPLIT", F.col("text").alias("TEXT"), F.col("_signer_id").alias("SIGNER_ID"), F.coalesce("_variation_id", F.lit("0")).alias("VARIATION_ID"), F.lit(fps).alias("FPS"))
    return mf.in_order(only_split(out, split))


def lsa64(facts: DataFrame, classes: DataFrame | None, variant: str = "cut", signers: dict[str, tuple[int, ...]] | None = None, split: str = "all", fps: float = 60.0) -> DataFrame:
    rows = facts.select(F.concat(F.lit(f"{variant}-"), "stem").alias("SAMPLE_ID"), F.col("stem").alias("VIDEO_ID"), F.col("rel_path").alias("REL_PATH"), F.col("class_id").cast("long").alias("CLASS_ID"), F.col("signer").cast("string").alias("SIGNER_ID"), F.col("repetition").cast("long").alias("REPETITION_ID"), F.lit(fps).alias("FPS"), (F.lit("all") if signers is None else split_by_signer(F.col("signer"), signers)).alias("SPLIT"))
    rows = only_split(rows, split) if signers is not None else rows
    if classes is not None:
        rows = joins.class_map(rows, classes, extras=tuple(c for c in classes.columns if c != "CLASS_ID"))
    return mf.in_order(rows)


def msasl(splits: dict[str, DataFrame], subset: int = ALL_CLASSES) -> DataFrame:
    rows = stacked([df.withColumn("SPLIT", F.lit(name)) for name, df in splits.items()])
    video = tx.youtube_id(F.col("url"))
    ms = lambda c: tx.milliseconds(F.col(c)).cast("string")
    sample = F.concat_ws("-", "SPLIT", video, ms("start_time"), ms("end_time"), F.col("label").cast("string"))
    at = lambda i: F.when(F.size("box") == 4, F.get("box", F.lit(i)))
    out = rows.select(sample.alias("SAMPLE_ID"), video.alias("VIDEO_ID"), F.col("start_time").alias("START"), F.col("end_time").alias("END"), "SPLIT", F.col("text").alias("TEXT"), F.col("label").alias("CLASS_ID"), at(1).alias("BBOX_X1"), at(0).alias("BBOX_Y1"), at(3).alias("BBOX_X2"), at(2).alias("BBOX_Y2"), F.when(F.size("box") == 4, F.lit(True)).alias("PERSON_DETECTED"), F.col("signer_id").alias("SIGNER_ID"), F.col("fps").alias("FPS"), F.col("url").alias("SOURCE_URL"))
    return only_classes(out, subset, subset < ALL_CLASSES)


def slovo(rows: DataFrame, split: str = "all", classes: str = "derive", class_map: DataFrame | None = None, background: tuple[str, ...] = (), probes: DataFrame | None = None) -> DataFrame:
    train = F.when(tx.flag(F.col("train")), "train").otherwise("test")
    df = only_split(rows.withColumn("SPLIT", train), split)
    df = without_background(df, "text", background)
    out = df.select(F.col("attachment_id").alias("SAMPLE_ID"), F.col("attachment_id").alias("VIDEO_ID"), F.concat("attachment_id", F.lit(".mp4")).alias("REL_PATH"), "SPLIT", F.col("text").alias("TEXT"), F.col("text").alias("GLOSS"), F.col("user_id").alias("SIGNER_ID"), *(tx.real(F.col(a)).cast("long").alias(b) for a, b in {"width": "SRC_WIDTH", "height": "SRC_HEIGHT", "length": "FRAME_COUNT"}.items() if a in df.columns))
    if probes is not None:
        out = out.join(probes.select("VIDEO_ID", F.col("fps").alias("FPS"), F.col("duration").alias("END")), "VIDEO_ID", "left").withColumn("START", F.lit(0.0))
    if classes == "derive":
        return mf.dense_classes(out, "GLOSS")
    if classes == "bundled" and class_map is not None:
        return joins.class_map(out, class_map, key="GLOSS", extras=("CLASS_ID",))
    return out


def wlasl(rows: DataFrame, subset: int = 0, split: str = "all", durations: DataFrame | None = None) -> DataFrame:
    fps = F.coalesce(tx.real(F.col("fps")), F.lit(0.0))
    a, b = tx.real(F.col("frame_start")), tx.real(F.col("frame_end"))
    timed = a.isNotNull() & b.isNotNull() & (fps > 0)
    sample = F.coalesce(tx.present(F.col("video_id")), F.concat_ws("-", F.col("i").cast("string"), F.col("j").cast("string")))
    out = rows.select(sample.alias("SAMPLE_ID"), sample.alias("VIDEO_ID"), F.when(timed, a / F.nullif(fps, F.lit(0.0))).otherwise(0.0).alias("START"), F.when(timed, b / F.nullif(fps, F.lit(0.0))).alias("END"), F.col("split").alias("SPLIT"), F.col("gloss").alias("TEXT"), F.col("gloss").alias("GLOSS"), F.col("i").cast("long").alias("CLASS_ID"), F.col("signer_id").alias("SIGNER_ID"), fps.alias("FPS"), F.col("variation_id").alias("VARIATION_ID"), F.col("url").alias("SOURCE_URL"))
    if durations is not None:
        out = out.join(durations.select("VIDEO_ID", F.col("duration").alias("_d")), "VIDEO_ID", "left").withColumn("END", F.coalesce("END", "_d")).drop("_d")
    out = out.withColumn("END", F.coalesce("END", F.lit(0.0)))
    return only_split(only_classes(out, subset, subset > 0), split)


def phoenix(splits: dict[str, DataFrame]) -> DataFrame:
    def one(name: str, df: DataFrame) -> DataFrame:
        clip = tx.clip_id(F.col("_id"))
        columns = [clip.alias("SAMPLE_ID"), clip.alias("VIDEO_ID"), F.concat(F.lit(f"{name}/"), clip, F.lit(".mp4")).alias("REL_PATH"), F.lit(name).alias("SPLIT")]
        columns += [F.trim(c).alias(n) for c, n in {"orth": "GLOSS", "translation": "TEXT", "signer": "SIGNER_ID"}.items() if c in df.columns]
        if {"start", "end"} <= set(df.columns):
            a, b = tx.real(F.col("start")), tx.real(F.col("end"))
            good = (a >= 0) & (b > a)
            columns += [F.when(good, a).alias("START"), F.when(good, b).alias("END")]
        return df.select(*columns)

    return stacked([one(n, d) for n, d in splits.items()])


def with_policy(df: DataFrame, there: DataFrame, policy: str, path: bool = False) -> DataFrame:
    return availability.by_path(df, there, policy) if path else availability.by_id(df, there, policy)


BUILDERS = {"youtube_asl": youtube_asl, "how2sign": how2sign, "openasl": openasl, "autsl": autsl, "csl": csl, "lsa64": lsa64, "msasl": msasl, "slovo": slovo, "wlasl": wlasl, "rwth_phoenix_weather": phoenix}

"""Annotation files, builders, sinks and jobs over files written by the tests."""

import json
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossmill.operators import availability, joins, models, shards
from glossmill.operators import manifest as mf
from glossmill.plans import adapters, builders, config, runner  # noqa: F401  adapters register datasets
from glossmill.sinks import files
from glossmill.sources import documents, tables
from glossmill.streaming import ingest


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def rows(df, *by):
    return [tuple(r) for r in df.orderBy(*(by or df.columns)).collect()]


def test_transcripts_become_segments(spark, tmp_path):
    say = lambda t, s, d: {"text": t, "start": s, "duration": d}
    put(tmp_path / "vid001.json", json.dumps([say("Hello world", 0.0, 2.0), say("x" * 301, 2, 2), say("short", 4, 0.1), say("  ", 5, 2), {"text": "no time"}, say("again", 6.0, 2.0)]))
    put(tmp_path / "bad.json", "{")
    put(tmp_path / "null.json", json.dumps([say(None, 0, 1), say("lost with its file", 1, 1)]))
    put(tmp_path / "empty.json", "[]")
    df = builders.youtube_asl(documents.transcripts(spark, str(tmp_path)))
    assert rows(df) == [("vid001-000", "vid001", 0.0, 2.0, "Hello world"), ("vid001-001", "vid001", 6.0, 8.0, "again")]


def test_manifest_files(spark, tmp_path):
    old = put(tmp_path / "m.tsv", "VIDEO_NAME\tSENTENCE_NAME\tSTART_REALIGNED\tEND_REALIGNED\tSENTENCE\nv1\ts1\t0\t2\tHello\nNA\t001\t1\t2\tNA\n")
    df = builders.how2sign(spark, old)
    assert rows(df.select("VIDEO_ID", "SAMPLE_ID", "START", "END", "TEXT")) == [("NA", "001", 1.0, 2.0, "NA"), ("v1", "s1", 0.0, 2.0, "Hello")]
    both = spark.createDataFrame([("old", "new")], "VIDEO_NAME string, VIDEO_ID string")
    assert mf.rename_aliases(both).columns == ["VIDEO_NAME", "VIDEO_ID"]
    two = spark.createDataFrame([("a", "b")], "SENTENCE string, CAPTION string")
    assert mf.rename_aliases(two).columns == ["TEXT", "CAPTION"]
    assert mf.has_timing(spark.createDataFrame([(1.0, None), (None, 2.0)], "START double, END double")).first()[0] is False
    issues = mf.validate(spark.createDataFrame([("s1",), ("s1",), ("s2",)], "SAMPLE_ID string")).collect()
    assert any("missing columns" in r["issue"] for r in issues) and any(r["issue"] == "duplicate SAMPLE_ID" and r["rows"] == 2 for r in issues)
    with pytest.raises(ValueError):
        mf.timing_columns(two)


def test_paths_and_policies(spark, tmp_path):
    for n in ("v1.mp4", "v2.webm", "train/00001.mp4"):
        put(tmp_path / n, "x")
    df = spark.createDataFrame([("a", "v1", None), ("b", "v2", "  "), ("c", "v3", "train/00001.mp4"), ("d", "v4", "")], "SAMPLE_ID string, VIDEO_ID string, REL_PATH string")
    listed = documents.listing(spark, str(tmp_path))
    base = str(tmp_path)
    assert [r["VIDEO_PATH"].removeprefix(base) for r in mf.resolve_paths(df, listed, base).orderBy("SAMPLE_ID").collect()] == ["/v1.mp4", "/v2.webm", "/train/00001.mp4", "/v4.mp4"]
    there = listed.select("stem").distinct()
    assert [r["VIDEO_ID"] for r in availability.by_id(df, there, "drop_unavailable").orderBy("VIDEO_ID").collect()] == ["v1", "v2"]
    marked = availability.by_path(df, listed.select("rel_path"), "mark_unavailable")
    assert [r["AVAILABLE"] for r in marked.orderBy("SAMPLE_ID").collect()] == [False, False, True, False]
    assert availability.only_available(marked).count() == 1
    with pytest.raises(availability.Unavailable, match="v3"):
        availability.by_id(df, there, "fail_fast")
    with pytest.raises(ValueError):
        availability.by_id(df, there, "x")


def test_openasl(spark, tmp_path):
    path = put(tmp_path / "o.tsv", "vid\tyid\tstart\tend\ten\tsplit\ns1\ty1\t0.0\t5.0\tHello\ttrain\ns2\ty1\t5\t6\t\ttest\n")
    found = documents.openasl_boxes(spark, put(tmp_path / "b.json", json.dumps({"s1": [10, 20, 100, 200]})))
    df = builders.openasl(tables.openasl(spark, path), "en", found)
    got = {r["SAMPLE_ID"]: r for r in df.collect()}
    assert got["s1"]["BBOX_X1"] == 10 and got["s1"]["BBOX_Y2"] == 200 and got["s1"]["PERSON_DETECTED"]
    assert got["s2"]["BBOX_X1"] is None and got["s2"]["PERSON_DETECTED"] is False and got["s2"]["TEXT"] == ""
    with pytest.raises(ValueError, match="yid"):
        tables.openasl(spark, put(tmp_path / "x.tsv", "vid\tstart\n"))


def test_msasl_and_wlasl(spark, tmp_path):
    m = documents.msasl(spark, put(tmp_path / "MSASL_val.json", json.dumps([{"url": "https://www.youtube.com/watch?v=abcdefghijk", "text": "hi", "signer_id": 4, "start_time": 0.5, "end_time": 1.9999, "label": 7, "fps": 25, "box": [0.1, 0.2, 0.8, 0.9]}, {"url": "youtu.be/abcdefghijk", "text": "x", "start_time": 0, "end_time": 1, "label": 700, "fps": 25}])))
    got = builders.msasl({"val": m}, 100).collect()
    assert len(got) == 1 and got[0]["SAMPLE_ID"] == "val-abcdefghijk-500-1999-7" and (got[0]["BBOX_X1"], got[0]["BBOX_Y1"], got[0]["BBOX_X2"], got[0]["BBOX_Y2"]) == (0.2, 0.1, 0.9, 0.8)
    assert builders.msasl({"val": m}).where("PERSON_DETECTED is null").count() == 1
    w = put(tmp_path / "w.json", json.dumps([{"gloss": "book", "instances": [{"video_id": "1", "fps": 25, "frame_start": 1, "frame_end": 50, "split": "train"}, {"fps": "x", "frame_start": 1, "frame_end": -1, "split": "val"}]}, {"gloss": "car", "instances": [{"video_id": "2", "fps": 25, "frame_start": 1, "frame_end": -1, "split": "train"}]}]))
    got = {r["SAMPLE_ID"]: r for r in builders.wlasl(documents.wlasl(spark, w)).collect()}
    assert (got["1"]["START"], got["1"]["END"], got["1"]["CLASS_ID"]) == (0.04, 2.0, 0)
    assert got["0-1"]["END"] == 0 and got["2"]["END"] == -0.04 and got["2"]["CLASS_ID"] == 1
    assert builders.wlasl(documents.wlasl(spark, w), subset=1, split="train").count() == 1


def test_csl(spark, tmp_path):
    corpus = tables.csl_corpus(spark, put(tmp_path / "corpus.txt", "# c\n\n5\t42\thello there\n6\tonly text\nx\t1\tbad\n7\n"))
    assert rows(corpus.drop("line")) == [(5, 42, "hello there"), (6, 0, "only text")]
    names = [("a/042_005_01.mp4", "042_005_01"), ("a/001_006.mp4", "001_006"), ("a/002_006_03.mp4", "002_006_03"), ("a/9.mp4", "9"), ("a/x_1_2.mp4", "x_1_2")]
    videos = documents.csl_videos(spark.createDataFrame(names, "rel_path string, stem string"))
    assert (42, 5, 1) in [tuple(r)[1:] for r in videos.collect()] and videos.count() == 4
    got = builders.csl(corpus, videos)
    assert rows(got.select("SAMPLE_ID", "SPLIT")) == [("000_006_00", "unknown"), ("000_006_03", "unknown"), ("042_005_01", "test")]
    assert builders.csl(corpus, videos, "split_ii", "train").count() == 3
    with pytest.raises(ValueError):
        builders.csl(corpus, videos, "split_iii").count()


def test_lsa_slovo_autsl_phoenix(spark, tmp_path):
    files_ = spark.createDataFrame([("001_003_005.mp4", "001_003_005"), ("x_1_2.mp4", "x_1_2"), ("002_009_001.mp4", "002_009_001")], "rel_path string, stem string")
    classes = tables.class_map(spark, put(tmp_path / "c.tsv", "CLASS_ID\tGLOSS\tHANDEDNESS\n1\topaque\tR\n2\tred\tL\n"), ("HANDEDNESS",))
    got = {r["SAMPLE_ID"]: r for r in builders.lsa64(documents.name_facts(files_), classes, signers=builders.LSA_SIGNERS).collect()}
    assert got["cut-001_003_005"]["GLOSS"] == "opaque" and got["cut-001_003_005"]["SPLIT"] == "train" and got["cut-002_009_001"]["SPLIT"] == "val"
    s = tables.slovo(spark, put(tmp_path / "s.csv", "attachment_id,user_id,text,train\na,u1,hello,True\nb,u2,no_event,0\nc,u3,abc,1\n"))
    got = {r["SAMPLE_ID"]: r for r in builders.slovo(s, background=("no_event",)).collect()}
    assert got["a"]["SPLIT"] == "train" and got["a"]["CLASS_ID"] == 1 and "b" not in got
    labels = tables.headerless(spark, put(tmp_path / "l.csv", "signer0_sample1,3\nsigner1_sample2,9\n"), ["sample_key", "label_id"])
    names = tables.headerless(spark, put(tmp_path / "n.csv", "3,abla,sister\n"), ["CLASS_ID", "GLOSS_TR", "GLOSS_EN"])
    got = {r["VIDEO_ID"]: r for r in builders.autsl({"train": labels}, names).collect()}
    a, b = got["signer0_sample1_color"], got["signer1_sample2_color"]
    assert (a["SIGNER_ID"], a["GLOSS"], a["TEXT"]) == ("0", "abla", "sister") and b["GLOSS"] == ""
    p = tables.phoenix(spark, put(tmp_path / "p.csv", "Name|Start|End|Signer|Orth|Translation\na/b/1|-1|5|S1|X Y|hallo\nc d|0|2|S2|Z|ja\n"))
    got = {r["SAMPLE_ID"]: r for r in builders.phoenix({"train": p}).collect()}
    assert got["a_b_1"]["START"] is None and got["c_d"]["END"] == 2 and got["c_d"]["REL_PATH"] == "train/c_d.mp4"
    with pytest.raises(ValueError):
        joins.unique_by(spark.createDataFrame([(1,), (1,)], "k int"), "k")


def test_shards_and_tar(spark, tmp_path):
    df = spark.range(25).select(F.format_string("s%02d", "id").alias("SAMPLE_ID"), F.lit(10).alias("n"))
    by = shards.by_count(df, "SAMPLE_ID", 10)
    assert rows(by.groupBy("shard_id").count()) == [(0, 10), (1, 10), (2, 5)]
    fold = shards.by_count_and_bytes(df, "SAMPLE_ID", "n", 4, 35)
    assert [r["count"] for r in fold.groupBy("shard_id").count().orderBy("shard_id").collect()] == [4] * 6 + [1]
    samples = by.select("shard_id", "SAMPLE_ID", F.lit("hi").alias("TEXT"), F.lit("{}").alias("meta"))
    got = files.write_tar_shards(files.webdataset_members(samples), str(tmp_path)).orderBy("shard_id").collect()
    assert [r["members"] for r in got] == [20, 20, 10]
    with tarfile.open(got[2]["path"]) as tar:
        assert tar.getnames()[:2] == ["s20.json", "s20.txt"] and os.path.basename(got[2]["path"]) == "shard-000002.tar"


@pytest.mark.parametrize("ranges", [1, 3, 9])
def test_the_fold_is_the_same_over_any_ranges(spark, ranges):
    import random

    rng = random.Random(ranges)
    data = [(rng.choice(["a", "b", None]), i, rng.choice([0, 1, 7, 30, 90, 200, None])) for i in range(700)]
    df = spark.createDataFrame(data, "src string, k long, size long")
    for most, most_bytes, group in ((9, 150, "src"), (9, 150, None), (40, 10**6, "src"), (1, 5, None), (500, 300, "src")):
        got = {r["k"]: r["shard_id"] for r in shards.by_count_and_bytes(df, "k", "size", most, most_bytes, group, ranges=ranges).collect()}
        want, state = {}, {}
        for g, k, size in data:
            shard, n, b = state.get(g if group else 0, (0, 0, 0))
            if n >= most or (b is not None and b >= most_bytes):
                shard, n, b = shard + 1, 0, 0
            state[g if group else 0] = shard, n + 1, None if b is None or size is None else b + size
            want[k] = shard
        assert got == want


def test_repeated_rows_are_folded_once_each(spark):
    data = [("a", i // 3, 10 + i % 3, f"{i}") for i in range(30)] + [("b", 1, 50, "x")] * 5 + [(None, 1, 5, "y"), (None, None, None, "z"), ("c", 1, None, "u"), ("c", 2, 90, "v")]
    df = spark.createDataFrame(data, "src string, k long, size long, extra string").repartition(4)
    got = shards.by_count_and_bytes(df, "k", "size", 4, 40, "src")
    assert got.columns == [*df.columns, "shard_id"] and sorted(map(repr, got.drop("shard_id").collect())) == sorted(map(repr, df.collect()))
    want, low = [], lambda x: (x is not None, x or 0)
    for g in ("a", "b", "c", None):
        shard, n, b = 0, 0, 0
        for src, k, size, extra in sorted((r for r in data if r[0] == g), key=lambda r: (low(r[1]), low(r[2]))):
            if n >= 4 or (b is not None and b >= 40):
                shard, n, b = shard + 1, 0, 0
            n, b = n + 1, None if b is None or size is None else b + size
            want.append((src, k, size, extra, shard))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert shards.by_count_and_bytes(df.limit(0), "k", "size", 4, 40, "src").count() == 0


def test_arrays_and_reports(spark, tmp_path):
    np.save(tmp_path / "c1.npy", np.arange(2 * 85 * 4, dtype=np.float32).reshape(2, 340))
    got = documents.landmark_arrays(spark, str(tmp_path)).orderBy("t").collect()
    assert len(got) == 2 and len(got[0]["frame"]) == 85 and got[0]["frame"][1]["x"] == 4
    clips = spark.createDataFrame([("a", 1, [3.0, 4.0]), ("a", 0, [1.0, 2.0])], "sample string, t int, values array<float>")
    out = files.write_arrays(clips, str(tmp_path)).first()
    assert np.load(out["path"]).tolist() == [[1, 2], [3, 4]]
    none = spark.createDataFrame([], "VIDEO_ID string, REASON string")
    files.write_report({"downloaded": 0}, none, str(tmp_path / "r"))
    assert json.load(open(tmp_path / "r/download_report.json")) == {"downloaded": 0}
    quoted = spark.createDataFrame([("a", 'say "x"')], "SAMPLE_ID string, TEXT string")
    files.write_manifest(quoted, str(tmp_path / "m"))
    assert rows(tables.manifest(spark, str(tmp_path / "m"))) == [("a", 'say "x"')]


def test_models(spark):
    class Small(models.WholeFrameDetector):
        def detect(self, frames):
            if len(frames) > 3:
                raise models.OutOfMemory
            return super().detect(frames)

    df = spark.createDataFrame([("a", "v", list(range(10)))], "SAMPLE_ID string, VIDEO_PATH string, frames array<int>")
    got = models.run_pose(df, models.FakeReader, Small, lambda: models.FakePose(85, fails=4), 16).first()
    assert got["status"] == "ok" and len(got["landmarks"]) == 10 and got["landmarks"][4][0]["v"] == 0 and got["landmarks"][5][0]["v"] == 1
    ceiling = {"most": 16}
    assert models.halving(lambda x: Small().detect(x), [("v", i, 1, 1) for i in range(10)], 16, ceiling) and ceiling["most"] <= 3

    class Never(models.WholeFrameDetector):
        def detect(self, frames):
            raise models.OutOfMemory("too large")

    assert models.run_detection(df, models.FakeReader, Never).first()["status"] == "error"


def test_jobs(spark, tmp_path):
    put(tmp_path / "data/t/v1.json", json.dumps([{"text": "a", "start": 0, "duration": 1}, {"text": "b", "start": 1, "duration": 1}]))
    put(tmp_path / "ids.txt", "v1\n")
    base = f"dataset: youtube_asl\npaths: {{transcripts: data/t}}\npost_processing: {{enabled: false}}\n"
    put(tmp_path / "configs/base.yaml", base)
    job = put(tmp_path / "configs/jobs/j.yaml", "base: ../base.yaml\nrun_name: r1\noutput: {config: {max_shard_count: 1}}\n")
    c = config.load(job, ["dataset.source.video_ids_file=ids.txt"])
    assert c["paths"]["transcripts"] == str(tmp_path / "data/t") and c["dataset"]["source"]["max_text_length"] == 300
    run = runner.run_job(spark, c)
    assert run.done == ("acquire", "manifest", "output") and len(os.listdir(tmp_path / "webdataset/youtube_asl/r1")) == 2
    assert runner.run_job(spark, c).done == ("acquire", "manifest", "output (kept)")
    put(tmp_path / "configs/experiments/e.yaml", "name: e\njobs:\n  - {job: configs/jobs/j.yaml, overrides: {dataset: {source: {video_ids_file: ids.txt}}}}\n  - configs/jobs/none.yaml\n")
    results = runner.run_experiment(spark, str(tmp_path / "configs/experiments/e.yaml"))
    assert runner.summary(results) == {"succeeded": 1, "failed": 1} and files.job_results(spark, results).count() == 2


def test_config_rules(tmp_path):
    a, b = tmp_path / "a.yaml", tmp_path / "b.yaml"
    a.write_text("base: b.yaml\n"), b.write_text("base: a.yaml\n")
    with pytest.raises(ValueError, match="circle"):
        config.load(a)
    assert config.merge({"a": {"b": 1, "l": [1]}}, {"a": {"l": [2]}}) == {"a": {"b": 1, "l": [2]}}
    assert [config.scalar(x) for x in ("true", "null", "3", "0.5", "x")] == [True, None, 3, 0.5, "x"]
    assert config.plain_path("D:\\x\\y") == "/mnt/d/x/y" and config.flatten({"a": {"b": 1}}) == {"a.b": 1}
    job = lambda **p: {"dataset": "how2sign", "processing": {"processor": "video2crop", **p}}
    with pytest.warns(FutureWarning):
        assert config.check(job(frame_skip=4))["processing"]["sample_rate"] == 0.25
    with pytest.warns(FutureWarning):
        assert config.check(job(frame_skip=4, target_fps=10))["processing"]["sample_rate"] == 10
    for bad in ({"dataset": "x"}, {}, job(sample_rate=0), job(processor="x"), job(detection="yolo"), job(processor="video2pose"), {"dataset": "how2sign", "post_processing": {"normalize": {"keypoint_preset": "x"}}}):
        with pytest.raises(ValueError):
            config.check(bad)
    with pytest.raises(ValueError, match="video_ids_file"):
        config.need_source(config.check({"dataset": "youtube_asl"}))


def test_stream(spark, tmp_path):
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 00:00:01")], "SAMPLE_ID string, t string").select("SAMPLE_ID", F.col("t").cast("timestamp").alias("t")).write.parquet(str(tmp_path / "in"))
    stream = ingest.first_arrivals(ingest.new_rows(spark, str(tmp_path / "in"), "SAMPLE_ID string, t timestamp"), "SAMPLE_ID", "t")
    ingest.into_parquet(stream, lambda df: df.withColumn("n", F.lit(1)), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2

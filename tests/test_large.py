"""What must not grow with the number of files or the length of a clip."""

import os

import numpy as np
import pyarrow as pa
import pytest

from glossmill.operators import acquire, joins, models
from glossmill.sinks import files
from glossmill.sources import documents


def test_the_driver_lists_no_files(spark, tmp_path):
    for n in ("b/x.mp4", "b/_h/y.mp4", ".c.mp4", "b/z.txt", "a b+c%20.mp4", "1.npy", "2.npy", "s.tar"):
        os.makedirs(tmp_path / os.path.dirname(n), exist_ok=True)
        np.save(tmp_path / n, np.ones((2, 85, 4), np.float32)) if n.endswith("npy") else (tmp_path / n).write_text("x")
    (tmp_path / "none.mp4").write_text("")
    top = str(tmp_path)
    made = documents.listing(spark, top), documents.artifacts(spark, f"file://{top}", "npy"), documents.landmark_arrays(spark, top), documents.tar_members(spark, top)
    assert all(df.inputFiles() == [] for df in made)
    assert sorted(r["rel_path"] for r in made[0].collect()) == ["a b+c%20.mp4", "b/x.mp4"]
    assert sorted((r["SAMPLE_ID"], r["path"]) for r in made[1].collect()) == [(str(i), f"{top}/{i}.npy") for i in (1, 2)]
    assert made[2].count() == 4


def test_sentences_meet_only_their_videos(spark, monkeypatch):
    monkeypatch.setattr(joins, "_PAIRS", 3)
    monkeypatch.setattr(joins, "_COPIES", 2)
    corpus = [(0, 1, "any"), (0, 1, "any"), (2, 1, "two"), (3, 1, "none"), (None, 1, "null"), (2, None, "null"), (0, 9, "none")]
    videos = [(s, 1, f"{s}.mp4", 0) for s in (0, 2, 2, 2, 2, 2, 4, None)] + [(2, None, "x.mp4", 0), (2, 8, "y.mp4", 0), (2, 1, None, None)]
    c, v = spark.createDataFrame(corpus, "signer int, sentence int, text string"), spark.createDataFrame(videos, "signer int, sentence int, rel_path string, variation int")
    want = []
    for signer, sentence, text in corpus:
        mine = [x for x in videos if sentence is not None and x[1] == sentence and (signer == 0 or signer is not None and signer == x[0])]
        want += [(signer, sentence, text, *x[2:]) for x in mine or [(None, None, None, None)]]
    out = joins.corpus_videos(c, v)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert " OR " not in out._jdf.queryExecution().optimizedPlan().toString()


def test_clips_stream(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "_NUMBERS", 1000)
    flat = np.arange(50 * 340, dtype=np.float32).reshape(50, 340)
    made = spark.createDataFrame([("s", t, flat[t].tolist()) for t in reversed(range(50))], "sample string, t int, values array<float>")
    df = files.write_arrays(made, str(tmp_path))
    assert "FlatMapGroups" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["sample"], r["frames"]) for r in df.collect()] == [("s", 50)] and os.listdir(tmp_path) == ["s.npy"]
    np.testing.assert_array_equal(np.load(tmp_path / "s.npy"), flat)
    whole, batches = [], 0
    for piece in range(3):
        with open(tmp_path / "s.npy", "rb") as f:
            for b in documents._read_frames("x/s.npy", f, piece, 3):
                whole, batches = whole + b.column("t").to_pylist(), batches + 1
    assert whole == list(range(50)) and batches > 10
    with pytest.raises(Exception, match="frames of"):
        files.write_arrays(spark.createDataFrame([("s", 0, [1.0]), ("s", 1, [1.0, 2.0])], "sample string, t int, values array<float>"), str(tmp_path)).collect()


def test_work_is_spread(spark, tmp_path):
    blobs = spark.range(200).coalesce(1).selectExpr("cast(id as string) AS name", "'x' AS payload")
    assert files.write_blobs(blobs, str(tmp_path)).rdd.getNumPartitions() >= 8
    rows = spark.range(200).coalesce(1).selectExpr("cast(id as string) AS SAMPLE_ID", "'v' AS VIDEO_PATH", "array(1, 2) AS frames")
    assert models.run_pose(rows, models.FakeReader, models.WholeFrameDetector, models.FakePose).rdd.getNumPartitions() >= 8


def test_landmarks_in_arrow():
    rows = [("a", [[{"x1": 0.0, "y1": 0.0, "x2": 1.0, "y2": 1.0, "confidence": 1.0, "label": 0}]], [[(1.0, 2.0, float("nan"), 0.5)], []], "ok", None), ("b", None, None, "error", "no"), ("c", [], [], "ok", None)]
    got = models._pose_batch(rows).to_pylist()
    assert [r["landmarks"] for r in got] == [[[{"x": 1.0, "y": 2.0, "z": None, "v": 0.5}], []], None, []]
    assert [r["detections"] for r in got] == [r[1] for r in rows]


def test_shards_stream(spark, tmp_path):
    members = [(s, f"k{k}", e, f"{s}{k}{e}".encode(), None) for s in range(3) for k in range(4) for e in ("txt", "json")]
    df = files.write_tar_shards(spark.createDataFrame(members, "shard_id long, key string, ext string, payload binary, source string"), str(tmp_path))
    assert "FlatMapGroups" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["shard_id"], r["members"]) for r in df.collect()) == [(0, 8), (1, 8), (2, 8)]
    back = documents.tar_members(spark, str(tmp_path)).collect()
    assert sorted((r["shard"], r["key"], r["ext"], bytes(r["payload"])) for r in back) == sorted((f"shard-{s:06d}.tar", k, e, p) for s, k, e, p, _ in members)


def test_listings_are_not_broadcast_unseen(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"{i:0100d}.npy").write_text("x")
    rows = spark.range(100).selectExpr("lpad(cast(id as string), 100, '0') AS SAMPLE_ID")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        df = joins.artifacts(rows, *(documents.artifacts(spark, str(tmp_path), "npy") for _ in range(2)))
        assert all(r["ARTIFACT"] for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tars_as_tarfile_has_them(spark, tmp_path):
    import io
    import tarfile

    names = [("a", "txt"), ("k" * 96, "npy"), ("k" * 97, "npy"), ("é", "txt"), ("d/e.f", "json")]
    (tmp_path / "source").write_bytes(b"y" * 1500)
    rows = [(0, k, e, None if e == "npy" else bytes(range(256)) * i, str(tmp_path / "source") if e == "npy" else None) for i, (k, e) in enumerate(names)]
    files.write_tar_shards(spark.createDataFrame(rows, "shard_id long, key string, ext string, payload binary, source string"), str(tmp_path / "t")).collect()
    want = io.BytesIO()
    with tarfile.open(fileobj=want, mode="w") as tar:
        for _, k, e, p, _ in sorted(rows, key=lambda r: r[1].encode()):
            info = tarfile.TarInfo(f"{k}.{e}")
            info.size = len(p if p is not None else b"y" * 1500)
            tar.addfile(info, io.BytesIO(p if p is not None else b"y" * 1500))
    assert (tmp_path / "t/shard-000000.tar").read_bytes() == want.getvalue()
    back = {(r["key"], r["ext"]): bytes(r["payload"]) for r in documents.tar_members(spark, str(tmp_path / "t")).collect()}
    assert back == {(k, e): p if p is not None else b"y" * 1500 for _, k, e, p, _ in rows}
    (tmp_path / "t/shard-000000.tar").write_bytes(want.getvalue()[:1700])
    with pytest.raises(Exception, match="unexpected end of data"):
        documents.tar_members(spark, str(tmp_path / "t")).collect()


def test_unfinished_files_lie_apart(spark, tmp_path, monkeypatch):
    seen, there = [], os.replace
    monkeypatch.setattr(os, "replace", lambda a, b: (seen.append(os.path.dirname(a)), there(a, b)))
    with files._apart(str(tmp_path)) as own:
        for i in range(3):
            files._atomic(f"{tmp_path}/in a/{i}.mp4", b"x" * i, own)
        assert sorted(documents._walk(str(tmp_path), ("mp4",), True)) == [(f"{tmp_path}/in a/{i}.mp4", i) for i in (1, 2)]
    assert set(seen) == {own} and os.listdir(tmp_path) == ["in a"]
    names = spark.range(50).selectExpr("concat('b/', id, '.npy') AS name", "cast(id as string) AS payload")
    assert sorted(map(tuple, files.write_blobs(names, str(tmp_path)).collect())) == sorted((f"{tmp_path}/b/{i}.npy", len(str(i))) for i in range(50))
    assert sorted(os.listdir(tmp_path)) == ["b", "in a"] and (tmp_path / "b/49.npy").read_text() == "49"


def test_fetching_without_a_pause_never_sleeps(spark):
    class Fetcher(acquire.Fetcher):
        def fetch(self, video_id):
            if video_id == "b":
                raise RuntimeError("gone")

    ids, none = spark.createDataFrame([("a",), ("b",), ("c",)], "x string"), spark.createDataFrame([], "x string")
    for pause, want in ((0.0, []), (0.5, [0.5, 0.6, 0.6])):
        slept: list[float] = []
        stats, missing = acquire.fetch_all(ids, none, Fetcher(), pause=pause, sleep=slept.append)
        assert (stats["wanted"], stats["downloaded"], missing, slept) == (3, 2, [("b", "gone")], want)

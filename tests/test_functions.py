"""Functions against hand-computed vectors and small Python versions of the rules."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from glossmill.functions import boxes, intervals, landmarks
from glossmill.functions import text as tx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def many(spark, values, kind, f):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r["x"] for r in rows.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text(spark):
    assert one(spark, tx.normalise(F.lit("  CafÃ©  \n  hello   world  "))) == "Café hello world"
    got = many(spark, ["Hello,  World!", "a_b 1", "\x1cx\x85", None], "string", lambda v: tx.normalise(v, lowercase=True, strip_punctuation=True))
    assert got == ["hello world", "a_b 1", "x", None]
    assert many(spark, ["naïve", "plain", "日本"], "string", tx.repair_encoding) == ["naïve", "plain", "日本"]


def test_identifiers(spark):
    urls = ["https://www.youtube.com/watch?v=abcdefghijk&t=1", "https://youtu.be/abc_efg-ijk", "http://x.org/a/verylongvideoname"]
    assert many(spark, urls, "string", tx.youtube_id) == ["abcdefghijk", "abc_efg-ijk", "verylongvid"]
    assert many(spark, ["signer12_x", "x"], "string", tx.signer_number) == ["12", ""]
    assert many(spark, ["/a/b 1/*", "a/b/1"], "string", tx.clip_id) == ["a_b_1", "a_b_1"]
    assert many(spark, ["True", "1", "yes", "0", "no", None, "2", "-3"], "string", tx.flag) == [True, True, True, False, False, False, True, True]
    assert many(spark, [1, 12, 1234], "int", lambda v: tx.padded(v, 3)) == ["001", "012", "1234"]
    assert many(spark, [1.9999, -1.9999], "double", tx.milliseconds) == [1999, -1999]


def loop_windows(start, end, size, stride, least):
    out, t = [], start
    if end - start < least:
        return out
    while t < end:
        last = min(t + size, end)
        if last - t < least:
            break
        out.append((len(out), t, last))
        t += stride
    return out


def test_windows(spark):
    cases = [(0.0, 18.0, 10, 5, 2), (0.0, 11.0, 10, 10, 2), (0.0, 1.0, 10, 5, 2), (3.0, 3.0, 1, 1, 0), (0.0, 20.0, 3, 4, 5)]
    for a, b, size, stride, least in cases:
        got = [tuple(w) for w in one(spark, intervals.windows(F.lit(a), F.lit(b), size, stride, least))]
        assert got == loop_windows(a, b, size, stride, least), (a, b)
        even = [tuple(w) for w in one(spark, intervals.even_windows(F.lit(a), F.lit(b), size, stride, least))]
        assert even == got
    with pytest.raises(ValueError):
        intervals.windows(F.lit(0.0), F.lit(1.0), 1, 0, 0)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.floats(0.5, 60), st.sampled_from([0.1, 0.3, 2.5, 5.0]), st.floats(0.05, 3))
def test_windows_add_strides_like_a_loop(spark, end, stride, least):
    got = [tuple(w) for w in one(spark, intervals.windows(F.lit(0.0), F.lit(end), 4.0, stride, least))]
    assert got == loop_windows(0.0, end, 4.0, stride, least)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 400), st.floats(0.05, 1.0))
def test_sampler_adds_up_like_a_loop(spark, n, ratio):
    want, total = [], 0.0
    for i in range(n):
        total += ratio
        if total >= 1:
            total -= 1
            want.append(i)
    assert one(spark, intervals.sample_by_ratio(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(ratio))) == want


def test_sampling(spark):
    frames = F.sequence(F.lit(0), F.lit(299))
    assert 225 <= len(one(spark, intervals.sample(frames, F.lit(30.0), intervals.effective_fps(24, F.lit(30.0))))) <= 255
    assert len(one(spark, intervals.sample(frames, F.lit(0.0), F.lit(None).cast("double")))) == 300
    assert one(spark, intervals.frame_range(F.lit(2.0), F.lit(1.0), F.lit(10.0))) == []
    assert one(spark, intervals.frame_range(F.lit(0.05), F.lit(0.3), F.lit(10.0))) == [0, 1, 2, 3]
    assert one(spark, intervals.effective_fps(0.5, F.lit(0.0))) is None
    assert one(spark, intervals.effective_fps(60, F.lit(30.0))) == 30
    with pytest.raises(ValueError):
        intervals.effective_fps(0, F.lit(1.0))


def test_boxes(spark):
    frames = F.expr("array(array(named_struct('x1',10d,'y1',20d,'x2',100d,'y2',200d), named_struct('x1',0d,'y1',0d,'x2',5d,'y2',5d)), array(), array(named_struct('x1',50d,'y1',5d,'x2',150d,'y2',180d)))")
    assert tuple(one(spark, boxes.union_of_largest(frames))) == (10, 5, 150, 200)
    assert one(spark, boxes.single_person(frames)) is False
    empty = F.expr("cast(array() as array<struct<x1:double,y1:double,x2:double,y2:double>>)")
    assert one(spark, boxes.union(empty)) is None
    b = boxes.box(F.lit(10), F.lit(10), F.lit(110), F.lit(60))
    assert tuple(one(spark, boxes.pad(b, 0.2, F.lit(120), F.lit(100)))) == (0, 0, 120, 70)
    assert one(spark, boxes.crop_plan(boxes.box(F.lit(5), F.lit(5), F.lit(5), F.lit(9)), F.lit(25))) is None
    cells = ['{"bbox": [1,2,3,4]}', "[1,2,3,4]", '{"box": [1,2,3,4,5]}', "[1,2]", "x"]
    assert [r and tuple(r) for r in many(spark, cells, "string", boxes.from_json_cell)] == [(1, 2, 3, 4)] * 3 + [None, None]


def test_presets():
    assert {k: len(v) for k, v in landmarks.PRESETS.items()} == {"mediapipe_553_to_85": 85, "mediapipe_543_to_83": 83, "mmpose_133_to_85": 85}
    for name, v in landmarks.PRESETS.items():
        assert len(set(v)) == len(v) and max(v) < int(name.split("_")[1])
    assert landmarks.resolve_preset("mmpose_133_to_85", [1]) == landmarks.PRESETS["mmpose_133_to_85"]
    assert landmarks.resolve_preset(None, [1]) == [1] and landmarks.resolve_preset() is None
    for bad in (lambda: landmarks.resolve_preset("x"), lambda: landmarks.gather(F.lit(1), []), lambda: landmarks.gather(F.lit(1), [16], 16), lambda: landmarks.check_flat(100)):
        with pytest.raises(ValueError):
            bad()


def clip(spark, frames):
    rows = [("c", t, k, *map(float, p), 1.0) for t, f in enumerate(frames) for k, p in enumerate(f)]
    return spark.createDataFrame(rows, "clip string, t int, k int, x float, y float, z float, v float")


def test_scaling(spark):
    df = clip(spark, [[(0, 0, 0), (2, 1, 10)], [(1, 0.5, 5), (2, 2, 10)]])
    got = {(r["t"], r["k"]): (r["x"], r["y"], r["z"]) for r in landmarks.scale(landmarks.mask(df, False)).collect()}
    assert got == {(0, 0): (0, 0, 0), (0, 1): (1, 0.5, 1), (1, 0): (0.5, 0.25, 0.5), (1, 1): (1, 1, 1)}
    flat = clip(spark, [[(3, 3, 3), (3, 3, 3)]])
    assert all(r["x"] == r["y"] == r["z"] == 0 for r in landmarks.scale(landmarks.mask(flat, False)).collect())
    with pytest.raises(ValueError):
        landmarks.scale(df, "x")


def test_masks_and_sentinel(spark):
    df = clip(spark, [[(1, 1, 1), (2, 2, 2)], [(0, 0, 0), (0, 0, 0)]]).withColumn("v", F.when(F.col("t") == 0, F.col("v")).otherwise(0).cast("float"))
    out = {r["t"]: list(r["values"]) for r in landmarks.normalise(df).collect()}
    assert out[1] == [-999.0] * 6 and out[0] == [0, 0, 0, 1, 1, 1]
    assert {r["t"]: list(r["values"]) for r in landmarks.normalise(df, indices=[1], remove_z=True).collect()} == {0: [0, 0], 1: [-999.0, -999.0]}
    kept = landmarks.scale(df.where("t = 1").withColumns({c: F.lit(-999.0).cast("float") for c in "xyz"}))
    assert all(r["x"] is None for r in kept.collect())


def test_bins_and_groups(spark):
    nums = lambda *v: F.array(*(F.lit(float(x)) for x in v))
    got = one(spark, landmarks.decode_bins(nums(0, 1, 3, 3), nums(2, 0), nums(0, 0, 1, 0), 2.0, 1.0, 4))
    assert (got["x"], got["y"], got["z"], got["score"]) == (1.0, 0.0, 0.0, 2.0)
    assert one(spark, landmarks.decode_bins(nums(-1, -2), nums(1, 2), nums(1), 2.0, 1.0, 4))["x"] == -1
    peak = one(spark, landmarks.encode_bins(F.lit(3.0), 8, 1.0))
    assert peak[3] == 1.0 and peak[7] == 0.0
    none = F.lit(None).cast("array<struct<x:float,y:float,z:float,v:float>>")
    assert len(one(spark, landmarks.holistic(none, none, none, none))) == 553

"""Sharding, chat formatting and radix dedup against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from glossmill.llm import chat, radix_dedup, sharding


def jump(key, n):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash_is_the_published_one(spark):
    keys = [0, 1, 2, 256, 0xDEAD10CC, 10863919174838991, -1, -(2**63), 2**63 - 1, *range(1000, 1100)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 11, 24, 25, 666):
        got = {r["k"]: r["s"] for r in df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}
    assert jump(10863919174838991, 11) == 6 and jump(0xDEAD10CC, 666) == 361
    with pytest.raises(ValueError):
        sharding.jump_hash(F.col("k"), 0)


def test_shards_grow_into_the_new_one_only(spark):
    df = spark.createDataFrame([(i % 700 if i % 3 else None, i % 5) for i in range(3000)], "doc_id long, size int")
    out = sharding.number_slots(sharding.assign_shards(df, "doc_id", 24, "shard", "grown"), "shard", cell_rows=40).collect()
    assert len(out) == 3000 and all(r["grown"] in (r["shard"], 24) for r in out) and any(r["grown"] == 24 for r in out)
    for s in range(24):
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.number_slots(sharding.assign_shards(df.limit(0), "doc_id", 24), "shard").count() == 0
    assert sharding.assign_shards(df, "doc_id", 24, "size").columns == df.columns


CHATS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a<|im_end|>b"), (1, 2, "assistant", "c <\\|im_sep|> <\\\\|x"), (1, 3, "user", None),
    (2, None, "assistant", "first"), (2, 5, "us\ner", "<|im_start|>assistant\nx<"), (2, 5, "us\ner", "<|im_start|>assistant\nx<"), (3, 1, None, ""), (None, 1, "user", "|im_end|>"), (None, 2, "assistant", "alone"),
]


def test_slots_of_a_row_that_is_repeated_very_often(spark):
    df = spark.range(60_000).select(F.when(F.col("id") < 50_000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit(1).alias("slot"))
    out = sharding.number_slots(sharding.assign_shards(df, "doc_id", 3), "shard", cell_rows=1000)
    assert out.columns == ["doc_id", "shard", "slot"]
    bad = out.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("slot").alias("d"), F.min("slot").alias("a"), F.max("slot").alias("b")).where("n <> d or a <> 0 or b <> n - 1")
    assert out.count() == 60_000 and bad.isEmpty()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") <= 3


def test_query_columns_of_sharding(spark):
    import zlib

    from glossmill.llm import queries

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.QUERIES["op3_jump_sharding"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts) and {r["law"] for r in got} == {"key"}
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and r["shard"] == jump(r["doc_id"], 24) and r["grown_shard"] == jump(r["doc_id"], 25)
    for s in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_chats_read_back(spark):
    df = spark.createDataFrame([(*c, "more") for c in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chats(df).select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("pieces")).alias("loss"), "formatted").collect()
    low = lambda x: (x is not None, x or 0)
    assert sorted(r["loss"] for r in out if r["conv_id"] is None) == ["", "alone"]  # rows without a conversation stay apart
    for r in (r for r in out if r["conv_id"] is not None):
        want = sorted(((t, role or "", text or "") for c, t, role, text in CHATS if c == r["conv_id"]), key=lambda x: (low(x[0]), x[1:]))
        assert [tuple(t) for t in r["turns"]] == [x[1:] for x in want]
        assert r["loss"] == "".join(x[2] for x in want if x[1] == "assistant")
    first = next(r["formatted"] for r in out if r["conv_id"] == 1)
    assert first.count("<|im_start|>assistant") == 1 and first.count("<|im_sep|>") == 1
    assert chat.format_chats(df.limit(0)).count() == 0


def test_native_plans_have_no_python(spark):
    from glossmill.llm import queries

    for name in ("op3_jump_sharding", "op7_chat_format"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_radix_dedup(spark):
    import re

    long = "x" * 70 + "y" * 5000
    texts = ["a b", "a  b", "a\t\nb", None, "", " ", long, long, long + "z", long[:-1], "q" * 64, "q" * 64, "q" * 65, "ä" * 600, "ä" * 600, "ä" * 600 + "b", "one"]
    data = [(i if i % 7 else 7 * (i // 14), t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "only null"), (None, "only null"), (3, None), (3, None)]
    df = spark.createDataFrame([(*d, "k") for d in data], "doc_id long, text string, source string")
    got = radix_dedup.exact_dedup(df, first=4, growth=3).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for d, t in data:
        groups.setdefault(norm(t), []).append(d)
    assert len(got) == len(data) and "source" in got[0].asDict()
    kept = {}
    for r in got:
        ids = groups[norm(r["text"])]
        known = [i for i in ids if i is not None]
        assert r["group_size"] == len(ids) and r["keep_id"] == (min(known) if known else None)
        if r["kept"]:
            kept.setdefault(norm(r["text"]), []).append(r["doc_id"])
            assert r["doc_id"] == r["keep_id"]
    assert {k: len(v) for k, v in kept.items()} == dict.fromkeys(groups, 1)
    assert radix_dedup.drop_copies(df).count() == len(groups) and radix_dedup.drop_copies(df).columns == df.columns
    assert radix_dedup.exact_dedup(df.limit(0)).count() == 0
    clash = df.withColumn("kept", F.lit("mine")).withColumn("_group", F.lit(1))
    assert {r["kept"] for r in radix_dedup.drop_copies(clash).collect()} == {"mine"}
    assert radix_dedup.exact_dedup(clash).columns == ["doc_id", "text", "source", "_group", "keep_id", "group_size", "kept"]


def test_texts_that_end_at_the_border_of_a_level(spark):
    texts = {}
    for border in (64, 64 + 512, 64 + 512 + 4096):
        longer = len(texts)
        texts |= {longer: "x" * border + " more words", longer + 1: "x" * border, longer + 2: "x" * border, longer + 3: "x" * (border - 1)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for drop_text in (False, True):
        got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in radix_dedup.exact_dedup(df, drop_text=drop_text).collect()}
        for i in texts:
            same = [j for j in texts if texts[j] == texts[i]]
            assert got[i] == (min(same), len(same), i == min(same))
    assert sorted(r["doc_id"] for r in radix_dedup.drop_copies(df).collect()) == sorted({t: i for i, t in reversed(texts.items())}.values())


def test_digest_column(spark):
    from glossmill.llm import queries

    r = queries.QUERIES["op6_radix_dedup"](spark, "/root/testdata/sf0.001").where("doc_id = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id = 0").first()["text"]
    import re

    assert r["text_sha256"] == hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text).encode()).hexdigest()

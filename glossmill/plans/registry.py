"""Queries of the library over the driver's tables, with their SQL.

The tables stand in for corpora: conversations for transcripts, documents and labels for a manifest and its listing,
nation and region for class maps, embeddings for landmark clips and boxes, orders and lineitem for segments of videos.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import boxes, intervals, landmarks
from ..functions import text as tx
from ..operators import availability, joins, shards
from ..operators import manifest as mf
from . import builders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of transcripts, only those of available videos, counted for each video."""
    df = QUERIES["segments_from_transcripts"](spark, sf_dir)
    there = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string"))
    kept = availability.by_id(df, there, "drop_unavailable")
    return kept.groupBy("VIDEO_ID").agg(F.count(F.lit(1)).alias("segments"), F.round(F.max("END"), 6).alias("last_end"))


_SPACES = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_NORM = rf"trim(regexp_replace(regexp_replace(text, '[\n\r]', ' ', 'g'), '{_SPACES}', ' ', 'g'))"
_PLAIN = r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(f"""
    WITH e AS (SELECT conv_id::VARCHAR AS VIDEO_ID, turn AS pos, turn * 5.0 AS s, length(text) / 100.0 AS d, {_NORM} AS t FROM conversations),
    k AS (SELECT *, row_number() OVER (PARTITION BY VIDEO_ID ORDER BY pos) - 1 AS idx FROM e WHERE t <> '' AND length(t) <= 300 AND d BETWEEN 0.2 AND 60)
    SELECT VIDEO_ID || '-' || printf('%03d', idx) AS SAMPLE_ID, VIDEO_ID, s::DOUBLE AS START, (s + d)::DOUBLE AS "END", t AS TEXT FROM k""")
def segments_from_transcripts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    entries = turns.select(F.col("conv_id").cast("string").alias("VIDEO_ID"), F.col("turn").alias("pos"), "text", (F.col("turn") * 5.0).alias("start"), (F.length("text") / 100.0).alias("duration"))
    return builders.youtube_asl(entries, fix_encoding=False)


@query(f"SELECT doc_id, {_NORM} AS TEXT FROM documents")
def normalize_text_default(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.normalise(F.col("text"), fix_encoding=False).alias("TEXT"))


@query(rf"SELECT doc_id, trim(regexp_replace(regexp_replace(lower({_NORM}), '{_PLAIN}', '', 'g'), '{_SPACES}', ' ', 'g')) AS TEXT FROM documents")
def normalize_text_lower_strip(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.normalise(F.col("text"), fix_encoding=False, lowercase=True, strip_punctuation=True).alias("TEXT"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Café ' || c_name WHEN 1 THEN 'it’s “' || c_name || '”' WHEN 2 THEN '“Käse” ' || c_name ELSE 'Ã ' || c_name END AS TEXT FROM customer")
def repair_encoding(spark, sf_dir):
    """UTF-8 that was read as Latin-1, or as Windows-1252, is repaired; text that is right, or can't be read so, stays."""
    cases = [F.concat(F.lit("CafÃ©  "), "c_name"), F.concat(F.lit("itâ€™s â€œ"), "c_name", F.lit("â€\x9d")), F.concat(F.lit("“Käse” "), "c_name"), F.concat(F.lit("Ã "), "c_name")]
    raw = F.element_at(F.array(*cases), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", tx.normalise(raw).alias("TEXT"))


@query('SELECT event_id AS SAMPLE_ID, user_id AS VIDEO_ID, value AS START, value + 1 AS "END", event_type AS TEXT, props AS CAPTION FROM events')
def manifest_alias_rename(spark, sf_dir):
    old = table(spark, sf_dir, "events").select(F.col("event_id").alias("SENTENCE_NAME"), F.col("user_id").alias("VIDEO_NAME"), F.col("value").alias("START_REALIGNED"), (F.col("value") + 1).alias("END_REALIGNED"), F.col("event_type").alias("SENTENCE"), F.col("props").alias("CAPTION"))
    df = mf.rename_aliases(old)
    start, end = mf.timing_columns(df)
    return mf.in_order(df).withColumnsRenamed({start: "START", end: "END"})


def _line_orders(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").where("l_quantity > 48").select("l_orderkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48)")
def availability_drop(spark, sf_dir):
    return availability.by_id(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), _line_orders(spark, sf_dir), "drop_unavailable", "o_orderkey")


@query('SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48) AS "AVAILABLE" FROM orders')
def availability_mark(spark, sf_dir):
    return availability.by_id(table(spark, sf_dir, "orders").select("o_orderkey"), _line_orders(spark, sf_dir), "mark_unavailable", "o_orderkey")


@query("SELECT count(*) AS missing_rows, count(DISTINCT doc_id) AS missing_ids FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def availability_missing(spark, sf_dir):
    return availability.missing_counts(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@query("SELECT CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN 'a/' || doc_id ELSE 'a/' || doc_id || 'x' END AS REL_PATH, doc_id % 3 = 1 AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS \"AVAILABLE\", doc_id FROM documents d")
def availability_by_path(spark, sf_dir):
    number = F.concat(F.lit("a/"), F.col("doc_id").cast("string"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 1, number).when(F.col("doc_id") % 3 == 2, F.concat(number, F.lit("x"))).alias("REL_PATH"))
    return availability.by_path(docs, table(spark, sf_dir, "labels").select(number), "mark_unavailable")


@query("SELECT DISTINCT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def to_download(spark, sf_dir):
    return availability.missing(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id"))


@query("SELECT o_orderkey FROM (SELECT DISTINCT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48)) ORDER BY o_orderkey LIMIT 5")
def topk_missing(spark, sf_dir):
    return availability.missing(table(spark, sf_dir, "orders").select("o_orderkey"), _line_orders(spark, sf_dir)).limit(5)


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 48)")
def skip_existing(spark, sf_dir):
    return availability.not_done(table(spark, sf_dir, "orders").select("o_orderkey"), _line_orders(spark, sf_dir), "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 100000")
def filter_available(spark, sf_dir):
    return availability.only_available(table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") > 100000).alias("AVAILABLE"))).drop("AVAILABLE")


def _nations(spark, sf_dir):
    return table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("CLASS_ID"), F.col("n_name").alias("GLOSS"))


@query("SELECT c_custkey, c_nationkey AS CLASS_ID, n_name AS GLOSS FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20")
def class_map_join(spark, sf_dir):
    return joins.class_map(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("CLASS_ID")), _nations(spark, sf_dir))


@query("SELECT count(*) FILTER (c_nationkey >= 20) AS unmapped FROM customer")
def unmapped_classes(spark, sf_dir):
    return joins.unmapped(joins.class_map(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("CLASS_ID")), _nations(spark, sf_dir)))


@query("SELECT n_name AS GLOSS, r_regionkey AS CLASS_ID FROM nation LEFT JOIN region ON replace(n_name, 'NATION_', 'R') = 'R' || r_regionkey")
def gloss_to_class(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("GLOSS"))
    regions = table(spark, sf_dir, "region").select(F.concat(F.lit("NATION_"), F.col("r_regionkey").cast("string")).alias("GLOSS"), F.col("r_regionkey").alias("CLASS_ID"))
    return joins.class_map(nations, regions, key="GLOSS", extras=("CLASS_ID",))


@query("SELECT c_custkey, c_nationkey AS k, coalesce(n, '') AS n FROM customer LEFT JOIN (SELECT n_regionkey AS r, arg_max(n_name, n_nationkey) AS n FROM nation GROUP BY 1) t ON c_nationkey = t.r")
def dictionary_lookup(spark, sf_dir):
    names = joins.last_wins(table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k"), F.col("n_name").alias("n"), "n_nationkey"), "k", "n_nationkey")
    return joins.lookup(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("k")), names, "k")


@query("SELECT p_partkey, p_size AS CLASS_ID FROM part WHERE p_size < 20")
def class_subset(spark, sf_dir):
    return builders.only_classes(table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("CLASS_ID")), 20, True)


@query("SELECT o_orderkey, o_orderstatus AS SPLIT FROM orders WHERE o_orderstatus = 'F'")
def split_filter(spark, sf_dir):
    return builders.only_split(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("SPLIT")), "F")


@query("SELECT event_id, nullif(event_type, 'error') AS label FROM events WHERE coalesce(nullif(event_type, 'error') NOT IN ('signup'), true)")
def background_exclusion(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("error")).alias("label"))
    return builders.without_background(rows, "label", ("signup",))


@query("SELECT s_suppkey, CASE WHEN s_nationkey IN (1,2,3,4,5,6,7,8) THEN 'train' WHEN s_nationkey = 9 THEN 'val' WHEN s_nationkey = 10 THEN 'test' ELSE 'unknown' END AS SPLIT FROM supplier")
def split_by_signer(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", builders.split_by_signer(F.col("s_nationkey"), builders.LSA_SIGNERS).alias("SPLIT"))


@query("SELECT p_partkey, CASE WHEN p_size * 2 BETWEEN 1 AND 94 THEN 'train' WHEN p_size * 2 BETWEEN 95 AND 100 THEN 'test' ELSE 'unknown' END AS SPLIT FROM part")
def split_by_sentence(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", builders.split_by_protocol(F.lit(0), F.col("p_size") * 2, "split_ii").alias("SPLIT"))


@query("SELECT p_partkey, p_type AS GLOSS, dense_rank() OVER (ORDER BY p_type) - 1 AS CLASS_ID FROM part")
def derive_class_ids(spark, sf_dir):
    return mf.dense_classes(table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("GLOSS")), "GLOSS")


@query("SELECT s_suppkey AS sentence_id, s_nationkey % 5 AS signer, s_suppkey % 20 AS sentence, c_name AS rel_path, c_custkey % 7 AS variation FROM supplier LEFT JOIN customer ON s_suppkey % 20 = c_custkey % 40 AND (s_nationkey % 5 = 0 OR s_nationkey % 5 = c_nationkey % 5)")
def corpus_video_match(spark, sf_dir):
    corpus = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("sentence_id"), (F.col("s_nationkey") % 5).alias("signer"), (F.col("s_suppkey") % 20).alias("sentence"))
    videos = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 40).alias("sentence"), (F.col("c_nationkey") % 5).alias("signer"), F.col("c_name").alias("rel_path"), (F.col("c_custkey") % 7).alias("variation"))
    return joins.corpus_videos(corpus, videos)


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'train' WHEN 'N' THEN 'val' ELSE 'test' END AS SPLIT, CASE WHEN l_returnflag = 'A' THEN l_tax END AS tax FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R')")
def union_splits(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    parts = [items.where(F.col("l_returnflag") == f).select("l_orderkey", "l_linenumber", "l_partkey", F.lit(name).alias("SPLIT"), *([F.col("l_tax").alias("tax")] if f == "A" else [])) for f, name in (("A", "train"), ("N", "val"), ("R", "test"))]
    return builders.stacked(parts)


@query(r"""SELECT page_id, coalesce(nullif(regexp_extract(url, '[?&]v=([A-Za-z0-9_-]{11})', 1), ''), nullif(regexp_extract(url, 'youtu\.be/([A-Za-z0-9_-]{11})', 1), ''), left(string_split(url, '/')[-1], 11)) AS VIDEO_ID,
    regexp_extract(url, '^[a-z]+://([^/:]+)', 1) AS host FROM pages""")
def extract_page_ids(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.youtube_id(F.col("url")).alias("VIDEO_ID"), F.regexp_extract("url", r"^[a-z]+://([^/:]+)", 1).alias("host"))


@query(r"SELECT page_id, translate(rtrim(ltrim(replace(trim(url), '/*', ''), '/'), '/'), '/ ', '__') AS clip FROM pages")
def clip_id_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.clip_id(F.col("url")).alias("clip"))


@query(r"SELECT c_custkey, regexp_extract(replace(c_name, 'Customer#', 'signer'), '^signer(\d+)', 1) AS SIGNER_ID FROM customer")
def signer_regex(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", tx.signer_number(F.replace("c_name", F.lit("Customer#"), F.lit("signer"))).alias("SIGNER_ID"))


@query("SELECT event_id, (props->>'k')::BIGINT AS k, json_exists(props, '$.k') AS has_k, event_type IN ('signup') AS yes FROM events")
def json_props(spark, sf_dir):
    v = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"), F.array_contains(F.json_object_keys("props"), "k").alias("has_k"), tx.flag(F.when(F.col("event_type") == "signup", " Yes ").when(F.col("event_type") == "error", "0")).alias("yes"))


@query("SELECT event_id, round(value, 2) AS x1, round(value + 1, 2) AS y1, round(value + 2, 2) AS x2, round(value + 3, 2) AS y2 FROM events WHERE event_id % 3 < 2")
def json_boxes(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    cell = F.format_string("[%s, %s, %s, %s]", *(F.round(F.col("value") + i, 2).cast("string") for i in range(4)))
    cell = F.when(F.col("event_id") % 3 == 0, cell).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"box": '), cell, F.lit("}"))).otherwise(F.lit('{"box": [1, 2]}'))
    out = e.select("event_id", boxes.from_json_cell(cell).alias("b")).where("b is not null").select("event_id", "b.*")
    return out.select("event_id", *(F.round(c, 2).alias(c) for c in ("x1", "y1", "x2", "y2")))


@query("SELECT l_partkey || '_' || l_suppkey || '_' || l_linenumber AS stem, l_partkey::INTEGER AS class_id, l_suppkey::INTEGER AS signer, l_linenumber AS repetition FROM lineitem WHERE l_returnflag <> 'N'")
def filename_facts(spark, sf_dir):
    from ..sources import documents

    third = F.when(F.col("l_returnflag") == "N", "x").otherwise(F.col("l_linenumber").cast("string"))
    names = table(spark, sf_dir, "lineitem").select(F.concat_ws("_", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"), third).alias("stem"))
    return documents.name_facts(names.withColumn("rel_path", F.concat("stem", F.lit(".mp4")))).drop("rel_path")


@query("SELECT concat_ws('-', event_type, user_id, trunc(value * 1000)::BIGINT, trunc((value + 1.5) * 1000)::BIGINT) AS SAMPLE_ID FROM events")
def ms_sample_key(spark, sf_dir):
    return table(spark, sf_dir, "events").select(F.concat_ws("-", "event_type", F.col("user_id").cast("string"), tx.milliseconds(F.col("value")).cast("string"), tx.milliseconds(F.col("value") + 1.5).cast("string")).alias("SAMPLE_ID"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_quantity / 25.0 END AS seconds FROM lineitem")
def frames_to_seconds(spark, sf_dir):
    fps = F.when(F.col("l_linenumber") == 3, 0.0).otherwise(25.0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", intervals.frame_time(F.col("l_quantity"), fps).alias("seconds"))


_SPAN = "SELECT conv_id::VARCHAR AS VIDEO_ID, max(turn * 5.0 + length(text) / 100.0) AS e FROM conversations GROUP BY 1"


@query(f"""WITH s AS ({_SPAN}), w AS (SELECT VIDEO_ID, i, i * 5.0 AS a, least(i * 5.0 + 10, e) AS b FROM s, range(0, 1000) t(i) WHERE i * 5.0 < e AND e >= 2)
    SELECT VIDEO_ID || '_w' || printf('%03d', i) AS SAMPLE_ID, VIDEO_ID, round(a, 6)::DOUBLE AS START, round(b, 6)::DOUBLE AS "END" FROM w WHERE b - a >= 2""")
def sliding_windows(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("SAMPLE_ID"), F.col("conv_id").cast("string").alias("VIDEO_ID"), (F.col("turn") * 5.0).alias("START"), (F.col("turn") * 5.0 + F.length("text") / 100.0).alias("END"))
    return mf.windowed(mf.video_spans(turns, ["SAMPLE_ID"]), 10.0, 5.0, 2.0)


@query("""WITH s AS (SELECT l_orderkey::VARCHAR AS VIDEO_ID, sum(l_quantity) AS e FROM lineitem GROUP BY 1), w AS (SELECT VIDEO_ID, i, i * 10.0 AS a, least(i * 10.0 + 30, e) AS b FROM s, range(0, 1000) t(i) WHERE i * 10.0 < e AND e >= 2.5)
    SELECT VIDEO_ID || '_w' || printf('%03d', i) AS SAMPLE_ID, VIDEO_ID, a::DOUBLE AS START, b::DOUBLE AS "END" FROM w WHERE b - a >= 2.5""")
def sliding_windows_even(spark, sf_dir):
    """Windows whose starts are products: exact for strides that sums represent exactly."""
    spans = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("VIDEO_ID")).agg(F.sum("l_quantity").alias("SPAN"))
    return mf.windowed(spans, 30.0, 10.0, 2.5, even=True)


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, arg_min(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY o_custkey")
def first_row_metadata(spark, sf_dir):
    return mf.first_of(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"])


@query("SELECT p_partkey, p_size // 2 AS kept, CASE WHEN p_size >= 2 THEN 1::BIGINT END AS first FROM part")
def sample_frames_ratio(spark, sf_dir):
    kept = intervals.sample(F.sequence(F.lit(0), F.col("p_size") - 1), F.lit(30.0), intervals.effective_fps(0.5, F.lit(30.0)))
    return table(spark, sf_dir, "part").select("p_partkey", kept.alias("f")).select("p_partkey", F.size("f").alias("kept"), F.get("f", F.lit(0)).alias("first"))


@query("SELECT p_partkey, CAST(floor(p_size * 0.8 + 1e-9) AS INTEGER) AS kept FROM part")
def sample_frames_fps(spark, sf_dir):
    kept = intervals.sample(intervals.frame_range(F.lit(0.0), (F.col("p_size") - 1) / 30.0 + 0.001, F.lit(30.0)), F.lit(30.0), intervals.effective_fps(24.0, F.lit(30.0)))
    return table(spark, sf_dir, "part").select("p_partkey", F.size(kept).alias("kept"))


@query("SELECT l_orderkey, l_linenumber, ((l_quantity::INTEGER + 2) // 3) AS kept FROM lineitem")
def sample_frames_skip(spark, sf_dir):
    frames = F.sequence(F.lit(1), F.col("l_quantity").cast("int"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.size(intervals.sample_by_skip(frames, 3)).alias("kept"))


def _boxes(spark, sf_dir):
    e = [F.get("embedding", F.lit(i)).cast("double") for i in range(4)]
    box = boxes.box(F.least(e[0], e[1]), F.least(e[2], e[3]), F.greatest(e[0], e[1]), F.greatest(e[2], e[3]))
    return table(spark, sf_dir, "embeddings").select("label", "vec_id", box.alias("box"))


_BOX = "SELECT label, vec_id, least(embedding[1], embedding[2])::DOUBLE AS x1, least(embedding[3], embedding[4])::DOUBLE AS y1, greatest(embedding[1], embedding[2])::DOUBLE AS x2, greatest(embedding[3], embedding[4])::DOUBLE AS y2 FROM embeddings"


@query(f"SELECT vec_id // 50 AS clip, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM ({_BOX}) GROUP BY 1")
def bbox_union_all(spark, sf_dir):
    """The box around all detections of a clip of 50."""
    clips = _boxes(spark, sf_dir).groupBy(F.floor(F.col("vec_id") / 50).alias("clip")).agg(boxes.union(F.collect_list("box")).alias("u"))
    return clips.select("clip", "u.*")


@query(f"""WITH b AS ({_BOX}), f AS (SELECT vec_id // 50 AS clip, vec_id // 5 AS frame, arg_max(struct_pack(x1, y1, x2, y2), ((x2 - x1) * (y2 - y1), -vec_id)) AS m FROM b GROUP BY 1, 2)
    SELECT clip, min(m.x1) AS x1, min(m.y1) AS y1, max(m.x2) AS x2, max(m.y2) AS y2 FROM f GROUP BY clip""")
def bbox_union_largest(spark, sf_dir):
    """Clips of ten frames with five detections each; of every frame the largest counts, the first of equals."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "box"))), lambda x: x["box"])
    frames = _boxes(spark, sf_dir).groupBy(F.floor(F.col("vec_id") / 50).alias("clip"), F.floor(F.col("vec_id") / 5).alias("frame")).agg(ordered.alias("detections"))
    return frames.groupBy("clip").agg(boxes.union_of_largest(F.collect_list("detections")).alias("u")).select("clip", "u.*")


_PIX = f"SELECT vec_id, (x1 + 1) * 320 AS x1, (y1 + 1) * 240 AS y1, (x2 + 1) * 320 AS x2, (y2 + 1) * 240 AS y2 FROM ({_BOX})"


@query(f"""SELECT vec_id, greatest(0, trunc(x1 - (x2 - x1) * 0.25)::INTEGER) AS x1, greatest(0, trunc(y1 - (y2 - y1) * 0.25)::INTEGER) AS y1,
    least(640, trunc(x2 + (x2 - x1) * 0.25)::INTEGER) AS x2, least(480, trunc(y2 + (y2 - y1) * 0.25)::INTEGER) AS y2 FROM ({_PIX})""")
def bbox_pad_clamp(spark, sf_dir):
    b = F.col("box")
    pixels = boxes.box((b["x1"] + 1) * 320, (b["y1"] + 1) * 240, (b["x2"] + 1) * 320, (b["y2"] + 1) * 240)
    return _boxes(spark, sf_dir).select("vec_id", boxes.pad(pixels, 0.25, F.lit(640), F.lit(480)).alias("p")).select("vec_id", "p.*")


@query(f"SELECT vec_id FROM ({_PIX}) WHERE (x2 - x1) * (y2 - y1) / (640.0 * 480.0) >= 0.001 AND vec_id % 2 = 0")
def area_filter(spark, sf_dir):
    b = F.col("box")
    d = F.struct(((b["x1"] + 1) * 320).alias("x1"), ((b["y1"] + 1) * 240).alias("y1"), ((b["x2"] + 1) * 320).alias("x2"), ((b["y2"] + 1) * 240).alias("y2"), F.when(F.col("vec_id") % 2 == 0, 0.9).otherwise(0.1).alias("confidence"), F.lit(0).alias("label"))
    rows = _boxes(spark, sf_dir).select("vec_id", F.array(d).alias("ds"))
    return rows.where(F.size(boxes.keep_people(F.col("ds"), 0.5, F.lit(640), F.lit(480), 0.001)) > 0).select("vec_id")


@query("SELECT l_orderkey, count(*) = count(DISTINCT l_linenumber) AS single FROM lineitem GROUP BY l_orderkey")
def single_person(spark, sf_dir):
    frames = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.collect_list("l_quantity").alias("people"))
    return frames.groupBy("l_orderkey").agg(boxes.single_person(F.collect_list("people")).alias("single"))


_INDICES = [3, 0, 15, 7]


def _clips(spark, sf_dir):
    flat = table(spark, sf_dir, "embeddings").select(F.col("label").alias("clip"), F.col("vec_id").alias("t"), landmarks.points(F.col("embedding")).alias("frame"))
    return landmarks.to_long(flat, "clip", "t", "frame")


@query("SELECT vec_id, list_transform([3, 0, 15, 7], lambda k: embedding[4 * k + 1]) AS xs FROM embeddings")
def landmark_gather(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", landmarks.gather(landmarks.points(F.col("embedding")), _INDICES, 16).alias("g"))
    return rows.select("vec_id", F.transform("g", lambda p: p["x"]).alias("xs"))


_LONG = "SELECT label AS clip, vec_id AS t, k, embedding[4 * k + 1] AS x, embedding[4 * k + 2] AS y, embedding[4 * k + 3] AS z, embedding[4 * k + 4] AS v FROM embeddings, range(0, 16) r(k)"
_ENDS = "SELECT *, min(x) OVER c AS x0, max(x) OVER c - min(x) OVER c AS xr, min(y) OVER c AS y0, max(y) OVER c - min(y) OVER c AS yr, min(z) OVER c AS z0, max(z) OVER c - min(z) OVER c AS zr FROM m WINDOW c AS (PARTITION BY clip)"


@query(f"""WITH m AS ({_LONG}), e AS ({_ENDS})
    SELECT clip, t, k::INTEGER AS k, round(((x - x0)::DOUBLE / greatest(xr, yr, zr))::FLOAT::DOUBLE, 5) AS x, round(((y - y0)::DOUBLE / greatest(xr, yr, zr))::FLOAT::DOUBLE, 5) AS y, round(((z - z0)::DOUBLE / greatest(xr, yr, zr))::FLOAT::DOUBLE, 5) AS z FROM e""")
def normalize_isotropic(spark, sf_dir):
    out = landmarks.scale(landmarks.mask(_clips(spark, sf_dir)), "isotropic_3d")
    return out.select("clip", "t", "k", *(F.round(F.col(c).cast("double"), 5).alias(c) for c in "xyz"))


@query(f"""WITH m AS ({_LONG}), e AS ({_ENDS})
    SELECT clip, t, k::INTEGER AS k, round(((x - x0)::DOUBLE / greatest(xr, yr))::FLOAT::DOUBLE, 5) AS x, round(((y - y0)::DOUBLE / greatest(xr, yr))::FLOAT::DOUBLE, 5) AS y, round(((z - z0)::DOUBLE / zr)::FLOAT::DOUBLE, 5) AS z FROM e""")
def normalize_xy_z(spark, sf_dir):
    out = landmarks.scale(landmarks.mask(_clips(spark, sf_dir)), "xy_isotropic_z_minmax")
    return out.select("clip", "t", "k", *(F.round(F.col(c).cast("double"), 5).alias(c) for c in "xyz"))


@query(f"SELECT clip, t, k::INTEGER AS k, CASE WHEN v >= 0.1::FLOAT THEN x END AS x, CASE WHEN v >= 0.1::FLOAT THEN y END AS y, CASE WHEN v >= 0.1::FLOAT THEN z END AS z FROM ({_LONG})")
def mask_low_visibility(spark, sf_dir):
    return landmarks.mask(_clips(spark, sf_dir), low_confidence=True, threshold=0.1)


@query(f"""WITH m AS ({_LONG}), e AS ({_ENDS}), s AS (SELECT clip, t, k, round(((x - x0)::DOUBLE / greatest(xr, yr))::FLOAT::DOUBLE, 5) AS x, round(((y - y0)::DOUBLE / greatest(xr, yr))::FLOAT::DOUBLE, 5) AS y FROM e)
    SELECT clip, t, (2 * k)::INTEGER AS i, x AS value FROM s UNION ALL SELECT clip, t, (2 * k + 1)::INTEGER, y FROM s""")
def flatten_without_z(spark, sf_dir):
    """The whole recipe without depth: every number of every frame, in its place."""
    out = landmarks.normalise(_clips(spark, sf_dir), remove_z=True)
    return out.select("clip", "t", F.posexplode("values").alias("i", "v")).select("clip", "t", "i", F.round(F.col("v").cast("double"), 5).alias("value"))


@query("SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard_id FROM documents")
def shard_by_count(spark, sf_dir):
    return shards.by_count(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 100)


@query("""WITH RECURSIVE o AS (SELECT doc_id, n_chars, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
    f AS (SELECT source, doc_id, i, 0::BIGINT AS shard_id, 1::BIGINT AS n, n_chars::BIGINT AS b FROM o WHERE i = 1
      UNION ALL SELECT o.source, o.doc_id, o.i, CASE WHEN f.n >= 20 OR f.b >= 20000 THEN f.shard_id + 1 ELSE f.shard_id END, CASE WHEN f.n >= 20 OR f.b >= 20000 THEN 1 ELSE f.n + 1 END,
        CASE WHEN f.n >= 20 OR f.b >= 20000 THEN o.n_chars ELSE f.b + o.n_chars END FROM f JOIN o ON o.source = f.source AND o.i = f.i + 1)
    SELECT f.doc_id, f.source, d.n_chars, f.shard_id FROM f JOIN documents d USING (doc_id)""")
def shard_by_bytes(spark, sf_dir):
    return shards.by_count_and_bytes(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id", "n_chars", 20, 20_000, "source")


@query("""SELECT d.doc_id::VARCHAR AS SAMPLE_ID, CASE WHEN l.doc_id IS NOT NULL THEN 'n/' || l.doc_id WHEN b.item_id IS NOT NULL THEN 'r/' || b.item_id END AS ARTIFACT,
    '{"video_id":"' || source || '","sample_id":"' || d.doc_id || '","start":0.0,"end":1.0,"processor":"video2pose"}' AS meta
    FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = d.doc_id""")
def webdataset_rows(spark, sf_dir):
    text = lambda c: F.col(c).cast("string")
    docs = table(spark, sf_dir, "documents").select(text("doc_id").alias("SAMPLE_ID"), F.col("source").alias("VIDEO_ID"), F.lit(0.0).alias("START"), F.lit(1.0).alias("END"))
    done = table(spark, sf_dir, "labels").select(text("doc_id").alias("SAMPLE_ID")).distinct().withColumn("path", F.concat(F.lit("n/"), "SAMPLE_ID"))
    raw = table(spark, sf_dir, "benchmark").select(text("item_id").alias("SAMPLE_ID")).withColumn("path", F.concat(F.lit("r/"), "SAMPLE_ID"))
    return joins.artifacts(docs, done, raw).select("SAMPLE_ID", "ARTIFACT", mf.sample_metadata("video2pose").alias("meta"))


@query("""WITH r AS (SELECT event_id % 400 AS s FROM events), d AS (SELECT s, count(*) AS n FROM r GROUP BY s HAVING count(*) > 1)
    SELECT 'only one of START and END' AS issue, NULL::BIGINT AS rows, NULL::BIGINT AS ids, NULL::VARCHAR AS examples
    UNION ALL SELECT 'duplicate SAMPLE_ID', sum(n)::BIGINT, count(*), (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT s::VARCHAR AS x FROM d ORDER BY s LIMIT 5)) FROM d HAVING count(*) > 0""")
def manifest_validation(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.col("event_id") % 400).alias("SAMPLE_ID"), F.col("user_id").alias("VIDEO_ID"), F.col("value").alias("START"))
    return mf.validate(rows).withColumn("examples", F.array_join("examples", ","))


@query("SELECT l_partkey, min(l_orderkey * 10 + l_linenumber) AS first FROM lineitem GROUP BY l_partkey")
def dedup_videos(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("first"))
    return mf.first_of(rows, ["l_partkey"], ["first"])


@query("SELECT count(*) AS segments, count(DISTINCT l_orderkey) AS videos, count(DISTINCT l_partkey) AS classes, count(DISTINCT l_suppkey) AS signers, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS splits FROM lineitem")
def manifest_stats(spark, sf_dir):
    names = {"l_orderkey": "VIDEO_ID", "l_partkey": "CLASS_ID", "l_suppkey": "SIGNER_ID", "l_returnflag": "SPLIT"}
    return mf.counts(table(spark, sf_dir, "lineitem").select(*names).withColumnsRenamed(names))


@query("SELECT count(*) AS total, count(*) FILTER (event_type = 'click') AS processed, count(*) FILTER (event_type = 'signup') AS skipped, count(*) FILTER (event_type = 'error') AS errors FROM events")
def stage_counters(spark, sf_dir):
    status = F.create_map(*(F.lit(x) for x in ("click", "ok", "signup", "skipped", "error", "error")))
    return mf.stage_counters(table(spark, sf_dir, "events").select(F.try_element_at(status, F.col("event_type")).alias("status")), "status")


@query("SELECT bool_or(o_totalprice > 0 AND o_custkey IS NOT NULL) AS has_timing FROM orders")
def timing_exists(spark, sf_dir):
    return mf.has_timing(table(spark, sf_dir, "orders").select(F.col("o_totalprice").alias("START"), F.col("o_custkey").alias("END")))


@query("""WITH r AS (SELECT sha256('{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_brand":"' || p_brand || '","p_size":' || p_size || '}') AS d FROM part),
    l AS (SELECT substr(d, 1, 4) AS leaf, sha256(string_agg(d, '' ORDER BY d)) AS h FROM r GROUP BY 1)
    SELECT sha256('p_partkey,p_name,p_brand,p_size:' || string_agg(h, '' ORDER BY leaf)) AS content_hash FROM l""")
def manifest_hash(spark, sf_dir):
    return mf.content_hash(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size"))


@query("SELECT o_orderkey, o_custkey AS VIDEO_ID, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INTEGER AS idx FROM orders")
def running_index(spark, sf_dir):
    return mf.running_index(table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("VIDEO_ID")), "VIDEO_ID", "o_orderkey")


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'a/b' || p_partkey || '.mp4' ELSE p_name || '.mp4' END AS path FROM part")
def output_paths(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("a/b"), F.col("p_partkey").cast("string"), F.lit(".avi"))).when(F.col("p_size") % 3 == 1, "nan").alias("REL_PATH"), F.col("p_name").alias("VIDEO_NAME"))
    return rows.select("p_partkey", mf.output_path(rows).alias("path"))


@query("SELECT s_suppkey::VARCHAR AS SAMPLE_ID, CASE WHEN s_nationkey < 10 THEN s_acctbal END AS \"BBOX_X1\", s_nationkey < 10 AS \"PERSON_DETECTED\" FROM supplier")
def bbox_merge(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    found = s.where("s_nationkey < 10").select(F.col("s_suppkey").cast("string").alias("SAMPLE_ID"), boxes.box(F.col("s_acctbal"), F.lit(0), F.lit(1), F.lit(1)).alias("box"))
    return joins.boxes_by_sample(s.select(F.col("s_suppkey").cast("string").alias("SAMPLE_ID")), found).select("SAMPLE_ID", "BBOX_X1", "PERSON_DETECTED")


_BIN = "list_position(embedding[{0}:{1}], list_max(embedding[{0}:{1}])) - 1"
_SEEN = "least(list_max(embedding[1:16]), list_max(embedding[17:32])) > 0"


@query(f"""SELECT vec_id, CASE WHEN {_SEEN} THEN ({_BIN.format(1, 16)}) / 2.0 ELSE -1 END::DOUBLE AS x, CASE WHEN {_SEEN} THEN ({_BIN.format(17, 32)}) / 2.0 ELSE -1 END::DOUBLE AS y,
    CASE WHEN {_SEEN} THEN (({_BIN.format(33, 48)}) / 8.0 - 1) * 2 ELSE -1 END::DOUBLE AS z, least(list_max(embedding[1:16]), list_max(embedding[17:32])) AS score FROM embeddings""")
def simcc_decode(spark, sf_dir):
    part = lambda i: F.slice("embedding", 16 * i + 1, 16)
    p = landmarks.decode_bins(part(0), part(1), part(2), 2.0, 2.0, 16)
    return table(spark, sf_dir, "embeddings").select("vec_id", p.alias("p")).select("vec_id", "p.*")


@query("SELECT label, round(avg(sqrt(power(embedding[1]::DOUBLE - embedding[5], 2) + power(embedding[2]::DOUBLE - embedding[6], 2) + power(embedding[3]::DOUBLE - embedding[7], 2))), 6) AS error FROM embeddings WHERE embedding[4] > 0 GROUP BY label")
def joint_error(spark, sf_dir):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    p, q = (F.struct(at(i).alias("x"), at(i + 1).alias("y"), at(i + 2).alias("z")) for i in (0, 4))
    rows = table(spark, sf_dir, "embeddings").select("label", p.alias("p"), q.alias("q"), (at(3) > 0).alias("ok")).where("ok")
    return rows.groupBy("label").agg(F.round(landmarks.joint_error(F.col("p"), F.col("q"), F.col("ok")), 6).alias("error"))

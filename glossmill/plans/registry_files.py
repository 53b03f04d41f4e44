"""Queries that write the driver's tables in the file formats of the sources, read these with the scans, and build.

Each writes into a folder of its own below the shared one and returns what was read back, so that scans, builders and sinks
are held against SQL on the tables themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import availability, joins, shards
from ..operators import manifest as mf
from ..session import work_folder
from ..sinks import files
from ..sources import documents, tables
from . import builders
from .registry import ORACLES, Query, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return put


def _csv(df: DataFrame, folder: str, sep: str, header: bool = True) -> str:
    df.coalesce(1).write.option("sep", sep).option("header", header).option("escape", '"').option("emptyValue", "").csv(folder)
    return folder


def _lines(df: DataFrame, folder: str) -> str:
    df.coalesce(1).write.text(folder)
    return folder


def _blobs(df: DataFrame, folder: str) -> str:
    files.write_blobs(df, folder).write.format("noop").mode("overwrite").save()
    return folder


def _text(c: str) -> Column:
    return F.col(c).cast("string")


_CLEAN = "trim(regexp_replace(regexp_replace(coalesce(text, ''), '[\\n\\r]', ' ', 'g'), '[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}]+', ' ', 'g'))"


@query(f"""
    WITH e AS (SELECT conv_id::VARCHAR AS VIDEO_ID, turn AS pos, turn * 5.0 AS s, (length(coalesce(text, '')) + 1) / 100.0 AS d, {_CLEAN} AS t FROM conversations
               WHERE conv_id % 7 <> 5 AND NOT (conv_id % 7 = 3 AND turn % 2 = 1)),
    k AS (SELECT *, row_number() OVER (PARTITION BY VIDEO_ID ORDER BY pos) - 1 AS idx FROM e WHERE t <> '' AND length(t) <= 300 AND d BETWEEN 0.2 AND 60)
    SELECT VIDEO_ID || '-' || printf('%03d', idx) AS SAMPLE_ID, VIDEO_ID, s::DOUBLE AS START, (s + d)::DOUBLE AS "END", t AS TEXT FROM k""")
def scan_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON transcripts, one file a video. Entries without a duration go; a null text loses its whole file."""
    turns = table(spark, sf_dir, "conversations").withColumn("text", F.coalesce("text", F.lit("")))
    entry = F.struct("turn", F.struct(F.when((F.col("conv_id") % 7 == 5), None).otherwise(F.col("text")).alias("text"), (F.col("turn") * 5.0).alias("start"), F.when(~((F.col("conv_id") % 7 == 3) & (F.col("turn") % 2 == 1)), (F.length("text") + 1) / 100.0).alias("duration")).alias("e"))
    kept = lambda x: F.when(x["e"]["text"].isNull(), F.to_json(x["e"], {"ignoreNullFields": "false"})).otherwise(F.to_json(x["e"]))
    cells = F.transform(F.array_sort(F.collect_list(entry)), kept)
    blobs = turns.groupBy("conv_id").agg(F.concat(F.lit("["), F.array_join(cells, ","), F.lit("]")).alias("payload"))
    folder = _blobs(blobs.select(F.concat(_text("conv_id"), F.lit(".json")).alias("name"), "payload"), work_folder(spark, "transcripts"))
    return builders.youtube_asl(documents.transcripts(spark, folder), fix_encoding=False)


_QUOTED = """'say "' || o_orderpriority || '"' || chr(9) || o_orderstatus"""


@query(f'SELECT o_orderkey::VARCHAR AS SAMPLE_ID, o_custkey::VARCHAR AS VIDEO_ID, o_totalprice AS START, o_totalprice + 1 AS "END", {_QUOTED} AS TEXT FROM orders')
def scan_manifest(spark, sf_dir):
    """A manifest under its older names, with quotes and tabs in texts, written and read."""
    o = table(spark, sf_dir, "orders")
    said = F.concat(F.lit('say "'), "o_orderpriority", F.lit('"\t'), "o_orderstatus")
    old = o.select(_text("o_orderkey").alias("SENTENCE_NAME"), _text("o_custkey").alias("VIDEO_NAME"), F.col("o_totalprice").alias("START_REALIGNED"), (F.col("o_totalprice") + 1).alias("END_REALIGNED"), said.alias("SENTENCE"))
    folder = work_folder(spark, "manifest")
    files.write_manifest(old, folder)
    return builders.how2sign(spark, folder)


@query("SELECT concat('\"', n_nationkey, '\"', chr(9), '\"', n_name, '\"', chr(9), '\"a \"\"b\"\"\"') AS line FROM nation UNION ALL SELECT concat('\"SAMPLE_ID\"', chr(9), '\"VIDEO_ID\"', chr(9), '\"TEXT\"')")
def segments_quoted(spark, sf_dir):
    """Every cell of a segment file is quoted, quotes are doubled."""
    n = table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("SAMPLE_ID"), F.col("n_name").alias("VIDEO_ID"), F.lit('a "b"').alias("TEXT"))
    folder = work_folder(spark, "segments")
    files.write_manifest(n.coalesce(1), folder, quote_all=True)
    return spark.read.text(folder).select(F.col("value").alias("line"))


@query("SELECT DISTINCT trim(c_mktsegment) AS VIDEO_ID FROM customer")
def scan_id_list(spark, sf_dir):
    """Ids one a line, with blanks around them, blank lines and repeats."""
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("value"))
    return tables.id_list(spark, _lines(c.unionByName(spark.range(2).select(F.lit("   ").alias("value"))), work_folder(spark, "ids")))


@query("""SELECT c_custkey::VARCHAR AS SAMPLE_ID, c_nationkey::VARCHAR AS VIDEO_ID, c_acctbal AS START, c_acctbal + 2 AS "END", coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_name END, '') AS TEXT, c_mktsegment AS SPLIT,
    CASE WHEN c_custkey % 4 < 3 THEN c_custkey::DOUBLE END AS BBOX_X1, CASE WHEN c_custkey % 4 < 3 THEN 2::DOUBLE END AS BBOX_Y1, CASE WHEN c_custkey % 4 < 3 THEN c_custkey::DOUBLE + 10 END AS BBOX_X2, CASE WHEN c_custkey % 4 < 3 THEN 20.5::DOUBLE END AS BBOX_Y2, c_custkey % 4 < 3 AS PERSON_DETECTED FROM customer""")
def build_openasl(spark, sf_dir):
    """OpenASL's table with the boxes of its JSON map, in the three forms that a box may have."""
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_custkey").alias("vid"), F.col("c_nationkey").alias("yid"), F.col("c_acctbal").alias("start"), (F.col("c_acctbal") + 2).alias("end"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_name")).alias("en"), F.col("c_mktsegment").alias("split"))
    box = F.format_string("[%d.0, 2, %d, 20.5]", F.col("c_custkey"), F.col("c_custkey") + 10)
    cell = F.when(F.col("c_custkey") % 4 == 0, box).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit('{"bbox":'), box, F.lit("}"))).when(F.col("c_custkey") % 4 == 2, F.concat(F.lit('{"box":'), box, F.lit("}"))).otherwise(F.lit('{"box":[1,2]}'))
    maps = c.groupBy((F.col("c_custkey") % 8).alias("g")).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), _text("c_custkey"), F.lit('":'), cell)), ","), F.lit("}")).alias("value"))
    found = documents.openasl_boxes(spark, _blobs(maps.select(F.concat(F.lit("boxes"), _text("g"), F.lit(".json")).alias("name"), F.col("value").alias("payload")), work_folder(spark, "boxes")))
    return builders.openasl(tables.openasl(spark, _csv(rows, work_folder(spark, "openasl"), "\t")), found=found)


_AUTSL_SPLIT = "CASE p_partkey % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END"


@query(f"""WITH p AS (SELECT *, 'signer' || p_size || '_sample' || p_partkey || '_depth' AS v, {_AUTSL_SPLIT} AS s FROM part)
    SELECT v AS SAMPLE_ID, v AS VIDEO_ID, s || '/' || v || '.mp4' AS REL_PATH, s AS SPLIT, (p_size % 30)::BIGINT AS CLASS_ID, coalesce(n_name, '') AS GLOSS,
        CASE WHEN n_nationkey % 2 = 1 THEN lower(n_name) ELSE coalesce(n_name, '') END AS TEXT, p_size::VARCHAR AS SIGNER_ID, 30::DOUBLE AS FPS, 0::DOUBLE AS START, CASE WHEN p_partkey % 4 = 0 THEN p_retailprice ELSE 0.0 END AS "END"
    FROM p LEFT JOIN nation ON p_size % 30 = n_nationkey""")
def build_autsl(spark, sf_dir):
    """AUTSL's files without headers; a class that is listed twice is that of its last line; lengths come from a probe."""
    p = table(spark, sf_dir, "part")
    split = F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("p_partkey") % 3 + 1).cast("int"))
    rows = p.select(split.alias("s"), F.format_string("signer%d_sample%d", "p_size", "p_partkey").alias("key"), (F.col("p_size") % 30).alias("label"))
    labels = {n: tables.headerless(spark, _csv(rows.where(F.col("s") == n).select("key", "label"), work_folder(spark, n), ",", False), ["sample_key", "label_id"]) for n in ("train", "val", "test")}
    n = table(spark, sf_dir, "nation")
    names = n.select("n_nationkey", F.lit("earlier").alias("tr"), F.lit("").alias("en"), F.lit(0).alias("o")).unionByName(n.select("n_nationkey", F.col("n_name").alias("tr"), F.when(F.col("n_nationkey") % 2 == 1, F.lower("n_name")).otherwise("").alias("en"), F.lit(1).alias("o")))
    classes = tables.headerless(spark, _csv(names.coalesce(1).sortWithinPartitions("o").drop("o"), work_folder(spark, "classes"), ",", False), ["CLASS_ID", "GLOSS_TR", "GLOSS_EN"])
    probed = p.where("p_partkey % 4 = 0").select(F.format_string("signer%d_sample%d_depth", "p_size", "p_partkey").alias("VIDEO_ID"), F.col("p_retailprice").alias("duration"))
    return builders.autsl(labels, classes, "depth", durations=probed)


@query("""WITH c AS (SELECT s_suppkey, (s_suppkey % 120)::INTEGER AS sentence, CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE (s_suppkey % 45 + 1)::INTEGER END AS signer, s_name || ' signs' AS t FROM supplier),
    v AS (SELECT (c_custkey % 50)::INTEGER AS signer, (c_custkey % 120)::INTEGER AS sentence, (c_custkey % 3)::INTEGER AS variation, printf('%03d_%03d_%02d', c_custkey % 50, c_custkey % 120, c_custkey % 3) AS stem FROM customer)
    SELECT printf('%03d_%03d_%02d', c.signer, c.sentence, coalesce(v.variation, 0)) AS SAMPLE_ID, coalesce(v.stem, printf('%03d_%03d_%02d', c.signer, c.sentence, 0)) AS VIDEO_ID,
        coalesce('color/' || v.stem || '.mp4', '') AS REL_PATH, CASE WHEN c.signer BETWEEN 1 AND 40 THEN 'train' WHEN c.signer BETWEEN 41 AND 50 THEN 'test' ELSE 'unknown' END AS SPLIT, t AS TEXT, c.signer::VARCHAR AS SIGNER_ID,
        coalesce(v.variation, 0)::VARCHAR AS VARIATION_ID, 30::DOUBLE AS FPS
    FROM c LEFT JOIN v ON c.sentence = v.sentence AND (c.signer = 0 OR c.signer = v.signer)""")
def build_csl(spark, sf_dir):
    """CSL's corpus in text lines, with comments, blanks and malformed lines, matched with its videos by their names."""
    s = table(spark, sf_dir, "supplier")
    signer = F.col("s_suppkey") % 45 + 1
    text = F.concat("s_name", F.lit(" signs"))
    line = F.when(F.col("s_suppkey") % 5 == 0, F.format_string("%d\t%s", F.col("s_suppkey") % 120, text)).otherwise(F.format_string("%d\t%d\t%s", F.col("s_suppkey") % 120, signer, text))
    extra = spark.createDataFrame([("# a comment",), ("   ",), ("x\t1\tno sentence",), ("alone",)], "value string")
    corpus = tables.csl_corpus(spark, _lines(extra.unionByName(s.select(line.alias("value"))), work_folder(spark, "corpus")))
    stem = F.format_string("%03d_%03d_%02d", F.col("c_custkey") % 50, F.col("c_custkey") % 120, F.col("c_custkey") % 3)
    listed = table(spark, sf_dir, "customer").select(stem.alias("stem"))
    listed = listed.unionByName(spark.createDataFrame([("1_x_2",), ("notes",)], "stem string"))
    return builders.csl(corpus, documents.csl_videos(listed.withColumn("rel_path", F.concat(F.lit("color/"), "stem", F.lit(".mp4")))))


@query("""SELECT printf('%03d_%03d_00', s_suppkey % 10 + 1, s_suppkey) AS SAMPLE_ID, CASE WHEN s_suppkey % 10 < 4 THEN 'late' ELSE 'unknown' END AS SPLIT FROM supplier""")
def csl_split_spec(spark, sf_dir):
    """A split of CSL by a file of its own: the last line of a sample counts, samples without one are of no split."""
    s = table(spark, sf_dir, "supplier")
    sample = F.format_string("%03d_%03d_00", F.col("s_suppkey") % 10 + 1, "s_suppkey")
    listed = s.where("s_suppkey % 10 < 4").select(sample.alias("a"), F.explode(F.array(F.lit("early"), F.lit("late"))).alias("b"))
    spec = tables.split_spec(spark, _csv(listed.coalesce(1).sortWithinPartitions("b"), work_folder(spark, "spec"), "\t", False))
    corpus = s.select(F.col("s_suppkey").cast("int").alias("sentence"), (F.col("s_suppkey") % 10 + 1).cast("int").alias("signer"), F.lit("t").alias("text"))
    none = spark.createDataFrame([], "rel_path string, signer int, sentence int, variation int")
    return builders.csl(corpus, none, spec=spec).select("SAMPLE_ID", "SPLIT")


@query("""WITH f AS (SELECT DISTINCT l_linenumber + l_orderkey % 20 AS c, l_partkey % 12 + 1 AS s, l_suppkey % 5 + 1 AS r FROM lineitem), g AS (SELECT *, printf('%03d_%03d_%03d', c, s, r) AS stem FROM f)
    SELECT 'raw-' || stem AS SAMPLE_ID, stem AS VIDEO_ID, stem || '.mp4' AS REL_PATH, c::BIGINT AS CLASS_ID, s::VARCHAR AS SIGNER_ID, r::BIGINT AS REPETITION_ID, 60::DOUBLE AS FPS,
        CASE WHEN s <= 8 THEN 'train' WHEN s = 9 THEN 'val' WHEN s = 10 THEN 'test' ELSE 'unknown' END AS SPLIT, n_name AS GLOSS, CASE WHEN n_nationkey % 2 = 0 THEN 'R' WHEN n_nationkey IS NOT NULL THEN 'B' END AS HANDEDNESS
    FROM g LEFT JOIN nation ON c = n_nationkey""")
def build_lsa64(spark, sf_dir):
    """LSA64's names of three numbers, its class map with the hands, and its signers' split."""
    rows = table(spark, sf_dir, "lineitem")
    stem = F.format_string("%03d_%03d_%03d", F.col("l_linenumber") + F.col("l_orderkey") % 20, F.col("l_partkey") % 12 + 1, F.col("l_suppkey") % 5 + 1)
    names = rows.select(stem.alias("stem")).distinct().unionByName(spark.createDataFrame([("001_002",), ("a_b_c",)], "stem string"))
    facts = documents.name_facts(names.withColumn("rel_path", F.concat("stem", F.lit(".mp4"))))
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("CLASS_ID"), F.col("n_name").alias("GLOSS"), F.when(F.col("n_nationkey") % 2 == 0, "R").otherwise("B").alias("HANDEDNESS"))
    classes = tables.class_map(spark, _csv(n, work_folder(spark, "classmap"), "\t"), ("HANDEDNESS",))
    return builders.lsa64(facts, classes, "raw", builders.LSA_SIGNERS)


@query("""WITH e AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 'val' ELSE 'train' END AS s, printf('%011d', event_id) AS v FROM events WHERE user_id % 50 < 30)
    SELECT s || '-' || v || '-' || trunc(event_id * 500.0)::BIGINT || '-' || trunc(event_id * 500.0 + 1250)::BIGINT || '-' || user_id % 50 AS SAMPLE_ID, v AS VIDEO_ID, event_id * 0.5::DOUBLE AS START, event_id * 0.5 + 1.25::DOUBLE AS "END", s AS SPLIT, event_type AS TEXT,
        user_id % 50 AS CLASS_ID, CASE WHEN event_id % 3 = 0 THEN 0.25::DOUBLE END AS BBOX_X1, CASE WHEN event_id % 3 = 0 THEN 0.125::DOUBLE END AS BBOX_Y1, CASE WHEN event_id % 3 = 0 THEN 0.75::DOUBLE END AS BBOX_X2, CASE WHEN event_id % 3 = 0 THEN 0.875::DOUBLE END AS BBOX_Y2,
        CASE WHEN event_id % 3 = 0 THEN true END AS PERSON_DETECTED, user_id::VARCHAR AS SIGNER_ID, 25::DOUBLE AS FPS, CASE WHEN event_id % 2 = 0 THEN 'https://youtu.be/' ELSE 'https://www.youtube.com/watch?v=' END || v AS SOURCE_URL FROM e""")
def build_msasl(spark, sf_dir):
    """MS-ASL's JSON splits: ids from links, boxes in their own order, the first classes only."""
    e = table(spark, sf_dir, "events")
    v = F.format_string("%011d", "event_id")
    url = F.concat(F.when(F.col("event_id") % 2 == 0, "https://youtu.be/").otherwise("https://www.youtube.com/watch?v="), v)
    box = F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0.125), F.lit(0.25), F.lit(0.875), F.lit(0.75))).when(F.col("event_id") % 3 == 1, F.array(F.lit(0.5)))
    row = F.struct(url.alias("url"), F.col("event_type").alias("text"), _text("user_id").alias("signer_id"), (F.col("event_id") * 0.5).alias("start_time"), (F.col("event_id") * 0.5 + 1.25).alias("end_time"), (F.col("user_id") % 50).alias("label"), F.lit(25.0).alias("fps"), box.alias("box"))
    splits = {}
    for i, name in enumerate(("val", "train")):
        part = e.where(F.col("event_id") % 2 == i).groupBy((F.col("event_id") % 16).alias("g")).agg(F.to_json(F.collect_list(row)).alias("payload"))
        splits[name] = documents.msasl(spark, _blobs(part.select(F.concat(_text("g"), F.lit(".json")).alias("name"), "payload"), work_folder(spark, "msasl")))
    return builders.msasl(splits, subset=30)


@query("""WITH r AS (SELECT * FROM events WHERE event_type <> 'error' AND user_id % 3 <> 1)
    SELECT event_id::VARCHAR AS SAMPLE_ID, event_id::VARCHAR AS VIDEO_ID, event_id || '.mp4' AS REL_PATH, 'train' AS SPLIT, event_type AS TEXT, event_type AS GLOSS, user_id::VARCHAR AS SIGNER_ID, 640::BIGINT AS SRC_WIDTH, (event_id % 90)::BIGINT AS FRAME_COUNT,
        CASE WHEN event_id % 2 = 0 THEN 25::DOUBLE END AS FPS, CASE WHEN event_id % 2 = 0 THEN event_id % 90 / 25.0 END AS "END", 0::DOUBLE AS START, (dense_rank() OVER (ORDER BY event_type) - 1)::BIGINT AS CLASS_ID FROM r""")
def build_slovo(spark, sf_dir):
    """SLoVo's annotations: flags in several spellings, background left out, classes numbered after the filters."""
    e = table(spark, sf_dir, "events")
    train = F.element_at(F.array(F.lit("True"), F.lit("0"), F.lit(" YES ")), (F.col("user_id") % 3 + 1).cast("int"))
    rows = e.select(F.col("event_id").alias("attachment_id"), "user_id", F.col("event_type").alias("text"), train.alias("train"), F.lit("640.0").alias("width"), (F.col("event_id") % 90).alias("length"))
    probes = e.where("event_id % 2 = 0").select(_text("event_id").alias("VIDEO_ID"), F.lit(25.0).alias("fps"), (F.col("event_id") % 90 / 25.0).alias("duration"))
    return builders.slovo(tables.slovo(spark, _csv(rows, work_folder(spark, "slovo"), ",")), "train", "derive", None, ("error",), probes)


@query("""SELECT event_id::VARCHAR AS SAMPLE_ID, event_type AS GLOSS, CASE event_type WHEN 'click' THEN 7::BIGINT WHEN 'signup' THEN 3::BIGINT END AS CLASS_ID FROM events""")
def slovo_bundled_classes(spark, sf_dir):
    """SLoVo with a class map that is keyed by the gloss."""
    e = table(spark, sf_dir, "events")
    rows = e.select(_text("event_id").alias("attachment_id"), _text("user_id").alias("user_id"), F.col("event_type").alias("text"), F.lit("1").alias("train"))
    listed = spark.createDataFrame([(7, "click"), (3, "signup"), (9, "unused")], "CLASS_ID int, GLOSS string")
    classes = tables.class_map(spark, _csv(listed, work_folder(spark, "classmap"), "\t"))
    return builders.slovo(rows, "all", "bundled", classes.select("GLOSS", "CLASS_ID")).select("SAMPLE_ID", "GLOSS", "CLASS_ID")


@query("""WITH x AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS j FROM customer WHERE c_nationkey < 20),
    y AS (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN c_nationkey || '-' || j ELSE c_name END AS s, CASE WHEN c_custkey % 4 = 0 THEN 0::DOUBLE ELSE 25::DOUBLE END AS f FROM x)
    SELECT s AS SAMPLE_ID, s AS VIDEO_ID, CASE WHEN f > 0 AND c_custkey % 3 > 0 THEN 1 / 25.0 ELSE 0.0 END AS START, CASE WHEN f > 0 AND c_custkey % 3 > 0 THEN (c_custkey % 90 - 1) / 25.0 WHEN c_custkey % 5 = 0 THEN 4.5 ELSE 0.0 END AS "END",
        lower(c_mktsegment) AS SPLIT, n_name AS TEXT, n_name AS GLOSS, n_nationkey::BIGINT AS CLASS_ID, c_custkey::VARCHAR AS SIGNER_ID, f AS FPS, '1' AS VARIATION_ID, 'u' || c_custkey AS SOURCE_URL
    FROM y JOIN nation ON c_nationkey = n_nationkey WHERE lower(c_mktsegment) = 'building'""")
def build_wlasl(spark, sf_dir):
    """WLASL's nested file: classes are places in it; frames become seconds where there is a rate, else a probe's length counts."""
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    one = F.struct(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 7 > 0, F.col("c_name")).otherwise("").alias("video_id"), F.when(F.col("c_custkey") % 4 > 0, "25").otherwise("x").alias("fps"), F.when(F.col("c_custkey") % 3 > 0, F.lit("1")).alias("frame_start"), (F.col("c_custkey") % 90 - 1).cast("string").alias("frame_end"), F.lower("c_mktsegment").alias("split"), _text("c_custkey").alias("signer_id"), F.concat(F.lit("u"), _text("c_custkey")).alias("url"), F.lit("1").alias("variation_id"))
    inner = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.transform(F.array_sort(F.collect_list(one)), lambda x: x.dropFields("k")).alias("instances"))
    outer = n.join(inner, "n_nationkey", "left").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", F.struct(F.col("n_name").alias("gloss"), F.coalesce("instances", F.array().cast(inner.schema["instances"].dataType)).alias("instances")).alias("e")))).alias("v"))
    folder = _blobs(outer.select(F.lit("wlasl.json").alias("name"), F.to_json(F.transform("v", lambda x: x["e"])).alias("payload")), work_folder(spark, "wlasl"))
    name = F.when(F.col("c_custkey") % 7 > 0, F.col("c_name"))
    probed = c.where("c_custkey % 5 = 0").select(name.alias("VIDEO_ID"), F.lit(4.5).alias("duration")).where("VIDEO_ID is not null")
    numbered = documents.wlasl(spark, folder).where("video_id = ''").select(F.concat_ws("-", _text("i"), _text("j")).alias("VIDEO_ID"), F.lit(4.5).alias("duration"), F.col("signer_id").cast("int").alias("s")).where("s % 5 = 0").drop("s")
    return builders.wlasl(documents.wlasl(spark, folder), 20, "building", probed.unionByName(numbered))


@query("""WITH p AS (SELECT *, CASE WHEN p_partkey % 2 = 0 THEN 'dev' ELSE 'test' END AS s FROM part)
    SELECT p_partkey || '_a_b' AS SAMPLE_ID, p_partkey || '_a_b' AS VIDEO_ID, s || '/' || p_partkey || '_a_b.mp4' AS REL_PATH, s AS SPLIT, p_name AS GLOSS, p_type AS TEXT,
        CASE WHEN s = 'dev' THEN p_brand END AS SIGNER_ID, CASE WHEN s = 'dev' AND p_size % 3 = 0 THEN p_size / 2.0 END AS START, CASE WHEN s = 'dev' AND p_size % 3 = 0 THEN p_size::DOUBLE END AS "END" FROM p""")
def build_phoenix(spark, sf_dir):
    """PHOENIX's corpora between bars; one names its rows id, the other name; times count only where they make sense."""
    p = table(spark, sf_dir, "part")
    ident = F.format_string("/%d/a b/", "p_partkey")
    start = F.when(F.col("p_size") % 3 == 0, (F.col("p_size") / 2.0).cast("string")).when(F.col("p_size") % 3 == 1, "-1").otherwise("x")
    dev = p.where("p_partkey % 2 = 0").select(ident.alias("Id"), F.concat(F.lit(" "), "p_brand").alias(" Signer"), start.alias("start"), (F.col("p_size") * 1.0).alias("END"), F.concat("p_name", F.lit(" ")).alias("orth"), F.col("p_type").alias("translation"))
    test = p.where("p_partkey % 2 = 1").select(ident.alias("name"), F.col("p_name").alias("orth"), F.col("p_type").alias("translation"))
    return builders.phoenix({n: tables.phoenix(spark, _csv(df, work_folder(spark, n), "|")) for n, df in (("dev", dev), ("test", test))})


@query("SELECT p_name || '_' || p_partkey AS stem, p_partkey % 2 = 0 AS \"AVAILABLE\" FROM part")
def listed_videos(spark, sf_dir):
    """Files of videos in folders and of other kinds are listed, and the availability of a manifest follows."""
    p = table(spark, sf_dir, "part")
    stem = F.concat("p_name", F.lit("_"), _text("p_partkey"))
    suffix = F.when(F.col("p_partkey") % 4 == 0, "mp4").when(F.col("p_partkey") % 4 == 2, "webm").otherwise("txt")
    folder = _blobs(p.select(F.concat(F.lit("in a/"), stem, F.lit("."), suffix).alias("name"), F.lit("x").alias("payload")), work_folder(spark, "videos"))
    return availability.by_id(p.select(stem.alias("stem")), documents.stems(spark, folder), "mark_unavailable", "stem")


_WIDE = 340


@query(f"SELECT label::VARCHAR AS sample, t::INTEGER AS t, k::INTEGER AS k, embedding[4 * k % 64 + 1] AS x, embedding[(4 * k + 1) % 64 + 1] AS y, embedding[(4 * k + 2) % 64 + 1] AS z, embedding[(4 * k + 3) % 64 + 1] AS v FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS t FROM embeddings), range(0, {_WIDE // 4}) r(k)")
def arrays_round_trip(spark, sf_dir):
    """Clips as arrays on disk and back: 85 landmarks a frame, in order of time."""
    flat = F.transform(F.sequence(F.lit(0), F.lit(_WIDE - 1)), lambda i: F.get("embedding", i % 64))
    clips = table(spark, sf_dir, "embeddings").select(_text("label").alias("sample"), F.col("vec_id").alias("t"), flat.alias("values"))
    folder = work_folder(spark, "arrays")
    files.write_arrays(clips, folder).write.format("noop").mode("overwrite").save()
    frames = documents.landmark_arrays(spark, folder)
    return frames.select("sample", "t", F.posexplode("frame").alias("k", "p")).select("sample", "t", "k", "p.*")


@query("""WITH d AS (SELECT *, (row_number() OVER (ORDER BY doc_id::VARCHAR) - 1) // 64 AS shard FROM documents WHERE doc_id % 5 > 0),
    m AS (SELECT shard, doc_id, unnest(['txt', 'json', 'npy']) AS ext, unnest([coalesce(text, ''), '{"video_id":"' || source || '","sample_id":"' || doc_id || '","start":0.0,"end":1.0,"processor":"video2pose"}', CASE WHEN doc_id % 2 = 0 THEN 'normalised ' ELSE 'array ' END || doc_id]) AS p FROM d)
    SELECT printf('shard-%06d.tar', shard) AS shard, doc_id::VARCHAR AS key, ext, sha256(p) AS sha FROM m""")
def tar_round_trip(spark, sf_dir):
    """Shards of 64 samples, each with its caption, its facts and what was made of it, the normalised before the raw; samples
    without that are left out. What the tars hold is read back."""
    docs = table(spark, sf_dir, "documents").select(_text("doc_id").alias("SAMPLE_ID"), F.col("source").alias("VIDEO_ID"), F.lit(0.0).alias("START"), F.lit(1.0).alias("END"), F.col("text").alias("TEXT"))
    made = {}
    for name, which in (("array", "doc_id % 5 > 0"), ("normalised", "doc_id % 2 = 0 AND doc_id % 5 > 0")):
        some = table(spark, sf_dir, "documents").where(which).select(F.concat(_text("doc_id"), F.lit(".npy")).alias("name"), F.concat(F.lit(f"{name} "), _text("doc_id")).alias("payload"))
        made[name] = documents.artifacts(spark, _blobs(some, work_folder(spark, name)), "npy")
    rows = joins.artifacts(docs.withColumn("meta", mf.sample_metadata("video2pose")), made["normalised"], made["array"]).where("ARTIFACT is not null")
    folder = work_folder(spark, "tars")
    files.write_tar_shards(files.webdataset_members(shards.by_count(rows, "SAMPLE_ID", 64), "npy"), folder).write.format("noop").mode("overwrite").save()
    return documents.tar_members(spark, folder).select("shard", "key", "ext", F.sha2("payload", 256).alias("sha"))


@query("SELECT o_orderkey::VARCHAR AS SAMPLE_ID, CASE o_orderkey % 4 WHEN 1 THEN 'given/' || o_orderkey || '.avi' WHEN 0 THEN 'v' || o_orderkey || '.webm' ELSE 'v' || o_orderkey || '.mp4' END AS path FROM orders")
def resolved_paths(spark, sf_dir):
    """A given path first, then the file that is there, of several the usual suffix, then the usual suffix without a file."""
    o = table(spark, sf_dir, "orders")
    m = o.select(_text("o_orderkey").alias("SAMPLE_ID"), F.concat(F.lit("v"), _text("o_orderkey")).alias("VIDEO_ID"), F.when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("given/"), _text("o_orderkey"), F.lit(".avi"))).otherwise(" ").alias("REL_PATH"))
    kinds = F.when(F.col("o_orderkey") % 4 == 0, F.array(F.lit(".avi"), F.lit(".webm"))).when(F.col("o_orderkey") % 4 == 2, F.array(F.lit(".mov"), F.lit(".mp4"))).otherwise(F.array(F.lit(".txt")))
    listed = o.select(F.concat(F.lit("v"), _text("o_orderkey")).alias("v"), F.explode(kinds).alias("x")).select(F.concat("v", "x").alias("rel_path"))
    return mf.resolve_paths(m, listed, "/base").select("SAMPLE_ID", F.replace("VIDEO_PATH", F.lit("/base/"), F.lit("")).alias("path"))


@query("SELECT 'wanted' AS name, '3' AS value UNION ALL SELECT 'downloaded', '2' UNION ALL SELECT 'errors', '1' UNION ALL SELECT 'VIDEO_ID', 'v9' UNION ALL SELECT 'REASON', 'gone, \"really\"'")
def acquire_report(spark, sf_dir):
    """The report of an acquisition, as JSON and as a list of what is missing, read back."""
    import json

    folder = work_folder(spark, "report")
    missing = spark.createDataFrame([("v9", 'gone, "really"')], "VIDEO_ID string, REASON string")
    files.write_report({"wanted": 3, "downloaded": 2, "errors": 1}, missing, folder)
    with open(f"{folder}/download_report.json") as f:
        stats = [(k, str(v)) for k, v in json.load(f).items()]
    back = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/missing_videos")
    listed = back.select(F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in back.columns))).alias("x")).select("x.*")
    return spark.createDataFrame(stats, "name string, value string").unionByName(listed)


@query("""SELECT 'poses' AS stage, sha256('{"rate": 0.5}') AS stage_config_hash, sha256('{"a": 1}') AS manifest_hash, sha256('["one", "two"]') AS upstream_success_hash, 6 AS output_count, 5 AS sampled, true AS holds, false AS other_config, false AS other_manifest, false AS lost_output""")
def stage_marker(spark, sf_dir):
    """A stage's marker: what it says, and when it still holds."""
    import os

    folder = work_folder(spark, "marker")
    outputs = [f"{folder}/out{i}.npy" for i in range(6)]
    _blobs(spark.range(6).select(F.concat(F.lit("out"), _text("id"), F.lit(".npy")).alias("name"), F.lit("x").alias("payload")), folder)
    content, ups = files.text_hash({"a": 1}), ["two", "one"]
    mark = files.write_marker(folder, "poses", {"rate": 0.5}, content, ups, outputs)
    holds = files.marker_holds(folder, {"rate": 0.5}, content, ups)
    others = files.marker_holds(folder, {"rate": 0.4}, content, ups), files.marker_holds(folder, {"rate": 0.5}, "x", ups)
    os.remove(outputs[0])
    row = (mark["stage"], mark["stage_config_hash"], mark["manifest_hash"], mark["upstream_success_hash"], mark["output_count"], len(mark["output_sample"]), holds, *others, files.marker_holds(folder, {"rate": 0.5}, content, ups))
    return spark.createDataFrame([row], "stage string, stage_config_hash string, manifest_hash string, upstream_success_hash string, output_count int, sampled int, holds boolean, other_config boolean, other_manifest boolean, lost_output boolean")


ORACLES.update(SQL)

"""Every stage of the pipeline against plain Python over what the stage before it kept."""

import re

import numpy as np
import public_tokenizers
import pytest

from glossmill.llm import scratch, secrets

from .test_text import brute_components

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch.materialise(stage(spark, out[-1], SF), "stage"))
    assert all(df.columns == columns for df in out[1:-1])
    raw, good, single, near, masked = ({r["doc_id"]: r for r in df.collect()} for df in out[:-1])
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    fine = [i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0 and i in raw]
    assert np.mean([i in good for i in fine]) > 0.97 and len(good) < len(raw)

    first = {}
    for i in sorted(good):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", good[i]["text"]), i)
    assert sorted(first.values()) == sorted(single)

    found = brute_components([(i, r["text"]) for i, r in sorted(single.items())], 5, 80)
    assert sorted({c for _, _, c in found}) == sorted(near)

    assert sorted(masked) == sorted(near)
    owners = {}
    for i, r in near.items():
        for _, _, _, v in secrets.find(r["text"] or ""):
            owners.setdefault(v, set()).add(r["source"])
    live = {v for v, o in owners.items() if len(o) <= 2}  # no value is in more repositories than two owners have here
    for i, r in masked.items():
        spans = [(a, b) for a, _, b, v in secrets.find(near[i]["text"]) if v in live]
        assert r["n_chars"] == len(r["text"]) and r["text"] == secrets.masked(near[i]["text"], spans, "[secret]")

    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in out[-1].collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, r in masked.items():
        ids = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in sorted(pieces[i], key=lambda p: p["start"])])
        assert ids.tolist() == [*known.encode(r["text"], add_special_tokens=False).ids, 1]
    assert sorted(pieces) == sorted(masked)


def test_run_is_the_chain_of_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and {"doc_id", "ids", "sequence_id", "offset"} <= set(rows.columns)


LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
KEY = "password=onlymine77 and more words here"
ODD = [None, None, "", "", " \n ", "same text of five words", "same  text of\nfive words", LONG, LONG + " end", KEY, "one", "éé ñ", "same text of five words"]


@pytest.fixture
def odd(spark, tmp_path):
    rows = [(None if i == 4 else i if i < 12 else 5, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else f"s{i % 2}", None if t is None else len(t), "mine", i, 0.5, True, "x") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, uid string, _row long, tail_prob double, kept boolean, found string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return df, str(tmp_path)


def texts(df):
    return sorted((repr(r["text"]) for r in df.collect()))


def test_stages_on_odd_rows(spark, odd):
    df, folder = odd
    run = dict(corpus_pipeline.STAGES)
    good = run["quality classifier"](spark, df, folder)
    assert texts(good) == texts(df)  # nothing is rated, so nothing is rejected
    single = run["exact dedup"](spark, df, folder)
    assert texts(single) == sorted(map(repr, [None, " \n ", "same text of five words", LONG, LONG + " end", KEY, "one", "éé ñ"])), texts(single)
    near = run["n-gram Jaccard join"](spark, df, folder)
    assert texts(near) == sorted(map(repr, [None, None, "", "", " \n ", "same text of five words", LONG, KEY, "one", "éé ñ"]))
    secret = run["secret scans"](spark, df, folder)
    assert texts(secret) == sorted(map(repr, [t.replace("password=onlymine77", "[secret]") if t else t for t in ODD]))
    for out in (good, single, near, secret):
        assert out.columns == df.columns and {(r["uid"], r["tail_prob"], r["kept"], r["found"]) for r in out.collect()} == {("mine", 0.5, True, "x")}
    pieces = run["packing"](spark, df, folder).collect()
    assert len({r["doc_id"] for r in pieces}) == 12 + 1 - 1 and sum(r["length"] for r in pieces if r["doc_id"] == 0) == 1


def test_stages_on_an_empty_table(spark, odd):
    df, folder = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df.limit(0), folder)
        assert out.count() == 0 and (name == "packing" or out.columns == df.columns)


def test_runs_dont_know_of_each_other(spark, odd):
    df, folder = odd
    near = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    first, second = near(spark, df, folder), near(spark, df.where("doc_id > 5"), folder)
    second.collect()
    second.scratch_run.delete()
    assert first.count() == 10

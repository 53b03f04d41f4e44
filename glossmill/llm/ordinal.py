"""Quality classifier by ordinal cumulative-link regression on graded ratings (operator 2).

Grades: 0 toxic, 1 of low quality, 2 fine. One weight for each hashed text feature is shared by all grades; ordered
thresholds part them: P(grade <= k) = sigmoid(threshold_k - score). That gives the expected grade and the tail
probability P(grade >= 2), on which selection rests.

Features are the distinct words of the whole text without the punctuation around them, the distinct runs of punctuation at
their ends, and in tenths the shares of words that repeat the one before and of words with such runs. Only features whose
grades differ from the sample's more than chance explains (likelihood ratio) get a weight; without that, rare words would
be learnt by heart. The model is fitted on at most ``MAX_RATED`` rated texts, chosen by a hash of their key, in one
task; it has a fixed size and is sent to all tasks.

Defined cases: a null text is empty and gets the thresholds' own probabilities; rated keys without a text, and texts
without a rating, are no trouble; labels that don't decide a grade (see ``grade_of``) are no rating; a key rated twice counts twice; with no ratings at all every document is kept; repeated
rows get equal results; an empty table gives an empty table; extra columns are kept by ``select_good``, and by ``rate`` but for those called like a result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrowtext, scratch

#: The most rated texts that a fit uses.
MAX_RATED = 10_000
BITS = 18
GRADES = 3
_MARKS = string.punctuation + "«»“”„’‘…–—"


def features(text: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of all distinct features, by text."""
    from pandas.util import hash_array

    dictionary, all_codes, counts = arrowtext.words(text)
    codes = all_codes
    owner = np.repeat(np.arange(len(counts)), counts)
    pairs = np.unique(owner * np.int64(max(1, len(dictionary))) + codes)
    owner, codes = pairs // max(1, len(dictionary)), pairs % max(1, len(dictionary))
    names = [w.decode() for w in dictionary]
    core = [w.strip(_MARKS) for w in names]
    tail = [w[len(w.rstrip(_MARKS)) :] for w in names]
    mask = np.uint64((1 << bits) - 1)
    marked = np.array([len(x) > 1 or not y for x, y in zip(tail, core)], bool)
    of = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(len(all_codes), bool)
    again[1:] = (all_codes[1:] == all_codes[:-1]) & (of[1:] == of[:-1])
    filled = np.flatnonzero(counts)
    shares = [(tag, 10 * np.bincount(of, weights=x, minlength=len(counts))[filled] // counts[filled]) for tag, x in (("a", again), ("m", marked[all_codes] if len(names) else again))]
    hashed = lambda x, tag: (hash_array(np.asarray([tag + y for y in x], dtype=object), categorize=False) & mask).astype(np.int64) if x else np.zeros(0, np.int64)
    has_core, has_tail = np.array([bool(x) for x in core], bool), np.array([bool(x) for x in tail], bool)
    a, b = hashed(core, "w"), hashed(tail, "t")
    if not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tenths = [filled << bits | hashed([str(i) for i in range(11)], tag)[share.astype(np.int64)] for tag, share in shares]
    out = np.unique(np.concatenate([(owner << bits | a[codes])[has_core[codes]], (owner << bits | b[codes])[has_tail[codes]], *tenths]))
    return out >> bits, out & int(mask)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def loss(p: np.ndarray, row: np.ndarray, feature: np.ndarray, grade: np.ndarray, size: int, decay: float) -> tuple[float, np.ndarray]:
    """Mean negative log likelihood of the grades, with decay of the weights, and its gradient. p holds ``size`` weights, the
    first threshold and the logarithms of the steps to the next ones."""
    n = len(grade)
    cuts = np.concatenate([[-np.inf], p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1 :]))]), [np.inf]])
    score = np.bincount(row, weights=p[feature], minlength=n)
    with np.errstate(over="ignore"):
        high, low = _sigmoid(cuts[grade + 1] - score), _sigmoid(cuts[grade] - score)
    prob = np.maximum(high - low, 1e-9)
    d_high, d_low = high * (1 - high) / prob, low * (1 - low) / prob
    g_score = (d_high - d_low) / n
    g = np.zeros_like(p)
    g[:size] = np.bincount(feature, weights=g_score[row], minlength=size) + decay * p[:size]
    g_cut = np.array([(-(d_high[grade == k].sum()) + d_low[grade == k + 1].sum()) / n for k in range(GRADES - 1)])
    g[size] = g_cut.sum()
    for j in range(GRADES - 2):
        g[size + 1 + j] = g_cut[j + 1 :].sum() * np.exp(p[size + 1 + j])
    return float(-np.log(prob).mean() + decay / 2 * (p[:size] ** 2).sum()), g


def fit(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, bits: int = BITS, rounds: int = 150, rate: float = 0.1, least: int = 3, evidence: float = 20.0, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the whole sample. Features of fewer than ``least`` texts, or with a likelihood ratio
    below ``evidence``, get no weight."""
    size = 1 << bits
    spread, ratio = np.bincount(feature, minlength=size), np.zeros(size)
    for k in range(GRADES):
        seen, part = np.bincount(feature[grade[row] == k], minlength=size), np.mean(grade == k) if len(grade) else 0
        some = np.flatnonzero(seen)
        ratio[some] += 2 * seen[some] * np.log(seen[some] / (spread[some] * part))
    known = (spread[feature] >= least) & (ratio[feature] >= evidence)
    row, feature = row[known], feature[known]
    n = len(grade)
    share = np.clip([(grade <= k).mean() if n else 0.01 for k in range(GRADES - 1)], 0.005, 0.995)
    first = np.log(share / (1 - share))
    # parameters: weights, the first threshold, logs of the steps to the next ones
    steps = np.log(np.maximum(np.diff(first), 0.05))
    p = np.concatenate([np.zeros(size), first[:1], steps])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, rounds + 1 if n else 0):
        _, g = loss(p, row, feature, grade, size, decay)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return p[:size].astype(np.float32), p[size] + np.concatenate([[0.0], np.cumsum(np.exp(p[size + 1 :]))])


def grade_of(quality: Column, toxic: Column) -> Column:
    """The graded rating of a pair of labels; null where they don't decide it, as a label that would is null.

    A toxic text is toxic whatever its quality. Without a toxic label, neither of the other grades is known.
    """
    return F.when(toxic > 0, 0).when(toxic.isNull() | quality.isNull(), None).when(quality <= 0, 1).otherwise(2)


def train(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", most: int = MAX_RATED, run: scratch.Run | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from ratings (key, grade). At most ``most`` ratings are used, so that they may be broadcast; and at
    most as many rated texts, where texts share a key."""
    run = run or scratch.Run(docs.sparkSession)
    sample = ratings.where(F.col(key).isNotNull() & F.col(grade).isNotNull()).select(F.col(key).alias("_k"), F.col(grade).cast("int").alias("_g"))
    sample = run.keep(sample.orderBy(F.xxhash64("_k"), "_k", "_g").limit(most), "rated")
    rated = docs.select(F.col(key), F.col(text)).join(F.broadcast(sample), F.col(key) == F.col("_k")).select(F.col(text).alias("text"), "_g", F.xxhash64("_k", text).alias("_h"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, "text"):
            row, feature = features(arrowtext.texts(batch, "text"))
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column("_g"), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(feature, pa.int32())), batch.column("_h")], ["grade", "features", "_h"])

    def fitted(table: pa.Table) -> pa.Table:
        lists = table.column("features").combine_chunks()
        grades, parents = table.column("grade").to_numpy().astype(np.int64), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        by = np.lexsort((np.asarray(lists.value_lengths()), grades))  # the sum's order doesn't follow the shuffle's
        rank = np.empty_like(by)
        rank[by] = np.arange(len(by))
        w, cuts = fit(rank[parents], lists.flatten().to_numpy().astype(np.int64), grades[by])
        return pa.table({"w": pa.array([w.tobytes()], pa.binary()), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    lists = rated.mapInArrow(listed, "grade int, features array<int>, _h long").orderBy("_h", "grade").limit(most)
    found = lists.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(lambda t: fitted(t), "w binary, cuts array<double>").collect()
    if not found:
        return np.zeros(1 << BITS, np.float32), np.array([-20.0, -19.0])
    return np.frombuffer(found[0]["w"], np.float32), np.array(found[0]["cuts"])


def rate(docs: DataFrame, weights: np.ndarray, cuts: np.ndarray, text: str = "text") -> DataFrame:
    """docs with expected_grade and tail_prob, the probability of the highest grade."""
    docs = docs.drop("expected_grade", "tail_prob")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrowtext.slices(batches, text):
            row, feature = features(arrowtext.texts(batch, text))
            score = np.bincount(row, weights=weights[feature], minlength=batch.num_rows)
            above = [1 - _sigmoid(c - score) for c in cuts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sum(above), pa.float64()), pa.array(above[-1], pa.float64())], [*names, "expected_grade", "tail_prob"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "expected_grade double", "tail_prob double"])
    return docs.mapInArrow(run, schema)


def select_good(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", tail: float = 0.5, run: scratch.Run | None = None) -> DataFrame:
    """The rows of docs whose tail probability reaches ``tail``, with docs's columns."""
    weights, cuts = train(docs, ratings, key, text, run=run)
    plain, names = scratch.shielded(docs)
    rated = rate(plain, weights, cuts, f"c{names.index(text)}").where(F.col("tail_prob") >= tail)
    return rated.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))

"""Language-model scoring with a weighted backoff automaton (operator 1).

Training counts all n-grams of all training texts, words and one end token. The model is a table of buckets of n-gram
hashes with their counts; it grows with the corpus and is never collected or broadcast. Smoothing is hierarchical
Dirichlet: p(w | h) = (c(hw) + mu p(w | h')) / (c(h) + mu), where h' is h without its first word, down to
p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). It needs only counts of n-grams, so that a frequent context is no hot key.

Texts are tokenised once, into blocks of a few MB that are written as word hashes and codes; training and scoring read
those. To score, a block asks the model's buckets for its distinct n-grams and gets their
counts back; of these it builds its part of the automaton. A state is a context that was seen in training. A seen n-gram
is an arc with the log of its smoothed probability; the failure arc of a state leads to the context without its first
word and weighs mu / (c(h) + mu), which is exactly the factor of unseen words. One traversal from left to right carries the
states of many texts at once and adds up their weights. N-grams are known by 64-bit hashes.

A block asks for each order by itself, by way of ``exchange``: the messages are in proportion to the blocks.

What a block asks for is combined before any shuffle, so that a word that makes up a third of all tokens is one number
of each block.

Defined cases: a null text is empty and consists of the end token; a null doc_id belongs to the training texts; repeated
rows are counted and scored each; an empty corpus gives an empty table; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrowtext, exchange, scratch

#: Bytes of text of a block; tokens that a counting task combines at once.
BLOCK_BYTES = 3 << 20
BUCKET_BLOCKS = 8
#: Tokens of a long text that are traversed as one stretch.
LANE = 256
COMBINED = 3_000_000
_END = np.uint64(0xA5A5F00D12345677)


class Grams:
    """The n-grams of some tokenised texts: at each order the hash of the n-gram that ends at a place, where there is one.

    hashes are those of the distinct words, ascending; the code after the last word's stands for the end token.
    """

    def __init__(self, hashes: np.ndarray, codes: np.ndarray, lengths: np.ndarray, order: int):
        self.types, self.codes, self.lengths = len(hashes), codes, lengths
        starts = np.cumsum(lengths) - lengths
        self.place = np.arange(len(codes)) - np.repeat(starts, lengths)
        self.at = [np.append(hashes, _END)[codes]]
        for _ in range(1, order):
            longer = np.zeros(len(codes), np.uint64)
            longer[1:] = arrowtext.extend(self.at[-1][:-1], self.at[0][1:])
            self.at.append(longer)

    def order(self, k: int, texts: np.ndarray | None = None) -> np.ndarray:
        """Hashes of all k-grams, in the order of their ends; only of the texts where ``texts`` is true, if given."""
        wanted = self.place >= k - 1
        return self.at[k - 1][wanted if texts is None else wanted & np.repeat(texts, self.lengths)]


def tokenised(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, codes with the end tokens, and the tokens of each text."""
    dictionary, codes, counts = arrowtext.words(text)
    hashes, number = np.unique(arrowtext.word_hashes(dictionary), return_inverse=True)
    return hashes, np.insert(number[codes], np.cumsum(counts), len(hashes)), counts + 1


BLOCKS = "_block long, texts long, held binary, hashes binary, codes binary, lengths binary, keys binary"


def blocks(df: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df, tokenised, as a written table of blocks; held_out says which texts aren't trained on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in arrowtext.slices(batches, text, BLOCK_BYTES):
            hashes, codes, lengths = tokenised(arrowtext.texts(batch, text))
            held = np.array(batch.column("_held").to_pylist(), bool)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([batch.schema.field(key)])) as out:
                out.write_batch(pa.RecordBatch.from_arrays([batch.column(key)], [key]))
            row = (number, len(lengths), held.tobytes(), arrowtext.pack_sorted(hashes), arrowtext.pack_small(codes), arrowtext.pack_small(lengths), sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int64(), pa.int64(), *[pa.binary()] * 5))], ["_block", "texts", "held", "hashes", "codes", "lengths", "keys"])
            number += 1

    docs = df.select(F.col(key), F.col(text), F.coalesce(held_out, F.lit(False)).alias("_held"))
    return scratch.materialise(docs.mapInArrow(run, BLOCKS), "lm-blocks")


def _grams(row: dict, order: int) -> Grams:
    return Grams(arrowtext.unpack_sorted(row["hashes"]), arrowtext.unpack_small(row["codes"]), arrowtext.unpack_small(row["lengths"]), order)


def _parts(values: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of ascending hashes by their upper bits."""
    if not len(values):
        return
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    edges = np.flatnonzero(np.diff(bucket)) + 1
    firsts = [0, *edges.tolist()]
    for a, b in zip(firsts, [*firsts[1:], len(values)]):
        yield int(bucket[a]), a, b


def _counted(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = [[] for _ in range(order)]
        tokens = 0

        def out() -> Iterator[pa.RecordBatch]:
            for k in range(order):
                if not waiting[k]:
                    continue
                values, counts = np.unique(np.concatenate(waiting[k]), return_counts=True)
                waiting[k].clear()
                parts = list(_parts(values, bits))
                yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([k + 1] * len(parts), pa.int32()), pa.array([arrowtext.pack_sorted(values[a:b]) for _, a, b in parts], pa.binary()), pa.array([arrowtext.pack_small(counts[a:b]) for _, a, b in parts], pa.binary())], ["bucket", "k", "hashes", "counts"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams, trained = _grams(row, order), ~np.frombuffer(row["held"], bool)
                for k in range(order):
                    waiting[k].append(grams.order(k + 1, trained))
                tokens += len(grams.codes)
                if tokens >= COMBINED:
                    yield from out()
                    tokens = 0
        yield from out()

    return run


def _summed(table: pa.Table) -> pa.Table:
    bucket = table.column("bucket")[0].as_py()
    rows: dict[int, list] = {}
    for k, h, c in zip(table.column("k").to_pylist(), table.column("hashes").to_pylist(), table.column("counts").to_pylist()):
        rows.setdefault(k, []).append((arrowtext.unpack_sorted(h), arrowtext.unpack_small(c)))
    out = []
    for k, parts in sorted(rows.items()):
        values, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        counts = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        out.append((bucket, k, arrowtext.pack_sorted(values), arrowtext.pack_sorted(np.cumsum(counts).astype(np.uint64)), int(counts.sum()), len(values)))
    columns = list(zip(*out))
    return pa.table({"bucket": pa.array(columns[0], pa.int32()), "k": pa.array(columns[1], pa.int32()), "hashes": pa.array(columns[2], pa.binary()), "counts": pa.array(columns[3], pa.binary()), "total": pa.array(columns[4], pa.int64()), "types": pa.array(columns[5], pa.int64())})


class Model:
    """Buckets of counts, and N and V of the training tokens."""

    def __init__(self, table: DataFrame, order: int, bits: int):
        self.table, self.order, self.bits = table, order, bits
        row = table.where("k = 1").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v")).first()
        self.tokens, self.types = int(row["n"]), int(row["v"])


def bucket_bits(corpus: DataFrame) -> int:
    """One bucket for about ``BUCKET_BLOCKS`` blocks: a block asks every bucket, so the fewer, the fuller the messages."""
    return max(3, min(30, math.ceil(math.log2(max(1, corpus.select("_block").count() / BUCKET_BLOCKS)))))


def train(corpus: DataFrame, order: int = 2, bits: int | None = None) -> Model:
    """Count the n-grams of a corpus in blocks, without its held-out texts. The number of buckets follows the corpus."""
    bits = bits or bucket_bits(corpus)
    counted = corpus.select("held", "hashes", "codes", "lengths").mapInArrow(_counted(order, bits), "bucket int, k int, hashes binary, counts binary")
    summed = counted.groupBy("bucket").applyInArrow(_summed, "bucket int, k int, hashes binary, counts binary, total long, types long")
    table = scratch.materialise(summed, "lm")
    return Model(table, order, bits)


def _asked(orders: tuple[int, ...], bits: int):
    """The distinct n-grams of each block, of some orders, by bucket, with how often the block's training texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams, trained, rows = _grams(row, max(orders)), ~np.frombuffer(row["held"], bool), []
                trained = np.repeat(trained, grams.lengths)
                for k in orders:
                    wanted = grams.place >= k - 1
                    values, inverse = np.unique(grams.at[k - 1][wanted], return_inverse=True)
                    counts = np.bincount(inverse[trained[wanted]], minlength=len(values))
                    rows += [(bucket, row["_block"], k, arrowtext.pack_sorted(values[a:b]), arrowtext.pack_small(counts[a:b])) for bucket, a, b in _parts(values, bits)]
                columns = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["bucket", "_block", "k", "hashes", "counts"])

    return run


_ASKED = "bucket int, _block long, k int, hashes binary, counts binary"
_REPLY = "_block long, bucket int, k int, counts binary"


def _answered(asked: pa.Table, model: pa.Table) -> pa.Table:
    known = {k: (arrowtext.unpack_sorted(h), np.diff(arrowtext.unpack_sorted(c).astype(np.int64), prepend=0)) for k, h, c in zip(model.column("k").to_pylist(), model.column("hashes").to_pylist(), model.column("counts").to_pylist())}
    counts = []
    for k, data in zip(asked.column("k").to_pylist(), asked.column("hashes").to_pylist()):
        values = arrowtext.unpack_sorted(data)
        have, c = known.get(k, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        answer = np.zeros(len(values), np.int64)
        if len(have):
            i = np.minimum(np.searchsorted(have, values), len(have) - 1)
            answer = np.where(have[i] == values, c[i], 0)
        counts.append(arrowtext.pack_small(answer))
    return pa.table({"_block": asked.column("_block"), "bucket": asked.column("bucket"), "k": asked.column("k"), "counts": pa.array(counts, pa.binary())})


class Automaton:
    """The part of the backoff automaton that some texts can reach. State 0 has no context; its arcs cover all words."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, types: int, mu: float):
        order, words = len(counts), grams.types + 1
        norm = tokens + 0.5 * (types + 1)
        codes, place = grams.codes, grams.place
        index, seen, prob, state = [], [], [], []
        arcs_key, arcs_lp, arcs_to = [], [], []
        self.backoff, self.fail = [np.zeros(1)], [np.zeros(1, np.int64)]
        states = 1
        ends = codes == grams.types
        for k in range(1, order + 1):
            valid = np.flatnonzero(place >= k - 1)
            values, first, inverse = np.unique(grams.at[k - 1][valid], return_index=True, return_inverse=True)
            where = np.full(len(codes), -1)
            where[valid] = inverse
            at = valid[first]  # an end of each distinct k-gram
            c = counts[k - 1].astype(np.float64)
            if k == 1:
                p, source = (c + 0.5) / norm, np.zeros(len(at), np.int64)
                real = np.ones(len(at), bool)
            else:
                context = index[-1][at - 1]
                p = (c + mu * prob[-1][index[-1][at]]) / (seen[-1][context] + mu)
                source, real = state[-1][context], c > 0
            own = np.full(len(at), -1, np.int64)  # states: contexts seen in training
            if k < order:
                new = np.flatnonzero((c > 0) & ~ends[at])
                own[new] = states + np.arange(len(new))
                states += len(new)
                self.backoff.append(np.log10(mu) - np.log10(c[new] + mu))
                self.fail.append(np.zeros(len(new), np.int64) if k == 1 else state[-1][index[-1][at[new]]])
            shorter = np.zeros(len(at), np.int64) if k == 1 else np.maximum(state[-1][index[-1][at]], 0)
            to = np.where(own >= 0, own, shorter)
            to[ends[at]] = 0
            pick = np.flatnonzero(real)
            arcs_key.append(source[pick] * words + codes[at[pick]])
            arcs_lp.append(np.log10(p[pick]))
            arcs_to.append(to[pick])
            index.append(where)
            seen.append(c)
            prob.append(p)
            state.append(own)
        keys, to = np.concatenate(arcs_key), np.concatenate(arcs_to)
        by = np.argsort(keys)
        self.order, self.words, self.arcs, self.weight, self.target = order, words, keys[by], np.concatenate(arcs_lp)[by], to[by]
        self.root = np.searchsorted(self.arcs, np.arange(words))  # state 0 has an arc for every word
        self.backoff, self.fail = np.concatenate(self.backoff), np.concatenate(self.fail)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one word each, and the weights on the way: failure arcs until a state has an arc for the word."""
        state, total, open_ = state.copy(), np.zeros(len(state)), np.arange(len(state))
        while len(open_):
            s, w = state[open_], word[open_]
            at = self.root[w]
            deep = np.flatnonzero(s)
            key = s[deep] * self.words + w[deep]
            at[deep] = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            found = np.ones(len(open_), bool)
            found[deep] = self.arcs[at[deep]] == key
            hit, miss = open_[found], open_[~found]
            total[hit] += self.weight[at[found]]
            state[hit] = self.target[at[found]]
            total[miss] += self.backoff[state[miss]]
            state[miss] = self.fail[state[miss]]
            open_ = miss
        return state, total

    def weights(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The weight of every token on its text's path from left to right.

        Many texts are traversed at once, and a long one in stretches of ``LANE`` tokens. A state depends on the last
        order - 1 tokens only, so that a stretch begins so many tokens early, without counting their weights.
        """
        parts = -(-lengths // LANE)
        first = np.repeat(np.cumsum(lengths) - lengths, parts)
        offset = LANE * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        begin, end = first + offset, first + np.minimum(offset + LANE, np.repeat(lengths, parts))
        at = np.maximum(first, begin - (self.order - 1))
        by = np.argsort(at - end, kind="stable")  # the longest first, so that those that go on are in front
        at, begin, end = at[by], begin[by], end[by]
        steps, state, out = end - at, np.zeros(len(at), np.int64), np.zeros(len(codes))
        for i in range(int(steps.max(initial=0))):
            n = int(np.searchsorted(-steps, -i))
            place = at[:n] + i
            state[:n], weight = self.step(state[:n], codes[place])
            own = place >= begin[:n]
            out[place[own]] = weight[own]
        return out

    def score(self, codes: list[int]) -> float:
        """The sum of the weights along the path of a text."""
        return float(self.weights(np.array(codes, np.int64), np.array([len(codes)])).sum())


def _scored(order: int, key: str, tokens: int, types: int, mu: float):
    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        grams = _grams(row, order)
        found = sorted(zip(replies.column("k").to_pylist(), replies.column("bucket").to_pylist(), replies.column("counts").to_pylist()))
        counts = [np.concatenate([arrowtext.unpack_small(c) for k, _, c in found if k == n] or [np.zeros(0, np.int64)]) for n in range(1, order + 1)]
        ends = np.cumsum(grams.lengths)
        weights = Automaton(grams, counts, tokens, types, mu).weights(grams.codes, grams.lengths)
        _, inverse = np.unique(grams.at[0], return_inverse=True)
        c = counts[0][inverse].astype(np.float64)
        of_text = np.repeat(np.arange(len(ends)), grams.lengths)
        base = np.bincount(of_text, weights=np.log10((c + 0.5) / (tokens + 0.5 * (types + 1))), minlength=len(ends))
        n_known = np.bincount(of_text, weights=c > 0, minlength=len(ends)).astype(np.int64)
        scores = np.bincount(of_text, weights=weights, minlength=len(ends))
        keys = pa.ipc.open_stream(row["keys"]).read_all().column(0)
        return pa.table({key: keys, "held_out": pa.array(np.frombuffer(row["held"], bool)), "n_tokens": pa.array(grams.lengths, pa.int64()), "n_known": pa.array(n_known, pa.int64()), "train_tokens": pa.array(np.full(len(ends), tokens), pa.int64()), "base_score": pa.array(base, pa.float64()), "score": pa.array(scores, pa.float64())})

    return run


def _finished(corpus: DataFrame, replies: DataFrame, order: int, tokens: int, types: int, kind: str, key: str, mu: float) -> DataFrame:
    schema = f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return corpus.groupBy("_block").cogroup(replies.groupBy("_block")).applyInArrow(_scored(order, key, tokens, types, mu), schema)


def score(corpus: DataFrame, model: Model, kind: str = "long", key: str = "doc_id", mu: float = 50.0) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of a corpus in blocks, by a model of
    any corpus; kind is the key's type."""
    asked = corpus.select("_block", "held", "hashes", "codes", "lengths").mapInArrow(_asked(tuple(range(1, model.order + 1)), model.bits), _ASKED).drop("counts")
    answered = asked.groupBy("bucket").cogroup(model.table.select("bucket", "k", "hashes", "counts").groupBy("bucket")).applyInArrow(_answered, _REPLY)
    replies = scratch.materialise(answered, "lm-replies")
    return _finished(corpus, replies, model.order, model.tokens, model.types, kind, key, mu)


def _own(k: int, bits: int):
    """What every block asks of its k-grams, with how often its training texts have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams = _grams(row, k)
                trained, wanted = np.repeat(~np.frombuffer(row["held"], bool), grams.lengths), grams.place >= k - 1
                values, inverse = np.unique(grams.at[k - 1][wanted], return_inverse=True)
                rows = exchange.messages(row["_block"], values, np.bincount(inverse[trained[wanted]], minlength=len(values)), 64, bits)
                columns = list(zip(*rows)) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["asker", "prefix", "hashes", "counts"])

    return run


def score_own(corpus: DataFrame, order: int = 2, kind: str = "long", key: str = "doc_id", mu: float = 50.0, bits: int = exchange.BITS, merged: int = exchange.MERGED) -> DataFrame:
    """As ``score`` by the model of the corpus's own training texts. One exchange for each order both counts and asks, so that
    neither the model nor a second copy of the n-grams is written, and only one order's n-grams are on disk at a time."""
    run, blocks = scratch.Run(corpus.sparkSession), corpus.select("_block").count()
    rows = corpus.select("_block", "held", "hashes", "codes", "lengths")
    replies = [exchange.answer(rows.mapInArrow(_own(k, bits), exchange.ASKED), blocks, 64, BUCKET_BLOCKS, run, bits=bits, merged=merged) for k in range(1, order + 1)]
    types, tokens, _, _ = exchange.totals(replies[0])
    told = [r.where("asker >= 0").select(F.col("asker").alias("_block"), F.col("prefix").alias("bucket"), F.lit(k).alias("k"), "counts") for k, r in enumerate(replies, 1)]
    return _finished(corpus, reduce(DataFrame.unionByName, told), order, tokens, types, kind, key, mu)

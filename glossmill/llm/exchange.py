"""Counts over a whole corpus for askers that each hold a part of it.

Every asker has ascending distinct hashes with its own counts of them, and is told the sums over all askers, in the same
order. The range of hashes is cut into 2 ** bits prefixes; an asker sends each prefix one message, so that the number of
messages is in proportion to the askers. While a prefix holds few enough askers' worth of hashes, one task sums it up. Else
the messages of ``MERGED`` askers to one prefix are merged first, with equal hashes as one, and the merged ones ask in turn,
each among the 2 ** bits parts of its prefix, and spread the answers to those that they speak for. So a level more serves
2 ** bits times the corpus with the same messages for each asker, and no group grows with the corpus.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext, scratch

#: Bits of the hash that a level looks at; askers whose messages are merged.
BITS, MERGED = 6, 64
ASKED = "asker long, prefix long, hashes binary, counts binary"
REPLY = "asker long, prefix long, counts binary"
_ASKED = {"asker": pa.int64(), "prefix": pa.int64(), "hashes": pa.binary(), "counts": pa.binary()}
_BOTH = "kind int, asker long, prefix long, hashes binary, counts binary, askers array<long>, inverses array<binary>"


def parts(values: np.ndarray, width: int, bits: int) -> list[tuple[int, int, int]]:
    """(prefix, from, to) of ascending hashes of ``width`` bits."""
    if not len(values):
        return []
    prefix = (values >> np.uint64(width - bits)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(prefix)) + 1).tolist(), len(prefix)]
    return [(int(prefix[a]), a, b) for a, b in zip(cuts, cuts[1:])]


def messages(asker: int, values: np.ndarray, counts: np.ndarray, width: int, bits: int) -> list[tuple[int, int, bytes, bytes]]:
    """Rows (asker, prefix, hashes, counts) of what an asker asks."""
    return [(asker, p, arrowtext.pack_sorted(values[a:b]), arrowtext.pack_small(counts[a:b])) for p, a, b in parts(values, width, bits)]


def _table(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(types)
    return pa.table({n: pa.array(c, t) for c, (n, t) in zip(columns, types.items())})


def _summed(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """The messages' hashes; all hashes, their sums, and the place of each message's hashes among all."""
    each = [arrowtext.unpack_sorted(h) for h in table.column("hashes").to_pylist()]
    own = np.concatenate([arrowtext.unpack_small(c) for c in table.column("counts").to_pylist()])
    values, inverse = np.unique(np.concatenate(each), return_inverse=True)
    return each, values, np.bincount(inverse, weights=own, minlength=len(values)).astype(np.int64), inverse


def _answered(most: int | None):
    def run(table: pa.Table) -> pa.Table:
        each, _, total, inverse = _summed(table)
        said, at, prefix, rows = (total if most is None else np.minimum(total, most))[inverse], 0, table.column("prefix")[0].as_py(), []
        for asker, values in zip(table.column("asker").to_pylist(), each):
            rows.append((asker, prefix, arrowtext.pack_small(said[at : at + len(values)])))
            at += len(values)
        several = total[total > 1]
        rows.append((-1, prefix, arrowtext.pack_small(np.array([(total > 0).sum(), total.sum(), len(several), several.sum()]))))
        return _table(rows, {"asker": pa.int64(), "prefix": pa.int64(), "counts": pa.binary()})

    return run


def _merged(width: int, bits: int):
    """The messages to one prefix as those of one asker: what it asks (kind 0), and whom it speaks for (kind 1)."""

    def run(table: pa.Table) -> pa.Table:
        each, values, total, inverse = _summed(table)
        asker, prefix = table.column("prefix")[0].as_py() << 32 | table.column("g")[0].as_py(), table.column("prefix")[0].as_py()
        rows = [(0, *m, None, None) for m in messages(asker, values, total, width, bits)]
        ends = np.cumsum([len(x) for x in each])
        rows.append((1, asker, prefix, None, None, table.column("asker").to_pylist(), [arrowtext.pack_small(x) for x in np.split(inverse, ends[:-1])]))
        return _table(rows, {"kind": pa.int32(), **_ASKED, "askers": pa.list_(pa.int64()), "inverses": pa.list_(pa.binary())})

    return run


def _spread(spoken: pa.Table, replies: pa.Table) -> pa.Table:
    rows = []
    if spoken.num_rows:
        said = sorted(zip(replies.column("prefix").to_pylist(), replies.column("counts").to_pylist()))
        total, row = np.concatenate([arrowtext.unpack_small(c) for _, c in said]), spoken.to_pylist()[0]
        rows = [(asker, row["prefix"], arrowtext.pack_small(total[arrowtext.unpack_small(i)])) for asker, i in zip(row["askers"], row["inverses"])]
    return _table(rows, {"asker": pa.int64(), "prefix": pa.int64(), "counts": pa.binary()})


def answer(asked: DataFrame, askers: int, width: int, each: int, run: scratch.Run, most: int | None = None, bits: int = BITS, merged: int = MERGED) -> DataFrame:
    """REPLY rows to ASKED ones, written; sums are held at ``most``. A task sums up about ``each`` askers' worth of hashes.

    Asker -1 gets, for every range that a task summed up: the hashes with a sum above 0 and their sums, and the same of those
    with a sum above 1.
    """
    levels = 1
    while askers > each << (bits * levels):
        levels += 1
    return _level(asked, askers, width, 1, levels, run, most, bits, merged)


def _level(asked: DataFrame, askers: int, width: int, level: int, levels: int, run: scratch.Run, most: int | None, bits: int, merged: int) -> DataFrame:
    if level == levels:
        return run.keep(asked.groupBy("prefix").applyInArrow(_answered(most), REPLY), "replies")
    groups = math.ceil(askers / merged)
    dealt = asked.withColumn("g", F.pmod(F.xxhash64("asker"), F.lit(groups)))
    both = run.keep(dealt.groupBy("prefix", "g").applyInArrow(_merged(width, bits * (level + 1)), _BOTH), "merged")
    deeper = _level(both.where("kind = 0").select("asker", "prefix", "hashes", "counts"), groups, width, level + 1, levels, run, most, bits, merged)
    spoken = both.where("kind = 1").select("asker", "prefix", "askers", "inverses")
    spread = spoken.groupBy("asker").cogroup(deeper.where("asker >= 0").groupBy("asker")).applyInArrow(_spread, REPLY)
    out = run.keep(spread.unionByName(deeper.where("asker < 0")), "replies")
    run.drop(both, deeper)
    return out


def totals(replies: DataFrame) -> list[int]:
    """The sums of what asker -1 was told: hashes and sums above 0, hashes and sums above 1."""

    def run(batches):
        for batch in batches:
            sums = [arrowtext.unpack_small(c).tolist() for c in batch.column("counts").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in sums], pa.int64()) for i in range(4)], ["a", "b", "c", "d"])

    sums = replies.where("asker < 0").select("counts").mapInArrow(run, "a long, b long, c long, d long")
    return list(sums.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "abcd")).first())

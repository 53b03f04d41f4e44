"""N-gram Jaccard join, size-aware and heavy-light (operator 10).

A document's set holds its distinct shingles of ``n`` words, as 64-bit hashes. Two sets link when their Jaccard similarity
reaches ``percent`` / 100. The join finds the components of all links without writing out the pairs.

Light sets, of at most ``boundary`` shingles, are joined by enumerating fixed-size subsets: linked sets a, b with
|a| <= |b| share at least ceil(percent |b| / 100) shingles, so both hold a common subset of that size.

Heavy sets, and light ones that a heavy one could link to, are joined by scanning inverted lists, shingle to sets. A linked
set shares all but a part of its shingles, so that of two linked sets the rarest shingles, as many as they may differ in and
one more, have one in common; lists hold these only. Rarity is the number of texts of the whole corpus that have the
shingle, counted exactly up to collisions of the hash's upper bits, which only make a shingle look more frequent. A passage
that many documents share hence fills no list, and what only one text has needs no list. Subsets too leave out such shingles.

The boundary is chosen by cost over the sizes that the corpus has: subsets of the light sets, against rare shingles of the
heavy ones times the mean length of a list.

Texts are read once, into written blocks. A block asks the corpus, by way of ``exchange``, how often its shingles occur, gets
the answers back, and deals out the keys of its sets, subsets and rare shingles, after combining them: of the sets that meet
under a key inside a block only the first goes on, so that a key that a third of all rows have is one entry of each block.

Sets that meet under some key form clusters; links inside a cluster are then decided exactly, from its sets, by scanning
inverted lists again. Many clusters share a task. A cluster beyond ``CLUSTER_SHINGLES`` is first compared with a few of its
own sets; what these link is one piece from then on, and only blocks of different pieces are compared with each other. No
text is ever moved: what moves are the sets of documents that met another one. Identical sets are one set throughout.

Defined cases: texts with fewer words than n have their whole sequence as one shingle; null texts and texts without words
have an empty set and link with nothing; repeated rows link, as their sets are equal; a null doc_id is never the smallest
of a component that has another; an empty table gives an empty table; extra columns are ignored by ``components`` and
kept by ``keep_one``, whatever their names, but a column uid is taken as the row's unique number by ``components``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrowtext, exchange, scratch

#: Sizes up to which a boundary is looked for. A set of this size has tens of thousands of subsets and a handful of rare shingles.
LIGHT_MOST = 32
#: Bytes of text of a block; blocks' worth of shingles that a task counts, and bytes of text whose keys make a bucket.
BLOCK_BYTES = 6 << 20
BUCKET_BLOCKS = 4
KEY_BYTES = 64 << 20
#: Shingles of a task that decides links, and of a cluster from which on it is compared in blocks.
TASK_SHINGLES = 100_000
CLUSTER_SHINGLES = 200_000
#: Sets of a large cluster that all its sets are compared with first.
LEADERS = 8
#: Edges that one task contracts.
EDGES_PER_TASK = 2_000_000
_SHORT = 0x5851F42D4C957F2D
_SUBSET = 0x2545F4914F6CDD1D
_ALL = (1 << 64) - 1


def tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending hashes of the distinct words, the codes of all words in order, and the words of each text."""
    dictionary, codes, counts = arrowtext.words(text)
    hashes, number = np.unique(arrowtext.word_hashes(dictionary), return_inverse=True)
    return hashes, number[codes], counts


def sets_of(hashes: np.ndarray, codes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of some texts one after another, each ascending, and their sizes."""
    at, owner = hashes[codes], np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
    gram, taken = at, place >= n - 1
    values = np.zeros(len(at), np.uint64)
    for k in range(1, n + 1):
        if k > 1:
            longer = np.zeros(len(at), np.uint64)
            longer[1:] = arrowtext.extend(gram[:-1], at[1:])
            gram = longer
        if k < n:  # a text of k words is one shingle, marked by its length
            last = np.cumsum(counts)[counts == k] - 1
            values[last] = arrowtext.mix(gram[last] ^ np.uint64(_SHORT * k & _ALL))
            taken[last] = True
    full = place >= n - 1
    values[full] = gram[full]
    value, doc = values[taken], owner[taken]
    ends = np.cumsum(np.bincount(doc, minlength=len(counts)))
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        value[a:b].sort()
    if len(value):
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        value, doc = value[fresh], doc[fresh]
    return value, np.bincount(doc, minlength=len(counts)).astype(np.int64)


class Sizes:
    """What the threshold says about sizes, in integers; and the keys that a set has, with a list scanned at ``scan`` entries."""

    def __init__(self, percent: int, boundary: int, scan: float = 1.0):
        self.percent, self.boundary, self.scan = percent, boundary, scan

    def largest_partner(self, size):
        return size * 100 // self.percent

    def shared(self, larger):
        """Shingles that a set of this size shares with any linked set that isn't larger."""
        return -(-larger * self.percent // 100)

    def rare(self, size):
        """Of so many rarest shingles, two linked sets have one in common."""
        return size - self.shared(size) + 1

    def listed(self, size):
        """Whether a set of this size scans lists: heavy ones, and light ones with heavy partners."""
        return self.largest_partner(size) > self.boundary

    def subset_sizes(self, size: int) -> list[int]:
        """Sizes of the subsets that a light set enumerates: for each light partner that isn't smaller."""
        return sorted({self.shared(b) for b in range(size, min(self.boundary, self.largest_partner(size)) + 1) if self.shared(b) <= size})

    def cost(self, size: int) -> float:
        """Subsets of a set of this size, and the entries of the lists that it scans."""
        light = sum(math.comb(size, c) for c in self.subset_sizes(size)) if size <= self.boundary else 0
        return light + (self.rare(size) * self.scan if self.listed(size) else 0)


def choose_boundary(histogram: dict[int, int], percent: int, scan: float = 1.0) -> int:
    """The boundary with the least cost over sets of the given sizes. Sets above LIGHT_MOST cost the same at every boundary."""
    cost = {x: sum(n * Sizes(percent, x, scan).cost(s) for s, n in histogram.items() if s > 0) for x in range(LIGHT_MOST + 1)}
    return min(cost, key=lambda x: (cost[x], x))


def _parts(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of ascending buckets."""
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
    return [(int(bucket[a]), a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _batch(types: dict[str, pa.DataType], rows: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in types.items()], list(types))


_FACTS = {"kind": pa.int32(), "uid": pa.int64(), "size": pa.int64(), "digest": pa.binary(), "block": pa.int64(), "bucket": pa.int32(), **{c: pa.binary() for c in ("hashes", "codes", "words", "uids", "fresh", "counts")}}
_FACTS_SQL = "kind int, uid long, size long, digest binary, block long, bucket int, hashes binary, codes binary, words binary, uids binary, fresh binary, counts binary"


def _facts(n: int, bits: int, prefix_bits: int):
    """Of every row (uid, key, text) its size and the digest of its set (kind 0); of every block its words (kind 1), and its
    messages to the exchange: its distinct shingles, cut to ``bits`` bits, with the number of its different sets that have
    them (kind 2; the prefix is the bucket)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in arrowtext.slices(batches, "text", BLOCK_BYTES):
            keys = batch.column("key")
            types = _FACTS | {"key": keys.type}
            hashes, codes, counts = tokens(arrowtext.texts(batch, "text"))
            values, sizes = sets_of(hashes, codes, counts, n)
            uid, ends = batch.column("uid").to_numpy(zero_copy_only=False), np.cumsum(sizes)
            digests = [hashlib.blake2b(values[b - s : b].tobytes(), digest_size=16).digest() for s, b in zip(sizes.tolist(), ends.tolist())]
            yield _batch(types, len(sizes), kind=[0] * len(sizes), uid=uid, size=sizes, digest=digests, block=[block] * len(sizes), key=keys)
            first: dict[bytes, int] = {}
            fresh = np.array([first.setdefault(d, i) == i for i, d in enumerate(digests)], bool)
            yield _batch(
                types, 1, kind=[1], block=[block], hashes=[arrowtext.pack_sorted(hashes)], codes=[arrowtext.pack_small(codes)],
                words=[arrowtext.pack_small(counts)], uids=[arrowtext.pack_small(uid)], fresh=[fresh.tobytes()],
            )
            cut, count = np.unique(values[np.repeat(fresh, sizes)] >> np.uint64(64 - bits), return_counts=True)
            asked = exchange.messages(block, cut, count, bits, prefix_bits)
            columns = [list(c) for c in zip(*asked)] or [[]] * 4
            yield _batch(types, len(asked), kind=[2] * len(asked), block=columns[0], bucket=columns[1], hashes=columns[2], counts=columns[3])
            block += 1

    return run


def keys_of(values: np.ndarray, sizes: np.ndarray, count: np.ndarray, law: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """(keys, number of the set) of all keys of some sets, whose shingles have the given counts."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    several = count > 1
    single = np.bincount(owner[~several], minlength=len(sizes))
    value, of, seen = values[several], owner[several], count[several]
    by = np.lexsort((value, seen, of))
    ranked, own = value[by], of[by]
    n = np.bincount(own, minlength=len(sizes))
    place = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    wanted = np.where(law.listed(sizes), law.rare(sizes) - single, 0)  # the rarest are those that only this set has
    take = place < wanted[own]
    keys, owners = [arrowtext.mix(ranked[take])], [own[take]]
    firsts = np.cumsum(n) - n
    for i in np.flatnonzero((sizes > 0) & (sizes <= law.boundary)).tolist():
        shared = value[firsts[i] : firsts[i] + n[i]]
        for c in law.subset_sizes(int(sizes[i])):
            if c <= len(shared):
                picks = np.array(list(combinations(range(len(shared)), c)))
                keys.append(arrowtext.mix(arrowtext.mix(shared[picks]).sum(axis=1, dtype=np.uint64) + np.uint64(_SUBSET * c & _ALL)))
                owners.append(np.full(len(picks), i))
    return np.concatenate(keys), np.concatenate(owners)


_KEYS = {"kind": pa.int32(), "uid": pa.int64(), "other": pa.int64(), "bucket": pa.int32(), "base": pa.int64(), "keys": pa.binary(), "refs": pa.binary()}
_KEYS_SQL = "kind int, uid long, other long, bucket int, base long, keys binary, refs binary"


def _keyed(n: int, bits: int, bucket_bits: int, law: Sizes):
    """From a block and what it was answered: by bucket its keys (kind 0), each with the first set that has it; edges between
    the sets that meet under a key inside the block (kind 1); and the sets that have a key (kind 2)."""

    def run(block: pa.Table, replies: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.Table.from_batches([_batch(_KEYS, 0)])
        row = block.to_pylist()[0]
        values, sizes = sets_of(arrowtext.unpack_sorted(row["hashes"]), arrowtext.unpack_small(row["codes"]), arrowtext.unpack_small(row["words"]), n)
        uid, fresh = arrowtext.unpack_small(row["uids"]), np.frombuffer(row["fresh"], bool)
        asked = np.unique(values[np.repeat(fresh, sizes)] >> np.uint64(64 - bits))
        said = sorted((b, c) for b, c in zip(replies.column("prefix").to_pylist(), replies.column("counts").to_pylist()) if b >= 0)
        total = np.concatenate([arrowtext.unpack_small(c) for _, c in said] or [np.zeros(0, np.int64)])
        copies = [u for x in replies.column("copies").to_pylist() if x for u in x]
        lead = fresh & (sizes > 0) & ~np.isin(uid, np.array(copies, np.int64))
        values = values[np.repeat(lead, sizes)]
        uid, sizes = uid[lead], sizes[lead]
        key, of = keys_of(values, sizes, total[np.searchsorted(asked, values >> np.uint64(64 - bits))], law)
        out = []
        if len(key):
            with_key, ends = np.unique(of), np.cumsum(sizes)
            out.append(_batch(_KEYS, len(with_key), kind=[2] * len(with_key), uid=uid[with_key], other=sizes[with_key], keys=[arrowtext.pack_sorted(values[ends[i] - sizes[i] : ends[i]]) for i in with_key.tolist()]))
            key, first, edges = _stars(key, uid[of])
            out.append(_batch(_KEYS, len(edges), kind=[1] * len(edges), uid=edges[:, 0], other=edges[:, 1]))
            parts, base = _parts((key >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(key), np.int64)), int(uid.min())
            out.append(_batch(_KEYS, len(parts), kind=[0] * len(parts), bucket=[p for p, _, _ in parts], base=[base] * len(parts), keys=[arrowtext.pack_sorted(key[a:b]) for _, a, b in parts], refs=[arrowtext.pack_small(first[a:b] - base) for _, a, b in parts]))
        return pa.Table.from_batches(out or [_batch(_KEYS, 0)])

    return run


def _forest(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Edges (node, smallest node that it is connected with) of all nodes that aren't the smallest."""
    nodes, ends = np.unique(np.stack([u, v]), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        least, new = np.minimum(label[a], label[b]), label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(nodes))
    return np.stack([nodes[far], nodes[label[far]]], axis=1)


def _stars(key: np.ndarray, uid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once with its smallest uid, ascending; and a forest of the rows that meet under the keys."""
    by = np.lexsort((uid, key))
    key, uid = key[by], uid[by]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    lead = uid[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    other = ~fresh & (lead != uid)
    return key[fresh], uid[fresh], _forest(uid[other], lead[other])


def _edges(pairs: np.ndarray) -> pa.Table:
    return pa.table({"u": pa.array(pairs[:, 0], pa.int64()), "v": pa.array(pairs[:, 1], pa.int64())})


def _met(table: pa.Table) -> pa.Table:
    """Edges (uid, first uid) of the sets that meet under a key of one bucket."""
    keys, uids = [], []
    for base, k, r in zip(table.column("base").to_pylist(), table.column("keys").to_pylist(), table.column("refs").to_pylist()):
        keys.append(arrowtext.unpack_sorted(k))
        uids.append(base + arrowtext.unpack_small(r))
    return _edges(_stars(np.concatenate(keys), np.concatenate(uids))[2])


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(list(batches), pa.schema([("u", pa.int64()), ("v", pa.int64())]))
    yield from _edges(_forest(table.column("u").to_numpy(), table.column("v").to_numpy())).to_batches()


def _stars_only(edges: DataFrame) -> bool:
    n = edges.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("u")).first()
    return n["n"] == n["u"] and edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()


def connected(edges: DataFrame, run: scratch.Run) -> DataFrame:
    """(node, root) of all nodes of the edges (u, v); root is the component's smallest node.

    Edges are dealt at random to tasks of about ``EDGES_PER_TASK``, which contract theirs to forests; if there is one task,
    that's it. Otherwise each round links every node's neighbours to the smallest of them and itself (first those larger
    than the node, then those not larger), which keeps the components, until all edges are stars: no node has two edges,
    and no root has one. A round's minima combine on the map side and are written, so that the join of a hub's edges with its
    minimum is a plain one, whose large partitions Spark splits.
    """
    edges = run.keep(edges.where("u <> v").select("u", "v"), "edges")
    tasks = max(1, math.ceil(edges.count() / EDGES_PER_TASK))
    dealt = edges.coalesce(1) if tasks == 1 else edges.repartition(tasks)
    whole, edges = edges, run.keep(dealt.mapInArrow(_contracted, "u long, v long"), "forest")
    run.drop(whole)
    while tasks > 1 and not _stars_only(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = run.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = run.keep(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        run.drop(edges, least)
        least = run.keep(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = run.keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        run.drop(large, least)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))


def links(sets: list[np.ndarray], percent: int, left: np.ndarray | None = None, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A forest of the links among some sets; with ``left``, only links between sets where it is true and sets where it isn't.
    Sets of one number in ``known`` are known to be connected.

    A set's shingles are put in order of their frequency among these sets. Of two linked sets the rarest shingles, as many
    as they may differ in and one more, have one in common; so inverted lists hold these only. A set scans the lists of
    its own rarest shingles. Of every component that it meets it is first compared with the set that shares most of them,
    then with the others of components that it still isn't part of.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    value, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, code, count = np.unique(value, return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    by = np.lexsort((rank[code], owner))
    code, firsts = rank[code][by], np.cumsum(sizes) - sizes  # now codes are ranks, ascending in each set
    place = np.arange(len(code)) - np.repeat(firsts, sizes)
    rare = place < np.repeat(sizes - -(-sizes * percent // 100) + 1, sizes)
    of = np.argsort(code[rare], kind="stable")
    listed, edges = owner[rare][of], np.searchsorted(code[rare][of], np.arange(len(count) + 1))
    label, mark, found = np.arange(n) if known is None else np.unique(known, return_inverse=True)[1], np.zeros(len(count), bool), []

    def compare(i: int, others: np.ndarray) -> None:
        """Join set i with those of the others that it links with."""
        some = sizes[others]
        at = np.repeat(firsts[others] - (np.cumsum(some) - some), some) + np.arange(some.sum())
        overlap = np.add.reduceat(mark[code[at]].astype(np.int64), np.cumsum(some) - some)
        for j in others[100 * overlap >= percent * (some + sizes[i] - overlap)].tolist():
            if label[i] != label[j]:
                a, b = min(label[i], label[j]), max(label[i], label[j])
                label[label == b] = a
                found.append((i, j))

    for i in range(n):
        own = code[firsts[i] : firsts[i] + sizes[i]]
        spans = [listed[edges[c] : edges[c + 1]] for c in own[rare[firsts[i] : firsts[i] + sizes[i]]].tolist()]
        other, shared = np.unique(np.concatenate(spans), return_counts=True)
        near = (other < i) & (label[other] != label[i]) & (100 * np.minimum(sizes[other], sizes[i]) >= percent * np.maximum(sizes[other], sizes[i]))
        if left is not None:
            near &= left[other] != left[i]
        other, shared = other[near], shared[near]
        if not len(other):
            continue
        mark[own] = True
        by_most = np.argsort(-shared, kind="stable")
        compare(i, other[by_most[np.unique(label[other[by_most]], return_index=True)[1]]])
        rest = other[label[other] != label[i]]
        if len(rest):
            compare(i, rest)
        mark[own] = False
    return found


def _solve(percent: int):
    def run(table: pa.Table) -> pa.Table:
        uid, cluster, block, known = (table.column(c).to_numpy() for c in ("uid", "cluster", "block", "known"))
        data = table.column("keys").to_pylist()
        out: list[tuple[int, int]] = []
        order = np.lexsort((uid, cluster))
        for some in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            left = block[some] == block[some[0]]
            found = links([arrowtext.unpack_sorted(data[i]) for i in some.tolist()], percent, None if left.all() else left, known[some])
            out += [(int(uid[some[a]]), int(uid[some[b]])) for a, b in found]
        return _edges(np.array(out, np.int64).reshape(-1, 2))

    return run


def _linked(tasks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) inside the tasks (t, uid, cluster, block, known): in a cluster with several blocks, those between blocks."""
    return tasks.join(sets.select("uid", "keys"), "uid").groupBy("t").applyInArrow(_solve(percent), "u long, v long")


def _in_blocks(members: DataFrame, sets: DataFrame, percent: int, run: scratch.Run) -> DataFrame:
    """Links inside large clusters, from members (uid, cluster, size, weight); weight is the cluster's size.

    Each cluster's leaders, a few of its sets, are compared with all its sets. What they link is a piece; sets without a
    link are pieces of their own. Large pieces are dealt into blocks of their own, small ones share blocks, and each pair of
    blocks that aren't of one piece is a task. So a cluster of one large piece is linear in its size.
    """
    slot = F.pmod(F.xxhash64("uid"), F.lit(LEADERS))
    leaders = members.groupBy("cluster", slot.alias("slot"), "weight").agg(F.min("uid").alias("uid"))
    leaders = run.keep(leaders.select("cluster", "weight", "uid"), "leaders")
    deals = F.ceil(F.col("weight") / TASK_SHINGLES).cast("int")
    task = lambda deal: F.xxhash64("cluster", deal).alias("t")
    own = members.select(task(F.pmod(F.xxhash64(F.lit(1), "uid"), deals).cast("int")), "uid", "cluster", F.lit(0).alias("block"), F.col("uid").alias("known"))
    sent = leaders.withColumn("deal", F.explode(F.sequence(F.lit(0), deals - 1))).select(task(F.col("deal")), "uid", "cluster", F.lit(1).alias("block"), F.col("uid").alias("known"))
    first = run.keep(_linked(own.unionByName(sent), sets, percent), "led")

    pieces = run.keep(connected(first, run), "pieces")
    known = members.join(pieces.select(F.col("node").alias("uid"), F.col("root").alias("piece")), "uid", "left")
    known = run.keep(known.withColumn("piece", F.coalesce("piece", "uid")), "known")
    half = lambda weight: F.ceil(F.col(weight) * 2 / CLUSTER_SHINGLES).cast("int")
    weights = known.groupBy("cluster", "piece").agg(F.sum("size").alias("w"))
    weights = run.keep(weights.withColumn("large", F.col("w") * 2 > CLUSTER_SHINGLES), "weights")
    large = weights.where("large").select("cluster", "piece", half("w").alias("parts"))
    mixed = run.keep(weights.where("not large").groupBy("cluster").agg(F.sum("w").alias("w")).select("cluster", half("w").alias("shared")), "mixed")
    numbered = lambda df, parts: df.withColumn("part", F.explode(F.sequence(F.lit(0), F.col(parts) - 1))).drop(parts)
    block = F.xxhash64("cluster", F.coalesce("piece", F.lit(-1)), "part").alias("b")
    blocks = numbered(large, "parts").unionByName(numbered(mixed, "shared").withColumn("piece", F.lit(None).cast("long")))
    blocks = run.keep(blocks.select("cluster", "piece", block), "blocks")
    a, b = (blocks.select("cluster", F.col("piece").alias(f"p{x}"), F.col("b").alias(x)) for x in "ij")
    pairs = a.join(b, "cluster").where((F.col("i") <= F.col("j")) & (F.col("pi").isNull() | F.col("pj").isNull() | (F.col("pi") != F.col("pj"))))
    pairs = run.keep(pairs.select(F.xxhash64("i", "j").alias("t"), F.explode(F.array_distinct(F.array("i", "j"))).alias("b")), "pairs")

    dealt = known.join(large, ["cluster", "piece"], "left").join(mixed, "cluster", "left")
    part = F.pmod(F.xxhash64(F.lit(2), F.when(F.col("parts").isNull(), F.col("piece")).otherwise(F.col("uid"))), F.coalesce("parts", "shared")).cast("int")
    dealt = dealt.select("uid", "cluster", F.col("piece").alias("known"), F.xxhash64("cluster", F.when(F.col("parts").isNull(), F.lit(-1).cast("long")).otherwise(F.col("piece")), part).alias("b"))
    tasks = dealt.join(pairs, "b").select("t", "uid", "cluster", F.col("b").alias("block"), "known")
    return first.unionByName(_linked(tasks, sets, percent))


def _cluster_links(clusters: DataFrame, sets: DataFrame, percent: int, run: scratch.Run) -> DataFrame:
    """Links (u, v) inside the clusters (node, root), exactly."""
    members = clusters.select(F.col("node").alias("uid"), F.col("root").alias("cluster")).join(sets.select("uid", "size"), "uid")
    members = run.keep(members, "members")
    weights = members.groupBy("cluster").agg(F.sum("size").alias("weight"), F.count(F.lit(1)).alias("sets")).where("sets > 1").drop("sets")
    weights = run.keep(weights, "weights")
    members = run.keep(members.join(weights, "cluster"), "members")
    small = members.where(F.col("weight") <= CLUSTER_SHINGLES)
    total = small.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    bins = max(1, math.ceil(total / TASK_SHINGLES))
    out = _linked(small.select(F.pmod(F.xxhash64("cluster"), F.lit(bins)).alias("t"), "uid", "cluster", F.lit(0).cast("long").alias("block"), F.col("uid").alias("known")), sets, percent)
    large = members.where(F.col("weight") > CLUSTER_SHINGLES)
    return out if large.isEmpty() else out.unionByName(_in_blocks(large, sets, percent, run))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, percent: int = 85, boundary: int | None = None, run: scratch.Run | None = None, prefix_bits: int = exchange.BITS, merged: int = exchange.MERGED) -> DataFrame:
    """(uid, key, n_shingles, component_id, first) of every row of docs, which has a unique long column uid. component_id is
    the smallest key of the component; first is true for exactly one row of each component, which has that key."""
    run = run or scratch.Run(docs.sparkSession)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    # Thousands of values for each shingle: a false companion would send a set, that needs no list, on its way.
    bits = min(60, 37 + max(0, math.ceil(math.log2(max(1, size / (128 << 20))))))
    bucket_bits = min(30, math.ceil(math.log2(max(8, size / KEY_BYTES))))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select("uid", F.col(key).alias("key"), F.col(text).alias("text"))
    facts = run.keep(rows.mapInArrow(_facts(n, bits, prefix_bits), f"{_FACTS_SQL}, key {kind}"), "facts")

    sets = run.keep(facts.where("kind = 0").select("uid", "key", "size", "digest", "block"), "sets")
    several = sets.where("size > 0").groupBy("digest").agg(F.min("uid").alias("lead"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    several = run.keep(several.select("digest", "lead"), "several")
    same = run.keep(sets.join(several, "digest").where("uid <> lead").select(F.col("uid").alias("u"), F.col("lead").alias("v"), "block"), "same")
    blocks = facts.where("kind = 1").select("block", "hashes", "codes", "words", "uids", "fresh")
    asked = facts.where("kind = 2").select(F.col("block").alias("asker"), F.col("bucket").cast("long").alias("prefix"), "hashes", "counts")
    replies = exchange.answer(asked, blocks.count(), bits, BUCKET_BLOCKS, run, 255, prefix_bits, merged)
    if boundary is None:
        histogram = sets.where(F.col("size").between(1, LIGHT_MOST)).groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()
        _, _, listed, seen = exchange.totals(replies)
        boundary = choose_boundary({r["size"]: r["n"] for r in histogram}, percent, seen / listed if listed else 1.0)
    copies = same.groupBy("block").agg(F.collect_list("u").alias("copies"))  # of one block
    told = replies.where("asker >= 0").select(F.col("asker").alias("block"), "prefix", "counts", F.lit(None).cast("array<long>").alias("copies"))
    told = told.unionByName(copies.select("block", F.lit(-1).cast("long").alias("prefix"), F.lit(None).cast("binary").alias("counts"), "copies"))
    keyed = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_keyed(n, bits, bucket_bits, Sizes(percent, boundary)), _KEYS_SQL)
    keyed = run.keep(keyed, "keyed")
    run.drop(replies, facts)

    met = keyed.where("kind = 0").select("bucket", "base", "keys", "refs").groupBy("bucket").applyInArrow(_met, "u long, v long")
    met = met.unionByName(keyed.where("kind = 1").select(F.col("uid").alias("u"), F.col("other").alias("v")))
    clusters = run.keep(connected(met, run), "clusters")
    own = keyed.where("kind = 2").select("uid", F.col("other").alias("size"), "keys")
    linked = _cluster_links(clusters, own, percent, run)
    groups = run.keep(connected(linked.unionByName(same.select("u", "v")), run), "components").select(F.col("node").alias("uid"), "root")
    run.drop(keyed)

    keys = sets.select("uid", "key", "size")
    least = groups.join(keys, "uid").groupBy("root").agg(F.min(F.struct(F.isnull("key").alias("none"), F.col("key").alias("key"), F.col("uid").alias("uid"))).alias("least"))
    least = run.keep(least, "least")
    out = keys.join(groups.join(least, "root").select("uid", "least"), "uid", "left")
    return out.select("uid", F.col("key").alias(key), F.col("size").alias("n_shingles"), F.when(F.col("least").isNull(), F.col("key")).otherwise(F.col("least.key")).alias("component_id"), F.coalesce(F.col("least.uid") == F.col("uid"), F.lit(True)).alias("first"))


def numbered(df: DataFrame, run: scratch.Run | None = None) -> DataFrame:
    """df with unique numbers uid, written, so that they stay."""
    return (run or scratch.Run(df.sparkSession)).keep(df.withColumn("uid", F.monotonically_increasing_id()), "numbered")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80, run: scratch.Run | None = None) -> DataFrame:
    """df's rows and columns with one document of each component: the one with the smallest key."""
    run = run or scratch.Run(df.sparkSession)
    plain, names = scratch.shielded(df)
    rows = numbered(plain, run)
    kept = components(rows, f"c{names.index(key)}", f"c{names.index(text)}", n, percent, run=run).where("first").select("uid")
    return rows.join(kept, "uid", "left_semi").select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))

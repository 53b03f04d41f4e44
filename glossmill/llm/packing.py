"""Hierarchical multi-length packing (operator 9).

A document's ids, with an end id, are cut into whole long windows; the rest is routed to the smallest context tier that
holds it. Tiers are packed from the longest to the shortest: each item of a tier opens a window, its gap takes the
largest fitting items of shorter tiers, and where nothing fits an item is cut so that the gap closes exactly. Hence
windows are full. What can't fill a window waits for later documents of the partition; at the partition's end the last
tokens go into windows of tier sizes, and at most one window is padded. Windows of a tier are numbered into step groups
of equal numbers of tokens.

There is no shuffle: every partition packs its own documents, in slices, and holds less than the sum of the tiers
between slices. Sequence ids carry the partition number, so that they are unique.

Defined cases: a null or empty text is the end id alone; texts of any length are packed whole; repeated rows are packed
each; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
import string
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import arrowtext

TIERS = (2048, 1024, 512, 256)
#: Words and marks that a worker remembers, and bytes of them and their ids; they are forgotten when there are so many.
MEMO, MEMO_BYTES = 1_500_000, 96 << 20
# Marks that may follow letters; and the Latin letters whose classes and lower cases all Unicode versions share,
# without the one that becomes a letter and a mark when lowered.
_MARKS = string.punctuation
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_LETTERS = re.compile(f"[{_LATIN}]+")
_LOADED: dict[str, WordEncoder] = {}


def _byte_characters() -> dict[int, str]:
    """The character that byte-level models write for each byte: printable bytes are themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_BYTES = _byte_characters()


def parted(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Lowered letters and the marks after them; a word of any other form stays whole, without marks."""
    core = pc.ascii_rtrim(words, characters=_MARKS)
    plain = pc.match_substring_regex(core, f"^[{_LATIN}]+$")
    some = np.asarray(plain.to_numpy(zero_copy_only=False), bool)
    size = lambda x: x.value_lengths() if hasattr(x, "value_lengths") else pc.binary_length(x)
    whole, kept = size(words).to_numpy(zero_copy_only=False).astype(np.int64), size(core).to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.where(some, whole - kept, 0)
    ends = np.cumsum(n)
    starts = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words)] + kept
    at = np.repeat(starts - (ends - n), n) + np.arange(n.sum())
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[at]
    marks = pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    return pc.if_else(plain, pc.utf8_lower(core), words), marks


class WordEncoder:
    """Ids of whole texts from ids of words. The tokenizer drops white space and never joins across it, so that the ids of a
    text are those of its words in order; nor does it join letters with the marks after them, and it lowers letters. So a
    word of Latin letters is known by its letters, lowered, and by its marks, and each of these goes through the tokenizer once.

    What is known is kept in flat arrays: the ids of entry i end at ends[i]. Entry 0 is empty.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words are parted only if this tokenizer parts them at every mark, and a letter skips its pipeline only if that does
        # nothing to it but lower it and write its bytes; every letter and mark is tried.
        whole = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        letters = [chr(c) for c in range(0x250) if _LETTERS.fullmatch(chr(c))]
        self.parts = all(whole(f"Wo{c}r{m}") == [*whole(f"wo{c.lower()}r"), *whole(m)] for m in (*_MARKS, *(f"{m}{n}" for m, n in zip(_MARKS, _MARKS[1:]))) for c in "aé")
        self.parts &= all(whole(f"{c}b{c}.,") == [*whole(f"{c.lower()}b{c.lower()}"), *whole(".,")] for c in letters)
        self.plain = all(whole(f"{c}q{c}") == self._letters(f"{c}q{c}".lower()) for c in letters)
        self.forget()

    def _letters(self, word: str) -> list[int]:
        """Ids of lowered letters, by the model alone."""
        if not word.isascii():
            word = "".join([_BYTES[b] for b in word.encode()])
        return [t.id for t in self.tokenizer.model.tokenize(word)]

    def forget(self) -> None:
        self.entries: dict[str, int] = {"": 0}
        self.flat, self.ends, self.held = array("I"), array("q", [0]), 0

    def learn(self, words: list[str]) -> None:
        """Words that aren't known yet, each once."""
        rest, keep, letters, is_letters = [], self._keep, self._letters, _LETTERS.fullmatch
        for w in words:
            if self.plain and is_letters(w) and w == w.lower():
                keep(w, letters(w))
            else:
                rest.append(w)
        for at in range(0, len(rest), 10_000):
            some = rest[at : at + 10_000]
            for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                keep(w, e.ids)

    def _keep(self, word: str, ids: list[int]) -> None:
        self.entries[word] = len(self.ends)
        self.flat.extend(ids)
        self.ends.append(len(self.flat))
        self.held += len(word) + 4 * len(ids)

    def _known(self, words: pa.Array) -> np.ndarray:
        """The entry of each word."""
        coded = words.dictionary_encode()
        names = coded.dictionary.to_pylist()
        self.learn([w for w in names if w not in self.entries])
        return np.fromiter(map(self.entries.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy(zero_copy_only=False)]

    def encode(self, text: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, each text closed by end_id; the number of ids of each text."""
        dictionary, codes, counts = arrowtext.coded(text, lower=False)
        if len(self.entries) + len(dictionary) > MEMO or self.held > MEMO_BYTES:
            self.forget()
        cores, marks = parted(dictionary) if self.parts else (dictionary, pa.array([""] * len(dictionary), pa.large_string()))
        entry = np.stack([self._known(cores), self._known(marks)], axis=1)
        ends = np.frombuffer(self.ends, np.int64)
        firsts = np.concatenate([[0], ends[:-1]])
        flat = np.append(np.frombuffer(self.flat, np.uint32), np.uint32(end_id)) if len(self.flat) else np.array([end_id], np.uint32)
        # the end id is one more entry, which stands after each text's last word
        firsts, sizes = np.append(firsts, len(flat) - 1), np.append(ends - firsts, 1)
        closed = np.insert(entry[codes], np.cumsum(counts), [len(sizes) - 1, 0], axis=0).ravel()
        n = sizes[closed]
        ids = flat[np.repeat(firsts[closed] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        of_text = np.repeat(np.arange(len(counts)), 2 * (counts + 1))
        return ids, np.bincount(of_text, weights=n, minlength=len(counts)).astype(np.int64)


class Packer:
    """Packs items (document number, start, length) into windows. ``place`` is called for each piece."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int, emit):
        self.tiers, self.step, self.emit = tuple(sorted(tiers, reverse=True)), step_tokens, emit
        self.pools: dict[int, list[tuple[int, object, int]]] = {w: [] for w in self.tiers}  # (length, document, start), ascending
        self.waiting = dict.fromkeys(self.tiers, 0)  # tokens in each pool
        self.sequences = 0
        self.made = dict.fromkeys(self.tiers, 0)

    def tier(self, length: int) -> int:
        return min(w for w in self.tiers if w >= length)

    def add(self, document, length: int) -> None:
        longest = self.tiers[0]
        for start in range(0, length - longest + 1, longest):
            self._window(longest, [(longest, document, start)])
        rest = length % longest
        if rest:
            self._put(rest, document, length - rest)

    def _put(self, length: int, document, start: int) -> None:
        w = self.tier(length)
        insort(self.pools[w], (length, document, start), key=lambda x: x[0])
        self.waiting[w] += length

    def _take(self, w: int, at: int) -> tuple[int, object, int]:
        item = self.pools[w].pop(at)
        self.waiting[w] -= item[0]
        return item

    def _window(self, tier: int, items: list[tuple[int, object, int]]) -> None:
        group = self.made[tier] * tier // self.step
        self.made[tier] += 1
        offset = 0
        for length, document, start in items:
            self.emit(document, start, length, self.sequences, offset, tier, group)
            offset += length
        self.sequences += 1

    def _largest(self, limit: int, tiers: tuple[int, ...]) -> tuple[int, object, int] | None:
        for w in tiers:
            at = bisect_right(self.pools[w], limit, key=lambda x: x[0])
            if at:
                return self._take(w, at - 1)
        return None

    def pack(self) -> None:
        """Full windows of every tier; what can't fill a window stays in the pools."""
        for k, w in enumerate(self.tiers):
            below = self.tiers[k:]
            while self.pools[w] and sum(self.waiting[s] for s in below) >= w:
                first = self._take(w, -1)
                items, gap = [first], w - first[0]
                while gap:
                    fit = self._largest(gap, below)
                    if fit is None:  # all are longer than the gap: the shortest is cut
                        length, document, start = self._take(next(s for s in reversed(below) if self.pools[s]), 0)
                        fit = (gap, document, start)
                        self._put(length - gap, document, start + gap)
                    items.append(fit)
                    gap -= fit[0]
                self._window(w, items)

    def left(self) -> list:
        return [x for w in self.tiers for x in self.pools[w]]

    def close(self) -> None:
        """The last tokens: windows of tier sizes, then one that is padded."""
        self.pack()
        rest = sorted(self.left(), key=lambda x: -x[0])
        for w in self.tiers:
            self.pools[w], self.waiting[w] = [], 0
        total = sum(x[0] for x in rest)
        while total:
            size = next((w for w in self.tiers if w <= total), total)
            items, gap = [], size
            while gap:
                length, document, start = rest.pop(0)
                part = min(length, gap)
                items.append((part, document, start))
                if part < length:
                    rest.insert(0, (length - part, document, start + part))
                gap -= part
            self._window(self.tier(size), items)
            total -= size


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, tiers: tuple[int, ...] = TIERS, step_tokens: int = 8 * 2048) -> DataFrame:
    """One row for each piece: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset, tier, step_group."""
    names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = WordEncoder(path)
        encoder, base = _LOADED[path], TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def emit(document, start, length, sequence, offset, tier, group) -> None:
            doc, ids, total, shift = document
            rows.append((doc, start, length, ids[start - shift : start - shift + length].tobytes(), total, base + sequence, offset, tier, base + group))

        def out() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *(pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())))], names)

        packer, kind = Packer(tiers, step_tokens, emit), pa.int64()
        for batch in arrowtext.slices(batches, text):
            kind = batch.column(key).type
            ids, lengths = encoder.encode(arrowtext.texts(batch, text), end_id)
            ids, ends = ids.astype("<u4"), np.cumsum(lengths)
            for doc, length, end in zip(batch.column(key).to_pylist(), lengths.tolist(), ends.tolist()):
                packer.add((doc, ids[end - length : end], length, 0), length)
            packer.pack()
            for w in packer.tiers:  # what waits keeps only its own ids, not the slice's
                packer.pools[w] = [(n, (d[0], d[1][s - d[3] : s - d[3] + n].copy(), d[2], s), s) for n, d, s in packer.pools[w]]
            yield out()
        packer.close()
        if rows:
            yield out()

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long")

"""Byte-level BPE by backtracking over an Aho-Corasick automaton (operator 4).

The bytes of a piece are mapped to Latin-1 for pyahocorasick, whose automaton finds every token at every place in one
pass. Encoding takes the longest token at each place and goes back to a shorter one, or to an earlier place, where two
neighbours aren't compatible. Two tokens are compatible if merging their joined bytes would leave the border between
them alone; the answer is memoised for each pair. A place that turned out to be dead is never entered again, so the
work is linear in the piece.

Defined cases: a null text is empty and has no ids; a null key stays one; texts of any length are encoded whole; every row
gives one row, repeated rows too; an empty table gives an empty table; columns beyond key and text are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrowtext

#: Segments that a worker remembers; the memo is emptied when it is full.
MEMO = 600_000
# ASCII white space splits texts into segments, the others send a text to the pattern as a whole; marks that may
# follow letters, and the end of the Latin letters whose class all Unicode versions share.
_SEGMENT = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_MARKS, _LATIN_END = string.punctuation, "\u0250"
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_LOADED: dict[tuple[str, str], Encoder] = {}


class Encoder:
    """Encoder and decoder for one file of ranks and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits: dict[int, bool] = {}
        self.lengths = [len(t) for t in self.tokens]
        # the token that two tokens make, for all that make one
        self.joined = {ranks[t[:n]] << 32 | ranks[t[n:]]: rank for t, rank in ranks.items() for n in range(1, len(t)) if t[:n] in ranks and t[n:] in ranks}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self._reachable(token, rank):
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        # of every token the longest shorter one that it begins with
        self.shorter = [-1] * len(self.tokens)
        for token, rank in ranks.items():
            self.shorter[rank] = next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if self.ranks.get(token[:n]) in self.halves), -1)
        if ranks:
            self.automaton.make_automaton()
        # What is remembered are tuples of plain values, which the garbage collector leaves alone.
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.memo: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        self.older: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
        # Letters with marks after them are parted without the pattern if that does so at every letter and mark.
        letters = [chr(c) for c in range(ord(_LATIN_END)) if chr(c).isalpha()]
        found = self.pattern.findall
        self.plain = all(found(f"{w}{c}a{c}") == [f"{w}{c}a{c}"] for c in letters for w in (" ", ""))
        self.plain &= all(found(f"{w}a{c}{m}") == [f"{w}a{c}", m] for c in "zé" for w in (" ", "") for m in (*_MARKS, *(x + y for x in _MARKS for y in _MARKS)))

    def _reachable(self, token: bytes, rank: int) -> bool:
        """Whether merging the token's bytes ends with the token; keeps the two halves of its last merge."""
        if len(token) == 1:
            self.halves[rank] = (rank, rank)
            return True
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None or best >= rank:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if parts[0] not in self.ranks or parts[1] not in self.ranks:
            return False
        self.halves[rank] = (self.ranks[parts[0]], self.ranks[parts[1]])
        return True

    def compatible(self, left: int, right: int) -> bool:
        """Whether the border between two tokens survives all merges; the answer is kept. Undoes the younger merge at the border, step by step:
        at each stage the two pieces that touch must not form a token that would have been merged before that step."""
        joined, lengths, halves = self.joined.get, self.lengths, self.halves
        a, b, before, answer = left, right, len(lengths), True
        while True:
            if joined(a << 32 | b, before) < before:
                answer = False
                break
            # of equal ranks the left merge comes first, so undo the right token at a tie
            if lengths[b] == 1:
                if lengths[a] == 1:
                    break
                before, a = a, halves[a][1]
            elif lengths[a] > 1 and a > b:
                before, a = a, halves[a][1]
            else:
                before, b = b + 1, halves[b][0]
        if len(self.fits) > 4_000_000:
            self.fits.clear()
        self.fits[left << 32 | right] = answer
        return answer

    def piece(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size, lengths, shorter, fits = len(data), self.lengths, self.shorter, self.fits
        longest = [-1] * size
        for end, (length, rank) in self.automaton.iter(data.decode("latin-1")):
            longest[end - length + 1] = rank  # ends ascend, so the longest comes last
        dead, place, chosen, left, token = bytearray(size + 1), 0, [], -1, longest[0]
        while True:
            while token >= 0:  # the longest token that may stand here
                if not dead[place + lengths[token]]:
                    fit = True if left < 0 else fits.get(left << 32 | token)
                    if fit or fit is None and self.compatible(left, token):
                        break
                token = shorter[token]
            if token >= 0:
                chosen.append(token)
                place += lengths[token]
                if place == size:
                    return chosen
                left, token = token, longest[place]
            elif chosen:
                dead[place] = 1
                token = chosen.pop()
                place -= lengths[token]
                left = chosen[-1] if chosen else -1
            else:
                raise ValueError("a byte of the text is no token")

    def matches(self, text: str) -> list[str]:
        """The pattern's matches in a segment."""
        word = text[1:] if text[:1] == " " else text
        letters = word.rstrip(_MARKS)
        if self.plain and letters.isalpha() and (letters.isascii() or max(letters) < _LATIN_END):
            cut = len(text) - len(word) + len(letters)
            return [text[:cut], text[cut:]] if cut < len(text) else [text]
        return self.pattern.findall(text)

    def segment(self, text: str) -> tuple[tuple[int, ...], str, bytes]:
        """Ids of a segment, their decimal form and their bytes. What was used lately is remembered, in two generations."""
        found = self.memo.get(text)
        if found is None:
            found = self.older.get(text)
            if found is None:
                ids = []
                for p in self.matches(text):
                    known = self.pieces.get(p)
                    if known is None:
                        known = tuple(self.piece(p.encode()))
                        if len(p) <= 64:
                            if len(self.pieces) >= MEMO:
                                self.pieces.clear()
                            self.pieces[p] = known
                    ids += known
                found = (tuple(ids), ",".join(map(str, ids)), self.decode(ids))
            if len(text) <= 64:
                if len(self.memo) >= MEMO // 2:
                    self.memo, self.older = {}, self.memo
                self.memo[text] = found
        return found

    def segments(self, text: str) -> list[str]:
        """Parts of a text that the pattern never matches across: white space with the word after it."""
        return [text] if _OTHER_SPACE.search(text) else _SEGMENT.findall(text)

    def encode(self, text: str) -> list[int]:
        return [i for s in self.segments(text) for i in self.segment(s)[0]]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


def load(path: str, pattern: str) -> Encoder:
    """The encoder for a file of ranks, once for each worker."""
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _LOADED[path, pattern] = Encoder(ranks, pattern)
    return _LOADED[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>, decoded binary) of every row. path names the ranks on the executors, as a fixed installation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in arrowtext.slices(batches, text):
            ids = [bpe.encode(t) for t in arrowtext.texts(batch, text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids], pa.binary())], [key, "ids", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>, decoded binary")


def encode_digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode``, with the ids and the decoded bytes reduced to digests where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in arrowtext.slices(batches, text):
            n, a, b = [], [], []
            for t in arrowtext.texts(batch, text).to_pylist():
                found = [bpe.segment(s) for s in bpe.segments(t)]
                n.append(sum([len(x[0]) for x in found]))
                a.append(hashlib.sha256(",".join([x[1] for x in found if x[1]]).encode()).hexdigest())
                b.append(hashlib.sha256(b"".join([x[2] for x in found])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(n, pa.int64()), pa.array(a), pa.array(b)], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")

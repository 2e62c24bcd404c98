"""Byte-level BPE by monoid tree reduction.

A text is cut by the pattern into pieces, each encoded separately. A piece is
encoded by halves: encode both halves recursively, then join the two id lists.
``join`` re-encodes a window around the seam, at first the last id on the left and
the first on the right, and grows it on whichever side is not yet stable. A side is
stable when the outermost id of the new window and its outer neighbour, encoded
together, give those two ids again: a list of reachable ids is the encoding of its
bytes exactly if that holds for every adjacent pair, so nothing outside the window
can change any more. Lists with ``join`` form a monoid, and any bracketing gives the
ids of the plain left-to-right merge loop. Above the pieces the join is plain
concatenation, since no merge crosses a piece. Decoding concatenates the bytes of
the ids up the same tree.

A piece that is itself in the vocabulary is its id at once, as the tiktoken library
has it. Null text counts as empty: no ids, the hash of the empty string. Empty
table: no rows. Repeated rows give repeated rows. Other columns are ignored."""

from __future__ import annotations

import base64
import heapq
import re
from hashlib import sha256
from itertools import chain

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from costlens.llm.common import text_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
_MEMO = 800_000
_UNSAFE = re.compile(r" \s| $")
_CUT = re.compile(r" (?=\S)")
_CODERS: dict[tuple[str, str], Coder] = {}


class Coder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.text_of = {v: str(v) for v in self.bytes_of}
        self.pieces = regex.compile(pattern)
        self.tree: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.units: dict[str, tuple[int, ...]] = {}

    def merge(self, raw: bytes) -> tuple[int, ...]:
        """The merge loop itself, for windows: the pair of lowest rank, leftmost
        first, until no pair is in the vocabulary."""
        n, ranks = len(raw), self.ranks
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, z = heapq.heappop(heap)
            mid = end[i]
            if not alive[i] or mid >= n or not alive[mid] or end[mid] != z or mid == z:
                continue
            alive[mid], end[i] = False, z
            if z < n:
                before[z] = i
                if (r := ranks.get(raw[i : end[z]])) is not None:
                    heapq.heappush(heap, (r, i, end[z]))
            if (p := before[i]) >= 0 and (r := ranks.get(raw[p:z])) is not None:
                heapq.heappush(heap, (r, p, z))
        return tuple(ranks[raw[i : end[i]]] for i in range(n) if alive[i])

    def apart(self, a: int, b: int) -> bool:
        """Whether two ids side by side stay as they are."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > _MEMO:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == (a, b)
        return known

    def join(self, a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
        if not a or not b or self.apart(a[-1], b[0]):
            return a + b
        left, right = 1, 1
        while True:
            window = self.merge(b"".join(self.bytes_of[x] for x in (*a[len(a) - left :], *b[:right])))
            grow_left = left < len(a) and not self.apart(a[len(a) - left - 1], window[0])
            grow_right = right < len(b) and not self.apart(window[-1], b[right])
            if not grow_left and not grow_right:
                return a[: len(a) - left] + window + b[right:]
            left = min(len(a), 2 * left) if grow_left else left
            right = min(len(b), 2 * right) if grow_right else right

    def reduce(self, raw: bytes) -> tuple[int, ...]:
        """Encode by halves."""
        if len(raw) < 2:
            return (self.ranks[raw],) if raw else ()
        ids = self.tree.get(raw)
        if ids is None:
            half = len(raw) // 2
            ids = self.join(self.reduce(raw[:half]), self.reduce(raw[half:]))
            if len(raw) <= 16:
                if len(self.tree) > _MEMO:
                    self.tree.clear()
                self.tree[raw] = ids
        return ids

    def piece(self, text: str) -> tuple[int, ...]:
        raw = text.encode("utf-8", "surrogatepass")
        one = self.ranks.get(raw)
        return self.reduce(raw) if one is None else (one,)

    def unit(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.piece, self.pieces.findall(text))))

    def encode(self, text: str) -> list[int]:
        """The ids of a text. It is first cut before every single space that a
        visible character follows, where the pattern always begins a piece; equal
        units are encoded once."""
        parts = _CUT.split(text) if _UNSAFE.search(text) else text.split(" ")
        if len(self.units) > _MEMO:
            self.units.clear()
        units = self.units
        for u in parts[1:]:
            if u not in units:
                units[u] = self.unit(" " + u)
        return [*self.unit(parts[0]), *chain.from_iterable(map(units.__getitem__, parts[1:]))]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 65_536:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def coder(path: str, pattern: str) -> Coder:
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(path, pattern)
    return _CODERS[path, pattern]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids (array<int>), decoded (binary) of every row."""
    def run(batches):
        c = coder(vocabulary, pattern)
        for b in batches:
            ids = [c.encode(t) for t in b["text"].to_pylist()]
            yield pa.record_batch([b["doc_id"], pa.array(ids, pa.list_(pa.int32())), pa.array([c.decode(x) for x in ids], pa.binary())], names=["doc_id", "ids", "decoded"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))


def digest(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    def run(batches):
        c = coder(vocabulary, pattern)
        for b in batches:
            n, line, plain = [], [], []
            for t in b["text"].to_pylist():
                ids = c.encode(t)
                n.append(len(ids))
                line.append(sha256(" ".join(map(c.text_of.__getitem__, ids)).encode()).hexdigest())
                plain.append(sha256(c.decode(ids)).hexdigest())
            yield pa.record_batch([b["doc_id"], pa.array(n, pa.int64()), pa.array(line, pa.string()), pa.array(plain, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

"""Token ids in files of independent zstandard frames with a trailing seek table.

File layout (little-endian): one frame after another, each the unsigned 32-bit ids
of one document or, beyond FRAME_IDS ids, of a part of one; a skippable frame with
the directory (doc_id or the null mark, id count per document); a skippable frame
with the seek table of the public seekable format: compressed size, decompressed
size and the low 32 bits of the XXH64 of every frame's content, then frame count,
descriptor and magic. A reader fetches the tail, picks the frames of the documents
it was asked for, decompresses those alone and checks their sums.

Documents are range-partitioned by doc_id (nulls first) and sorted, one file per
partition, so the files in order hold all ids in ascending doc_id order. The id 0
ends each document. A retried task writes another file; the manifest names the
files of the attempts that counted.

Null text counts as empty (the end id alone). Rows with one doc_id lie next to each
other, in the order of their texts. Empty table: no files, no rows. Very long
documents take several frames. Other columns are ignored."""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

from costlens.llm.common import cut, new_folder, text_of

END_ID = 0
FRAME_IDS = 1 << 20
SEEK_MAGIC, SKIP_MAGIC, DIRECTORY_MAGIC = 0x8F92EAB1, 0x184D2A5E, 0x184D2A50
NULL_ID = -(1 << 63)
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Units kept in a worker's memos, with their ids and with the number of ids alone; at this
#: many a memo starts anew.
_MEMO, _COUNT_MEMO = 1_500_000, 1_000_000
#: Characters whose units are held at once.
_AT_ONCE = 1 << 20
_CUT = re.compile(r" (?=\S)")
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """The tokenizer over a memo of units. A text is cut before every single space
    that a visible character follows; the pre-tokenizer always begins a piece there,
    so the ids of a text are the ids of its units in a row. Units not met before are
    encoded many in a row, too, and told apart by the ids that begin with a space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.opens = [n is not None and n.startswith("\u0120") for n in names]  # the byte-level name of a space
        self.memo: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, units: list[str], counts: bool) -> None:
        memo = self.counts if counts else self.memo
        plain = [u for u in units if " " not in u]
        rows = [plain[i : i + 64] for i in range(0, len(plain), 64)]
        for row, e in zip(rows, self.tokenizer.encode_batch_fast([" " + " ".join(r) for r in rows], add_special_tokens=False), strict=True):
            ids, opens = e.ids, self.opens
            at = [i for i, x in enumerate(ids) if opens[x]]
            raw = array("I", ids).tobytes()
            for u, i, j in zip(row, at, [*at[1:], len(ids)], strict=True):
                memo[u] = j - i if counts else raw[4 * i : 4 * j]
        odd = [u for u in units if " " in u]
        ids = self._ids([" " + u for u in odd])
        memo.update(zip(odd, (len(x) // 4 for x in ids) if counts else ids, strict=True))

    def _units(self, texts: list[str], counts: bool = False) -> list[tuple[bytes, list[str]]]:
        """The ids of each text's first unit, and the other units, which the memo has."""
        memo = self.counts if counts else self.memo
        if len(memo) > (_COUNT_MEMO if counts else _MEMO):
            memo.clear()
        rows = [None if any(s in t for s in self.specials) else t.split(" ") for t in texts]
        first = [r and r.pop(0) for r in rows]
        new = set(chain.from_iterable(r or () for r in rows)).difference(memo)
        # a space before a blank or at the end is no cut; the memo never has such a unit
        if unsafe := {u for u in new if not u or u[0].isspace()}:
            rows = [r if r is None or unsafe.isdisjoint(r) else _CUT.split(t)[1:] for t, r in zip(texts, rows, strict=True)]
            first = [r if r is None else t[: len(t) - sum(map(len, r)) - len(r)] for t, r in zip(texts, rows, strict=True)]
            new = set(chain.from_iterable(r or () for r in rows)).difference(memo)
        self._learn(list(new), counts)
        heads = list({f for f in first if f})
        head = dict(zip(heads, self._ids(heads), strict=True))
        whole = iter(self._ids([t for t, r in zip(texts, rows, strict=True) if r is None]))
        return [(next(whole), []) if r is None else (head.get(f, b""), r) for f, r in zip(first, rows, strict=True)]

    @staticmethod
    def _portions(texts: list[str]) -> Iterator[list[str]]:
        held: list[str] = []
        size = 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= _AT_ONCE:
                yield held
                held, size = [], 0
        yield held

    def encode_each(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        for portion in self._portions(texts):
            for first, rest in self._units(portion):
                yield first + b"".join(map(self.memo.__getitem__, rest))

    def count_each(self, texts: list[str]) -> Iterator[int]:
        """The number of ids of each text."""
        for portion in self._portions(texts):
            for first, rest in self._units(portion, counts=True):
                yield len(first) // 4 + sum(map(self.counts.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        return next(self.encode_each([text]))


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class FrameWriter:
    """Writes one file; ``add`` a document's ids at a time, then ``close``."""

    def __init__(self, sink, level: int = 1):
        self.sink, self.pack = sink, zstandard.ZstdCompressor(level=level)
        self.table: list[bytes] = []
        self.ids: list[int] = []
        self.counts: list[int] = []

    def _frame(self, content: bytes) -> None:
        packed = self.pack.compress(content)
        self.table.append(struct.pack("<III", len(packed), len(content), xxh64_intdigest(content) & 0xFFFFFFFF))
        self.sink.write(packed)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(NULL_ID if doc_id is None else doc_id)
        self.counts.append(len(ids) // 4)
        for at in range(0, max(1, len(ids)), 4 * FRAME_IDS):
            self._frame(ids[at : at + 4 * FRAME_IDS])

    def close(self) -> None:
        directory = np.array(self.ids, "<i8").tobytes() + np.array(self.counts, "<u8").tobytes()
        self.sink.write(struct.pack("<II", DIRECTORY_MAGIC, len(directory)) + directory)
        self.table.append(struct.pack("<III", len(directory) + 8, 0, 0))
        entries = b"".join(self.table)
        self.sink.write(struct.pack("<II", SKIP_MAGIC, len(entries) + 9) + entries + struct.pack("<IBI", len(self.table), 0x80, SEEK_MAGIC))


class FrameReader:
    """Reads one file; decompresses the frames of the documents asked for."""

    def __init__(self, source):
        self.source, size = source, source.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & 0x80:
            raise ValueError("no seek table with checksums")
        table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.sums = table[:, :2], table[:, 2]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))
        n = (int(self.sizes[-1, 0]) - 8) // 16
        directory = self._at(int(self.starts[-2]) + 8, 16 * n)
        self.doc_ids = np.frombuffer(directory[: 8 * n], "<i8")
        self.counts = np.frombuffer(directory[8 * n :], "<u8").astype(np.int64)
        parts = np.maximum(1, -(-self.counts // FRAME_IDS))
        self.first = np.concatenate(([0], np.cumsum(parts)))
        self.unpack = zstandard.ZstdDecompressor()

    def _at(self, start: int, size: int) -> bytes:
        self.source.seek(start)
        return self.source.read(size)

    def ids(self, k: int) -> bytes:
        """The ids of the ``k``-th document of the file."""
        out = []
        for f in range(self.first[k], self.first[k + 1]):
            content = self.unpack.decompress(self._at(int(self.starts[f]), int(self.sizes[f, 0])), max_output_size=int(self.sizes[f, 1]))
            if len(content) != self.sizes[f, 1] or xxh64_intdigest(content) & 0xFFFFFFFF != self.sums[f]:
                raise ValueError(f"frame {f} is damaged")
            out.append(content)
        return b"".join(out)

    def find(self, doc_id: int) -> list[bytes]:
        """The ids of every document with this doc_id."""
        a, b = np.searchsorted(self.doc_ids, [doc_id, doc_id + 1])
        return [self.ids(k) for k in range(a, b)]


def _write(folder: str, vocabulary: str):
    def run(batches):
        task, sink, out = TaskContext.get(), None, None
        for b in batches:
            for doc_id, ids in zip(b["doc_id"].to_pylist(), encoder(vocabulary).encode_each(b["text"].to_pylist()), strict=True):
                if sink is None:
                    store, root = fs.FileSystem.from_uri(folder)
                    store.create_dir(root, recursive=True)
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.ids.zst"
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    out = FrameWriter(sink)
                out.add(doc_id, ids + struct.pack("<I", END_ID))
        if sink is not None:
            out.close()
            sink.close()
            yield pa.record_batch([pa.array([task.partitionId()], pa.int32()), pa.array([f"{folder}/{name}"]), pa.array([len(out.ids)], pa.int64()), pa.array([sum(out.counts)], pa.int64())], names=["part", "path", "n_docs", "n_tokens"])
    return run


def write(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the ids of ``docs`` under ``folder``, a URI that all executors reach;
    returns the manifest: part, path, n_docs, n_tokens, start of each file."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = cut(rows.mapInArrow(_write(folder, vocabulary), "part int, path string, n_docs long, n_tokens long"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return made.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def _read(batches):
    for b in batches:
        for path, start in zip(b["path"].to_pylist(), b["start"].to_pylist(), strict=True):
            store, name = fs.FileSystem.from_uri(path)
            with store.open_input_file(name) as f:
                reader = FrameReader(f)
                sums = pa.array([crc32(reader.ids(k)) for k in range(len(reader.counts))], pa.int64())
            ids = [None if x == NULL_ID else x for x in reader.doc_ids.tolist()]
            counts = reader.counts.tolist()
            starts = [start + x for x in accumulate([0, *counts[:-1]])] if counts else []
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), sums], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document of the files."""
    files = cut(manifest, "token-manifest")
    return files.repartition(max(1, files.count())).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Write all of ``docs`` to a new folder and read it back."""
    folder = new_folder(docs.sparkSession, "token-ids")
    if "://" not in folder:
        folder = f"file://{folder}" if folder.startswith("/") else folder.replace(":", "://", 1)
    return read(write(docs, folder, vocabulary))

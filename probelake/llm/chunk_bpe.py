"""BPE encoding by content-defined chunks that documents share, with repaired joins.

A rolling hash cuts texts where their content says so; equal passages are therefore cut alike wherever they stand. A
worker encodes a chunk once and reuses its ids for all documents that hold it, as long as it is remembered. A chunk's
ids cover the words that lie wholly in it. What crosses a join is encoded anew, checked against the tokenizer on a
window around the join; a window that disagrees sends the whole text through the tokenizer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_memo
from .tokens import WordEncoder, split_words

#: The rolling hash looks at 16 bytes; one in 1024 positions is a cut; chunks have at least 256 bytes.
WINDOW_DOUBLINGS = 4
CUT_MASK = np.uint64(0x3FF << 20)
LEAST_CHUNK = 256
#: Bytes of ids that a worker remembers, at most twice.
REMEMBERED_BYTES = 32 << 20
SEED = 977

_BLANK = re.compile(rb"[ \t\n\x0b\x0c\r]")


def _gear() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 2**63, 256, dtype=np.uint64)


def cut_points(data: bytes, gear: np.ndarray) -> list[int]:
    """Ends of the chunks of a UTF-8 text, the last one included; never inside a character."""
    raw = np.frombuffer(data, np.uint8)
    rolled = gear[raw]
    for i in range(WINDOW_DOUBLINGS):
        step = 1 << i
        if len(rolled) > step:
            rolled[step:] += rolled[:-step] << np.uint64(step)
    ends, last = [], 0
    for at in (np.flatnonzero((rolled & CUT_MASK) == 0) + 1).tolist():
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        if at - last >= LEAST_CHUNK and at < len(data):
            ends.append(at)
            last = at
    return [*ends, len(data)]


class ChunkEncoder:
    """``encode`` gives a text's ids as little-endian unsigned 32-bit bytes; counts what it reused."""

    def __init__(self, path: str) -> None:
        self.words = WordEncoder.here(path)
        self.gear = _gear()
        self.young: dict[bytes, tuple] = {}
        self.old: dict[bytes, tuple] = {}
        self.held = 0
        self.windows: dict[str, bool] = {}
        self.chunks = self.reused = self.repaired = 0

    @classmethod
    def here(cls, path: str) -> ChunkEncoder:
        return worker_memo(("chunk-encoder", path), lambda: cls(path))

    def _chunk(self, data: bytes) -> tuple:
        """Head before the first blank, ids of the words within, tail after the last blank, first and last word."""
        key = xxhash.xxh3_128_digest(data)
        self.chunks += 1
        entry = self.young.get(key)
        if entry is not None:
            self.reused += 1
            return entry
        entry = self.old.get(key)
        if entry is not None:
            self.reused += 1
        else:
            first = _BLANK.search(data)
            if first is None:
                return data, None, b"", "", ""
            end = max(data.rfind(blank) for blank in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
            inner = split_words(data[first.start() : end].decode("utf-8"))
            entry = (
                data[: first.start()], self.words.words(inner), data[end + 1 :], inner[0] if inner else "", inner[-1] if inner else "",
            )
        if self.held >= REMEMBERED_BYTES:
            self.young, self.old, self.held = {}, self.young, 0
        self.young[key] = entry
        self.held += len(entry[1]) + len(entry[0]) + len(entry[2]) + 300
        return entry

    def _agrees(self, left: str, middle: str, right: str) -> bool:
        """Whether the tokenizer, given the words around a join as one text, makes the ids that the parts give."""
        window = f"{left} {middle} {right}"
        known = self.windows.get(window)
        if known is None:
            parts = b"".join(self.words.encode(part) for part in (left, middle, right))
            known = self.words.library(window) == parts
            if len(self.windows) >= 50_000:
                self.windows.clear()
            self.windows[window] = known
        return known

    def encode(self, text: str) -> bytes:
        if not self.words.known:
            return self.words.library(text)
        data = text.encode("utf-8")
        out: list[bytes] = []
        start, crossing, before = 0, b"", ""
        for end in cut_points(data, self.gear) if data else []:
            head, ids, tail, first, last = self._chunk(data[start:end])
            start = end
            if ids is None:
                crossing += head
                continue
            middle = (crossing + head).decode("utf-8")
            if out and not self._agrees(before, middle, first):
                self.repaired += 1
                return self.words.library(text)
            out += [self.words.encode(middle), ids]
            crossing, before = tail, last or middle
        out.append(self.words.encode(crossing.decode("utf-8")))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return self.words.decode(ids)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` per row, and with ``with_ids`` the ``ids`` and ``decoded``.

    A null text is empty and has no ids. No shuffle; a task holds an Arrow batch and what its worker remembers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.here(path)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                columns: list[list] = [[], [], [], [], []]
                for text in part.column(1).to_pylist():
                    packed = encoder.encode(text or "")
                    ids = np.frombuffer(packed, "<u4").tolist()
                    decoded = encoder.decode(packed)
                    columns[0].append(len(ids))
                    columns[1].append(hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
                    columns[2].append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                    if with_ids:
                        columns[3].append(ids)
                        columns[4].append(decoded)
                arrays = [part.column(0), pa.array(columns[0], pa.int64()), *(pa.array(c, pa.string()) for c in columns[1:3])]
                if with_ids:
                    arrays += [pa.array(columns[3], pa.list_(pa.int32())), pa.array(columns[4], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
    schema = "_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else "")
    read = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text"))
    return read.mapInArrow(run, schema).withColumnRenamed("_id", id_col)

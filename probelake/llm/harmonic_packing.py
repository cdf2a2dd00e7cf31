"""Harmonic packing: documents by reciprocal-capacity classes, a fixed count of one class to a sequence.

A document of more than ``capacity / (k + 1)`` and at most ``capacity / k`` tokens is of class ``k``, and ``k`` of a class
share a sequence, whole. Each worker packs what it has read on its own, lot by lot: no document waits for another
worker's. Documents that must be cut anyway, being longer than a sequence, are cut so that they fill the gaps that the
classes leave; what remains of them fills sequences of its own, the last of a lot in powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_tokens import ByteEncoder

#: Documents of this class and all higher ones share sequences in any number that fits.
SMALL_CLASS = 16
#: Tokens that a worker holds and packs together.
LOT = 1 << 22
#: What ends each document.
END_ID = 0
#: Sequence numbers of a partition.
NUMBERS = 1 << 40


def harmonic_bins(lengths: list[int], documents: list[int], capacity: int, small: int = SMALL_CLASS) -> list[list[int]]:
    """Bins of ``documents`` (of at most ``capacity`` tokens): ``k`` of class ``k``, or next-fit from class ``small`` on.

    A class's last bin holds what is left of it.
    """
    classes: dict[int, list[int]] = {}
    for doc in documents:
        classes.setdefault(min(capacity // lengths[doc], small), []).append(doc)
    bins = []
    for k in sorted(classes):
        own = classes[k]
        if k < small:
            bins += [own[at : at + k] for at in range(0, len(own), k)]
            continue
        now, used = [], 0
        for doc in own:
            if used + lengths[doc] > capacity:
                bins.append(now)
                now, used = [], 0
            now.append(doc)
            used += lengths[doc]
        bins.append(now)
    return bins


def plan_lot(lengths: list[int], capacity: int, small: int = SMALL_CLASS) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces ``(document, start, length, sequence, offset)`` for documents of at least one token, and the sequences used.

    Every sequence is full or has a power of two of tokens. Documents over ``capacity`` are cut into the gaps. If they
    cannot fill them all, those documents that fill their share of a sequence worst are cut as well, no more of them than
    it takes.
    """
    whole = [doc for doc, n in enumerate(lengths) if n <= capacity]
    cut = [doc for doc, n in enumerate(lengths) if n > capacity]
    slack = lambda doc: capacity / (capacity // lengths[doc]) - lengths[doc]
    worst = sorted(whole, key=slack, reverse=True)
    given = 0
    while True:
        bins = harmonic_bins(lengths, sorted(worst[given:]), capacity, small)
        gaps = sum(capacity - sum(lengths[doc] for doc in own) for own in bins)
        missing = gaps - sum(lengths[doc] for doc in cut)
        if missing <= 0:
            break
        while missing > 0 and given < len(worst):
            doc = worst[given]
            cut.append(doc)
            missing -= capacity // (capacity // lengths[doc])
            given += 1
    pieces = []
    at, start = 0, 0

    def fill(room: int, sequence: int, offset: int) -> None:
        nonlocal at, start
        while room:
            n = min(room, lengths[cut[at]] - start)
            pieces.append((cut[at], start, n, sequence, offset))
            room, offset, start = room - n, offset + n, start + n
            if start == lengths[cut[at]]:
                at, start = at + 1, 0

    for sequence, own in enumerate(bins):
        offset = 0
        for doc in own:
            pieces.append((doc, 0, lengths[doc], sequence, offset))
            offset += lengths[doc]
        fill(capacity - offset, sequence, offset)
    used = len(bins)
    left = sum(lengths[doc] for doc in cut[at:]) - start
    while left:
        n = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        fill(n, used, 0)
        left, used = left - n, used + 1
    return pieces, used


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 1024, id_col: str = "doc_id", text: str = "text", end_id: int = END_ID,
    with_ids: bool = True, lot: int = LOT, small: int = SMALL_CLASS,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece, and its ``ids`` with ``with_ids``.

    A document's ids are those of the tokenizer file and ``end_id``; a null or empty text is ``end_id`` alone. Every row
    is a document, also one that repeats another's id or has none. Other columns are not looked at.

    One pass over the partitions of ``docs``, without a shuffle: a task holds the ids of at most ``lot`` tokens and of one
    further Arrow batch. Sequence numbers are made of the partition's number and a count, so a repeated task gives the
    same rows as long as its partition has the same rows in the same order, as partitions of files do.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder.here(path)
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() * NUMBERS
        held: list[tuple] = []
        size = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            pieces, used = plan_lot([len(ids) // 4 for _, ids in held], capacity, small)
            for first in range(0, len(pieces), 1 << 16):
                rows: list[tuple] = []
                for doc, start, n, sequence, offset in pieces[first : first + (1 << 16)]:
                    doc_id, ids = held[doc]
                    own = ids[4 * start : 4 * (start + n)]
                    row = (doc_id, start, n, zlib.crc32(own), len(ids) // 4, number + sequence, offset)
                    rows.append((*row, np.frombuffer(own, "<u4")) if with_ids else row)
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            number += used

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                for doc_id, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encoder.encode(value or "") + end
                    held.append((doc_id, ids))
                    size += len(ids) // 4
                    if size >= lot:
                        yield from packed()
                        held.clear()
                        size = 0
        if held:
            yield from packed()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    kinds = [pa.int64()] * 7 + ([pa.list_(pa.int64())] if with_ids else [])
    schema = ", ".join(f"{name} long" for name in names[:7]) + (", ids array<long>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text)).mapInArrow(run, schema)

"""Best-fit packing of token sequences by patterns fitted with non-negative least squares.

The histogram of piece lengths is all that the planner sees, so a plan costs the same for any number of documents.
Patterns of few lengths that fill a sequence are enumerated on a coarse grid; non-negative least squares finds how often
each should be used to match the histogram; the counts are rounded down; all pieces left are placed best-fit, longest
first, into the gaps and into new sequences. Runs of equal pieces are placed together, as ranges.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged
from .common import text_batches
from .tokens import WordEncoder

#: Grid cells of a sequence, and pieces in a pattern at most.
GRID = 64
FEW = 3
#: Groups that the pieces of one length are numbered in.
CELLS = 1024
#: What ends each document.
END_ID = 1


def non_negative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """``x >= 0`` with least ``|a x - b|``, by the active-set method of Lawson and Hanson."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    scale = 1e-9 * max(float(np.abs(a.T @ b).max(initial=0.0)), 1.0)
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= scale:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            solved = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[at] = solved
                break
            low = solved <= 0
            ratio = x[at][low] / np.maximum(x[at][low] - solved[low], 1e-300)
            step = float(ratio.min())
            x[at] += step * (solved - x[at])
            drop = at[low][ratio <= step + 1e-12]
            x[drop] = 0
            active[drop] = False
            if not active.any():
                break
    return x


def patterns(grid: int = GRID, few: int = FEW) -> list[tuple[int, ...]]:
    """Descending cell counts of at most ``few`` parts that sum to ``grid``."""

    def fill(left: int, most: int, parts: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif parts:
            for part in range(min(left, most), math.ceil(left / parts) - 1, -1):
                for rest in fill(left - part, part, parts - 1):
                    yield (part, *rest)

    return list(fill(grid, grid, few))


class _Plan:
    """Ranges of equal pieces and where they go. ``rows``: length, first rank, count, first sequence, offset."""

    def __init__(self, histogram: dict[int, int], capacity: int) -> None:
        self.left = dict(histogram)
        self.used: dict[int, int] = dict.fromkeys(histogram, 0)
        self.capacity = capacity
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.sizes: list[int] = []

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self.used[length], count, sequence, offset))
        self.used[length] += count
        self.left[length] -= count

    def open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def gap(self, free: int, sequence: int, count: int) -> None:
        if free and count:
            if free not in self.gaps:
                self.gaps[free] = []
                insort(self.sizes, free)
            self.gaps[free].append((sequence, count))

    def fill(self, length: int, sequence: int, count: int, free: int) -> None:
        """As many pieces of ``length`` as fit into each of ``count`` sequences; then the same for one with the rest."""
        each = free // length
        whole = min(count, self.left[length] // each)
        if whole:
            for i in range(each):
                self.put(length, whole, sequence, self.capacity - free + i * length)
            self.gap(free - each * length, sequence, whole)
        rest = min(self.left[length], each) if whole < count else 0
        for i in range(rest):
            self.put(length, 1, sequence + whole, self.capacity - free + i * length)
        if rest:
            self.gap(free - rest * length, sequence + whole, 1)
        untouched = whole + bool(rest)
        self.gap(free, sequence + untouched, count - untouched)

    def best_fit(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.sizes, length)
            if at == len(self.sizes):
                break
            free = self.sizes[at]
            sequence, count = self.gaps[free].pop()
            if not self.gaps[free]:
                del self.gaps[free]
                self.sizes.pop(at)
            self.fill(length, sequence, count, free)
        if self.left[length]:
            count = -(-self.left[length] // (self.capacity // length))
            self.fill(length, self.open(count), count, self.capacity)


def plan_packing(histogram: dict[int, int], capacity: int, grid: int = GRID, few: int = FEW) -> tuple[list[tuple], int]:
    """Rows ``(length, first rank, count, first sequence, offset)`` for a histogram of lengths, and the sequences used."""
    plan = _Plan({length: count for length, count in histogram.items() if count}, capacity)
    lengths = sorted(plan.left, reverse=True)
    cell = -(-capacity // grid)
    by_cell: dict[int, list[int]] = {}
    for length in lengths:
        by_cell.setdefault(-(-length // cell), []).append(length)
    have = {c: sum(plan.left[x] for x in own) for c, own in by_cell.items()}
    usable = [p for p in patterns(grid, few) if all(have.get(part, 0) for part in p)]
    if usable:
        cells = sorted(by_cell, reverse=True)
        row_of = {c: i for i, c in enumerate(cells)}
        matrix = np.zeros((len(cells), len(usable)))
        for j, pattern in enumerate(usable):
            for part in pattern:
                matrix[row_of[part], j] += 1
        weight = np.array(cells, float) / grid
        wanted = np.array([have[c] for c in cells], float)
        repeats = np.floor(non_negative_least_squares(matrix * weight[:, None], wanted * weight) + 1e-6).astype(int)
        for j in np.argsort(-repeats, kind="stable"):
            *firsts, last = usable[j]
            have = {c: sum(plan.left[x] for x in by_cell[c]) for c in set(firsts)}
            count = min([int(repeats[j]), *(have[c] // firsts.count(c) for c in have)])
            if count <= 0:
                continue
            groups = [(plan.open(count), count, capacity)]
            for part in firsts:
                groups = [g for group in groups for g in _lay(plan, by_cell[part], *group)]
            for group in groups:
                for sequence, n, free in _lay(plan, lengths, *group):
                    plan.gap(free, sequence, n)
    for length in lengths:
        plan.best_fit(length)
    return plan.rows, plan.sequences


def _lay(plan: _Plan, lengths: list[int], sequence: int, count: int, free: int) -> list[tuple[int, int, int]]:
    """One piece into each of ``count`` sequences, the longest of ``lengths`` (descending) that are left and fit.

    The part that ends a pattern may be of any length: so it takes up what the grid's rounding left free.
    """
    out = []
    for length in lengths[bisect_left(lengths, -free, key=lambda x: -x) :]:
        n = min(count, plan.left[length])
        if n:
            plan.put(length, n, sequence, plan.capacity - free)
            out.append((sequence, n, free - length))
            sequence, count = sequence + n, count - n
        if not count:
            break
    return out + ([(sequence, count, free)] if count else [])


def token_pieces(
    docs: DataFrame, path: str, capacity: int = 4096, id_col: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` per piece, and its ``ids`` with ``with_ids``.

    A document's ids are those of the tokenizer and ``END_ID``; a null text is empty. Documents over ``capacity`` ids are
    cut into pieces of that length, the last of them shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.here(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    packed = encoder.encode(text or "") + end
                    for piece, start in enumerate(range(0, len(packed) // 4, capacity)):
                        ids = packed[4 * start : 4 * (start + capacity)]
                        row = (doc_id, piece, start, len(ids) // 4, zlib.crc32(ids))
                        rows.append((*row, np.frombuffer(ids, "<u4").tolist()) if with_ids else row)
                columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                if rows:
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int32())] if with_ids else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return text_batches(docs.select(F.col(id_col).cast("long"), F.col(text))).mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (``doc_id, piece, length``, 1 to ``capacity``) with ``sequence_id`` and ``offset``, gapless in each sequence.

    The driver gets the histogram (at most ``capacity`` rows) and makes the plan. Pieces of one length are numbered by a
    two-step count, within ``CELLS`` groups by a hash of id and piece and then over the groups, so a length that a third
    of all pieces have is dealt like the others. Equal rows are interchangeable: either may get a place.
    """
    pieces = staged(pieces, "packing-pieces")
    histogram = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    rows, _ = plan_packing(histogram, capacity)
    cell = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(CELLS))
    at = pieces.withColumn("_cell", cell)
    over = Window.partitionBy("length").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    firsts = staged(
        at.groupBy("length", "_cell").count().select("length", "_cell", F.coalesce(F.sum("count").over(over), F.lit(0)).alias("_first")),
        "packing-firsts",
    )
    within = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece")
    ranked = (
        at.withColumn("_n", F.row_number().over(within)).join(firsts, ["length", "_cell"])
        .withColumn("_rank", F.col("_first") + F.col("_n") - 1).drop("_cell", "_n", "_first")
    )
    plan: dict[int, np.ndarray] = {}
    for row in sorted(rows):
        plan.setdefault(row[0], []).append(row[1:])
    plan = {length: np.array(ranges, np.int64) for length, ranges in plan.items()}
    names = [c for c in ranked.columns if c != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(batch.schema.get_field_index("length")).to_numpy()
            ranks = batch.column(batch.schema.get_field_index("_rank")).to_numpy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths).tolist():
                own, ranges = lengths == length, plan[length]
                found = np.searchsorted(ranges[:, 0], ranks[own], side="right") - 1
                sequence[own] = ranges[found, 2] + ranks[own] - ranges[found, 0]
                offset[own] = ranges[found, 3]
            kept = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{c}` {kind}" for c, kind in ranked.dtypes if c != "_rank")
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, with_ids: bool = True, **columns: str) -> DataFrame:
    """Every document's pieces with their places: see ``token_pieces`` and ``pack``."""
    return pack(token_pieces(docs, path, capacity, with_ids=with_ids, **columns), capacity)

"""Vector code compression: product codes whose codebooks are fitted by Lloyd rounds over active entries only.

A vector of integers is cut into equal parts; each part is replaced by the index of its codebook's nearest entry. After a
round only some entries have moved. A part whose own entry stayed fixed still has its stored exact distance, and every
entry that stayed was no better before: it is compared with the moved entries alone. Other parts rescan their codebook.

Vectors travel as blocks of packed integers with their codes and distances. A round reads the blocks, writes them with new
codes to the shared folder and adds up what its tasks found; nothing but these sums, a few thousand numbers, reaches the
driver, and nothing is shuffled by vector.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_dir
from .common import same

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors in a block at most.
BLOCK = 4096
#: Tasks that add up what all tasks of a round found.
ADDERS = 16
LONGEST = 2**63 - 1


def packed(values: np.ndarray) -> bytes:
    """Integers in as few bytes each as hold them all (named by the first byte), or as text if 8 do not."""
    flat = values.ravel()
    most = max((abs(int(flat.min())), abs(int(flat.max())))) if len(flat) else 0
    for size in (2, 4, 8):
        if most < 1 << (8 * size - 1):
            return bytes([size]) + flat.astype(f"<i{size}").tobytes()
    return b"\0" + ",".join(map(str, flat.tolist())).encode()


def unpacked(data: bytes) -> np.ndarray:
    """As 64-bit integers, or Python's where those are too short."""
    if data[0]:
        return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)
    return np.array([int(x) for x in data[1:].split(b",")], object)


def scaled_floors(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of doubles, exact at every size. ``scale`` is a power of two."""
    with np.errstate(over="ignore"):
        floors = np.floor(values * scale)
    if len(floors) and not np.abs(floors).max() < 2.0**62:
        return np.array([math.floor(Fraction(x) * scale) for x in values.tolist()], object)
    return floors.astype(np.int64)


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


def distances(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of each part from each entry, exact: as doubles, 64-bit or Python's integers, by their size."""
    most = 4 * parts.shape[1] * max(_largest(parts), _largest(book)) ** 2
    if most < 1 << 53:
        x, c = parts.astype(np.float64), book.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    if most >= 1 << 63:
        parts, book = parts.astype(object), book.astype(object)
    else:
        parts, book = parts.astype(np.int64), book.astype(np.int64)
    apart = parts[:, None, :] - book[None, :, :]
    return (apart * apart).sum(2)


def reassign(
    parts: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, apart: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entries, their distances, and how many distances were computed.

    ``code`` and ``apart`` are those of the round before, exact for entries that have not ``moved``. Ties go to the lower
    index: of two equal entries that stayed the lower one was taken before, a moved one wins at equal distance if it is
    lower.
    """
    code, apart = code.copy(), apart.astype(object) if book.dtype == object else apart.copy()
    active = np.flatnonzero(moved)
    lost = moved[code]
    again, fixed = np.flatnonzero(lost), np.flatnonzero(~lost)
    if len(again):
        found = distances(parts[again], book)
        code[again] = found.argmin(1)
        if found.dtype == object:
            apart = apart.astype(object)
        apart[again] = found[np.arange(len(again)), code[again]]
    if len(fixed) and len(active):
        found = distances(parts[fixed], book[active])
        at = found.argmin(1)
        least = found[np.arange(len(fixed)), at]
        nearer = (least < apart[fixed]) | ((least == apart[fixed]) & (active[at] < code[fixed]))
        if found.dtype == object:
            apart = apart.astype(object)
        code[fixed[nearer]], apart[fixed[nearer]] = active[at[nearer]], least[nearer]
    return code, apart, len(again) * len(book) + len(fixed) * len(active)


class Codebooks:
    """``books[part]``: entries by components. ``moved[part]``: which entries differ from those of the round before."""

    def __init__(self, books: list[np.ndarray]) -> None:
        self.books = books
        self.moved = [np.ones(len(book), bool) for book in books]

    def step(self, sums: np.ndarray, counts: np.ndarray) -> None:
        """Entries become the componentwise floors of their parts' means; unused ones stay."""
        for part, book in enumerate(self.books):
            new = [
                [s // int(counts[part, e]) for s in sums[part, e].tolist()] if counts[part, e] else book[e].tolist()
                for e in range(len(book))
            ]
            fresh = unpacked(packed(np.array(new, object))).reshape(book.shape)
            self.moved[part] = (fresh != book).any(1)
            self.books[part] = fresh

    def digest(self) -> str:
        numbers = ",".join(str(x) for book in self.books for x in book.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def _fields(ids: T.DataType, label: T.DataType) -> T.StructType:
    """Of a block: what names its vectors, their components, codes, distances, and what they add to each entry."""
    return T.StructType(
        [
            T.StructField("ids", T.ArrayType(ids)), T.StructField("labels", T.ArrayType(label)),
            *(T.StructField(name, T.BinaryType()) for name in ("vectors", "codes", "apart", "sums")),
        ]
    )


def blocks(rows: DataFrame, scale: int, width: int) -> DataFrame:
    """Rows ``_id, _label, _vector`` of ``width`` components as blocks without codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                values = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                one = [0, len(part)]
                lists = [pa.ListArray.from_arrays(pa.array(one, pa.int32()), part.column(i)) for i in range(2)]
                vectors = pa.array([packed(scaled_floors(values, scale))], pa.binary())
                nothing = pa.array([None], pa.binary())
                yield pa.RecordBatch.from_arrays([*lists, vectors, nothing, nothing, nothing], names=schema.names)

    schema = _fields(rows.schema["_id"].dataType, rows.schema["_label"].dataType)
    return rows.mapInArrow(run, schema)


def assigned(rows: DataFrame, fitted: Codebooks, width: int) -> DataFrame:
    """Blocks with the codes, distances and sums of these codebooks."""
    books, moved = fitted.books, fitted.moved
    parts, size = len(books), width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                ids, labels = row.column(0), row.column(1)
                vectors, codes, apart = (row.column(k)[0].as_py() for k in (2, 3, 4))
                x = unpacked(vectors).reshape(-1, parts, size)
                n = len(x)
                if codes is None:
                    now, far = np.zeros((parts, n), np.int64), np.zeros((parts, n), np.int64)
                else:
                    now, far = (unpacked(data).reshape(parts, n) for data in (codes, apart))
                far = list(far)
                sums = np.zeros((parts, len(books[0]), size + 1), object)
                for p in range(parts):
                    all_new = codes is None
                    was = np.ones_like(moved[p]) if all_new else moved[p]
                    now[p], far[p], _ = reassign(x[:, p], books[p], was, now[p], far[p])
                    for e in range(len(books[p])):
                        own = x[now[p] == e, p]
                        sums[p, e, :size] = own.sum(0) if own.dtype == object else _exact_sum(own)
                        sums[p, e, size] = len(own)
                out = [pa.array([packed(v)], pa.binary()) for v in (now, np.array([d.tolist() for d in far], object), sums)]
                yield pa.RecordBatch.from_arrays([ids, labels, row.column(2), *out], names=names)

    names = rows.schema.names
    return rows.mapInArrow(run, rows.schema)


def _exact_sum(own: np.ndarray) -> list[int]:
    """Column sums of 64-bit integers, over halves of 32 bits so that nothing overflows."""
    low, high = own & 0xFFFFFFFF, own >> 32
    return [int(a) + (int(b) << 32) for a, b in zip(low.sum(0), high.sum(0), strict=True)]


def _total(rows: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """All blocks' sums, added within tasks, then within ``ADDERS`` tasks, then on the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column(0).to_pylist():
                values = unpacked(data).astype(object)
                total = values if total is None else total + values
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([packed(total)], pa.binary())], names=["sums"])

    halfway = rows.select("sums").mapInArrow(add, "sums binary")
    found = halfway.repartition(ADDERS).mapInArrow(add, "sums binary").collect()
    return sum((unpacked(row["sums"]).astype(object) for row in found), np.zeros(math.prod(shape), object)).reshape(shape)


def _write(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _remove(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def usable(rows: DataFrame, parts: int, id_col: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """``_id, _label, _vector`` (doubles) of the rows that take part, and their vectors' length (0 without rows)."""
    known = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = rows.select(
        F.col(id_col).cast("long").alias("_id"), F.col(label).alias("_label"), F.col(vector).cast("array<double>").alias("_vector")
    ).where(
        F.col("_vector").isNotNull() & (F.size("_vector") > 0) & (F.size("_vector") % parts == 0) & F.forall("_vector", known)
    )
    first = kept.select("_id", F.size("_vector").alias("n")).orderBy(F.asc_nulls_last("_id"), "n").limit(1).collect()
    width = first[0]["n"] if first else 0
    return kept.where(F.size("_vector") == width), width


def fit(
    rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[Codebooks, DataFrame]:
    """Codebooks of ``usable`` rows, and the blocks with the codes that the last ones give."""
    first = rows.orderBy(F.asc_nulls_last("_id"), "_vector").limit(entries).collect()
    start = [scaled_floors(np.array(row["_vector"], np.float64), scale).astype(object) for row in first]
    grid = unpacked(packed(np.array(start, object))).reshape(len(first), parts, width // parts)
    fitted = Codebooks([grid[:, p].copy() for p in range(parts)])
    path = work_dir(rows.sparkSession, "vector-blocks")
    now = _write(blocks(rows, scale, width), path)
    for done in range(rounds + 1):
        next_path = work_dir(rows.sparkSession, "vector-blocks")
        now = _write(assigned(now, fitted, width), next_path)
        _remove(now, path)
        path = next_path
        if done < rounds:
            total = _total(now, (parts, len(first), width // parts + 1))
            fitted.step(total[:, :, :-1], total[:, :, -1])
    return fitted, now


def _listed(rows: DataFrame, parts: int, label: T.DataType) -> DataFrame:
    """``vec_id, _label, code, _error`` of each vector of the blocks; ``_error`` as decimal text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                codes = unpacked(row.column(2)[0].as_py()).reshape(parts, -1)
                errors = unpacked(row.column(3)[0].as_py()).reshape(parts, -1).astype(object).sum(0)
                text = ["".join(f"{c:02x}" for c in own) for own in codes.T.tolist()]
                listed = [pa.array(text, pa.string()), pa.array(list(map(str, errors)), pa.string())]
                yield pa.RecordBatch.from_arrays([row.column(0).flatten(), row.column(1).flatten(), *listed], names=names)

    names = ["vec_id", "_label", "code", "_error"]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("_label", label), *(T.StructField(n, T.StringType()) for n in names[2:])])
    return rows.select("ids", "labels", "codes", "apart").mapInArrow(run, schema)


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, code, error, label, label_error`` of each row that takes part, and the codebooks (none without such rows).

    Components become ``floor(scale * x)`` (``scale`` a power of two); a codebook starts as that part of the ``entries``
    smallest ids, as many as there are. ``code`` has two hex digits a part, so ``entries`` is at most 256.

    Rows whose vector is null, empty, holds null or non-finite components, has a length that ``parts`` does not divide or
    another length than the vector of the smallest id take no part. Rows that repeat an id all take part, the smaller
    vector first; so do rows with a null id, behind all others. Labels of any type that can be grouped; nulls are one
    label. Sums are exact at every size; an error or sum beyond a long becomes null. Other columns are not looked at.
    """
    if entries > 256 or scale & (scale - 1):
        raise ValueError("at most 256 entries, and a scale that is a power of two")
    taking_part, width = usable(rows, parts, id_col, vector, label)
    kind = taking_part.schema["_label"].dataType
    fitted = None
    if width:
        fitted, final = fit(taking_part, width, parts, entries, rounds, scale)
        coded = _listed(final, parts, kind)
    else:
        empty = taking_part.where("false")
        coded = empty.select(F.col("_id").alias("vec_id"), "_label", F.lit("").alias("code"), F.lit("").alias("_error"))
    coded = _write(coded, work_dir(rows.sparkSession, "vector-codes"))
    number = F.col("_error").try_cast("decimal(38,0)")
    sums = coded.groupBy("_label").agg(F.try_sum(number).alias("_sum"), F.count_if(number.isNull()).alias("_beyond"))
    known = F.when(F.col("_beyond") == 0, F.col("_sum").try_cast("long"))
    totals = _write(sums.select("_label", known.alias("label_error")), work_dir(rows.sparkSession, "vector-labels"))
    joined = coded.join(totals, same(coded, totals, "_label"))
    return (
        joined.select(
            "vec_id", "code", F.col("_error").try_cast("long").alias("error"), coded["_label"].alias("label"), "label_error"
        ),
        fitted,
    )

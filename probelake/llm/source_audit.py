"""How far each source of a language departs from the others, over a K-squared quadtree of the group-term counts.

Groups are the (language, source) pairs, terms the words that enough of a language's documents hold. The count matrix of a
language is sparse: it is cut into tiles of groups by blocks of terms, and each tile that holds a count becomes a
quadtree whose empty quadrants are not stored. Whatever lies in them costs nothing: a group's chance for a term that it
lacks is one number, so a pair's divergence there is the histogram of the other group's counts priced against that number.
Only where both groups' quadrants hold counts are the trees traversed, jointly for all pairs, down to the common leaves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged

#: Chances are whole numbers of this unit.
UNIT = 1_000_000_000
#: Groups of a tile and terms of a block, about: names are dealt by hash.
TILE, BLOCK = 128, 1024
#: Different (group, term) pairs that a worker counts before it passes them on.
HELD = 600_000
#: Values of the histogram that are priced at once.
SLICE = 1 << 12
#: Everything but letters A-Z, a-z and bytes of longer characters separates terms.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256))
#: Sides of a quadrant are halved.
K = 2


def tally(counts: Counter, rows: Counter, terms: list[bytes]) -> None:
    """Add one text's terms: each occurrence to ``counts``, each term once to ``rows``. Lists and sets are counted in C."""
    counts.update(terms)
    rows.update(set(terms))


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """``lang, source, term, count, docs``: occurrences, and rows with the term, summed within tasks only.

    Nulls are empty. Every row also counts one for the term null, so that groups without terms are there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], Counter] = {}
        rows: dict[tuple[str, str], Counter] = {}
        held = 0

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), own in counts.items():
                items = list(own.items())
                for at in range(0, len(items), 1 << 16):
                    part = items[at : at + (1 << 16)]
                    n, seen = len(part), rows[lang, source]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(source, pa.string()), n),
                            pa.array([term for term, _ in part], pa.string()),
                            pa.array([count for _, count in part], pa.int64()),
                            pa.array([seen[term] for term, _ in part], pa.int64()),
                        ],
                        names=["lang", "source", "term", "count", "docs"],
                    )

        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                for lang, source, data in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                    own = counts.setdefault((lang, source), Counter())
                    seen = rows.setdefault((lang, source), Counter())
                    held -= len(own)
                    tally(own, seen, data.translate(_TERM_BYTES).split())
                    own[None] += 1
                    held += len(own)
                    if held >= HELD:
                        yield from told()
                        counts.clear()
                        rows.clear()
                        held = 0
        yield from told()

    empty = F.lit("")
    read = docs.select(
        F.coalesce(F.col(lang), empty).alias("lang"), F.coalesce(F.col(source), empty).alias("source"),
        F.coalesce(F.col(text), empty).cast("binary").alias("text"),
    )
    return read.mapInArrow(run, "lang string, source string, term string, count long, docs long")


def _chance(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (count + 2) / (total + 2 * terms))``, exact for any counts that a long holds."""
    wide = lambda c: c.cast("decimal(20,0)")
    share = F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (wide(count) + 2), wide(total) + 2 * wide(terms))
    return (share + 1).cast("long")


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``floor((p - q) ** 2 / (p + q))`` of positive chances, which are at most ``UNIT + 1``."""
    apart = p - q
    return apart * apart // (p + q)


class Quadtree:
    """The cells ``(row, column) -> value`` of a square of side ``2 ** height`` (K = 2).

    ``levels[h]`` has the Morton codes of the quadrants that hold a cell, in ascending order; the last level is the
    cells themselves, with ``values`` beside it. A quadrant that is not listed is all zero.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, height: int) -> None:
        code = np.zeros(len(rows), np.int64)
        for bit in range(height):
            code |= ((rows >> bit & 1) << (2 * bit + 1)) | ((columns >> bit & 1) << (2 * bit))
        order = np.argsort(code, kind="stable")
        self.values, self.height = values[order], height
        self.levels = [np.unique(code >> 2 * (height - h)) for h in range(height)] + [code[order]]

    def holds(self, level: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which quadrants hold a cell, and their places in the level."""
        own = self.levels[level]
        at = np.minimum(np.searchsorted(own, code), max(len(own) - 1, 0))
        return (own[at] == code if len(own) else np.zeros(len(code), bool)), at


#: Children of a pair of quadrants in the same columns: (row half of the one, row half of the other, column half).
_CHILDREN = np.array([(a, b, c) for a in range(K) for b in range(K) for c in range(K)], np.int64)
#: Pairs of quadrants that are taken down together.
FRONTIER = 1 << 18


def common_leaves(one: Quadtree, other: Quadtree, mirrored: bool) -> Iterator[tuple[np.ndarray, ...]]:
    """``(row, row of the other, value, value of the other)`` wherever a column holds a value in both rows.

    Pairs of quadrants in the same columns are taken down level by level; a pair of which either is all zero goes no
    further. With ``mirrored`` both trees are the same one, and only rows ``a < b`` are told.
    """
    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        held, at = one.holds(level, a)
        held_too, at_too = other.holds(level, b)
        both = held & held_too
        a, b, at, at_too = a[both], b[both], at[both], at_too[both]
        if mirrored:
            # Of two quadrants in the same columns the one with the smaller code has the smaller rows.
            kept = a < b if level == one.height else a <= b
            a, b, at, at_too = a[kept], b[kept], at[kept], at_too[kept]
        if not len(a):
            continue
        if level == one.height:
            yield _row(a, level), _row(b, level), one.values[at], other.values[at_too]
            continue
        down = lambda code, rows: ((code[:, None] << 2) | (rows << 1) | _CHILDREN[:, 2]).ravel()
        stack.append((level + 1, down(a, _CHILDREN[:, 0]), down(b, _CHILDREN[:, 1])))


def _row(code: np.ndarray, height: int) -> np.ndarray:
    row = np.zeros(len(code), np.int64)
    for bit in range(height):
        row |= (code >> (2 * bit + 1) & 1) << bit
    return row


def _height(*ends: np.ndarray) -> int:
    return max(1, max(int(end.max(initial=0)) for end in ends).bit_length())


def _tiled(df: DataFrame, prefix: str = "") -> DataFrame:
    """Cells ``lang, tile, block, at, place, p`` of a tile and block as one row of arrays."""
    cells = F.collect_list(F.struct("at", "place", "p"))
    return df.groupBy("lang", "block", "tile").agg(cells.alias("_c")).select(
        "lang", "block", F.col("tile").alias(f"{prefix}tile"),
        *[F.col(f"_c.{name}").alias(f"{prefix}{name}") for name in ("at", "place", "p")],
    )


def _leaf_sums(pairs: DataFrame) -> DataFrame:
    """``lang, tile, at, b_tile, b_at, shared, excess`` per pair of groups that share terms of a block.

    ``excess`` is what their common terms add beyond the price of each group's counts against the other's zero chance.
    """

    def numbers(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
        return batch.column(batch.schema.get_field_index(name))[i].values.to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                lang, tile, other_tile = (batch.column(batch.schema.get_field_index(n))[i].as_py() for n in ("lang", "tile", "b_tile"))
                at, place, p, zero, b_at, b_place, b_p, b_zero = (
                    numbers(batch, n, i) for n in ("at", "place", "p", "zeros", "b_at", "b_place", "b_p", "b_zeros")
                )
                height = _height(at, place, b_at, b_place)
                mirrored = tile == other_tile
                one = Quadtree(at, place, p, height)
                other = one if mirrored else Quadtree(b_at, b_place, b_p, height)
                shared = np.zeros((len(zero), len(b_zero)), np.int64)
                excess = np.zeros_like(shared)
                for g, s, p_g, p_s in common_leaves(one, other, mirrored):
                    np.add.at(shared, (g, s), 1)
                    beyond = _divergence(p_g, p_s) - _divergence(p_g, b_zero[s]) - _divergence(zero[g], p_s)
                    np.add.at(excess, (g, s), beyond)
                g, s = np.nonzero(shared)
                n = len(g)
                columns = [
                    pa.array([lang] * n, pa.string()), pa.array([tile] * n, pa.int64()), pa.array(g),
                    pa.array([other_tile] * n, pa.int64()), pa.array(s), pa.array(shared[g, s]), pa.array(excess[g, s]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["lang", "tile", "at", "b_tile", "b_at", "shared", "excess"]
    schema = "lang string, tile long, at long, b_tile long, b_at long, shared long, excess long"
    return pairs.mapInArrow(run, schema)


def _zero_prices(pairs: DataFrame) -> DataFrame:
    """``lang, tile, at, b_tile, b_at, price``: each group's counts against the zero chance of each group of a tile.

    Counts come as a histogram, so a chance that many terms have is priced once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda name: batch.column(batch.schema.get_field_index(name))  # noqa: E731, B023
            for i in range(len(batch)):
                lang, tile, other_tile = (column(n)[i].as_py() for n in ("lang", "tile", "b_tile"))
                at, p, n, zero, other = (
                    column(name)[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                    for name in ("at", "p", "n", "zeros", "b_zeros")
                )
                price = np.zeros((len(zero), len(other)), np.int64)
                for first in range(0, len(at), SLICE):
                    part = slice(first, first + SLICE)
                    np.add.at(price, at[part], n[part, None] * _divergence(p[part, None], other[None, :]))
                g, s = (x.ravel() for x in np.indices(price.shape))
                m = len(g)
                columns = [
                    pa.array([lang] * m, pa.string()), pa.array([tile] * m, pa.int64()), pa.array(g),
                    pa.array([other_tile] * m, pa.int64()), pa.array(s), pa.array(price.ravel()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "tile", "at", "b_tile", "b_at", "price"])

    return pairs.mapInArrow(run, "lang string, tile long, at long, b_tile long, b_at long, price long")


def audit(
    docs: DataFrame, min_docs: int = 10, top: int = 10, text: str = "text", lang: str = "lang", source: str = "source",
    tile: int = TILE, block: int = BLOCK,
) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: the divergence of a group from each other source of its language, all ranks. Part ``term``: the
    ``top`` terms that a group holds more often than its language, by their share of its divergence from it.

    Null texts, languages and sources are empty. Terms are runs of letters A-Z (lower-cased) and of characters beyond
    ASCII. A language keeps the terms that at least ``min_docs`` of its rows hold; without any its pairs have the value
    0. Every row is a document. Other columns are not looked at. All numbers are exact; counts may be as large as a long.

    Terms are counted within tasks before the first shuffle. A group is a row here whatever its share of the documents;
    the longest lists are a tile's, of ``tile`` groups by ``block`` terms.
    """
    counted = staged(
        term_counts(docs, lang, source, text).groupBy("lang", "source", "term").agg(
            F.sum("count").alias("count"), F.sum("docs").alias("docs")
        ),
        "audit-counts",
    )
    cells = counted.where("term is not null")
    kept = staged(
        cells.groupBy("lang", "term").agg(F.sum("count").alias("in_lang"), F.sum("docs").alias("docs"))
        .where(F.col("docs") >= min_docs).drop("docs"),
        "audit-kept",
    )
    of_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("in_lang").alias("of_lang"))
    sized = counted.where("term is null").groupBy("lang").agg(F.count(F.lit(1)).alias("_groups")).join(of_lang, "lang", "left")
    sized = staged(sized.fillna(0, ["terms", "of_lang"]), "audit-languages")
    number = lambda name, parts: F.pmod(F.xxhash64(name), parts).cast("long")
    placed = kept.join(sized, "lang").withColumn("block", number("term", F.ceil(F.col("terms") / block)))
    in_block = Window.partitionBy("lang", "block").orderBy("term")
    placed = staged(
        placed.select(
            "lang", "term", "block", (F.row_number().over(in_block) - 1).cast("long").alias("place"),
            _chance(F.col("in_lang"), F.col("of_lang"), F.col("terms")).alias("q"),
        ),
        "audit-terms",
    )
    held = staged(cells.select("lang", "source", "term", "count").join(placed, ["lang", "term"]), "audit-cells")
    totals = held.groupBy("lang", "source").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("own"))
    groups = counted.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(sized, "lang")
    groups = groups.fillna(0, ["total", "own"]).withColumn("tile", number("source", F.ceil(F.col("_groups") / tile)))
    in_tile = Window.partitionBy("lang", "tile").orderBy("source")
    zero = F.when(F.col("terms") > 0, _chance(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(1).cast("long"))
    groups = staged(
        groups.select(
            "lang", "source", "tile", (F.row_number().over(in_tile) - 1).cast("long").alias("at"), "total", "own", "terms",
            zero.alias("zero"),
        ),
        "audit-groups",
    )
    chance = _chance(F.col("count"), F.col("total"), F.col("terms"))
    priced = staged(
        held.join(groups, ["lang", "source"]).select("lang", "source", "term", "block", "place", "tile", "at", "q", chance.alias("p")),
        "audit-chances",
    )

    # Zero chances of a tile's groups, by their place in it.
    zeros = groups.groupBy("lang", "tile").agg(F.sort_array(F.collect_list(F.struct("at", "zero"))).alias("_z"))
    zeros = staged(zeros.select("lang", "tile", F.col("_z.zero").alias("zeros")), "audit-zeros")
    b_zeros = zeros.select("lang", F.col("tile").alias("b_tile"), F.col("zeros").alias("b_zeros"))
    tiles = staged(_tiled(priced).join(zeros, ["lang", "tile"]), "audit-tiles")
    b_tiles = tiles.select(
        "lang", "block", *[F.col(c).alias(f"b_{c}") for c in ("tile", "at", "place", "p", "zeros")]
    )
    # A tile with itself needs no second copy of its cells.
    nothing = F.array().cast("array<long>")
    alone = tiles.select(
        "*", F.col("tile").alias("b_tile"), *[nothing.alias(f"b_{c}") for c in ("at", "place", "p")], F.col("zeros").alias("b_zeros")
    )
    apart = tiles.join(b_tiles, ["lang", "block"]).where("tile < b_tile")
    leaves = staged(_leaf_sums(alone.unionByName(apart)), "audit-leaves")
    turned = leaves.select(
        "lang", F.col("b_tile").alias("tile"), F.col("b_at").alias("at"), F.col("tile").alias("b_tile"), F.col("at").alias("b_at"),
        "shared", "excess",
    )
    common = leaves.unionByName(turned).groupBy("lang", "tile", "at", "b_tile", "b_at").agg(
        F.sum("shared").alias("shared"), F.sum("excess").alias("excess")
    )
    bars = priced.groupBy("lang", "tile", "at", "p").agg(F.count(F.lit(1)).alias("n"))
    bars = bars.groupBy("lang", "tile").agg(F.collect_list(F.struct("at", "p", "n")).alias("_b"))
    bars = zeros.join(bars, ["lang", "tile"], "left").select(
        "lang", "tile", "zeros", *[F.coalesce(F.col(f"_b.{c}"), nothing).alias(c) for c in ("at", "p", "n")]
    )
    prices = staged(_zero_prices(bars.join(b_zeros, "lang")), "audit-prices")
    back = prices.select(
        "lang", F.col("b_tile").alias("tile"), F.col("b_at").alias("at"), F.col("tile").alias("b_tile"), F.col("at").alias("b_at"),
        F.col("price").alias("back"),
    )
    ends = ["lang", "tile", "at", "b_tile", "b_at"]
    summed = prices.join(back, ends).join(common, ends, "left").fillna(0, ["shared", "excess"])
    g = groups.select("lang", "tile", "at", "source", F.col("own").alias("own"), "terms", F.col("zero").alias("z"))
    s = groups.select(
        "lang", F.col("tile").alias("b_tile"), F.col("at").alias("b_at"), F.col("source").alias("item"),
        F.col("own").alias("b_own"), F.col("zero").alias("b_z"),
    )
    both_zero = F.call_function("div", (F.col("z") - F.col("b_z")) * (F.col("z") - F.col("b_z")), F.col("z") + F.col("b_z"))
    empty = F.col("terms") - F.col("own") - F.col("b_own") + F.col("shared")
    value = F.col("price") + F.col("back") + F.col("excess") + empty * both_zero
    pair = (
        summed.join(g, ["lang", "tile", "at"]).join(s, ["lang", "b_tile", "b_at"]).where(F.col("source") != F.col("item"))
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    )
    apart_from = F.col("p") - F.col("q")
    term = priced.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        F.call_function("div", apart_from * apart_from, F.col("p") + F.col("q")).alias("value"),
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pair.withColumn("rank", F.row_number().over(order))
    best = term.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.unionByName(best)

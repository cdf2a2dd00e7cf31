"""Near-duplicate documents by MinHash bands, checked with odd sketches and confirmed on whole shingle sets.

MinHash samples of a document's word shingles are cut into bands; documents that agree in a band are candidates. Each
sample also flips one bit of a parity bitmap (odd sketch); the population count of two bitmaps' XOR estimates the
similarity and spares most of the exact comparisons. Parity bitmaps of the sets themselves, whose XOR counts the shingles
that only one of two documents has, spare nearly all others: copies of one text that differ from each other by a little too
much are many pairs, but few of them pass. What passes is compared on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged
from .common import lower_ascii, text_batches, words
from .graph import components

#: A pair at similarity 0.8 shares none of the bands with probability (1 - 0.8 ** 8) ** 96, or 2e-8; one at 0.3, as
#: documents with a long common passage have, shares one with probability 0.006.
BANDS, ROWS = 96, 8
SAMPLES = BANDS * ROWS
SKETCH_WORDS = 16
SKETCH_BITS = 64 * SKETCH_WORDS
#: Shingles that a parity bitmap of a set takes at most: of larger sets one in 2, 4, ... is taken, by its hash.
PARITY_BITS_OF_SIZE = 11
#: Deviations by which an estimate must miss the threshold before a pair is given up.
CAUTION = 4.7
#: Bands that a document must share with the central one of their buckets to be compared with it in the first step; a
#: pair at similarity 0.8 shares 16 on average. All other pairs are left to the second step.
EARLY_BANDS = 6
#: Shingles that a task hashes at a time.
SLICE = 1 << 16
SEED = 20_201


def shingle_set(text: Column, n: int) -> Column:
    """Distinct 64-bit hashes of the ``n``-word shingles, A-Z lower-cased; fewer words make one; none without words.

    To be used on a column made by ``words_column`` so that the text is split once.
    """
    w, size = text, F.size(text)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(size - n, F.lit(0))), lambda i: F.xxhash64(*[w[i + j] for j in range(n)]))
    return F.when(size >= n, F.array_distinct(runs)).when(size > 0, F.array(F.xxhash64(w))).otherwise(
        F.array().cast("array<bigint>")
    )


def with_sets(docs: DataFrame, n: int, id_col: str, text: str) -> DataFrame:
    """``doc_id, shingles`` (sorted)."""
    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), words(lower_ascii(F.col(text))).alias("_w"))
    return split.select("doc_id", F.sort_array(shingle_set(F.col("_w"), n)).alias("shingles"))


def widest_distance(percent: int) -> int:
    """XOR population counts up to this are taken for pairs that may reach ``percent``.

    At similarity J, about ``SAMPLES * (1 - J)`` samples differ; each differing sample flips up to two bits, of which
    some coincide. ``CAUTION`` standard deviations are granted, of the samples (taken through the flips' slope) and of
    the bits together.
    """
    miss = 1 - percent / 100
    flips = 2 * SAMPLES * miss
    stay = (1 - 2 / SKETCH_BITS) ** flips
    bits = SKETCH_BITS / 2 * (1 - stay)
    of_samples = stay * 2 * math.sqrt(SAMPLES * miss * (1 - miss))
    of_bits = math.sqrt(SKETCH_BITS / 4 * (1 - stay * stay))
    return math.ceil(bits + CAUTION * math.hypot(of_samples, of_bits))


def parity_maps(values: np.ndarray, sizes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """A bitmap of ``SKETCH_BITS`` per set: the parities of its values' hashes, of one in ``2 ** level`` values.

    ``values`` (unsigned 64 bits) are those of all sets, one set after the other.
    """
    mixed = values * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    taken = (mixed >> np.uint64(40)) & ((np.uint64(1) << levels.astype(np.uint64)) - np.uint64(1))[owner] == 0
    at = owner[taken] * SKETCH_BITS + (mixed[taken] % np.uint64(SKETCH_BITS)).astype(np.int64)
    odd = np.bincount(at, minlength=len(sizes) * SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(sizes), SKETCH_BITS), axis=1).view(np.int64)


def _lists(rows: np.ndarray) -> pa.ListArray:
    """A matrix as lists of its rows."""
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(rows).ravel()))


def parity_levels(sizes: np.ndarray) -> np.ndarray:
    """The level of a set's first parity map; its second one is of the next, for partners that are larger."""
    return np.maximum(np.frexp(sizes.astype(np.float64))[1] - PARITY_BITS_OF_SIZE, 0)


def _signatures(sets: DataFrame, percent: int) -> DataFrame:
    """``doc_id, n, f1, f2, bands, sketch, level, parity, thinner`` per document: size, 128-bit fingerprint, band keys, odd
    sketch of the samples, parity maps of the set at its level and, where a partner that reaches ``percent`` may be there,
    the next."""
    draw = np.random.default_rng(SEED)
    factors = draw.integers(1, 2**63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    turns = draw.integers(0, 2**63, SAMPLES, dtype=np.uint64)
    mixers = draw.integers(1, 2**63, ROWS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = np.uint64(29)

    def fold(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        least, turned = np.empty((SAMPLES, len(starts)), np.uint64), np.empty_like(values)
        for i in range(SAMPLES):
            np.multiply(values, factors[i], out=turned)
            turned += turns[i]
            least[i] = np.minimum.reduceat(turned, starts)
        keys = np.empty((BANDS, len(starts)), np.uint64)
        for band in range(BANDS):
            key = np.full(len(starts), band + 1, np.uint64)
            for row in range(ROWS):
                key = (key ^ least[band * ROWS + row]) * mixers[row + 1]
                key ^= key >> shift
            keys[band] = key
        bits = np.zeros((len(starts), SKETCH_BITS), np.uint8)
        each = np.arange(len(starts))
        for i in range(SAMPLES):
            x = (least[i] ^ turns[i]) * mixers[0]
            x = (x ^ (x >> shift)) * mixers[1]
            bits[each, (x >> np.uint64(40)) % np.uint64(SKETCH_BITS)] ^= 1
        sketch = np.packbits(bits, axis=1).view(np.int64)
        return keys.T.astype(np.int64), sketch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shingles")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = np.diff(offsets)
            keys = np.zeros((len(sizes), BANDS), np.int64)
            sketch, parity, thinner = (np.zeros((len(sizes), SKETCH_WORDS), np.int64) for _ in range(3))
            levels = parity_levels(sizes)
            full = np.flatnonzero(sizes)
            at = 0
            while at < len(full):
                end = at + 1
                while end < len(full) and offsets[full[end] + 1] - offsets[full[at]] <= SLICE:
                    end += 1
                own = full[at:end]
                first, last = offsets[own[0]], offsets[own[-1] + 1]
                keys[own], sketch[own] = fold(values[first:last], offsets[own] - first)
                parity[own] = parity_maps(values[first:last], sizes[own], levels[own])
                # Only sets near the next level can have partners there.
                high = own[100 * sizes[own] >= percent << (PARITY_BITS_OF_SIZE + levels[own])]
                if len(high):
                    some = np.concatenate([values[offsets[i] : offsets[i + 1]] for i in high])
                    thinner[high] = parity_maps(some, sizes[high], levels[high] + 1)
                at = end
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("doc_id", "n", "f1", "f2")), _lists(keys), _lists(sketch),
                    pa.array(levels, pa.int32()), _lists(parity), _lists(thinner),
                ],
                names=["doc_id", "n", "f1", "f2", "bands", *SKETCHES],
            )

    ready = sets.select(
        "doc_id", "shingles", F.size("shingles").cast("long").alias("n"),
        F.xxhash64("shingles").alias("f1"), F.xxhash64(F.lit("set"), "shingles").alias("f2"),
    )
    return text_batches(ready).mapInArrow(
        run, "doc_id long, n long, f1 long, f2 long, bands array<long>, sketch array<long>, level int, parity array<long>, thinner array<long>"
    )


#: What pairs are judged by before they are compared.
SKETCHES = ("sketch", "level", "parity", "thinner")


def _distance(a: Column, b: Column) -> Column:
    return sum(F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(SKETCH_WORDS))


def widest_parity(total: Column, level: Column, percent: int) -> Column:
    """XOR population counts of parity maps up to this are taken for pairs that may reach ``percent``.

    Two sets of ``total`` elements together differ in at most ``most`` of them, each of which flips one bit; so the whole
    count is ``most`` at least as surely as the sets are too far apart. Bits that are hit twice flip back: the count stays
    below its mean and ``CAUTION`` standard deviations, of the bits, and of the draw where elements are sampled.
    """
    most = (100 - percent) / (100 + percent) * total / F.pow(F.lit(2.0), level)
    stay = F.pow(F.lit(1 - 2 / SKETCH_BITS), most)
    mean = SKETCH_BITS / 2 * (1 - stay)
    drawn = SKETCH_BITS / 4 * (1 - stay * stay)
    whole = F.greatest(SKETCH_BITS / 4 * (1 - stay * stay * (1 + 4 * most / SKETCH_BITS)), F.lit(0.0))
    likely = mean + CAUTION * F.sqrt(F.when(level > 0, drawn).otherwise(whole)) + 1
    return F.when(level > 0, likely).otherwise(F.least(most, likely))


def _may_be_alike(u: str, v: str, limit: int, percent: int) -> Column:
    """Whether the sizes and sketches of two nodes, columns ``<name><u>`` and ``<name><v>``, let them reach ``percent``."""
    own, other = ({name: F.col(f"{name}{end}") for name in ("n", *SKETCHES)} for end in (u, v))
    near = 100 * F.least(own["n"], other["n"]) >= percent * F.greatest(own["n"], other["n"])
    level = F.greatest(own["level"], other["level"])
    maps = [F.when(x["level"] == level, x["parity"]).otherwise(x["thinner"]) for x in (own, other)]
    apart = _distance(*maps) <= widest_parity(own["n"] + other["n"], level, percent)
    return near & (_distance(own["sketch"], other["sketch"]) <= limit) & apart


def _renamed(nodes: DataFrame, end: str, *more: str) -> DataFrame:
    return nodes.select(*more, *[F.col(name).alias(f"{name}{end}") for name in ("n", *SKETCHES)])


def _confirmed(pairs: DataFrame, docs: DataFrame, n: int, percent: int, id_col: str, text: str) -> DataFrame:
    """The pairs ``u, v`` whose whole sets reach the threshold. Sets are made again, for documents in a pair only."""
    needed = staged(pairs.select(F.col("u").alias("_d")).union(pairs.select("v")).distinct(), "near-needed")
    wanted = docs.join(needed, docs[id_col].cast("long") == needed["_d"], "left_semi")
    sets = staged(with_sets(wanted, n, id_col, text).dropDuplicates(["doc_id"]), "near-sets")
    left = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("_b"))
    both = pairs.join(left, "u").join(right, "v")
    shared = both.select("u", "v", F.size(F.array_intersect("_a", "_b")).alias("_i"), (F.size("_a") + F.size("_b")).alias("_t"))
    return shared.where(100 * F.col("_i") >= percent * (F.col("_t") - F.col("_i"))).select("u", "v")


def _between_components(
    shared: DataFrame, nodes: DataFrame, known: DataFrame, limit: int, percent: int
) -> DataFrame | None:
    """Pairs ``u, v`` of different components that share a bucket and may be alike; None if there are none.

    In a bucket of several components, those outside the most frequent one are paired with all others. The sketches
    are compared inside the join, so only hopeful pairs leave it.
    """
    placed = shared.join(known, shared["node"] == known["node"], "left").select(
        "band", shared["node"], F.coalesce("component", shared["node"]).alias("component")
    )
    placed = staged(placed, "near-placed")
    sizes = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("c"))
    mixed = staged(
        sizes.groupBy("band").agg(F.max(F.struct("c", "component")).alias("most"), F.count(F.lit(1)).alias("k")).where("k > 1")
        .select("band", F.col("most.component").alias("main")),
        "near-mixed",
    )
    if mixed.isEmpty():
        return None
    sketched = nodes.select("node", "n", *SKETCHES)
    inside = staged(placed.join(mixed, "band").join(sketched, "node"), "near-inside")
    one = _renamed(inside.where(F.col("component") != F.col("main")), "_u", "band", F.col("node").alias("u"), F.col("component").alias("_cu"))
    other = _renamed(inside, "_v", "band", F.col("node").alias("v"), F.col("component").alias("_cv"), "main")
    worth = (
        (one["band"] == other["band"]) & (F.col("_cu") != F.col("_cv")) & ((F.col("_cv") == F.col("main")) | (F.col("u") < F.col("v")))
        & _may_be_alike("_u", "_v", limit, percent)
    )
    rest = staged(one.join(other, worth).select("u", "v").distinct(), "near-rest")
    return None if rest.isEmpty() else rest


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row; ``kept`` where the id is its component's smallest.

    Documents are linked if the shared shingles are at least ``percent`` per cent of the united ones. Null texts and
    texts without words have no shingles and no links. Rows with a null id are linked with nothing (``component_id``
    null, kept). Rows that repeat an id are one document; should their texts differ, one of them is compared.

    Equal sets are one node, so copies cost nothing. First each document is compared with one other: of the most central
    documents of its buckets (those that agree in a band), which meet most others in theirs, the one that it shares most
    buckets with. Then, in buckets that still hold several components, every document outside
    the most frequent component is compared with all others of the bucket. No pair is left out: two documents of a
    bucket end up compared, or in one component already. Where most of a group is near its central document, the group costs
    its size. Copies that are all a little too far from each other stay components of their own; their sketches are
    compared pair by pair, inside the join, and only pairs that these cannot tell apart come out of it.
    """
    signed = staged(_signatures(with_sets(docs, n, id_col, text), percent), "near-signatures")
    nodes = staged(
        signed.where("doc_id is not null and n > 0").groupBy("f1", "f2").agg(
            F.min("doc_id").alias("node"), *[F.any_value(c).alias(c) for c in ("n", "bands", *SKETCHES)]
        ),
        "near-nodes",
    )
    alike = nodes.select("f1", "f2", "node")
    member = nodes.select("node", F.explode("bands").alias("band"))
    sizes = staged(member.groupBy("band").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "near-buckets")
    placed = staged(member.join(sizes, "band"), "near-members")
    # How many others a node meets in its buckets: most for the document that the others are copies of.
    met = staged(placed.groupBy("node").agg(F.sum("c").alias("met")), "near-met")
    central = placed.join(met, "node").groupBy("band").agg(F.max(F.struct("met", (-F.col("node")).alias("_least"))).alias("_first"))
    firsts = staged(central.select("band", (-F.col("_first._least")).alias("first")), "near-firsts")
    shared = staged(placed.join(firsts, "band").select("band", "node", "first"), "near-shared")
    limit = widest_distance(percent)

    def hopeful(pairs: DataFrame) -> DataFrame:
        u, v = (_renamed(nodes, f"_{end}", F.col("node").alias(end)) for end in ("u", "v"))
        return pairs.join(u, "u").join(v, "v").where(_may_be_alike("_u", "_v", limit, percent)).select("u", "v")

    first = shared.where(F.col("node") != F.col("first")).select(F.col("node").alias("u"), F.col("first").alias("v"))
    first = first.groupBy("u", "v").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= EARLY_BANDS)
    first = first.groupBy("u").agg(F.max(F.struct("_c", "v")).alias("_m")).select("u", F.col("_m.v").alias("v"))
    links = staged(_confirmed(staged(hopeful(first), "near-pairs"), docs, n, percent, id_col, text), "near-links")
    known = staged(components(links), "near-components")
    more = _between_components(shared, nodes, known, limit, percent)
    if more is not None:
        more = staged(_confirmed(more, docs, n, percent, id_col, text), "near-more")
    groups = known if more is None or more.isEmpty() else staged(components(links.unionByName(more)), "near-groups")
    least = groups.withColumnRenamed("component", "least")
    of_node = staged(
        alike.join(least, alike["node"] == least["node"], "left").select("f1", "f2", F.coalesce("least", alike["node"]).alias("group")),
        "near-of-node",
    )
    told = signed.select("doc_id", F.col("n").alias("n_shingles"), "f1", "f2").join(of_node, ["f1", "f2"], "left")
    grouped = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("group")).otherwise(F.col("doc_id"))
    return told.select("doc_id", "n_shingles", grouped.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near-duplicates, with all their columns.

    Of rows that repeat an id one stays; rows with a null id all stay.
    """
    kept = near_duplicates(docs, n, percent, id_col, text).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"))
    first = Window.partitionBy("_id").orderBy(F.xxhash64(f"_row.{text}"), f"_row.{text}")
    named = rows.where("_id is not null").join(kept, "_id", "left_semi").withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return named.select("_row.*").unionByName(rows.where("_id is null").select("_row.*"))

"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all documents that may be learnt from. The weights are fitted on a bounded sample of
labelled documents by follow-the-regularised-leader with elastic-net penalties; a temperature, fitted on sampled
documents kept out of the training, calibrates the scores. Prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import text_batches

UNDETERMINED = "und"
#: Hashed features, n-gram lengths 1 to ORDERS, characters looked at together.
FEATURES = 1 << 16
ORDERS = 3
SLICE = 1 << 19
#: Labelled documents per language that the weights are fitted on, the bound of the sample; those with the smallest
#: hashes of their ids. One in ``CALIBRATE`` of them only sets the temperature.
SAMPLE = 400
CALIBRATE = 5
#: Languages that a model knows at most, the most frequent ones; rows of others are not learnt from.
LANGUAGES = 256
#: Follow-the-regularised-leader: step, its smoothing, L1 and L2 penalties, passes; and the scale of the features.
ALPHA, BETA, L1, L2, PASSES, SCALE = 0.3, 1.0, 0.02, 0.05, 6, 30.0
#: Documents with a lower score are rejected by ``keep_identified``.
LEAST_SCORE = 0.5
#: Pieces that vectors of document frequencies are summed in.
BLOCKS = 16
#: Parts of a language whose draws are ranked on their own.
PARTS = 64

_PAD = " " * ORDERS
_LETTER = regex.compile(r"\p{L}")
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@dataclass
class Model:
    """``weights`` (features x languages) hold frequencies' weights, scale and temperature already."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER.search(text) is not None


def gram_features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Feature numbers of every n-gram of each order at each place; where each text begins, and its places.

    Lower-cased; white space and controls count as blanks. A text is followed by blanks, of which the first is a place
    too, so its n-grams are its own.
    """
    lowered = [text.lower() + _PAD for text in texts]
    sizes = np.array([len(text) for text in lowered], np.int64)
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    points[points < 33] = 32
    starts = np.cumsum(sizes) - sizes
    found, rolled = [], np.zeros(len(points), np.uint32)
    for order in range(ORDERS):
        rolled = (rolled + np.uint32(order + 1)) * _MIX[0]
        shifted = np.full(len(points), 32, np.uint32)
        shifted[: len(points) - order] = points[order:]
        rolled = (rolled ^ shifted) * _MIX[1]
        rolled ^= rolled >> np.uint32(15)
        found.append(((rolled * _MIX[2]) >> np.uint32(16)).astype(np.int64))
    return found, starts, sizes - len(_PAD) + 1


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) <= SLICE:
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many rows of ``text`` each feature occurs, and the number of rows. Tasks count; blocks of counts are summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES, np.int64), 0
        seen = np.zeros(FEATURES, bool)
        for batch in batches:
            own = [text for text in batch.column(0).to_pylist() if has_letter(text)]
            rows += len(own)
            for at, end in _slices(own):
                found, starts, sizes = gram_features(own[at:end])
                for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
                    seen[:] = False
                    for grams in found:
                        seen[grams[start : start + size]] = True
                    total += seen
        if rows:
            blocks = [block.tobytes() for block in np.split(total, BLOCKS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(BLOCKS), pa.int32()), pa.array(blocks, pa.binary()), pa.array([rows] * BLOCKS, pa.int64())],
                names=["block", "counts", "rows"],
            )

    def add(table: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()], axis=0)
        rows = sum(table.column("rows").to_pylist())
        return pa.table({"block": table.column("block")[:1].cast(pa.int32()), "counts": pa.array([sums.tobytes()], pa.binary()), "rows": [rows]})

    schema = "block int, counts binary, rows long"
    # Two steps: what many tasks found is added up in groups first, so that no task gathers from all.
    part = text_batches(texts).mapInArrow(count, schema).withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(16)))
    halfway = part.groupBy("block", "part").applyInArrow(add, schema)
    found = {row["block"]: row for row in halfway.groupBy("block").applyInArrow(add, schema).collect()}
    if not found:
        return np.zeros(FEATURES, np.int64), 0
    return np.concatenate([np.frombuffer(found[i]["counts"], np.int64) for i in range(BLOCKS)]), found[0]["rows"]


def sample_features(labelled: DataFrame, per_language: int) -> list[Row]:
    """``lang, draw, grams, counts, places`` of at most ``per_language`` rows ``lang, draw, text`` for each language.

    First the draws alone are ranked, within ``PARTS`` parts of a language and then over these, for the largest draw
    that is in. Texts are read again where they lie and held against that, so only the texts of the sample are shuffled.
    """
    draws = labelled.select("lang", "draw", F.pmod("draw", F.lit(PARTS)).alias("_part"))
    for by in (["lang", "_part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("draw"))
        draws = draws.withColumn("_n", place).where(F.col("_n") <= per_language).drop("_n")
    last = draws.groupBy("lang").agg(F.max("draw").alias("_last")).collect()
    if not last:
        return []
    limits = F.create_map(*[F.lit(x) for row in last for x in (row["lang"], row["_last"])])
    order = Window.partitionBy("lang").orderBy("draw", F.xxhash64("text"))
    drawn = labelled.where(F.col("draw") <= limits[F.col("lang")])
    chosen = drawn.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_language).drop("_n")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, draw, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found, _, sizes = gram_features([text])
                own = np.concatenate([grams[: sizes[0]] for grams in found])
                counts = np.bincount(own, minlength=FEATURES)
                grams = np.flatnonzero(counts)
                arrays = [
                    pa.array([lang]), pa.array([draw], pa.int64()), pa.array([grams], pa.list_(pa.int32())),
                    pa.array([counts[grams]], pa.list_(pa.int32())), pa.array([int(sizes[0]) * ORDERS], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "draw", "grams", "counts", "places"])

    schema = "lang string, draw long, grams array<int>, counts array<int>, places long"
    return sorted(chosen.select("lang", "draw", "text").mapInArrow(sparse, schema).collect(), key=lambda r: (r["draw"], r["lang"], r["grams"]))


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of a softmax over sparse rows ``(features, values, class)``."""
    z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))
    bias, bias_n = np.zeros(classes), np.zeros(classes)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for _ in range(PASSES):
        for at, x, y in rows:
            w = weights(z[at], n[at])
            error = _softmax((x @ w + bias)[None, :])[0]
            error[y] -= 1
            slope = x[:, None] * error[None, :]
            squared = slope * slope
            sigma = (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA
            z[at] += slope - sigma * w
            n[at] += squared
            bias_n += error * error
            bias -= ALPHA * error / (BETA + np.sqrt(bias_n))
    return weights(z, n), bias


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def fit_temperature(logits: np.ndarray, classes: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section between 0.5 and 20."""
    if not len(classes):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(classes)), classes]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = np.log(0.5), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _known_languages(labelled: DataFrame) -> DataFrame:
    """The rows of the ``LANGUAGES`` most frequent languages, which are what the driver and the model have room for."""
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    kept = [row["lang"] for row in counts.orderBy(F.desc("n"), "lang").limit(LANGUAGES + 1).collect()]
    return labelled if len(kept) <= LANGUAGES else labelled.where(F.col("lang").isin(kept[:LANGUAGES]))


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from rows ``lang, draw, text`` (language and text not null); without rows one that knows no language."""
    lettered = _known_languages(labelled.where(F.col("text").rlike(r"\p{L}")))
    frequency, n = document_frequencies(lettered.select("text"))
    idf = np.log((1 + n) / (1 + frequency)) + 1
    drawn = sample_features(lettered, sample)
    languages = sorted({row["lang"] for row in drawn})
    rows = []
    for row in drawn:
        at = np.array(row["grams"], np.int64)
        rows.append((at, np.array(row["counts"]) / row["places"] * idf[at] * SCALE, languages.index(row["lang"])))
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0))
    kept_out = rows[::CALIBRATE] if len(rows) >= 10 * CALIBRATE else []
    weights, bias = fit_ftrl([row for i, row in enumerate(rows) if not kept_out or i % CALIBRATE], len(languages))
    logits = np.array([x @ weights[at] + bias for at, x, _ in kept_out]).reshape(len(kept_out), len(languages))
    heat = fit_temperature(logits, np.array([y for _, _, y in kept_out], int))
    return Model(languages, (weights * idf[:, None] * SCALE / ORDERS / heat).astype(np.float32), bias / heat)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; ``und`` and 0 for null texts, texts without a letter, or no languages.

    Columns of ``docs`` with these names are replaced. Texts are read whole, many at a time; no shuffle.
    """
    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    place = kept.index(next(c for c in kept if c.lower() == text.lower()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            named, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            known = [i for i, text in enumerate(texts) if model.languages and has_letter(text)]
            own = [texts[i] for i in known]
            for at, end in _slices(own):
                found, starts, sizes = gram_features(own[at:end])
                ends = np.stack([starts, starts + sizes], axis=1).ravel()
                sums = sum(np.add.reduceat(model.weights[grams], ends, axis=0, dtype=np.float64)[::2] for grams in found)
                chances = _softmax(sums / sizes[:, None] + model.bias)
                for i, best, chance in zip(known[at:end], chances.argmax(1).tolist(), chances.max(1).tolist(), strict=True):
                    named[i], scores[i] = model.languages[best], min(chance, 1.0)
            columns = [*batch.columns, pa.array(named), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    return text_batches(docs.select(*kept)).mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4. False for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, learnt from its own rows that are not held out.

    Only text and known ``lang`` of rows with an id that ``held_out`` denies are learnt from; the language, source and id
    of a document play no part in its prediction. Equal texts get equal predictions.
    """
    labelled = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    learnt = labelled.select(F.col(lang).alias("lang"), F.xxhash64(F.lit("sample"), F.col(id_col)).alias("draw"), F.col(text).alias("text"))
    return predict(docs, train(learnt, sample), text)


def keep_identified(docs: DataFrame, least: float = LEAST_SCORE, **columns: str) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of at least ``least``."""
    kept = identify(docs, **columns).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.drop(*(c for c in ("lang_pred", "score") if c not in {x.lower() for x in docs.columns}))

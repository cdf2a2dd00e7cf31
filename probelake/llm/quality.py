"""Quality rules: base counts and the divergence of a document's histograms from its language's.

Two histograms are compared with references by Jensen-Shannon distance (base 2, 0 to 1): character classes, and the most
common short words of the language. The references are sums over all documents of a language. Only DataFrame functions
are used.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import staged
from .common import BLANKS, lower_ascii, same, text_key, words

#: Stripped from the end of a word before it is looked up among the common words.
MARKS = ".,;:!?"
#: Character classes counted by pattern; what they leave is ``other``, bytes beyond one a character are ``wide``.
CLASSES = {"blank": r"[\x20\x09-\x0D]+", "lower": "[a-z]+", "upper": "[A-Z]+", "digit": "[0-9]+", "mark": r"[.,;:!?'\"()-]+"}
HISTOGRAM = ("blank", "lower", "upper", "digit", "mark", "other", "wide")

MIN_WORDS = 50
MAX_REPEATED = 50
#: Common words a language has in its reference, and the longest word looked at.
COMMON_WORDS = 50
COMMON_LENGTH = 5
#: Below so many words a histogram says too little; the distances are then not held against a document.
GUARD_WORDS = 50
#: Largest distances of a good document: ``a + b / sqrt(words)``, since short texts stray further from their language.
CLASS_LIMIT = (0.15, 1.0)
WORD_LIMIT = (0.22, 1.75)


def _count(pattern: str, text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _halved(p: Column, q: Column) -> Column:
    """One bucket's share of the Jensen-Shannon divergence."""
    m = (p + q) / 2
    return F.when(p > 0, p * F.log2(p / m) / 2).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m) / 2).otherwise(0.0)


def _distance(divergence: Column) -> Column:
    return F.sqrt(F.greatest(divergence, F.lit(0.0)))


def _short(listed: Column) -> Column:
    """Those of the words that may be common: short, without the marks at their ends, A-Z lower-cased."""
    near = F.filter(listed, lambda w: F.char_length(w) <= COMMON_LENGTH + 1)
    bare = F.transform(near, lambda w: lower_ascii(F.rtrim(w, F.lit(MARKS))))
    return F.filter(bare, lambda w: F.char_length(w).between(1, COMMON_LENGTH))


def base_features(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """A row per document: ``_id, _text, _lang``, base counts, character classes, sorted short words (``_s``). No shuffle.

    ``blank`` is what the words leave of a text, ``lower`` is counted in the words put together, and the other classes and
    the symbols in what is left of those.

    ``n_repeat_words``: 3-word windows are hashed (64 bits) and sorted with their positions; positions of windows equal
    to a neighbour are put in order again and the words that they cover are summed.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(
        F.col(id_col).alias("_id"), text_key(F.col(text)).alias("_text"), F.col(lang).alias("_lang"),
        whole.alias("_whole"), words(F.col(text)).alias("_w"), F.split(whole, "\n", -1).alias("_l"),
    )
    read = read.withColumn("_dense", F.array_join("_w", ""))
    read = read.withColumn("_rest", F.regexp_replace("_dense", CLASSES["lower"], ""))
    spoken = F.filter("_l", lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    n = F.size("_w")
    w = F.col("_w")
    windows = F.when(
        n >= 3, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(3)) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
    ).otherwise(F.array().cast("array<bigint>"))
    chars = F.char_length("_whole")
    counted = read.select(
        "_id", "_text", "_lang", n.cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_rest", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size(spoken) - F.size(F.array_distinct(spoken))).cast("long").alias("n_dup_lines"),
        windows.alias("_g"), F.sort_array(_short(w)).alias("_s"), chars.cast("long").alias("_chars"),
        (F.octet_length("_whole") - chars).cast("long").alias("wide"),
        (chars - F.char_length("_dense")).cast("long").alias("blank"),
        (F.char_length("_dense") - F.char_length("_rest")).cast("long").alias("lower"),
        *[_count(CLASSES[name], F.col("_rest")).cast("long").alias(name) for name in ("upper", "digit", "mark")],
    )
    by_hash = F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    ordered = counted.withColumn("_h", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), by_hash))
    s = F.col("_h")
    found_again = lambda j: (F.get(s, j - 1)["h"] == s[j]["h"]) | (F.get(s, j + 1)["h"] == s[j]["h"])
    repeats = F.sort_array(
        F.array_compact(F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.when(found_again(j), s[j]["i"])))
    )
    covered = F.aggregate(
        repeats, F.struct(F.lit(-3).alias("at"), F.lit(0).alias("n")),
        lambda seen, i: F.struct(i.alias("at"), (seen["n"] + F.least(F.lit(3), i - seen["at"])).alias("n")),
    )["n"]
    return ordered.select(
        "_id", "_text", "_lang", "n_words", (F.col("_chars") - F.col("blank")).alias("word_chars"), "n_symbols", "n_dup_lines",
        F.when(s.isNotNull(), covered).otherwise(0).cast("long").alias("n_repeat_words"),
        *CLASSES, (F.col("_chars") - sum(F.col(c) for c in CLASSES)).alias("other"), "wide", "_s",
    )


def references(features: DataFrame, short: DataFrame) -> list[Row]:
    """A row per language: class sums, words, and the counts of its ``COMMON_WORDS`` most common short words.

    Sums run over all documents whose language is known. The rows go to the driver, one per language.
    """
    known = features.where(F.col("_lang").isNotNull())
    totals = staged(
        known.groupBy("_lang").agg(*[F.sum(c).alias(c) for c in HISTOGRAM], F.sum("n_words").alias("r_words")), "language-totals"
    )
    ranked = Window.partitionBy("_lang").orderBy(F.desc("r_count"), "word")
    counts = short.where(F.col("_lang").isNotNull()).groupBy("_lang", "word").agg(F.count(F.lit(1)).alias("r_count"))
    top = counts.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= COMMON_WORDS)
    listed = top.groupBy("_lang").agg(
        F.sum("r_count").alias("r_common"), F.sort_array(F.collect_list(F.struct("word", "r_count"))).alias("r_list")
    )
    return totals.join(listed, "_lang", "left").orderBy("_lang").collect()


def _reference_array(languages: list[Row]) -> Column:
    """The references as one constant: language, share of each class and of the common words."""
    entries = []
    for row in languages:
        chars = sum(row[c] for c in HISTOGRAM)
        if chars and row["r_words"]:
            shares = {c: row[c] / chars for c in HISTOGRAM}
            entries.append({"lang": row["_lang"], "common": (row["r_common"] or 0) / row["r_words"], **shares})
    fields = ", ".join(f"{c}: double" for c in ("common", *HISTOGRAM))
    return F.from_json(F.lit(json.dumps(entries)), f"array<struct<lang: string, {fields}>>")


def word_divergence(features: DataFrame, languages: list[Row]) -> DataFrame:
    """``_id, _text, _held``: by language, the divergence over the common words a text has, and how many it has.

    A row's short words are sorted; those in any reference are counted by their first and last places. Their terms are
    summed per row on the map side: with shares p here and q in the reference, a word adds
    ``(p log2 p + q log2 q - (p + q) log2(p + q) + p) / 2`` once ``q / 2`` is put in for every common word, had or not.
    Rows alike in id and text are summed together.
    """
    listed = [
        (row["_lang"], x["word"], x["r_count"] / row["r_words"]) for row in languages for x in row["r_list"] or () if row["r_words"]
    ]
    common = features.sparkSession.createDataFrame(listed, "r_lang string, word string, q double")
    common = common.withColumn("q_log", F.col("q") * F.log2("q"))
    known = F.from_json(F.lit(json.dumps(sorted({word for _, word, _ in listed}))), "array<string>")
    turned = features.select("_id", "_text", "n_words", "_s", F.reverse("_s").alias("_r"), F.array_intersect("_s", known).alias("_p"))
    count = lambda w: F.size("_s") + 2 - F.array_position("_r", w) - F.array_position("_s", w)
    counted = turned.select(
        "_id", "_text", "n_words", F.inline(F.transform("_p", lambda w: F.struct(w.alias("word"), count(w).cast("long").alias("c"))))
    ).withColumn("p", F.col("c") / F.col("n_words"))
    p, q = F.col("p"), F.col("q")
    # A word meets many languages: what depends on one side only is worked out before.
    met = counted.withColumn("p_log", p * F.log2(p)).join(common, "word")
    term = (F.col("p_log") + F.col("q_log") - (p + q) * (F.ln(p + q) / math.log(2)) + p) / 2
    summed = met.groupBy("_id", "_text", "r_lang").agg(F.sum(term).alias("d"), F.sum("c").alias("c"))
    return summed.groupBy("_id", "_text").agg(
        F.map_from_entries(F.collect_list(F.struct("r_lang", F.struct("d", "c")))).alias("_held")
    )


def verdicts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """A row per distinct (``_id, _text``) of ``docs``, ``_times`` how often it is there.

    Base counts, ``base_failed``, the distances to the nearest language (``nearest_lang``, by words, then classes) and
    ``kept``. A document fails the base with under ``MIN_WORDS`` words or over ``MAX_REPEATED`` per cent repeated words;
    it fails the method if it has ``GUARD_WORDS`` words and a distance over the limit for its length. All references are
    tried, as ``lang`` may be null or wrong; without any reference only the base counts. A null text has no words and
    fails. Counts and reference sums are whole numbers, so results do not depend on how rows are spread.

    Only counts per language and common word, and a few numbers per document, are shuffled, never texts.
    """
    features = staged(base_features(docs, id_col, text, lang), "quality-features")
    short = features.where(F.col("_lang").isNotNull()).select("_lang", F.explode("_s").alias("word"))
    languages = references(features, short)
    held = word_divergence(features, languages)
    once = [c for c in features.columns if c not in ("_lang", "_s")]
    own = features.groupBy(*once).agg(F.count(F.lit(1)).alias("_times"))
    named = held.toDF("_of_id", "_of_text", "_held")
    alike = F.col("_id").eqNullSafe(F.col("_of_id")) & (F.col("_text") == F.col("_of_text"))
    met = own.join(named, alike, "left").drop("_of_id", "_of_text")
    chars = sum(F.col(c) for c in HISTOGRAM)
    nothing = F.struct(F.lit(0.0).alias("d"), F.lit(0).cast("long").alias("c"))

    def against(r: Column) -> Column:
        had = F.coalesce(F.try_element_at(F.col("_held"), r["lang"]), nothing)
        p, q = 1 - had["c"] / F.col("_times") / F.col("n_words"), 1 - r["common"]
        by_word = had["d"] / F.col("_times") + r["common"] / 2 + _halved(p, q)
        by_class = sum(_halved(F.col(c) / chars, r[c]) for c in HISTOGRAM)
        return F.struct(_distance(by_word).alias("word"), _distance(by_class).alias("class"), r["lang"].alias("lang"))

    nearest = F.when(F.col("n_words") > 0, F.array_min(F.transform(_reference_array(languages), against)))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    judged = met.withColumn("_near", nearest).select(
        "_id", "_text", "_times", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), F.col("_near.class").alias("class_distance"),
        F.col("_near.word").alias("word_distance"), F.col("_near.lang").alias("nearest_lang"),
    )
    spread = 1 / F.sqrt(F.col("n_words"))
    far = (F.col("class_distance") > CLASS_LIMIT[0] + CLASS_LIMIT[1] * spread) | (
        F.col("word_distance") > WORD_LIMIT[0] + WORD_LIMIT[1] * spread
    )
    return judged.withColumn(
        "kept", F.when(F.col("base_failed"), False).when(F.col("n_words") < GUARD_WORDS, True).otherwise(~F.coalesce(far, F.lit(False)))
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose verdict is ``kept``, with all their columns."""
    good = verdicts(docs, id_col, text, lang).where("kept").select("_id", "_text")
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), text_key(F.col(text)).alias("_text"))
    return rows.join(good, same(rows, good, "_id", "_text"), "left_semi").select("_row.*")

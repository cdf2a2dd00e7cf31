import re
from collections import Counter

import pytest

from probelake.llm import quality
from probelake.llm.queries import QUERIES

from .conftest import listed, texts


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {i + j for i, window in enumerate(windows) if times[window] > 1 for j in range(3)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
    }


def test_base_counts_of_odd_texts(odd_docs):
    got = {row["_id"]: row for row in listed(quality.verdicts(odd_docs)) if row["_id"] is not None}
    for i, text in enumerate(texts()):
        want = brute(text)
        assert {name: got[i][name] for name in want} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert got[i]["base_failed"] == failed
        assert not (failed and got[i]["kept"])
    assert got[0]["_times"] == 2 and got[4]["_times"] == 2 and got[1]["_times"] == 1


def test_whole_table(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = listed(QUERIES["op1_quality"](spark, sf_dir))
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for row in rows:
        want = brute(docs[row["doc_id"]])
        assert {name: row[name] for name in want} == want
        if row["base_failed"]:
            assert row["kept"] is False


def test_distances_are_those_of_the_histograms(spark):
    import math

    def js(p, q):
        m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
        part = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m, strict=True) if a)
        return math.sqrt(max((part(p) + part(q)) / 2, 0))

    docs = [(0, "the cat, and the dog", "en"), (1, "und der Hund und so", "de"), (2, "the und Zebra 12", None)]
    got = {r["_id"]: r for r in listed(quality.verdicts(spark.createDataFrame(docs, "doc_id long, text string, lang string")))}
    short = lambda text: [w for w in (x.rstrip(".,;:!?").lower() for x in text.split() if len(x) <= 6) if 0 < len(w) <= 5]
    expected = []
    for _, text, lang in docs[:2]:
        n, common = len(text.split()), Counter(short(text))
        mine, m = Counter(short(docs[2][1])), 4
        names = sorted(common)
        q = [common[w] / n for w in names]
        p = [mine[w] / m for w in names]
        expected.append((js([*p, 1 - sum(p)], [*q, 1 - sum(q)]), lang))
    assert got[2]["word_distance"] == pytest.approx(min(expected)[0])
    assert got[2]["nearest_lang"] == min(expected)[1]
    assert got[0]["word_distance"] == pytest.approx(0, abs=1e-6) and got[0]["class_distance"] == pytest.approx(0, abs=1e-6)


def test_junk_goes_and_prose_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r["doc_id"] for r in listed(quality.keep_good(docs).select("doc_id"))}
    judged = {r["_id"]: r for r in listed(quality.verdicts(docs))}
    for row in marks.collect():
        if row["quality"] == 1 and not judged[row["doc_id"]]["base_failed"]:
            assert row["doc_id"] in kept


def test_columns_stay_and_nothing_is_fine(odd_docs, no_docs):
    assert quality.keep_good(odd_docs).columns == odd_docs.columns
    assert quality.verdicts(no_docs).count() == 0
    assert quality.keep_good(no_docs).count() == 0


def test_what_one_side_fixes_is_worked_out_before_words_meet_languages(spark):
    features = spark.createDataFrame([(0, 1, 3, ["a", "a", "b"])], "_id long, _text long, n_words long, _s array<string>")
    entries = [{"word": "a", "r_count": 2}, {"word": "b", "r_count": 1}]
    rows = [{"_lang": lang, "r_words": 4, "r_list": entries} for lang in ("de", "en")]
    held = quality.word_divergence(features, rows)
    joined = held._jdf.queryExecution().optimizedPlan().toString().split("Join ")[0]
    assert len(re.findall(r"\b(?:LOG2|log2|ln|LN)\(", joined)) == 1
    assert {k: v["c"] for k, v in listed(held)[0]["_held"].items()} == {"de": 3, "en": 3}


def test_classes_are_counted_without_the_blanks(spark):
    text = " The  quick\tbrown\n fox, 12 times: É! #x\x0b"
    row = listed(quality.base_features(spark.createDataFrame([(0, text, "en")], "doc_id long, text string, lang string")))[0]
    want = {"blank": r"[\x20\x09-\x0D]", "lower": "[a-z]", "upper": "[A-Z]", "digit": "[0-9]", "mark": r"[.,;:!?'\"()-]"}
    assert {name: row[name] for name in want} == {name: len(re.findall(pattern, text)) for name, pattern in want.items()}
    assert (row["other"], row["wide"]) == (2, 1)

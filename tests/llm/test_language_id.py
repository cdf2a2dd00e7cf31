import zlib

import numpy as np

from probelake.llm import language_id
from probelake.llm.queries import QUERIES

from .conftest import listed


def test_held_out_accuracy(spark, sf_dir):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = listed(QUERIES["op6_language_id"](spark, sf_dir))
    assert sorted(r["doc_id"] for r in rows) == sorted(known)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_held_out_labels_and_ids_do_not_matter(spark):
    words = {"en": "the cat and the dog", "de": "und der große Hund"}
    rows = [(i, f"{words[lang]} {i % 7}", lang) for i in range(120) for lang in ("en" if i % 2 else "de",)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    first = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in listed(language_id.identify(frame(rows)))}
    second = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in listed(language_id.identify(frame(told)))}
    assert first == second
    assert all(first[i][0] == lang for i, _, lang in rows)


def test_odd_texts(odd_docs, no_docs):
    rows = listed(language_id.identify(odd_docs))
    assert len(rows) == odd_docs.count()
    for r in rows:
        if not language_id.has_letter(r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in ("en", "de")
    assert set(language_id.identify(odd_docs).columns) == set(odd_docs.columns)
    assert language_id.keep_identified(odd_docs).select(*odd_docs.columns).columns == odd_docs.columns
    assert language_id.identify(no_docs).count() == 0
    unlabelled = odd_docs.withColumn("lang", odd_docs["lang"].substr(9, 1)).where("lang is null or lang = ''").selectExpr(
        "doc_id", "text", "cast(null as string) as lang"
    )
    assert {r["lang_pred"] for r in listed(language_id.identify(unlabelled))} == {"und"}


def test_frequencies_count_each_document_once(spark):
    texts = ["abc abc", "xyz", "abc", "", "12"]
    got, rows = language_id.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros(language_id.FEATURES, int)
    for text in texts[:3]:
        found, _, sizes = language_id.gram_features([text])
        want[np.unique(np.concatenate([grams[: sizes[0]] for grams in found]))] += 1
    assert rows == 3 and (got == want).all()


def test_grams_of_a_text_do_not_depend_on_its_neighbours():
    alone, _, sizes = language_id.gram_features(["Größe  x"])
    together, starts, _ = language_id.gram_features(["first text", "Größe\tx".replace("\t", "  "), "last"])
    for a, b in zip(alone, together, strict=True):
        assert (a[: sizes[0]] == b[starts[1] : starts[1] + sizes[0]]).all()


def test_penalties_and_temperature():
    rng = np.random.default_rng(0)
    rows = [(np.array([y, 10 + rng.integers(5)]), np.array([1.0, 0.1]), y) for y in rng.integers(0, 2, 300).tolist()]
    weights, _ = language_id.fit_ftrl(rows, 2)
    assert weights[0, 0] > 0 > weights[0, 1] and (weights[100:] == 0).all()
    logits = rng.normal(size=(4000, 3))
    classes = np.array([rng.choice(3, p=p) for p in language_id._softmax(logits)])
    assert 0.85 < language_id.fit_temperature(logits, classes) < 1.15
    assert 2.5 < language_id.fit_temperature(logits * 3, classes) < 3.5

import random
import re

import numpy as np
import pytest

from probelake.llm import graph, near_dups
from probelake.llm.queries import QUERIES

from .conftest import listed

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, n, percent):
    """``{id: (size of the set, component)}`` of unique ids, over all pairs."""
    sets = {i: shingles(text, n) for i, text in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for at, a in enumerate(ids):
        for b in ids[at + 1 :]:
            small, large = sorted((len(sets[a]), len(sets[b])))
            if small and 100 * small >= percent * large and find(a) != find(b):
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (small + large - shared):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(got, want):
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (size, least, i == least) for i, (size, least) in want.items()
    }


def test_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(listed(QUERIES["op8_near_dups"](spark, sf_dir)), brute(rows, 4, 80))


def test_groups_of_near_copies_and_chains(spark):
    rng = random.Random(4)
    rows = []
    for group in range(12):
        base = [f"g{group}w{rng.randrange(500)}" for _ in range(120)]
        for _ in range(14):
            text = list(base)
            for _ in range(rng.randrange(7)):
                text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
            base = text if group % 3 == 0 else base  # every third group is a chain
    passage = " ".join(f"common{i}" for i in range(60))
    rows += [(len(rows) + i, f"{passage} " + " ".join(f"own{i}x{j}" for j in range(40))) for i in range(60)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, node string, band string")
    for n, percent in ((4, 80), (5, 80), (3, 90)):
        check(listed(near_dups.near_duplicates(frame, n, percent)), brute(rows, n, percent))


def test_odd_texts(odd_docs, no_docs):
    rows = listed(near_dups.near_duplicates(odd_docs, 4, 80))
    assert len(rows) == odd_docs.count()
    named = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    want = brute([(r["doc_id"], r["text"]) for r in odd_docs.where("doc_id is not null").select("doc_id", "text").collect()], 4, 80)
    check(named.values(), want)
    assert [(r["component_id"], r["kept"]) for r in rows if r["doc_id"] is None] == [(None, True)] * 2
    kept = near_dups.keep_one_of_each(odd_docs, 4, 80)
    assert kept.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=repr)
    assert ids == sorted([*{i for i, (_, least) in want.items() if i == least}, None, None], key=repr)
    assert near_dups.near_duplicates(no_docs).count() == 0 and near_dups.keep_one_of_each(no_docs).count() == 0


def test_sketches_spare_pairs_but_lose_none():
    limit = near_dups.widest_distance(80)
    rng = np.random.default_rng(2)
    samples, bits = near_dups.SAMPLES, near_dups.SKETCH_BITS
    for similarity, least_passed, most_passed in ((0.8, 2000, 2000), (0.6, 0, 20)):
        passed = 0
        for _ in range(2000):
            differing = rng.binomial(samples, 1 - similarity)
            flips = np.bincount(rng.integers(0, bits, 2 * differing), minlength=bits) % 2
            passed += flips.sum() <= limit
        assert least_passed <= passed <= most_passed


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7)]
    root = {i: i for i in range(1000)}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: find(i) for i in nodes}

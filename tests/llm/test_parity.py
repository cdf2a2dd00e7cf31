"""Parity bitmaps of whole sets: what they may and may not give up."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from probelake.llm import near_dups
from probelake.llm.near_dups import near_duplicates, parity_levels, parity_maps, widest_parity

from .conftest import listed


def maps(sets, levels):
    values = np.concatenate([np.array(sorted(s), np.uint64) for s in sets])
    return parity_maps(values, np.array([len(s) for s in sets]), np.array(levels))


def count(a, b):
    return int(np.unpackbits((a ^ b).view(np.uint8)).sum())


@pytest.fixture(scope="module")
def limits(spark):
    cases = [(total, level) for total in (20, 100, 294, 600, 3000, 4000, 9000, 40_000) for level in (0, 1, 2, 5)]
    df = spark.createDataFrame(cases, "total long, level int")
    rows = df.select("total", "level", widest_parity(F.col("total"), F.col("level"), 80).alias("w")).collect()
    return {(r["total"], r["level"]): r["w"] for r in rows}


@pytest.mark.parametrize("n", [10, 50, 147, 300, 1500, 2000])
def test_sets_at_the_threshold_are_never_given_up(limits, n):
    draw = np.random.default_rng(n)
    apart = 2 * n // 9
    worst = 0
    for _ in range(60):
        pool = draw.integers(0, 2**63, n + apart, dtype=np.uint64)
        left, right = set(pool[:n].tolist()), set(pool[apart // 2 : n + apart // 2 + apart % 2].tolist())
        differ = len(left ^ right)
        a, b = maps([left, right], [0, 0])
        assert count(a, b) <= differ and (count(a, b) - differ) % 2 == 0
        worst = max(worst, count(a, b))
    if (2 * n, 0) in limits:
        assert worst <= limits[2 * n, 0] <= 2 * n / 9


def test_levels_of_larger_sets_are_shared_by_partners(limits):
    assert parity_levels(np.array([0, 1, 2047, 2048, 4095, 4096, 20_000])).tolist() == [0, 0, 0, 1, 1, 2, 4]
    draw = np.random.default_rng(3)
    pool = draw.integers(0, 2**63, 5000, dtype=np.uint64)
    for apart, alike in ((400, True), (900, True), (2400, False)):
        left, right = set(pool[:4500].tolist()), set(pool[apart // 2 : 4500 - apart // 2].tolist()) | set(
            draw.integers(0, 2**63, apart // 2, dtype=np.uint64).tolist()
        )
        a, b = maps([left, right], [2, 2])
        assert (count(a, b) <= limits[9000, 2]) == alike


def copies(n, words=300, edits=6, seed=0):
    draw = np.random.default_rng(seed)
    base = [f"word{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for at in draw.choice(words, edits, replace=False):
            text[at] = f"new{i}x{at}"
        out.append((i, " ".join(text)))
    return out


@pytest.mark.parametrize("edits", [2, 4, 6])
def test_pairs_to_confirm_follow_the_size_of_a_group_of_copies(spark, edits, monkeypatch):
    found = []
    confirmed = near_dups._confirmed

    def counting(pairs, *rest):
        found.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_dups, "_confirmed", counting)
    totals = {}
    for n in (100, 200):
        found.clear()
        data = copies(n, edits=edits)
        got = {r["doc_id"]: r["component_id"] for r in listed(near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), n=4))}
        totals[n] = sum(found)
        sets = [{tuple(t.split()[i : i + 4]) for i in range(297)} for _, t in data]
        group = list(range(n))
        for a in range(n):
            for b in range(a):
                if group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    low, high = sorted((group[a], group[b]))
                    group = [low if g == high else g for g in group]
        assert got == dict(enumerate(group))
    assert totals[200] <= 4 * 200, totals


def test_a_group_whose_first_document_is_gone_is_held_together_by_its_centre(spark, monkeypatch):
    found = []
    between = near_dups._between_components

    def counting(*args):
        pairs = between(*args)
        found.append(pairs.count() if pairs is not None else 0)
        return pairs

    monkeypatch.setattr(near_dups, "_between_components", counting)
    # Each has 0 to 9 of 300 words changed; the smallest ids are the furthest away.
    data = [(9 * i + 9 - e, text) for e in range(1, 10) for i, text in copies(30, edits=e, seed=e)] + [(5000, copies(1, edits=0)[0][1])]
    got = listed(near_duplicates(spark.createDataFrame(data, "doc_id long, text string"), n=4))
    sizes = sorted((sum(1 for r in got if r["component_id"] == c) for c in {r["component_id"] for r in got}), reverse=True)
    assert sizes[0] >= 8 * 30 and found[0] <= len(data)

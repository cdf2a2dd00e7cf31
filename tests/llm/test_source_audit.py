import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from probelake.llm import source_audit
from probelake.llm.source_audit import Quadtree, audit, common_leaves

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    """``rows``: lang, source, text."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = TERM.findall(lowered)
        docs[lang].update(set(found))
        counts[lang, source].update(found)
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [term for term, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def chances(count, kept=kept, v=v):
            n = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: chances(counts[lang, s]) for s in sources}
        q = chances(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items[:most])]
    return sorted(out)


def words(seed, n, common):
    draw = np.random.default_rng(seed)
    return " ".join(f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in draw.integers(0, common, n))


@pytest.fixture(scope="module")
def corpus():
    rows = [("en" if i % 3 else "de", f"s{i % 7}", words(i, 30 + 5 * (i % 7), 20 + 10 * (i % 5))) for i in range(120)]
    rows += [("en", "hot", words(1000 + i, 40, 25)) for i in range(60)]
    rows += [("en", "hot", "É straße ÉÉ don't_stop X1Y 東京 ﬁ")] * 6 + [("en", "", "\0 \x7f[]{}` ÉÉ")] * 6
    rows += [("fr", "s1", "rare words only"), ("fr", "s2", None), (None, "s1", "")]
    return rows + [(None, None, None), ("", None, "x"), ("en", "only", "12 34")]


@pytest.mark.parametrize("tile, block", [(128, 1024), (2, 16), (1, 3)])
def test_equals_brute_force(spark, corpus, tile, block):
    docs = spark.createDataFrame(corpus, "lang string, source string, text string").repartition(5)
    got = sorted(tuple(r) for r in audit(docs, min_docs=4, top=3, tile=tile, block=block).collect())
    want = brute(corpus, 4, 3)
    assert got == want
    assert any(r[0] == "fr" and r[2] == "pair" and r[4] == 0 for r in got)


def test_few_terms_are_held_by_a_worker(spark, corpus, monkeypatch):
    monkeypatch.setattr(source_audit, "HELD", 5)
    docs = spark.createDataFrame(corpus, "lang string, source string, text string")
    assert sorted(tuple(r) for r in audit(docs, 4, 3).collect()) == brute(corpus, 4, 3)


def test_odd_rows_and_clashing_names(odd_docs, no_docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    clash = odd_docs
    for name in ("term", "count", "docs", "tile", "at", "value", "rank"):
        clash = clash.withColumn(name, odd_docs["source"])
    assert sorted(tuple(r) for r in audit(clash, 2, 5).collect()) == brute(rows, 2, 5)
    assert audit(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_trees_meet_in_the_columns_that_both_rows_hold(seed):
    draw = np.random.default_rng(seed)
    a, b = (draw.random((9, 37)) < 0.2 for _ in range(2))
    cells = [(np.nonzero(m)[0].astype(np.int64), np.nonzero(m)[1].astype(np.int64)) for m in (a, b)]
    one, other = (Quadtree(r, c, r * 1000 + c, 6) for r, c in cells)
    met = sorted((int(g), int(s), int(x), int(y)) for part in common_leaves(one, other, False) for g, s, x, y in zip(*part, strict=True))
    assert met == sorted((g, s, g * 1000 + c, s * 1000 + c) for g in range(9) for s in range(9) for c in range(37) if a[g, c] and b[s, c])
    own = sorted((int(g), int(s)) for part in common_leaves(one, one, True) for g, s, *_ in zip(*part, strict=True))
    assert own == sorted((g, s) for g in range(9) for s in range(g + 1, 9) for c in range(37) if a[g, c] and a[s, c])


def test_empty_quadrants_are_not_stored():
    tree = Quadtree(np.zeros(4, np.int64), np.arange(4), np.arange(4), 10)
    assert [len(level) for level in tree.levels] == [1] * 9 + [2, 4]


def test_terms_are_tallied_without_a_loop_over_another_counter():
    class Told(Counter):
        def update(self, given=None, /):
            assert given is None or isinstance(given, list | set)
            super().update(given or ())

    counts, rows = Told(), Told()
    for text in (b"a b a", b"b c", b""):
        source_audit.tally(counts, rows, text.split())
    assert counts == {b"a": 2, b"b": 2, b"c": 1} and rows == {b"a": 1, b"b": 2, b"c": 1}

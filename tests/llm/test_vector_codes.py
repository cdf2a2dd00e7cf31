import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from probelake.llm import vector_codes
from probelake.llm.vector_codes import compress, distances, packed, reassign, unpacked

from .conftest import listed

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def brute(rows, parts=8, entries=16, rounds=6):
    """``rows``: id, vector, label; plain Lloyd with Python's integers."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], ""
    width = len(kept[0][1])
    whole = [[math.floor(x) if abs(x) > 1e300 else math.floor(x * 4096) for x in r[1]] for r in kept]
    size = width // parts
    cut = [[tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for done in range(rounds + 1):
        codes = [[min((far(v[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)] for v in cut]
        if done == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [v[p] for v, c in zip(cut, codes, strict=True) if c[p][1] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    errors = [sum(d for d, _ in c) for c in codes]
    by_label = defaultdict(int)
    for r, e in zip(kept, errors, strict=True):
        by_label[r[2]] += e
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    long = lambda x: x if x < 2**63 else None
    out = [(r[0], "".join(f"{i:02x}" for _, i in c), long(e), long(by_label[r[2]])) for r, c, e in zip(kept, codes, errors, strict=True)]
    return sorted(out, key=repr), hashlib.sha256(numbers.encode()).hexdigest()


def got(spark, rows, repartition=3, **options):
    data = [(*r, "x", "y") for r in rows]
    coded, fitted = compress(spark.createDataFrame(data, SCHEMA).repartition(repartition), **options)
    found = [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in listed(coded)]
    return sorted(found, key=repr), fitted.digest() if fitted else ""


def vectors(n, width=16, seed=0, spread=1.0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(5, width))
    return [
        (i, [float(x) for x in centres[i % 5] * spread + draw.normal(size=width) * 0.2], int(i % 4) if i % 4 else None) for i in range(n)
    ]


def test_equals_plain_lloyd(spark):
    rows = vectors(150)
    # Copies, a hot vector, repeated ids, nulls and what takes no part.
    rows += [(200 + i, rows[7][1], 9) for i in range(60)] + [rows[3], (3, rows[4][1], 1), (None, rows[5][1], 1)]
    rows += [(300, None, 1), (301, [], 1), (302, [1.0, None] * 8, 1), (303, [math.nan] * 16, 1), (304, [math.inf] + [0.0] * 15, 1)]
    assert got(spark, rows) == brute(rows)


def test_other_lengths_take_no_part(spark):
    rows = vectors(30)
    odd = [(500, [0.5] * 15, 1), (501, [0.5] * 24, 1), (-1, [0.5] * 3, 2)]
    assert got(spark, rows + odd) == brute(rows)


@pytest.mark.parametrize("scale", [1e4, 1e7, 1e12, 1e40])
def test_large_components_stay_exact(spark, scale):
    rows = [(i, [x * scale for x in v], label) for i, v, label in vectors(40, 8)]
    assert got(spark, rows, rounds=3) == brute(rows, rounds=3)


def test_few_rows_and_none(spark):
    assert got(spark, vectors(5)) == brute(vectors(5))
    assert got(spark, []) == ([], "")
    assert got(spark, [(1, None, 2)]) == ([], "")


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 7)
    assert got(spark, vectors(90), 5) == brute(vectors(90))


@pytest.mark.parametrize("seed", range(6))
def test_active_entries_give_what_a_rescan_gives_for_less(seed):
    draw = np.random.default_rng(seed)
    parts = draw.integers(-3, 4, (400, 2))
    book = draw.integers(-3, 4, (16, 2))
    every = np.ones(16, bool)
    code, apart, n = reassign(parts, book, every, np.zeros(400, np.int64), np.zeros(400, np.int64))
    assert n == 400 * 16
    for _ in range(5):
        moved = draw.random(16) < 0.3
        book = np.where(moved[:, None], draw.integers(-3, 4, book.shape), book)
        stayed = int((~moved[code]).sum())
        code, apart, n = reassign(parts, book, moved, code, apart)
        want = ((parts[:, None] - book[None]) ** 2).sum(2)
        assert code.tolist() == want.argmin(1).tolist() and apart.tolist() == want.min(1).tolist()
        assert n == (400 - stayed) * 16 + stayed * int(moved.sum())


def test_integers_survive_packing():
    for values in ([0], [-32768, 32767], [-32767], [2**31, -5], [2**63 - 1], [2**63, -(2**90)], []):
        assert unpacked(packed(np.array(values, object))).tolist() == values


@pytest.mark.parametrize("most", [100, 2**20, 2**29, 2**40])
def test_distances_are_exact_at_every_size(most):
    draw = np.random.default_rng(1)
    parts, book = draw.integers(-most, most, (20, 8)), draw.integers(-most, most, (4, 8))
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(a, b, strict=True)) for b in book] for a in parts]
    assert distances(parts, book).tolist() == want

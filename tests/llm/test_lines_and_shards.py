import hashlib
import zlib
from collections import Counter, defaultdict

from probelake.llm import line_dedup, sharding
from probelake.llm.queries import QUERIES

from .conftest import listed, texts

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def key(line):
    return line.strip(BLANKS).translate(LOWER)


def brute_lines(rows, min_docs, min_chars):
    found = Counter(k for _, text in rows for k in {key(line) for line in (text or "").split("\n")} if len(k) >= min_chars)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not found.get(key(line), 0) >= min_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


def test_lines_of_odd_texts(odd_docs):
    pairs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    for least, chars in ((10, 1), (2, 5), (1, 0)):
        got = line_dedup.drop_common_lines(odd_docs, least, chars)
        mine = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in got.collect()), key=repr)
        assert mine == brute_lines(pairs, least, chars)
    others = [c for c in odd_docs.columns if c not in ("n_lines", "n_dropped")]
    assert got.columns == [*others, "n_lines", "n_dropped"]


def test_lines_of_nothing(no_docs):
    assert line_dedup.drop_common_lines(no_docs).count() == 0


def test_lines_of_whole_table(spark, sf_dir):
    pairs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {d: (n, gone, hashlib.sha256((t or "").encode()).hexdigest()) for d, n, gone, t in brute_lines(pairs, 10, 1)}
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in listed(QUERIES["op9_line_dedup"](spark, sf_dir))}
    assert got == want


def check_shards(rows, pairs, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in pairs
    )
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert set(slots) <= set(range(shards))
    return sizes


def test_shards_of_odd_texts(odd_docs, no_docs):
    pairs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    check_shards(listed(sharding.shard_by_bytes(odd_docs, 3)), pairs, 3)
    assert sharding.shard_by_bytes(no_docs).count() == 0
    assert len(texts()) < len(pairs)


def test_shards_of_whole_table_are_even(spark, sf_dir):
    pairs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sizes = check_shards(listed(QUERIES["op10_sharding"](spark, sf_dir)), pairs, 8)
    mean = sum(sizes.values()) / 8
    slack = max(len((t or "").encode()) for _, t in pairs) + mean / 50
    assert all(abs(size - mean) <= slack for size in sizes.values())


def test_a_hot_text_is_subdivided(spark):
    docs = spark.range(20_000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, repeat('copy ', 20), concat('text ', id, repeat(' x', 40))) as text"
    )
    rows = listed(sharding.shard_by_bytes(docs, 8, ranges=256))
    sizes, copies = Counter(), Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
        copies[r["shard"]] += r["size"] == 101
    assert max(sizes.values()) < 1.1 * min(sizes.values())
    assert sum(n > 0 for n in copies.values()) <= 4


def test_small_groups_stay_together(spark):
    docs = spark.range(9_000).selectExpr("id as doc_id", "concat('text ', id % 3000) as text")
    where = defaultdict(set)
    for r in listed(sharding.shard_by_bytes(docs, 8, ranges=256)):
        where[r["text_crc32"], r["size"]].add(r["shard"])
    assert sum(len(s) > 1 for s in where.values()) == 0

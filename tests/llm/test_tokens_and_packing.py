import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from probelake.llm import chunk_bpe, packing, tokens
from probelake.llm.common import byte_tokenizer_file, tokenizer_file
from probelake.llm.queries import QUERIES

from .conftest import listed, texts


@pytest.fixture(scope="module")
def library():
    return tokens.load(tokenizer_file())


ALPHABET = "abcXYZ éÉßñµ²½'’st.,!#  \n\t\x1c\x85\xa0 ́ÅİΣσ東京９٣<|endoftext|>"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*ALPHABET, "<|endoftext|>", "don't", "the "]), max_size=60).map("".join))
def test_words_give_the_library_s_ids(text):
    encoder = tokens.WordEncoder.here(tokenizer_file())
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
    assert encoder.decode(encoder.encode(text)) == encoder.tokenizer.decode(want, skip_special_tokens=False)


def test_a_file_of_another_make_goes_through_its_tokenizer(spark, odd_docs):
    other = tokens.load(byte_tokenizer_file())
    words, chunks = tokens.WordEncoder(byte_tokenizer_file()), chunk_bpe.ChunkEncoder(byte_tokenizer_file())
    assert not words.known and tokens.WordEncoder(tokenizer_file()).known
    for text in [*(t or "" for t in texts()), "Upper  CASE\n é"]:
        want = other.encode(text, add_special_tokens=False).ids
        for encoder in (words, chunks):
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want
            assert encoder.decode(encoder.encode(text)) == other.decode(want, skip_special_tokens=False)
    pieces = listed(packing.pack_documents(odd_docs, byte_tokenizer_file(), 512))
    for row in (r for r in pieces if r["doc_id"] == 9):
        assert row["ids"] == [*other.encode(texts()[9], add_special_tokens=False).ids, 1]


def test_chunks_give_the_library_s_ids_and_are_reused(library):
    encoder = chunk_bpe.ChunkEncoder(tokenizer_file())
    passage = " ".join(f"shared{i} passage, with words" for i in range(400))
    for text in [*(t or "" for t in texts()), f"one {passage} end", f"quite another start {passage}", "é" * 5000, "x" * 20_000]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.reused >= 5 and encoder.repaired == 0


def test_a_join_that_disagrees_is_repaired(library):
    encoder = chunk_bpe.ChunkEncoder(tokenizer_file())
    encoder._agrees = lambda *parts: False
    text = " ".join(f"word{i}" for i in range(2000))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.repaired == 1


def test_cuts_depend_on_content_and_keep_characters_whole():
    gear = chunk_bpe._gear()
    shared = "".join(chr(97 + (i * 7919) % 26) + "é" * (i % 3 == 0) for i in range(20_000)).encode()
    first, second = chunk_bpe.cut_points(shared, gear), chunk_bpe.cut_points(b"moved " + shared, gear)
    assert len({e + 6 for e in first} & set(second)) > len(first) * 0.8
    for a, b in zip([0, *first], first, strict=False):
        shared[a:b].decode()


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_encoded_documents(spark, sf_dir, odd_docs, no_docs, library):
    got = listed(chunk_bpe.encode_documents(odd_docs, tokenizer_file()))
    want = Counter((r["doc_id"], *digests(library, r["text"])) for r in odd_docs.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)
    assert chunk_bpe.encode_documents(no_docs, tokenizer_file()).count() == 0
    docs = {r["doc_id"]: digests(library, r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    whole = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in listed(QUERIES["op7_chunk_bpe"](spark, sf_dir))}
    assert whole == docs


def pieces_of(library, doc_id, text, capacity):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
    cut = ((at, ids[at : at + capacity]) for at in range(0, len(ids), capacity))
    return [(doc_id, i, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())) for i, (at, own) in enumerate(cut)]


def check_packed(rows, want, capacity):
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == Counter(want)
    packed = defaultdict(list)
    for r in rows:
        packed[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in packed.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(packed)


def test_packed_documents(spark, sf_dir, odd_docs, no_docs, library):
    rows = listed(packing.pack_documents(odd_docs, tokenizer_file(), 64))
    want = [p for r in odd_docs.select("doc_id", "text").collect() for p in pieces_of(library, r["doc_id"], r["text"], 64)]
    check_packed(rows, want, 64)
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert packing.pack_documents(no_docs, tokenizer_file()).count() == 0
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = [p for r in docs for p in pieces_of(library, r["doc_id"], r["text"], 4096)]
    used = check_packed(listed(QUERIES["op5_packing"](spark, sf_dir)), want, 4096)
    assert used <= -(-sum(p[3] for p in want) // 4096) + 2


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=30))
def test_plans_place_every_piece_once(histogram):
    rows, used = packing.plan_packing(histogram, 64)
    placed, ranks = defaultdict(list), defaultdict(list)
    for length, rank, count, sequence, offset in rows:
        ranks[length] += range(rank, rank + count)
        for i in range(count):
            placed[sequence + i].append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    assert len(placed) == used
    for own in placed.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64


def test_plans_come_near_the_bound():
    lengths = np.minimum(np.random.default_rng(5).lognormal(6.3, 1.2, 50_000).astype(int) + 1, 4096)
    histogram = dict(Counter(lengths.tolist()))
    _, used = packing.plan_packing(histogram, 4096)
    assert used <= 1.001 * -(-int(lengths.sum()) // 4096) + 1


def test_least_squares():
    rng = np.random.default_rng(3)
    a, x = rng.random((20, 30)), np.where(rng.random(30) < 0.3, rng.random(30), 0)
    found = packing.non_negative_least_squares(a, a @ x)
    assert (found >= 0).all() and np.allclose(a @ found, a @ x, atol=1e-6)


def test_words_and_pieces_share_the_memory(library):
    encoder = tokens.WordEncoder(tokenizer_file(), remembered=20)
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)},x" for i in range(300))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sum(len(held) for held in vars(encoder).values() if isinstance(held, dict) and held is not encoder.alphabet) <= 2 * 20

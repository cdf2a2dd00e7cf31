import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from probelake.llm import harmonic_packing, tokens
from probelake.llm.byte_tokens import ByteEncoder, merge_ranks
from probelake.llm.common import byte_tokenizer_file, table, tokenizer_file
from probelake.llm.harmonic_packing import harmonic_bins, pack_documents, plan_lot

from .conftest import listed, texts

ALPHABET = "abcXYZ éÉßñµ²½'’st.,!#  \n\n\t\r\x1c\x85\xa0　́ÅİΣσ東京９٣😀"


@pytest.fixture(scope="module")
def library():
    return tokens.load(byte_tokenizer_file())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*ALPHABET, "<|endoftext|>", "don't", " the"]), max_size=60).map("".join))
def test_the_library_s_ids(text):
    encoder = ByteEncoder.here(byte_tokenizer_file())
    assert encoder.ordinary is not None
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library(text)


def test_a_file_of_another_make_goes_through_the_library():
    encoder = ByteEncoder.here(tokenizer_file())
    assert encoder.ordinary is None
    for text in texts():
        assert np.frombuffer(encoder.encode(text or ""), "<u4").tolist() == tokens.load(tokenizer_file()).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("change", ["normalizer", "prefix", "merges", "dropout"])
def test_a_changed_file_is_not_taken_for_the_known_make(change):
    with open(byte_tokenizer_file(), encoding="utf-8") as file:
        spec = json.load(file)
    assert merge_ranks(spec) is not None
    if change == "normalizer":
        spec["normalizer"] = {"type": "Lowercase"}
    elif change == "prefix":
        spec["pre_tokenizer"]["add_prefix_space"] = True
    elif change == "merges":
        spec["model"]["merges"][:2] = spec["model"]["merges"][1::-1]
    else:
        spec["model"]["dropout"] = 0.1
    assert merge_ranks(spec) is None


def test_classes_share_sequences_by_their_number():
    lengths = [600, 1024, 400, 500, 350, 350, 350, 200] + [10] * 200
    bins = harmonic_bins(lengths, list(range(len(lengths))), 1024)
    assert bins[:6] == [[0], [1], [2, 3], [4, 5], [6], [7]]
    small = [own for own in bins if own[0] >= 8]
    assert [len(own) for own in small] == [102, 98]
    for own in bins:
        k = 1024 // lengths[own[0]]
        assert len({1024 // lengths[d] for d in own}) == 1 and (k >= 16 or len(own) <= k)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=80), st.sampled_from([8, 16, 24]), st.sampled_from([2, 4, 16]))
def test_every_plan_is_whole_and_full(lengths, capacity, small):
    pieces, used = plan_lot(lengths, capacity, small)
    of_sequence, of_document = defaultdict(list), defaultdict(list)
    for doc, start, n, sequence, offset in pieces:
        of_sequence[sequence].append((offset, n))
        of_document[doc].append((start, n))
    assert set(of_sequence) == set(range(used)) and set(of_document) == set(range(len(lengths)))
    for sequence, own in of_sequence.items():
        end = 0
        for offset, n in sorted(own):
            assert offset == end and n > 0
            end += n
        assert end == capacity or (end < capacity and end & (end - 1) == 0)
    for doc, own in of_document.items():
        end = 0
        for start, n in sorted(own):
            assert start == end
            end += n
        assert end == lengths[doc]


def test_documents_that_fit_stay_whole_where_long_ones_fill_the_gaps():
    lengths = [500] * 40 + [300] * 60 + [20_000]
    pieces, used = plan_lot(lengths, 1024)
    assert {doc for doc, _, n, _, _ in pieces if n < lengths[doc]} == {100}
    assert used == pytest.approx(sum(lengths) / 1024, abs=8)
    counts = defaultdict(Counter)
    for doc, _, _, sequence, _ in pieces:
        counts[sequence][lengths[doc]] += 1
    assert all(c[500] in (0, 2) and c[300] in (0, 3) for c in counts.values())


def held_against_the_library(library, docs, rows, capacity):
    by_sequence, by_id = defaultdict(list), defaultdict(list)
    for row in rows:
        by_sequence[row["sequence_id"]].append((row["offset"], row["length"]))
        by_id[row["doc_id"]].append((row["start"], row["length"], row["ids_crc32"], row["doc_tokens"]))
    for own in by_sequence.values():
        end = 0
        for offset, n in sorted(own):
            assert offset == end
            end += n
        assert end == capacity or end & (end - 1) == 0
    want = defaultdict(list)
    for doc_id, text in docs:
        want[doc_id].append([*library.encode(text or "", add_special_tokens=False).ids, 0])
    assert set(by_id) == set(want)
    for doc_id, all_ids in want.items():
        if len(all_ids) > 1:
            assert sum(n for _, n, _, _ in by_id[doc_id]) == sum(map(len, all_ids))
            continue
        (ids,), end = all_ids, 0
        for start, n, crc, tokens_of in sorted(by_id[doc_id]):
            assert start == end and tokens_of == len(ids)
            assert crc == zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())
            end += n
        assert end == len(ids)


def test_whole_table(spark, sf_dir, library):
    docs = table(spark, sf_dir, "documents")
    rows = listed(pack_documents(docs, byte_tokenizer_file(), with_ids=False))
    held_against_the_library(library, [(r["doc_id"], r["text"]) for r in docs.collect()], rows, 1024)
    # Documents that fit are cut only as far as the gaps need it.
    cut = {r["doc_id"] for r in rows if r["length"] < r["doc_tokens"] <= 1024}
    assert len(cut) <= docs.count() / 4


def test_odd_rows_and_several_lots(odd_docs, no_docs, library):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    for lot in (1, 300, harmonic_packing.LOT):
        held_against_the_library(library, docs, listed(pack_documents(odd_docs, byte_tokenizer_file(), lot=lot, with_ids=False)), 1024)
    assert pack_documents(no_docs, byte_tokenizer_file()).collect() == []


def test_ids_are_told_when_asked_for(odd_docs):
    for row in pack_documents(odd_docs, byte_tokenizer_file(), capacity=64).collect():
        assert len(row["ids"]) == row["length"] <= 64
        assert zlib.crc32(np.array(row["ids"], "<u4").tobytes()) == row["ids_crc32"]

from __future__ import annotations

import struct
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spindlewave.llm import packing, rans, tokens
from spindlewave.session import work_dir
from tests.llm.conftest import odd_rows

PIECES = ["the", "It's", "don't", "a", " ", "  ", "\n", ",", ".", "!!", "'", "'s", "é", "É", "İ", "ß", "1", "23", "²", "…",
          "一二", "😀", "<|endoftext|>", "<|", "|>", "́", "\x1c", "\u2003", "_", "x*y", "Σ", "ﬁ", "×", "÷", "\x00"]


@pytest.fixture(scope="module")
def plain(tokenizer):
    return Tokenizer.from_file(tokenizer)


def ids_of(encoder, texts):
    found = []
    for _, ids, places in encoder.encode(pa.array(texts, pa.string())):
        found += [ids[a:b].tolist() for a, b in zip(places[:-1], places[1:], strict=True)]
    return found


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.lists(st.sampled_from(PIECES)).map("".join), st.text(max_size=20)), max_size=6))
def test_ids_are_those_of_the_tokenizer(texts):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = tokens.kept("plain", lambda: Tokenizer.from_file(path))
    expected = [plain.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert ids_of(tokens.encoder(path), texts) == expected


def test_memory_grows_and_begins_anew(tokenizer, plain, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 50)
    encoder = tokens.Encoder(tokenizer)
    for part in range(20):
        texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + (i * part) % 26)}{'z' * (i % 5)}" for i in range(200))]
        assert ids_of(encoder, texts) == [plain.encode(texts[0], add_special_tokens=False).ids]
    memory = tokens.Memory(np.uint16)
    first = np.arange(1, 200_001, dtype=np.uint64) * np.uint64(65_536)  # all begin at the same slots
    first = first[:3000]
    memory.add(first, first + np.uint64(1), np.arange(3000).astype(np.uint16), np.ones(3000, np.int64))
    entry = memory.find(first, first + np.uint64(1))
    assert (memory.ids[memory.place[entry]] == np.arange(3000)).all()
    assert (memory.find(first, first) == -1).all()  # half a hash is not enough


def least_bins(lengths, capacity):
    """Brute force: the fewest bins."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def put(at, bins):
        if len(bins) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[at] <= capacity and bins[k] not in bins[:k]:
                bins[k] += lengths[at]
                put(at + 1, bins)
                bins[k] -= lengths[at]
        put(at + 1, [*bins, lengths[at]])

    put(0, [])
    return best[0] if lengths else 0


@settings(max_examples=200, deadline=None)
@given(lengths=st.lists(st.integers(1, 20), max_size=11), capacity=st.integers(20, 30))
def test_dominance_loses_no_bin(lengths, capacity):
    counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    rest = counts.copy()
    fixed = packing.reduce_by_dominance(rest, capacity)
    number = sum(times for times, _ in fixed)
    left = [length for length, n in enumerate(rest) for _ in range(n)]
    assert number + least_bins(left, capacity) == least_bins(lengths, capacity)
    bins = packing.plan(counts, capacity)
    used = np.zeros_like(counts)
    for times, content in bins:
        assert sum(length * each for length, each in content) <= capacity
        for length, each in content:
            used[length] += times * each
    assert (used == counts).all()


def test_companions_by_brute_force():
    """Every set that is fixed dominates each feasible one that holds the same piece."""
    random = np.random.default_rng(1)
    for _ in range(200):
        capacity = 30
        lengths = random.integers(4, 30, 9).tolist()
        counts = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
        longest = max(lengths)
        found = packing.companions(counts, longest, capacity)
        if found is None:
            continue
        lengths.remove(longest)
        for size in range(4):
            for other in combinations(lengths, size):
                if longest + sum(other) <= capacity:
                    assert fits_into(list(other), list(found))


def fits_into(items, places):
    """Whether items can be dealt to places without exceeding any."""
    if not items:
        return True
    return any(
        items[0] <= place and fits_into(items[1:], [*places[:k], place - items[0], *places[k + 1 :]])
        for k, place in enumerate(places)
    )


def check_packed(rows, plain, texts, capacity):
    expected = []
    for doc_id, text in texts:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece in range(-(-len(ids) // capacity)):
            part = ids[piece * capacity : (piece + 1) * capacity]
            expected.append((doc_id, piece, piece * capacity, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    found = [tuple(r[:5]) for r in rows]
    assert sorted(found, key=key) == sorted(expected, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packed_documents(spark, odd_docs, no_docs, tokenizer, plain, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 3)  # lengths are ranked in parts
    texts = [(r[0], r[1]) for r in odd_rows()]
    for capacity in (64, 4096):
        rows = packing.pack_documents(odd_docs, tokenizer, capacity).collect()
        number = check_packed(rows, plain, texts, capacity)
        assert number <= -(-sum(r["length"] for r in rows) // capacity) + 1
    assert packing.pack_documents(no_docs, tokenizer).count() == 0
    pieces = packing.token_pieces(odd_docs, tokenizer, 64)
    assert all(len(r["ids"]) == 4 * r["length"] for r in pieces.select("ids", "length").collect())
    with pytest.raises(ValueError, match="length"):
        packing.pack(spark.createDataFrame([(1, 99)], "doc_id long, length long"), ["doc_id"], 64)


@settings(max_examples=60, deadline=None)
@given(
    ids=st.lists(st.integers(0, 60), max_size=700), lanes=st.sampled_from([1, 3, 16]), every=st.sampled_from([1, 2, 7])
)
def test_coder_round_trip(ids, lanes, every):
    ids = np.array(ids, np.uint32)
    frequencies = rans.shared_frequencies(np.bincount(ids, minlength=70))
    assert not len(ids) or frequencies.sum() == 1 << rans.SCALE
    coder = rans.Coder(frequencies, lanes, every)
    frame = coder.encode(ids)
    assert (coder.decode(frame) == ids).all()
    for at in (0, len(frame) // 2, len(frame) - 1):
        damaged = bytearray(frame)
        damaged[at] ^= 1
        with pytest.raises(rans.Damaged):
            coder.decode(bytes(damaged))


def test_coder_is_near_the_entropy():
    random = np.random.default_rng(0)
    ids = np.minimum(random.geometric(0.05, 1 << 19), 200).astype(np.uint32)
    counts = np.bincount(ids, minlength=201)
    share = counts[counts > 0] / len(ids)
    bits = -(share * np.log2(share)).sum() * len(ids)
    coder = rans.Coder(rans.shared_frequencies(counts), 1024, 256)  # as files are written
    frame = coder.encode(ids)
    words = struct.unpack_from(rans.HEADER, frame)[-1]
    assert 32 * words < 1.001 * bits  # the code itself
    assert 8 * len(frame) < 1.05 * bits  # with checkpoints
    other = rans.Coder(rans.shared_frequencies(counts + 1))
    with pytest.raises(rans.Damaged, match="table"):
        other.decode(coder.encode(ids))


def test_files(spark, odd_docs, no_docs, tokenizer, plain):
    path = work_dir(spark, "rans-test")
    ids = rans.token_table(odd_docs, tokenizer)
    from spindlewave.llm.common import stored

    rans.write_blocks(stored(ids, "ids"), path, block_tokens=500, lanes=8, every=4)
    rows = rans.read_blocks(spark, path).orderBy("file_no", "block_no", "nth").collect()
    texts = {}
    for r in odd_rows():
        texts.setdefault(r[0], []).append([*plain.encode(r[1] or "", add_special_tokens=False).ids, 1])
    start, last = 0, None
    for r in rows:
        assert r["start"] == start
        assert last is None or (r["doc_id"] is not None and r["doc_id"] >= last)
        found = np.frombuffer(r["ids"], "<u4").tolist()
        texts[r["doc_id"]].remove(found)
        assert (len(found), zlib.crc32(r["ids"])) == (r["n_tokens"], r["ids_crc32"])
        start, last = start + len(found), r["doc_id"] if r["doc_id"] is not None else last
    assert not any(texts.values())
    empty = work_dir(spark, "rans-empty")
    rans.encode_documents(no_docs, empty, tokenizer)
    assert rans.read_blocks(spark, empty).count() == 0


def test_wide_ids(spark):
    column = pa.array([rans.packed(np.array([1, 70_000], np.uint32)), rans.packed(np.array([5, 6], np.uint16))])
    assert [x.tolist() for x in rans.unpacked(column)] == [[1, 70_000], [5, 6]]


def test_a_tokenizer_that_cuts_elsewhere_gets_whole_texts(tokenizer):
    import public_tokenizers

    texts = ["Two  words, and don't 12", "", None, "a\n\nb\tc", "Ünïcödé 一二三 😀", " lead and trail "]
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert tokens.cuttable(tokenizer) and not tokens.cuttable(other)
    for path in (tokenizer, other):
        library = Tokenizer.from_file(path)
        found = [x for _, ids, places in tokens.Encoder(path).encode(pa.array(texts)) for x in np.split(ids, places[1:-1])]
        assert [x.tolist() for x in found] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]

"""Tokenising and packing: ids against the tokenizer library, plans against their rules."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwright.llm import packing
from cartwright.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


ENCODE = None


def encode(text):
    global ENCODE
    ENCODE = ENCODE or packing.ByteLevelEncoder(PATH)
    return np.frombuffer(ENCODE(text), "<u4").tolist()


ODD = "aZé's ,.!\n\t\r\x0b\x1c\x85\xa0 　😀<|endoftext|>0́中"
MARK = "<|endoftext|>"
LIBRARY = Tokenizer.from_file(PATH)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*ODD, MARK]), max_size=40).map("".join) | st.text(max_size=20))
def test_ids_are_those_of_the_tokenizer(text):
    assert encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    ["", " ", "  a", "a  ", "a   b", " a b ", "don't we'll", "x \n y\n\nz", "word " * 9000, MARK, MARK * 2, f"{MARK} x {MARK}",
     f"a {MARK} b", f"a{MARK}b", f" {MARK}\n", f"<|end{MARK}oftext|>"],
)
def test_ids_of_odd_texts(reference, text):
    assert encode(text) == reference(text)


def test_words_beyond_the_memo(monkeypatch, reference):
    monkeypatch.setattr(packing, "MEMO_WORDS", 1)
    text = "one two three two one " + "x" * 50 + " " + "x" * 50
    assert np.frombuffer(packing.ByteLevelEncoder(PATH)(text), "<u4").tolist() == reference(text)


@pytest.mark.parametrize("n", [1, 2, 1023, 1024, 1025, 2048, 2049, 5000])
def test_only_the_first_piece_is_shorter(n):
    pieces = packing.cut(n, 1024)
    assert [s for s, _ in pieces] == [sum(k for _, k in pieces[:i]) for i in range(len(pieces))]
    assert sum(k for _, k in pieces) == n and all(k == 1024 for _, k in pieces[1:])
    assert len(pieces) == -(-n // 1024)


def _sequences(plan, counts):
    """Contents of every sequence, by offset."""
    bins = {}
    for size, n in counts.items():
        slots = plan[plan["size"] == size].to_dict("records")
        for slot, after in zip(slots, [*slots[1:], {"rank": n}]):
            for r in range(slot["rank"], after["rank"]):
                k = r - slot["rank"]
                at = (slot["offset"] + k % slot["per"] * size, size)
                bins.setdefault(slot["sequence"] + k // slot["per"], []).append(at)
    return {b: sorted(items) for b, items in bins.items()}


def _matched(counts, capacity):
    """Sequences that large pieces need: the most pairs, taken greedily one by one."""
    large = sorted((s for s, n in counts.items() for _ in range(n) if 3 * s > capacity), reverse=True)
    n = 0
    while large:
        big = large.pop(0)
        fits = next((i for i, s in enumerate(large) if big + s <= capacity), None)
        if fits is not None:
            large.pop(fits)
        n += 1
    return n


@pytest.mark.parametrize("seed", range(25))
def test_plans(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 3, 10, 30, 64])
    counts = {}
    for _ in range(rng.randrange(0, 80)):
        size = rng.randint(1, capacity) if rng.random() < 0.6 else rng.randint(1, max(1, capacity // 4))
        counts[size] = counts.get(size, 0) + rng.choice([1, 1, 1, 5, 40])
    bins = _sequences(packing.packing_plan(counts, capacity), counts)
    assert sorted(bins) == list(range(len(bins)))
    placed = {}
    for items in bins.values():
        end = 0
        for at, size in items:
            assert at == end
            end += size
            placed[size] = placed.get(size, 0) + 1
        assert end <= capacity
    assert placed == counts
    large = {s: n for s, n in counts.items() if 3 * s > capacity}
    n_large = sum(any(3 * s > capacity for _, s in items) for items in bins.values())
    assert n_large == _matched(large, capacity)
    # Best fit: at most one sequence stays half empty, and none was opened while a small piece had room elsewhere.
    used = [sum(s for _, s in items) for items in bins.values() if all(3 * s <= capacity for _, s in items)]
    assert sum(2 * u <= capacity for u in used) <= 1


def _check(rows, texts, reference, capacity):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, copies in texts.items():
        ids = [*reference(copies[0] or ""), 2]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc_id])
        want = [
            (i, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes()))
            for i, (s, n) in enumerate(packing.cut(len(ids), capacity))
        ] * len(copies)
        assert got == sorted(want)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= capacity
    return len(sequences)


def test_documents_become_sequences(documents, reference, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 20)
    rng = random.Random(8)
    words = ["the", "quick", "Füchse", "x", "\n", "1999", ",", "  "]
    texts = {i: [" ".join(rng.choices(words, k=rng.choice([1, 1, 1, 5, 30, 200])))] for i in range(150)}
    texts |= {500: [None], 501: [""], 502: ["long " * 30_000], 503: ["same"] * 40, None: ["no id"]}
    docs = documents(
        [(i, t, None, None) for i, copies in texts.items() for t in copies],
        clash=("piece", "start", "length", "sequence_id", "offset", "size", "rank"),
    )
    rows = packing.pack_documents(docs, PATH, capacity=64, with_ids=True).collect()
    n = _check(rows, texts, reference, 64)
    assert n <= 1.03 * sum(r.length for r in rows) / 64 + 1
    for r in rows:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


def test_no_documents(documents):
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_query(spark, reference):
    rows = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    texts = {r.doc_id: [r.text] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert tokenizer_path() == PATH
    n = _check(rows, texts, reference, 1024)
    assert n <= 1.01 * sum(r.length for r in rows) / 1024 + 1

"""Token counts against the tokenizer library with its default settings, and against plain merging."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cartwright.llm import token_counts
from cartwright.llm.added_tokens import AddedTokens
from cartwright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = token_counts.TokenCounter(PATH)
ODD = "aZé's ,.!\n\t\r\x0b\x1c\x85\xa0 　😀>0́中ݘ𐢼"
MARK = "<|endoftext|>"
TEXTS = [
    "", " ", "  a", "a  ", "a   b", " a b ", "don't we'll", "x \n y\n\nz", "word " * 9000, "x" * 5000, "ab" * 3000,
    MARK, f"{MARK} x {MARK}", f"a {MARK} b", f"a{MARK}b", MARK * 3, f" {MARK}\n", "<|endoftext", f"<|end{MARK}oftext|>",
]


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("text", TEXTS)
def test_counts_of_odd_texts(text):
    assert COUNTER(text) == library(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*ODD, MARK]), max_size=40).map("".join) | st.text(max_size=20))
def test_counts_are_those_of_the_library(text):
    assert COUNTER(text) == library(text)


def _plain_tokens(ranks, word):
    """Merging by a scan for the lowest-ranked pair, leftmost first, over and over."""
    symbols = list(word)
    while True:
        found = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not found:
            return len(symbols)
        _, i = min(found)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def test_heap_and_list_merge_like_scans():
    table, rng = token_counts.MergeTable(PATH), random.Random(3)
    words = ["".join(rng.choices("theandring", k=rng.randrange(1, 40))) for _ in range(300)] + ["", "a", "aaaaaaaaaaaaa"]
    assert [table.tokens(w) for w in words] == [_plain_tokens(table.ranks, w) for w in words]


def test_words_beyond_the_memo(monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_WORDS", 2)
    counter = token_counts.TokenCounter(PATH)
    text = "one two three two one, three  four " + "x" * 50
    assert [counter(text), counter(text)] == [library(text)] * 2
    assert len(counter._words) <= 2 and len(counter._spaced) <= 2


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_counts.MergeTable(public_tokenizers.path("word_bpe_49k.json"))


def test_added_tokens_and_their_flags(tmp_path):
    tokenizer = Tokenizer.from_str(LIBRARY.to_str())
    from tokenizers import AddedToken

    tokenizer.add_tokens([AddedToken("<m>", lstrip=True), AddedToken("<mm>", rstrip=True), AddedToken("one", single_word=True)])
    path = str(tmp_path / "t.json")
    tokenizer.save(path)
    counter, added = token_counts.TokenCounter(path), AddedTokens(path)
    for text in ["a <m> b", "a <mm> \n b", "one ones one.", "<m<m>m>", " <m><mm> ", "none one"]:
        assert counter(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), text
    assert list(added.parts("a <m>")) == ["a", added.ids[added._contents.index("<m>")]]


def test_query_on_whole_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op13_token_counts"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), library(text)) and r.over_limit == (r.n_tokens > 1024)
    assert {r.over_limit for r in got} == {True, False}


def test_odd_rows(documents):
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "word " * 1024, "en", "s"), (3, "word " * 1024, "en", "s")]
    rows += [(None, f"a {MARK} é", None, None), (4, "x" * 200_000, "en", "s")]
    docs = documents(rows, clash=("n_tokens", "n_bytes", "row", "over_limit", "count"))
    got = token_counts.count_tokens(docs, PATH).collect()
    want = sorted((repr(i), len((t or "").encode()), library(t or "")) for i, t, _, _ in rows)
    assert sorted((repr(r.row.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) and r.row.n_tokens == "x" for r in got)
    assert token_counts.count_tokens(documents([]), PATH).collect() == []

"""Token counts by byte-pair merging, without making tokens.

A word's bytes are a linked list; a heap holds its adjacent pairs by merge
rank. The lowest-ranked pair is popped and merged until no pair is left that
the vocabulary merges: the word has as many tokens as bytes minus merges. No
identifier is looked up or emitted, so vocabularies without ids would do.

Texts are cut into words by the file's own pre-tokenizer. A worker remembers
the counts of a bounded number of words; those beyond are merged again.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.added_tokens import AddedTokens
from cartwright.llm.text import packed, whole

LIMIT = 1024
#: A worker remembers the counts of this many words of at most ``MEMO_CHARS`` characters.
MEMO_WORDS = 500_000
MEMO_CHARS = 32

_WIDE_SPACE = re.compile(r" \s|\s ")


class MergeTable:
    """Ranks of the pairs that a byte-level BPE of a ``tokenizers`` file merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        byte_level = (content.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        if model["type"] != "BPE" or not byte_level or content.get("normalizer") or any(model.get(k) for k in odd):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}

    def tokens(self, word: str) -> int:
        """Tokens of one word, given as the characters that stand for its bytes."""
        rank_of = self.ranks.get
        symbols: list[str | None] = list(word)
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [
            (rank, at)
            for at, pair in enumerate(zip(symbols, symbols[1:]))
            if (rank := rank_of(pair)) is not None
        ]
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, left = heapq.heappop(heap)
            right = after[left]
            # A pair whose symbols have been merged with others since is out of date.
            if right >= size or rank_of((symbols[left], symbols[right])) != rank:
                continue
            merges += 1
            symbols[left] += symbols[right]
            symbols[right] = None
            beyond, previous = after[right], before[left]
            after[left] = beyond
            if beyond < size:
                before[beyond] = left
                if (rank := rank_of((symbols[left], symbols[beyond]))) is not None:
                    heapq.heappush(heap, (rank, left))
            if previous >= 0 and (rank := rank_of((symbols[previous], symbols[left]))) is not None:
                heapq.heappush(heap, (rank, previous))
        return size - merges


class TokenCounter:
    """Token counts of texts. A word after a single space counts alike wherever it stands."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        table, cut = MergeTable(path), Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._added, self._cut = AddedTokens(path), cut

        class Words(dict):
            """Pre-tokenizer words."""

            def __missing__(self, word: str) -> int:
                count = table.tokens(word)
                if len(self) < MEMO_WORDS and len(word) <= MEMO_CHARS:
                    self[word] = count
                return count

        words = Words()

        class Spaced(dict):
            """What stands between two single spaces, with the first of them."""

            def __missing__(self, text: str) -> int:
                count = sum(words[word] for word, _ in cut(" " + text))
                if len(self) < MEMO_WORDS and len(text) <= MEMO_CHARS:
                    self[text] = count
                return count

        self._words, self._spaced = words, Spaced()

    def __call__(self, text: str) -> int:
        return sum(1 if isinstance(part, int) else self._plain(part) for part in self._added.parts(text))

    def _plain(self, text: str) -> int:
        if _WIDE_SPACE.search(text):
            words = self._words
            return sum(words[word] for word, _ in self._cut(text))
        first, *rest = text.split(" ")
        return sum(self._words[word] for word, _ in self._cut(first)) + sum(map(self._spaced.__getitem__, rest))


@cache
def _counter(path: str) -> TokenCounter:
    """One counter for all tasks of a worker."""
    return TokenCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = LIMIT) -> DataFrame:
    """``row`` (all input columns), ``n_bytes``, ``n_tokens`` and ``over_limit`` for every row of ``docs``.

    ``tokenizer`` is the path of a byte-level ``tokenizers`` file that every
    worker can open. Whole texts are counted, without begin or end tokens;
    strings of added tokens in a text are one token each. A null or empty text
    has no tokens; rows may repeat, and other columns are passed on unread.
    A word of any length is merged in n log n steps.
    """

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(tokenizer)
        for texts in batches:
            yield pa.array([counter(text.as_py()) for text in texts], pa.int64())

    return docs.select(packed(docs).alias("row"), count(whole()).alias("n_tokens")).select(
        "row",
        F.octet_length(F.coalesce("row.text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )

"""Tokenising documents and packing them into sequences of equal capacity.

Large-item matching: pieces above a third of the capacity fit at most twice
into a sequence and are matched greedily, the largest with the largest that
fits; smaller pieces go, in falling size, to the tightest gap that takes them.

Lengths are whole numbers up to the capacity, so pieces of one length are
interchangeable: the plan is made from the count of pieces per length (at most
``capacity`` numbers) and says which ranks of a length go where. Its size
depends on the capacity alone. Ranks are computed by Spark in hash buckets, so
a length shared by a third of all pieces is spread over many tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.added_tokens import AddedTokens
from cartwright.llm.text import whole
from cartwright.runtime import materialize

CAPACITY = 1024
END = 2
#: Pieces per hash bucket while they are ranked.
BUCKET_ROWS = 50_000
#: A worker remembers the ids of this many words; others are encoded each time they occur.
MEMO_WORDS = 150_000

#: Fixed value: how the byte-level vocabulary cuts a text before merging.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_WIDE_SPACE = re.compile(r" \s|\s ")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself, or the next free character from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(spare)}


class ByteLevelEncoder:
    """Ids of a ``tokenizers`` file with a byte-level BPE, as little-endian 32-bit numbers.

    The vocabulary is read by ``tokenizers``; merging is done by ``tiktoken``,
    which gives the same ids about five times as fast, once per distinct word
    as far as the memo goes: a word after a single space is encoded alike
    wherever it stands. Texts in which white space touches a space are encoded
    whole. Added tokens of the file, special ones included, are taken out of a
    text first, as its library does by default.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        byte_of = _byte_of_char()
        vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
        ranks = {
            bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if all(c in byte_of for c in token)
        }
        # The end mark of such files is stored among the words but never merged.
        ranks = {token: i for token, i in ranks.items() if not (token.startswith(b"<|") and token.endswith(b"|>"))}
        encode = tiktoken.Encoding("byte-level", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        class Memo(dict):
            def __missing__(self, word: str) -> bytes:
                ids = np.array(encode(" " + word), "<u4").tobytes()
                if len(self) < MEMO_WORDS and len(word) <= 32:
                    self[word] = ids
                return ids

        self._encode, self._memo, self._added = encode, Memo(), AddedTokens(path)

    def __call__(self, text: str) -> bytes:
        return b"".join(
            part.to_bytes(4, "little") if isinstance(part, int) else self._plain(part) for part in self._added.parts(text)
        )

    def _plain(self, text: str) -> bytes:
        if _WIDE_SPACE.search(text):
            return np.array(self._encode(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        memo = self._memo
        return b"".join([np.array(self._encode(first), "<u4").tobytes(), *[memo[w] for w in rest]])


@cache
def _encoder(path: str) -> ByteLevelEncoder:
    """One encoder and one memo for all tasks of a worker."""
    return ByteLevelEncoder(path)


def cut(n_ids: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece. Only the first piece of a long document may be shorter than the capacity."""
    first = n_ids if n_ids <= capacity else n_ids % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n_ids, capacity))]


def token_pieces(
    docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = END, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for every row of ``docs``.

    A document is the ids of its text and then ``end``; a null text is empty.
    ``tokenizer`` is the path of a byte-level ``tokenizers`` file that every
    worker can open. ``ids_crc32`` is the unsigned CRC-32 of a piece's ids.
    """
    fields = [
        docs.schema["doc_id"],
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = _encoder(tokenizer), np.array([end], "<u4").tobytes()
        for batch in batches:
            row_of, piece, start, length, crc, tokens = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = encode(text.as_py()) + last
                for number, (at, size) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * at : 4 * (at + size)]
                    row_of.append(row)
                    piece.append(number)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        tokens.append(np.frombuffer(part, "<i4"))
            columns = [
                batch.column(0).take(pa.array(row_of, pa.int64())),
                pa.array(piece, pa.int32()),
                *(pa.array(c, pa.int64()) for c in (start, length, crc)),
            ]
            if with_ids:
                columns.append(pa.array(tokens, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return docs.select("doc_id", whole().alias("text")).mapInArrow(tokenize, T.StructType(fields))


# ------------------------------------------------------------------- the plan


class _Plan:
    """Slots (size, first rank, first sequence, pieces per sequence, offset) and the gaps still open."""

    def __init__(self, capacity: int):
        self.capacity, self.slots, self.n_sequences = capacity, [], 0
        self.ranked: dict[int, int] = {}
        self.gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def fill(self, size: int, first: int, n: int, per: int, offset: int) -> None:
        """``per`` pieces of ``size`` into each of ``n`` sequences from ``first`` on."""
        rank = self.ranked.get(size, 0)
        self.slots.append((size, rank, first, per, offset))
        self.ranked[size] = rank + n * per

    def open(self, sizes: tuple[int, ...], n: int) -> None:
        """``n`` new sequences that begin with pieces of these sizes."""
        used = 0
        for size in sizes:
            self.fill(size, self.n_sequences, n, 1, used)
            used += size
        self.gaps[self.capacity - used].append((self.n_sequences, n))
        self.n_sequences += n

    def match_large(self, left: dict[int, int]) -> None:
        sizes = sorted((s for s in left if 3 * s > self.capacity), reverse=True)
        for big in sizes:
            for partner in (s for s in sizes if s <= min(big, self.capacity - big)):
                n = left[big] // 2 if partner == big else min(left[big], left[partner])
                if n:
                    self.open((big, partner), n)
                    left[big] -= n
                    left[partner] -= n
            if left[big]:
                self.open((big,), left[big])
                left[big] = 0

    def fit_small(self, size: int, n: int) -> None:
        """Each piece goes to the smallest gap that takes it, or to a new sequence."""
        gap = size
        while n:
            while gap < self.capacity and not self.gaps[gap]:
                gap += 1
            if gap == self.capacity and not self.gaps[gap]:
                self.gaps[gap].append((self.n_sequences, -(-n // (self.capacity // size))))
                self.n_sequences += self.gaps[gap][0][1]
            first, count = self.gaps[gap].pop()
            per = gap // size
            take, per = (min(count, n // per), per) if n >= per else (1, n)
            self.fill(size, first, take, per, self.capacity - gap)
            n -= take * per
            self.gaps[gap - per * size].append((first, take))
            if count > take:
                self.gaps[gap].append((first + take, count - take))


def packing_plan(counts: dict[int, int], capacity: int) -> pd.DataFrame:
    """Slots for ``counts`` pieces of each length: ranks of a length from ``rank`` on start at ``sequence`` and ``offset``."""
    plan, left = _Plan(capacity), dict(counts)
    plan.match_large(left)
    for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        plan.fit_small(size, left[size])
    slots = pd.DataFrame(plan.slots, columns=["size", "rank", "sequence", "per", "offset"], dtype="int64")
    return slots.sort_values(["size", "rank"], ignore_index=True)


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length, ...) with ``sequence_id`` and ``offset``.

    ``pieces`` must be a stored table: it is read for the counts and again for
    the ranks. Rows that repeat a piece are packed one by one. Every sequence
    is filled from offset 0 without gaps up to what is left free at its end.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = packing_plan(counts, capacity)
    size, rank, sequence, per, offset = (slots[c].to_numpy() for c in slots.columns)
    keys = (size << 44) | rank
    buckets = max(1, -(-sum(counts.values()) // BUCKET_ROWS))

    names = pieces.columns
    placed = pieces.select(
        *names, F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int").alias("__bucket")
    )
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__bucket", "length").agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    inside = Window.partitionBy("__bucket", "length").orderBy("doc_id", "piece")
    ranked = placed.withColumn("__inside", F.row_number().over(inside)).join(offsets, ["__bucket", "length"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, (lengths.to_numpy() << 44) | ranks.to_numpy(), "right") - 1
        nth = ranks.to_numpy() - rank[at]
        return pd.DataFrame({"sequence_id": sequence[at] + nth // per[at], "offset": offset[at] + nth % per[at] * size[at]})

    spot = place("length", F.col("__before") + F.col("__inside") - 1)
    return ranked.select(*names, spot.alias("__spot")).select(*names, "__spot.sequence_id", "__spot.offset")


def pack_documents(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack all documents: one row per piece.

    ``with_ids`` adds the token ids of each piece; without them only lengths
    and checksums are stored and moved.
    """
    pieces = materialize(
        token_pieces(docs, tokenizer, capacity=capacity, end=end, with_ids=with_ids), "pieces"
    )
    return pack(pieces, capacity=capacity)

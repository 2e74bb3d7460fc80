"""Byte-level BPE with a two-tier lookup (operator 7).

A text is split by the vocabulary's pattern. Tier one: a minimal perfect hash
over the vocabulary finds pre-tokens that are tokens as a whole. Tier two:
other pre-tokens are merged from their bytes, with a heap of adjacent pairs
over a doubly linked list, so a pre-token of n bytes costs O(n log n).

Encoding and decoding run over Arrow batches, one text at a time; the
vocabulary tables are broadcast (their size is the vocabulary's). Each Python
worker remembers the ids of frequent pieces in a table of bounded size.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .common import Memory, giving_back, ship, text_or_empty, text_slices

# how the public rank files split text before merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MEMORY = 200_000  # remembered pieces per worker and generation
LONGEST = 32  # characters of a remembered piece
MARKS = frozenset(".,;:!?")
NONE = -1  # in place of an id: merged away, or past the end
_AFTER, _BEFORE = list(range(1, 1025)), list(range(-1, 1023))  # links of short pieces
_M64 = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of n distinct byte strings, by displacement: keys
    fall into buckets; largest bucket first, a seed is tried until the bucket's
    keys land on free slots of a table of exactly n slots."""

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        n = self.n = max(1, len(keys))
        self.buckets = max(1, n // per_bucket)
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        if len(set(hashes)) != len(hashes):
            raise ValueError("keys must be distinct")
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            groups[h % self.buckets].append(i)
        self.seeds = [0] * self.buckets
        self.slots: list[int] = [-1] * n  # key number in each slot
        for bucket in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            members = groups[bucket]
            if not members:
                break
            seed = 0
            while True:
                at = [self._slot(hashes[i], seed) for i in members]
                if len(set(at)) == len(at) and all(self.slots[a] < 0 for a in at):
                    break
                seed += 1
            self.seeds[bucket] = seed
            for a, i in zip(at, members):
                self.slots[a] = i

    def _slot(self, h: int, seed: int) -> int:
        x = (h ^ (seed * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9 & _M64
        return (x ^ (x >> 29)) % self.n

    def find(self, key: bytes) -> int:
        """The slot's key number; the caller compares the key itself."""
        h = xxhash.xxh3_64_intdigest(key)
        return self.slots[self._slot(h, self.seeds[h % self.buckets])]


class Vocabulary:
    """Tokens by id, the perfect hash over them, and the ranks of merges."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.pattern = pattern
        self.keys = list(ranks)
        self.ids = [ranks[k] for k in self.keys]
        self.hash = PerfectHash(self.keys)
        self.tokens: list[bytes] = [b""] * (max(self.ids, default=-1) + 1)
        for k, i in ranks.items():
            self.tokens[i] = k
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        # for each token the tokens that it makes with those that may follow it, by id
        joined: list[dict[int, int]] = [{} for _ in self.tokens] or [{}]
        for k, i in ranks.items():
            for c in range(1, len(k)):
                if k[:c] in ranks and k[c:] in ranks:
                    joined[ranks[k[:c]]][ranks[k[c:]]] = i
        self.joined = joined
        self.follow = [d.get for d in joined]
        self.longest = max(map(len, self.keys), default=0)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "follow"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.follow = [d.get for d in self.joined]

    def whole(self, piece: bytes) -> int | None:
        at = self.hash.find(piece)
        return self.ids[at] if at >= 0 and self.keys[at] == piece else None

    def merge(self, piece: bytes) -> list[int]:
        """Merge the lowest-ranked adjacent pair (the leftmost of equals) until
        no pair is a token. A heap entry is rank and position in one number; it
        counts only while its rank is that of its position in ``now``. The
        position past the end, which no pair can use, closes the list."""
        follow, n = self.follow, len(piece)
        ids = [self.bytes[b] for b in piece]
        ids.append(NONE)
        now = [follow[a](b) for a, b in zip(ids, ids[1:])]
        now.append(None)
        heap = [r << 32 | i for i, r in enumerate(now) if r is not None]
        heapify(heap)
        after, before = (_AFTER[: n + 1], _BEFORE[: n + 1]) if n < len(_AFTER) else (list(range(1, n + 2)), list(range(-1, n)))
        while heap:
            top = heappop(heap)
            i, r = top & 0xFFFFFFFF, top >> 32
            if now[i] != r:
                continue
            j = after[i]
            k = after[j]
            ids[i], ids[j], now[j] = r, NONE, None
            after[i], before[k] = k, i
            q = now[i] = follow[r](ids[k])
            if q is not None:
                heappush(heap, q << 32 | i)
            if i:
                h = before[i]
                q = now[h] = follow[ids[h]](r)
                if q is not None:
                    heappush(heap, q << 32 | h)
        return [x for x in ids if x >= 0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.whole(piece) if len(piece) <= self.longest else None
        return [whole] if whole is not None else self.merge(piece)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Encoder:
    """Encodes texts in one worker. ``words`` remembers what stands between two
    single spaces, with the leading space; ``tokens`` other pre-tokens."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.split = regex.compile(vocabulary.pattern).findall
        self.vocabulary = vocabulary
        self.plain = vocabulary.pattern == PATTERN
        self.tokens = Memory(self._token, MEMORY // 8, LONGEST)
        self.words = Memory(self._word, MEMORY, LONGEST)

    def _ids(self, token: str) -> bytes:
        return array("i", self.vocabulary.encode_piece(token.encode())).tobytes()

    def _token(self, token: str) -> bytes:
        if self.plain and token[0] == " " and token[1:].isalpha():
            return self.words[token[1:]]
        return self._ids(token)

    def _word(self, word: str) -> bytes:
        # letters alone are one pre-token with the space before them, a mark after them is another
        if word.isalpha():
            return self._ids(" " + word)
        if word[-1:] in MARKS and word[:-1].isalpha():
            return self.words[word[:-1]] + self.tokens[word[-1]]
        return self._pieces(" " + word)

    def _pieces(self, text: str) -> bytes:
        return b"".join([self.tokens[t] for t in self.split(text)])

    def encode(self, text: str) -> bytes:
        """Ids as int32 bytes. Where no two spaces meet, every pre-token lies
        between two spaces (its own leading one included), since the pattern
        never joins across a space that a non-space follows; otherwise the
        whole text is split at once."""
        if not text:
            return b""
        if "  " in text or not self.plain:
            return self._pieces(text)
        head, *rest = text.split(" ")
        return self._pieces(head) + b"".join(map(self.words.__getitem__, rest))


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    key = shared.value.token
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value.vocabulary)
    return _encoders[key]


class _Shared:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        parts = [vocabulary.pattern.encode(), *vocabulary.keys, repr(vocabulary.ids).encode()]
        self.token = xxhash.xxh3_128_intdigest(b"".join(len(p).to_bytes(8, "big") + p for p in parts))


def int_lists(parts: list[bytes]) -> pa.Array:
    """A list<int32> column from the bytes of each row."""
    ends = np.cumsum([0] + [len(p) // 4 for p in parts])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32), pa.int32()))


def _whole(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def encoder(spark: SparkSession, vocabulary: Vocabulary):
    """A function from a text column to its ``array<int>`` of token ids; null
    text is empty."""
    ship(spark)
    shared = spark.sparkContext.broadcast(_Shared(vocabulary))

    def encode_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _encoder(shared)
        for texts in batches:
            yield _whole([int_lists([own.encode(t) for t in part.to_pylist()]) for part in text_slices(texts)], pa.list_(pa.int32()))

    udf = F.arrow_udf(giving_back(encode_column), ArrayType(IntegerType()))
    return lambda col: udf(text_or_empty(col))


def decode_lists(lists: pa.Array, tokens: list[bytes]) -> pa.Array:
    """The bytes of each list of ids, one list at a time."""
    token, out = tokens.__getitem__, []
    ids, ends = np.asarray(lists.values), lists.offsets.to_numpy()
    for i in range(len(lists)):
        out.append(b"".join(map(token, ids[ends[i] : ends[i + 1]].tolist())) if lists[i].is_valid else b"")
    return pa.array(out, pa.binary())


def decoder(spark: SparkSession, vocabulary: Vocabulary):
    """A function from an ``array<int>`` column to the bytes it stands for. An
    id outside the vocabulary is an error; null and empty arrays are empty."""
    ship(spark)
    shared = spark.sparkContext.broadcast(_Shared(vocabulary))

    def decode_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield decode_lists(lists, shared.value.vocabulary.tokens)

    udf = F.arrow_udf(decode_column, BinaryType())
    return lambda col: udf(col)


def coder(spark: SparkSession, vocabulary: Vocabulary):
    """A function from a text column to ``struct(ids, decoded)``: encoded, and
    decoded from the ids, in one pass through Python."""
    ship(spark)
    shared = spark.sparkContext.broadcast(_Shared(vocabulary))

    def code_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _encoder(shared)
        for texts in batches:
            parts = []
            for part in text_slices(texts):
                ids = int_lists([own.encode(t) for t in part.to_pylist()])
                parts.append(pa.StructArray.from_arrays([ids, decode_lists(ids, own.vocabulary.tokens)], names=["ids", "decoded"]))
            yield _whole(parts, pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.binary())]))

    udf = F.arrow_udf(giving_back(code_column), StructType([StructField("ids", ArrayType(IntegerType())), StructField("decoded", BinaryType())]))
    return lambda col: udf(text_or_empty(col))


def encode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, ids, decoded`` for each row, in one pass without a shuffle:
    the token ids of the whole text and the bytes these ids decode to. Null
    text is empty text (no ids, no bytes). Ids may be null or repeat; other
    columns are ignored. An empty table gives an empty result."""
    code = coder(df.sparkSession, vocabulary)
    return df.select(F.col(id_col), code(text_col).alias("_coded")).select(id_col, "_coded.ids", "_coded.decoded")

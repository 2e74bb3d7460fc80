"""Fill-in-the-middle transformation (operator 11).

A text is cut into units, each a run of visible characters with the white space
before it (white space at the end is a unit of its own), and split after two of
them into prefix, middle and suffix. The cuts are found by SWAR arithmetic: the
UTF-8 bytes of an Arrow batch are viewed as little-endian 64-bit words; a few
additions mark the byte that ends each unit; ``bitwise_count`` gives the marks
of every word; a search in their running sum finds the word that holds the k-th
mark and a multiplication finds the byte in it. No unit is ever made a string.

Only the text goes to Python, and three numbers come back. The pieces are cut,
put together and restored by SQL functions, so there is no shuffle, no state,
and nothing grows but with the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import ship, text_or_empty

SLICE = 4 << 20  # bytes of text whose words are held at once; a longer text is one slice
SENTINELS = ("<P>", "<S>", "<M>")

_U = np.uint64
_LOW = _U(0x0101010101010101)  # the lowest bit of each byte
_HIGH = _U(0x8080808080808080)  # the highest bit of each byte
_SEVEN = _U(0x7F7F7F7F7F7F7F7F)


def _every(byte: int) -> np.uint64:
    return _U(byte * 0x0101010101010101)


def white_space(words: np.ndarray) -> np.ndarray:
    """High bit set in each byte that is 0x20 or 0x09 to 0x0D. Adding 0x80 - b
    to seven bits carries into the eighth exactly when they are at least b."""
    seven = words & _SEVEN
    control = (seven + _every(0x80 - 0x09)) & ~(seven + _every(0x80 - 0x0E))
    blank = ~((seven ^ _every(0x20)) + _SEVEN)
    return (control | blank) & ~words & _HIGH


def starts(words: np.ndarray) -> np.ndarray:
    """High bit set in each byte that starts a code point (is no continuation)."""
    return ~(words & ~(words << _U(1))) & _HIGH


def select_in_word(marks: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The byte that holds the k-th mark (from 1) of each word of high bits."""
    running = (marks >> _U(7)) * _LOW  # byte j: marks in bytes 0 to j
    below = ((k.astype(_U) - _U(1)) * _LOW | _HIGH) - running  # high bit: fewer than k
    return np.bitwise_count(below & _HIGH)


class Marks:
    """Rank and select over the marked bytes of a run of words."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:], dtype=np.int64)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marks before byte ``at``."""
        word, byte = at >> 3, (at & 7).astype(_U)
        # the word past the end has no byte before ``at``
        inside = self.marks[np.minimum(word, len(self.marks) - 1)] & ((_U(1) << (byte << _U(3))) - _U(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of the k-th mark (from 1)."""
        word = np.searchsorted(self.before, k, side="left") - 1
        return word * 8 + select_in_word(self.marks[word], k - self.before[word])


def cut(raw: np.ndarray, ends: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and code points of its prefix and of its middle.
    ``raw`` holds the bytes of all texts one after another, ``ends`` the n + 1
    borders between them."""
    n = len(ends) - 1
    if not n or not len(raw):
        return (np.zeros(n, np.int64),) * 3
    words = np.zeros(-(-len(raw) // 8), _U)
    words.view(np.uint8)[: len(raw)] = raw
    white = white_space(words)
    follows = white >> _U(8)  # the next byte is white space
    follows[:-1] |= white[1:] << _U(56)
    marks = ~white & follows
    last = ends[1:][ends[1:] > ends[:-1]] - 1  # the last byte of a text ends a unit, whatever follows
    # where a text ends, white space of the next one may have marked that byte: or, not add
    np.bitwise_or.at(marks, last >> 3, _U(0x80) << ((last & 7).astype(_U) << _U(3)))
    units, chars = Marks(marks), Marks(starts(words))
    first = units.rank(ends)
    count = first[1:] - first[:-1]
    a, b = h1 % (count + 1), h2 % (count + 1)

    def border(k: np.ndarray) -> np.ndarray:
        at = ends[:-1].copy()
        some = k > 0
        at[some] = units.select((first[:-1] + k)[some]) + 1
        return chars.rank(at)

    low, high = border(np.minimum(a, b)), border(np.maximum(a, b))
    return count, low - chars.rank(ends[:-1]), high - low


def slices(ends: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes, or of one row."""
    start, n = 0, len(ends) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
        yield start, min(stop, n)
        start = stop


def cut_texts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.StructArray:
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    h1, h2 = h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)
    parts = [
        cut(raw[ends[i] : ends[j]], ends[i : j + 1] - ends[i], h1[i:j], h2[i:j])
        for i, j in slices(ends)
    ]
    columns = [np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in range(3)]
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n", "prefix_chars", "middle_chars"])


def _cutter(spark: SparkSession):
    """A function of a text and two numbers: struct(n, prefix_chars, middle_chars)."""
    ship(spark)

    def cut_columns(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, h1, h2 in batches:
            yield cut_texts(texts, h1, h2)

    names = ("n", "prefix_chars", "middle_chars")
    udf = F.arrow_udf(cut_columns, StructType([StructField(c, LongType()) for c in names]))
    return lambda text, h1, h2: udf(text, h1, h2)


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hex digits as a number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 42,
    rate: int = 50,
    spm_rate: int = 80,
    sentinels: Sequence[str] = SENTINELS,
) -> DataFrame:
    """``<id_col>, n, form, prefix_chars, middle_chars, output, restored`` for
    each row, in one pass without a shuffle.

    ``n`` counts the units. Two numbers drawn from SHA-256 of ``<seed>:<id>``
    choose the borders of the middle, a third whether the text is transformed
    (``rate`` per cent), a fourth its form: ``psm`` (prefix, suffix, middle)
    or, in ``spm_rate`` per cent, ``spm`` (suffix, prefix, middle), each part
    after its sentinel. Other texts are ``plain`` and have null lengths.
    ``restored`` is the text rebuilt from ``output`` and ``form`` alone.

    Null and empty texts are plain and empty with n = 0, and a text that
    contains a sentinel is plain. A null id draws from ``<seed>:``; rows with
    equal id and text come out equal. Other columns are ignored, whatever
    their names. A text of any length is cut whole; about six times its bytes
    are held meanwhile. An empty table gives an empty result.
    """
    text = F.col("_text")
    rows = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    rows = rows.withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256))
    drawn = rows.withColumns({f"_h{k}": _draw(F.col("_hash"), k) for k in range(4)})
    cuts = drawn.withColumn("_cut", _cutter(df.sparkSession)("_text", "_h0", "_h1"))
    plain = (text == "") | (F.col("_h2") % 100 >= rate)
    for s in sentinels:
        plain = plain | text.contains(s)
    a, b = F.col("_cut.prefix_chars"), F.col("_cut.middle_chars")
    formed = cuts.withColumn("form", F.when(plain, "plain").when(F.col("_h3") % 100 < spm_rate, "spm").otherwise("psm"))
    prefix, middle = text.substr(F.lit(1), a.cast("int")), text.substr((a + 1).cast("int"), b.cast("int"))
    suffix = text.substr((a + b + 1).cast("int"), F.char_length(text))
    p, s, m = (F.lit(x) for x in sentinels)
    output = (
        F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle))
        .otherwise(text)
    )
    out = formed.withColumn("output", output)
    moved = F.col("form") != "plain"
    return out.select(
        F.col("_id").alias(id_col),
        F.col("_cut.n").alias("n"),
        "form",
        F.when(moved, a).alias("prefix_chars"),
        F.when(moved, b).alias("middle_chars"),
        "output",
        restore("output", "form", sentinels).alias("restored"),
    )


def restore(output: str | Column, form: str | Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text of an output, from the output and its form alone."""
    output = F.col(output) if isinstance(output, str) else output
    form = F.col(form) if isinstance(form, str) else form
    parts = F.split(output, "|".join(map(re.escape, sentinels)), -1)
    # each form starts with a sentinel, so part 0 is empty
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)

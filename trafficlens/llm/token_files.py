"""Token ids in Huffman-coded binary files (operator 1).

``encode_documents`` turns whole texts into ids with the ``tokenizers``
library; ``write_tokens`` codes the ids of all documents, in ascending id
order, with one canonical, length-limited Huffman code made from their global
counts; ``read_tokens`` gets them back.

A file holds independent blocks of ``BLOCK`` ids. A block starts with the bit
offset of every ``STRIDE``-th id, so decoding can start at any of these
checkpoints; the reader starts at all of them at once and steps them together
through one lookup table. After the blocks comes the list of documents (id and
number of ids) and a fixed-length tail::

    file   := block* index tail
    block  := u32 ids, u32 payload bytes, u32 offset per checkpoint, payload
    index  := per document: u8 has id, i64 id, u64 ids
    tail   := u64 start of the index, u64 documents, magic

Numbers are little-endian; codes are written from the highest bit down.
"""

from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import scratch_path
from .common import Memory, giving_back, ship, text_or_empty, text_slices
from .files import reading, this_task, writing

BLOCK, STRIDE, GROUP = 1 << 16, 256, 8  # ids per block, ids per checkpoint, blocks decoded together
MAX_LENGTH = 18  # bits of the longest code; the lookup table has 2 ** MAX_LENGTH entries
MAGIC = b"TLHUFF01"
MEMORY = 200_000  # remembered words, and letter runs, per worker and generation
LONGEST = 64
ODD_SPACE = "[\x1c-\x1f]"  # split off as white space here, but not by the library


# Latin letters whose lower case is one letter and which no normal form changes, then punctuation without
# the apostrophe (which starts contractions)
LATIN_WORD = "^(?P<run>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)(?P<tail>[!-&(-/:-@\\[-`{-~]*)$"


def id_type(vocabulary_size: int) -> np.dtype:
    """Of ids at rest: two bytes where they suffice."""
    return np.dtype("<u2" if vocabulary_size <= 1 << 16 else "<u4")


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


# ---- texts to ids ---------------------------------------------------------


class WordMemory:
    """Ids of texts by the library, word by word. For vocabularies that drop
    white space and case and never merge across a change between letters and
    punctuation, a text's ids are those of its words in turn, and those of a
    word are its letters' and its punctuation's. The distinct words of a batch
    are taken apart together; of their distinct letter runs, those not
    remembered go to the library's model, other words to the whole tokenizer;
    the ids are then laid out in the order of the words."""

    def __init__(self, path: str, by_word: bool, kind: str, special_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.by_word = by_word
        self.code = "H" if np.dtype(kind).itemsize == 2 else "I"
        self.letters = byte_letters()
        self.tokenize = self.tokenizer.model.tokenize
        self.runs = Memory(self._run, MEMORY, LONGEST)
        self.others = Memory(self._whole, MEMORY // 8, LONGEST)

    def _whole(self, text: str) -> bytes:
        (coded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array(self.code, coded.ids).tobytes()

    def _run(self, run: str) -> bytes:
        """Ids of one lower-case run of letters or of punctuation."""
        if not run:
            return b""
        written = run if run.isascii() else run.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenize(written)]).tobytes()

    def _run_ids(self, runs: pa.Array) -> pa.Array:
        coded = runs.dictionary_encode()
        return pa.array([self.runs[r] for r in coded.dictionary.to_pylist()], pa.binary()).take(coded.indices)

    def _word_ids(self, words: pa.Array) -> pa.Array:
        parts = pc.extract_regex(words, LATIN_WORD)
        plain = parts.is_valid()
        runs, tails = (pc.struct_field(parts, i).filter(plain) for i in (0, 1))
        ids = pc.binary_join_element_wise(self._run_ids(pc.utf8_lower(runs)), self._run_ids(tails), pa.scalar(b"", pa.binary()))
        rest = [self.others[w] for w in words.filter(pc.invert(plain)).to_pylist()]
        place = np.empty(len(words), np.int64)
        is_plain = plain.to_numpy(zero_copy_only=False)
        place[is_plain] = np.arange(len(ids))
        place[~is_plain] = np.arange(len(ids), len(words))
        return pa.concat_arrays([ids, pa.array(rest, pa.binary())]).take(pa.array(place))

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each whole text as little-endian bytes."""
        if not self.by_word:
            return pa.array([self._whole(t) for t in texts.to_pylist()], pa.binary())
        lists = pc.utf8_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        ids = self._word_ids(words.dictionary).take(words.indices)
        borders = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False), dtype=np.int64)))
        raw = b"".join(ids.to_pylist()) if ids.offset else ids.buffers()[2]
        joined = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends[borders].astype(np.int64)), raw if raw is not None else pa.py_buffer(b"")])
        odd = pc.match_substring_regex(texts, ODD_SPACE)
        out = joined.cast(pa.binary())
        if pc.any(odd).as_py():
            whole = [self._whole(t) if o else None for t, o in zip(texts.to_pylist(), odd.to_pylist())]
            out = pc.coalesce(pa.array(whole, pa.binary()), out)
        return out


@lru_cache(maxsize=2)
def _memory(path: str, by_word: bool, kind: str, special_as_text: bool) -> WordMemory:
    return WordMemory(path, by_word, kind, special_as_text)


def encode_documents(
    df: DataFrame,
    tokenizer_path: str,
    vocabulary_size: int,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    by_word: bool = True,
    special_as_text: bool = True,
) -> DataFrame:
    """``doc_id, n, ids`` for each row: the ids of the whole text (null: empty)
    with ``end_id`` appended, as bytes of ``id_type``, and their number. The
    tokenizer file must be readable on the executors. ``by_word=False`` encodes whole texts in
    one call each, for vocabularies whose tokens may cross white space. Strings of
    special tokens in a text are ordinary text; with ``special_as_text=False``
    they become the special ids, as in the library's plain ``encode``."""
    ship(df.sparkSession)
    kind = id_type(vocabulary_size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, end = _memory(tokenizer_path, by_word, kind.str, special_as_text), pa.scalar(np.array([end_id], kind).tobytes(), pa.binary())
        for rows in batches:
            start = 0
            for part in text_slices(rows.column(1)):
                ids = pc.binary_join_element_wise(memory.encode(part), end, pa.scalar(b"", pa.binary()))
                n = pc.divide(pc.binary_length(ids).cast(pa.int64()), kind.itemsize)
                yield pa.record_batch([rows.column(0).slice(start, len(ids)), n, ids], names=["doc_id", "n", "ids"])
                start += len(ids)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(giving_back(run), "doc_id bigint, n bigint, ids binary")


# ---- the code -------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = MAX_LENGTH) -> np.ndarray:
    """Lengths of an optimal prefix code with no length above ``limit``
    (package-merge); symbols that do not occur get 0."""
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes longer than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    row, leaf_rows = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        by = np.argsort(both, kind="stable")
        row = both[by]
        leaf_rows.append(by < len(leaves))
    take, depth = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for is_leaf in reversed(leaf_rows):
        taken = int(is_leaf[:take].sum())
        depth[:taken] += 1
        take = 2 * (take - taken)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of length, then symbol."""
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    for s in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[s])
        if n:
            code <<= n - last
            codes[s], last = code, n
            code += 1
    return codes


def lookup_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Symbol and length by the next ``width`` bits."""
    width = max(1, int(lengths.max(initial=1)))
    symbols, sizes = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.uint8)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(lengths[used], kind="stable")]  # canonical order fills the table from 0 up
    fill = 1 << (width - lengths[used].astype(np.int64))
    symbols[: fill.sum()] = np.repeat(used, fill)
    sizes[: fill.sum()] = np.repeat(lengths[used], fill)
    return symbols, sizes, width


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    size = lengths[ids].astype(np.int64)
    if not size.all():
        raise ValueError("an id has no code")
    ends = np.cumsum(size)
    starts = ends - size
    at = starts >> 3
    word = codes[ids].astype(np.uint64) << (np.uint64(32) - (size + (starts & 7)).astype(np.uint64))
    total = int(ends[-1] + 7) >> 3
    payload = np.zeros(total + 4)
    for k in range(4):  # bits of different codes never overlap, so sums are unions
        part = ((word >> np.uint64(24 - 8 * k)) & np.uint64(255)).astype(np.float64)
        payload += np.bincount(at + k, weights=part, minlength=total + 4)[: total + 4]
    data = payload[:total].astype(np.uint8).tobytes()
    return struct.pack("<II", len(ids), len(data)) + starts[::STRIDE].astype("<u4").tobytes() + data


def decode_blocks(blocks: list[tuple[int, np.ndarray, bytes]], table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Ids of several blocks (number of ids, checkpoints, payload): all
    checkpoints advance together, one table lookup per id."""
    symbols, sizes, width = table
    bases, at = [], 0
    for _, _, data in blocks:
        bases.append(at)
        at += len(data)
    raw = np.frombuffer(b"".join(b[2] for b in blocks) + bytes(8), np.uint8).astype(np.uint32)
    window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    place = np.concatenate([8 * base + b[1].astype(np.int64) for base, b in zip(bases, blocks)])
    left = np.concatenate([np.minimum(STRIDE, b[0] - STRIDE * np.arange(len(b[1]))) for b in blocks])
    out = np.zeros((len(place), STRIDE), np.uint32)
    mask = np.uint32((1 << width) - 1)
    last = len(window) - 1
    for step in range(int(left.max(initial=0))):
        bits = (window[np.minimum(place >> 3, last)] >> (32 - width - (place & 7)).astype(np.uint32)) & mask
        out[:, step] = symbols[bits]
        place += sizes[bits]
    return out[np.arange(STRIDE) < left[:, None]]


# ---- files ----------------------------------------------------------------


def _write_partition(folder: str, shared, kind: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = this_task()
        codes, lengths = shared.value
        name, index, held, n_held, at, total = f"part-{part:05d}.huff", [], [], 0, 0, 0
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        with writing(folder, name, attempt) as out:

            def flush(least: int) -> None:
                nonlocal held, n_held, at
                while n_held >= least and n_held:
                    joined = np.concatenate(held)
                    block = encode_block(joined[:BLOCK], codes, lengths)
                    out.write(block)
                    at += len(block)
                    held, n_held = [joined[BLOCK:]], max(0, n_held - BLOCK)

            def all_rows():
                yield first
                yield from batches

            for rows in all_rows():
                for doc, ids in zip(rows.column(0).to_pylist(), rows.column(2)):
                    own = np.frombuffer(ids.as_buffer(), kind)
                    index.append(struct.pack("<BqQ", doc is not None, doc or 0, len(own)))
                    held.append(own)
                    n_held += len(own)
                    total += len(own)
                    if n_held >= 4 * BLOCK:
                        flush(BLOCK)
            flush(BLOCK)
            flush(1)
            out.write(b"".join(index))
            out.write(struct.pack("<QQ", at, len(index)) + MAGIC)
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(index)], pa.int64()), pa.array([total], pa.int64())], names=["part", "file", "docs", "ids"])

    return run


def write_tokens(tokens: DataFrame, folder: str, vocabulary_size: int, limit: int = MAX_LENGTH) -> str:
    """Write ``doc_id, n, ids`` to ``folder`` in ascending order of doc_id
    (null first, rows of the same id by their ids' hash): data files, the code
    (``code.parquet``) and the list of files (``files.parquet``).

    Only counts (one per vocabulary entry) reach the driver. ``tokens`` should
    be a written table: it is read for the counts, for the ranges and for the
    data."""
    spark = tokens.sparkSession
    ship(spark)
    kind = id_type(vocabulary_size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary_size, np.int64)
        for rows in batches:
            for ids in rows.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), kind), minlength=vocabulary_size)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    counts = np.zeros(vocabulary_size, np.int64)
    for row in tokens.select("ids").mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts, limit)
    coded = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(coded, "id int, length int").coalesce(1).write.parquet(f"{folder}/code.parquet")

    shared = spark.sparkContext.broadcast((canonical_codes(lengths), lengths))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        tokens.withColumn("_h", F.xxhash64("ids"))
        .repartitionByRange(parts, F.col("doc_id"), F.col("_h"))
        .sortWithinPartitions("doc_id", "_h")
        .select("doc_id", "n", "ids")
    )
    written = ordered.mapInArrow(_write_partition(f"{folder}/data", shared, kind), "part int, file string, docs bigint, ids bigint")
    written.write.parquet(f"{folder}/files.parquet")
    return folder


def _read_blocks(source, end: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    at = 0
    while at < end:
        n, size = struct.unpack("<II", source.read(8))
        marks = -(-n // STRIDE)
        offsets = np.frombuffer(source.read(4 * marks), "<u4")
        yield n, offsets, source.read(size)
        at += 8 + 4 * marks + size


def _read_file(folder: str, name: str, table) -> Iterator[tuple[int | None, np.ndarray]]:
    from .files import filesystem

    fs, base = filesystem(folder)
    with fs.open_input_file(f"{base}/{name}") as f:
        size = f.size()
        f.seek(size - 24)
        start, docs, magic = struct.unpack("<QQ8s", f.read(24))
        if magic != MAGIC:
            raise ValueError(f"{name} is not a token file")
        f.seek(start)
        index = np.frombuffer(f.read(17 * docs), np.dtype([("has", "u1"), ("doc", "<i8"), ("n", "<u8")]))
    with reading(folder, name) as source:
        blocks = _read_blocks(source, start)
        held, n_held = [], 0
        for has, doc, n in index:
            n = int(n)
            while n_held < n:
                group = [b for _, b in zip(range(GROUP), blocks)]
                if not group:
                    raise ValueError(f"{name} ends early")
                held.append(decode_blocks(group, table))
                n_held += len(held[-1])
            if len(held) > 1:
                held = [np.concatenate(held)]
            ids = held[0][:n] if held else np.zeros(0, np.uint32)
            held, n_held = [held[0][n:]] if held else [], n_held - n
            yield (int(doc) if has else None), ids


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` from the files: ``start`` is the number
    of ids of all documents before, ``ids`` the u32 bytes. One task per file;
    the code and the list of files are small."""
    ship(spark)
    code = spark.read.parquet(f"{folder}/code.parquet").collect()
    lengths = np.zeros(max((r["id"] for r in code), default=0) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["length"]
    shared = spark.sparkContext.broadcast(lookup_table(lengths))
    files, start = [], 0
    for r in spark.read.parquet(f"{folder}/files.parquet").orderBy("part").collect():
        files.append((r["part"], r["file"], start))
        start += r["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for name, at in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
                out, size = [], 0
                for doc, ids in _read_file(f"{folder}/data", name, shared.value):
                    out.append((doc, at, len(ids), ids.tobytes()))
                    at += len(ids)
                    size += len(ids)
                    if size > 1 << 20:
                        yield _batch(out)
                        out, size = [], 0
                if out:
                    yield _batch(out)

    listed = spark.createDataFrame(files, "part int, file string, start bigint")
    return listed.repartition(max(1, len(files)), "part").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, n, ids = zip(*rows)
    return pa.record_batch(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"]
    )


def token_files(
    df: DataFrame, tokenizer_path: str, vocabulary_size: int, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", by_word: bool = True,
    special_as_text: bool = True,
) -> DataFrame:
    """Encode, write and read back: ``doc_id, start, n_tokens, ids``.

    Ids of documents are integers; null ids come first, repeated ids follow
    one another. Null and empty texts have the end id alone. Columns other than
    id and text are ignored. An empty table gives no files and no rows."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    draft = f"{folder}/_ids"
    encode_documents(df, tokenizer_path, vocabulary_size, end_id, id_col, text_col, by_word, special_as_text=special_as_text).write.option("compression", "zstd").parquet(draft)
    write_tokens(spark.read.parquet(draft), folder, vocabulary_size)
    return read_tokens(spark, folder)

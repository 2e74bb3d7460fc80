"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package (once per context), as
    ``--py-files`` would; needed where it is not installed on the executors."""
    sc = spark.sparkContext
    if getattr(sc, "_trafficlens_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="trafficlens-pkg-"), "trafficlens_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._trafficlens_shipped = True


def give_back() -> None:
    """Give this process's freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def giving_back(run):
    """The task function ``run`` (batches to batches), after whose last batch
    the worker gives freed memory back to the system. Workers outlive their
    tasks, and what their allocators hold on to counts against later stages."""

    @wraps(run)  # Spark reads the annotations
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


class Memory(dict):
    """What ``make`` returned for short texts, in two generations: those used
    since the present one began, and what the one before it still holds. When
    the present one is full it becomes the former, whose unused entries are
    forgotten. Texts over ``longest`` characters are made anew each time."""

    def __init__(self, make, limit: int, longest: int):
        super().__init__()
        self.make, self.limit, self.longest, self.former = make, limit, longest, {}

    def __missing__(self, text: str) -> bytes:
        made = self.former.get(text)
        if made is None:
            made = self.make(text)
        if len(text) <= self.longest:
            if len(self) >= self.limit:
                self.former = dict(self)
                self.clear()
            self[text] = made
        return made


def text_slices(texts: pa.Array, most: int = 4 << 20) -> Iterator[pa.Array]:
    """Parts of a text column of at most ``most`` bytes, or of one text."""
    ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + most, side="right")) - 1)
        yield texts.slice(start, stop - start)
        start = stop


def text_or_empty(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Groups of equal ``key`` from batches already sorted by it. Only one
    group is held at a time; callers bound the size of a group."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key))
        ends = _ends(keys)
        start = 0
        for end in ends:
            value = keys[start].as_py()
            if held and value != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = value
            if end < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
            start = end
    if held:
        yield pa.Table.from_batches(held)


def _ends(keys: pa.Array) -> list[int]:
    n = len(keys)
    if n == 1:
        return [1]
    change = pc.not_equal(keys.slice(1), keys.slice(0, n - 1))
    return [i + 1 for i in pc.indices_nonzero(change).to_pylist()] + [n]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunk_units(rows: DataFrame, key: str, item: str, size: str, block: int) -> DataFrame:
    """Deal the rows of each key into blocks and pair the blocks, so that any
    two rows of a key meet in a unit of at most about ``2 * block`` rows.

    ``size`` is the column with the key's row count. A key of up to ``block``
    rows is one unit; a larger one has ``k = ceil(size / block)`` blocks and
    each row goes to the ``k`` units of its block. Adds ``unit`` (long hash of
    key and block pair) and ``side`` (0: own block with the smaller number).
    """
    k = F.greatest(F.lit(1), F.ceil(F.col(size) / F.lit(block)).cast("int"))
    mine = F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.col("_k")).cast("int")
    return (
        rows.withColumn("_k", k)
        .withColumn("_c", mine)
        .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("_lo", F.least("_c", "_o"))
        .withColumn("_hi", F.greatest("_c", "_o"))
        .withColumn("unit", F.concat_ws(":", F.col(key).cast("string"), "_lo", "_hi"))
        .withColumn("side", F.when(F.col("_lo") == F.col("_hi"), 0).when(F.col("_c") == F.col("_lo"), 1).otherwise(2))
        .drop("_k", "_c", "_o", "_lo", "_hi")
    )

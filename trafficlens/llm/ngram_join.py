"""Jaccard join on word n-grams with Bayesian candidate pruning (operator 8).

1. Every text becomes its set of word 5-grams (lower-cased, split on white
   space) and 128 MinHash values. Texts with the same set form a class; only
   one representative of a class goes on.
2. Bands of 4 values are the candidate buckets. At a similarity of 0.8 a pair
   shares at least one of 32 bands but for 1 pair in 20 million.
3. Within a bucket, MinHash values are compared 16 at a time; a pair is dropped
   as soon as the posterior probability (uniform prior, binomial matches) that
   its similarity reaches the threshold falls below ``tolerance``. What is
   left ties representatives into candidate groups. At the default of 1e-9 a
   pair of similarity 0.80 is dropped in one of the eight steps with
   probability 9.1e-9, at 0.81 with 2.5e-9, at 0.85 with 1.7e-11 (summed over
   the distribution of matches), so the loss stays below that of the bands.
4. Within a candidate group all pairs are pruned the same way and the rest are
   verified exactly on the n-grams themselves. Links are counted, and the
   verified links give the final groups.

A bucket or group of any size is dealt into blocks, and pairs of blocks are
the units of work, so no task holds a whole hot group; units return a row per
text (its links and the root of its part), never a row per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .common import chunk_units, giving_back, ship, sorted_groups, text_or_empty, text_slices
from .components import connected_components

HASHES, ROWS, STEP = 128, 4, 16
TOLERANCE = 1e-9  # least posterior probability of a pair that is still compared
BANDS = HASHES // ROWS
_U = np.uint64
_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
GRAM_CODE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | _U(1)
MULTIPLY = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) | _U(1)
ADD = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64)
PRIME = _U(0x9E3779B97F4A7C15)
PRIME_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        up, down = np.full(size, PRIME), np.full(size, PRIME_INVERSE)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
    return _powers


def words_of(text: str) -> list[str]:
    return text.lower().split()


def gram_hashes(words: list[str], n: int) -> np.ndarray:
    """Distinct 64-bit hashes of the n-grams of a word list; a list shorter
    than ``n`` is one gram, an empty list none."""
    if not words:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(" ".join(words).encode("utf-8", "replace"), np.uint8)
    up, down = _power_tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_CODE[raw] * up[: len(raw)], out=sums[1:])
    cut = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(raw)]))
    word = _mix((sums[ends] - sums[starts]) * down[starts])
    n = min(n, len(word))
    gram = np.zeros(len(word) - n + 1, np.uint64)
    for k in range(n):
        gram += word[k : len(word) - n + 1 + k] * GRAM_CODE[k % 64] + _U(k)
    return np.unique(_mix(gram))


def minhash(grams: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(grams), 1024):
        values = (MULTIPLY[:, None] * grams[None, i : i + 1024] + ADD[:, None]) >> _U(32)
        np.minimum(out, values.min(axis=1).astype(np.uint32), out=out)
    return out


def _signature_batches(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, signs, bands = [], [], []
            for text in (t for part in text_slices(batch.column(1)) for t in part.to_pylist()):
                grams = gram_hashes(words_of(text), n)
                if not len(grams):
                    keys.append(None), signs.append(None), bands.append(None)
                    continue
                s = minhash(grams)
                low = int(np.add.reduce(_mix(grams + PRIME)))
                high = int(np.bitwise_xor.reduce(_mix(grams))) ^ len(grams)
                keys.append(low.to_bytes(8, "big") + high.to_bytes(8, "big"))
                signs.append(s.tobytes())
                pair = s.view(np.uint64).reshape(BANDS, 2)
                band = _mix(_mix(pair[:, 0] + np.arange(BANDS, dtype=np.uint64)) * PRIME + pair[:, 1])
                bands.append(band.view(np.int64))
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(keys, pa.binary()), pa.array(signs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "h", "k", "sig", "bands"],
            )

    return run


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 16, 32, ... compared values: the fewest matches at which the
    posterior P(similarity >= threshold) is at least ``tolerance``. With a
    uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail is
    a binomial sum."""
    from math import comb

    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            tail = sum(comb(n + 1, j) * threshold**j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1))
            if tail >= tolerance:
                out.append(m)
                break
    return tuple(out)


def survivors(signs: np.ndarray, i: int, others: np.ndarray, need: tuple[int, ...]) -> np.ndarray:
    """Those of ``others`` that stay candidates of ``i``, 16 values at a time."""
    got = np.zeros(len(others), np.int32)
    for step, least in enumerate(need):
        part = slice(step * STEP, (step + 1) * STEP)
        got += (signs[others, part] == signs[i, part]).sum(axis=1, dtype=np.int32)
        ok = got >= least
        if not ok.all():
            others, got = others[ok], got[ok]
            if not len(others):
                break
    return others


def _prune_unit(need: tuple[int, ...]):
    """Edges of a spanning forest of each unit's surviving pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for unit in sorted_groups(batches, "unit"):
            keys = unit.column("k").to_pylist()
            signs = np.frombuffer(b"".join(unit.column("sig").to_pylist()), np.uint32).reshape(len(keys), HASHES)
            left = np.arange(len(keys))
            while len(left):
                root, queue, left = int(left[0]), [int(left[0])], left[1:]
                while queue and len(left):
                    found = survivors(signs, queue.pop(), left, need)
                    if len(found):
                        left = np.setdiff1d(left, found, assume_unique=True)
                        queue.extend(found.tolist())
                        us.extend(keys[f] for f in found)
                        vs.extend([keys[root]] * len(found))
            if len(us) > 10_000:
                yield _edges(us, vs)
                us, vs = [], []
        yield _edges(us, vs)

    return run


def _edges(us: list, vs: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])


def _verify_unit(n: int, threshold: float, need: tuple[int, ...]):
    """For each text of a unit with verified links: the root of its part of
    the unit and how many rows it links to (copies of the partner counted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in sorted_groups(batches, "unit"):
            keys, sides = unit.column("k").to_pylist(), unit.column("side").to_pylist()
            copies = unit.column("copies").to_pylist()
            lists = [words_of(t) for t in unit.column("text").to_pylist()]
            signs = np.stack([minhash(gram_hashes(w, n)) for w in lists])
            number: dict[tuple, int] = {}
            sets = []
            for w in lists:
                m = min(n, len(w))
                grams = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)}
                sets.append(np.fromiter((number.setdefault(g, len(number)) for g in grams), np.int64, len(grams)))
            sizes = np.array([len(s) for s in sets])
            side = np.array(sides)
            root, links = list(range(len(keys))), [0] * len(keys)

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            has = np.zeros(len(number), bool)
            for i in range(len(keys)):
                later = np.arange(i + 1, len(keys)) if side[i] == 0 else np.flatnonzero(side == 2) if side[i] == 1 else ()
                if not len(later):
                    continue
                later = later[np.minimum(sizes[later], sizes[i]) >= threshold * np.maximum(sizes[later], sizes[i]) - 1e-9]
                later = survivors(signs, i, later, need) if len(later) else later
                if not len(later):
                    continue
                has[sets[i]] = True
                joined = np.concatenate([sets[j] for j in later])
                starts = np.concatenate(([0], np.cumsum(sizes[later])[:-1]))
                common = np.add.reduceat(has[joined].astype(np.int64), starts)
                has[sets[i]] = False
                linked = later[common >= threshold * (sizes[i] + sizes[later] - common) - 1e-9]
                for j in linked.tolist():
                    links[i] += copies[j]
                    links[j] += copies[i]
                    root[find(j)] = find(i)
            hit = [i for i in range(len(keys)) if links[i]]
            yield pa.record_batch(
                [pa.array([keys[i] for i in hit], pa.binary()), pa.array([keys[find(i)] for i in hit], pa.binary()), pa.array([links[i] for i in hit], pa.int64())],
                names=["u", "v", "links"],
            )

    return run


def _by_unit(rows: DataFrame, run, schema: str) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(giving_back(run), schema)


def ngram_join(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    tolerance: float = TOLERANCE,
    block: int = 512,
    verify_block: int = 256,
) -> DataFrame:
    """One row per input row: ``<id_col>, class_id, n_links, class_size``.

    Two rows are linked when the Jaccard similarity of their word n-gram sets
    is at least ``threshold``; ``n_links`` counts the other rows linked to it
    (exact copies too), ``class_id`` is the smallest id of its connected
    group and ``class_size`` the rows of the group. Texts of fewer than ``n``
    words are one gram. Null, empty and blank texts have no gram: they link to
    nothing and are their own class (``class_id`` is their id). Null ids take
    part but never name a class unless all of it is null. Rows that repeat an
    id are rows of their own. Other columns are ignored. ``threshold`` must
    be 0.7 or more: the bands are laid out for 0.8.
    """
    rows, classes, _ = _joined(df, id_col, text_col, n, threshold, tolerance, block, verify_block)
    return rows.select("id", "k").join(classes.drop("keep_id", "keep_h"), "k", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("class_id", F.when(F.col("k").isNull(), F.col("id"))).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def keep_one(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    tolerance: float = TOLERANCE,
    block: int = 512,
    verify_block: int = 256,
) -> DataFrame:
    """The rows of ``df``, all columns, with one row of each linked group (see
    ``ngram_join``): that with the smallest id, null last. Texts without a gram
    stay, one row per id and text."""
    rows, classes, base = _joined(df, id_col, text_col, n, threshold, tolerance, block, verify_block)
    kept = classes.select(F.col("keep_id").alias("_id"), F.col("keep_h").alias("_h")).union(rows.where("k is null").select("id", "h")).distinct()
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id_col).alias("_own"), F.xxhash64(text_or_empty(text_col)).alias("_hash"))
    found = whole.join(kept, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")))
    once = Window.partitionBy("_id", "_h").orderBy(F.lit(1))
    return found.withColumn("_n", F.row_number().over(once)).where("_n = 1").select("_row.*")


def _joined(df: DataFrame, id_col: str, text_col: str, n: int, threshold: float, tolerance: float, block: int, verify_block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, h, k), classes by k, and the input as (id, text, h)."""
    if not 0.7 <= threshold <= 1.0:
        raise ValueError("threshold must be between 0.7 and 1")
    ship(df.sparkSession)
    need = least_matches(threshold, tolerance)
    id_type = df.schema[id_col].dataType.simpleString()
    base = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    base = base.withColumn("h", F.xxhash64("text"))

    rows = materialize(base.mapInArrow(giving_back(_signature_batches(n)), f"id {id_type}, h bigint, k binary, sig binary, bands array<bigint>"), name="minhash")
    reps = materialize(
        rows.where("k is not null")
        .groupBy("k")
        .agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("sig").alias("sig"),
            F.first("bands").alias("bands"),
        )
        .select("k", F.col("rep.id").alias("rep"), F.col("rep.h").alias("h"), "copies", "sig", "bands"),
        name="ngram-classes",
    )
    # buckets of two or more; of buckets with the same members one is enough
    placed = reps.select("k", F.posexplode("bands").alias("band", "value"))
    buckets = (
        placed.groupBy("band", "value")
        .agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("k")).alias("x"), F.sum(F.pmod(F.xxhash64("k", F.lit(1)), F.lit(1 << 40))).alias("y"))
        .where("size > 1")
        .groupBy("size", "x", "y")
        .agg(F.min(F.struct("band", "value")).alias("b"))
        .select("size", "b.band", "b.value")
    )
    members = placed.join(buckets, ["band", "value"]).select(F.concat_ws("/", "band", "value").alias("bucket"), "k", "size")
    units = chunk_units(members, "bucket", "k", "size", block).select("unit", "k").join(reps.select("k", "sig"), "k")
    groups = connected_components(_by_unit(units.select("unit", "k", "sig"), _prune_unit(need), "u binary, v binary"))

    sized = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    todo = groups.join(sized, "component").select(F.hex("component").alias("group"), F.col("node").alias("k"), "size")
    todo = todo.join(reps.select("k", "rep", "h", "copies"), "k")
    # the representative's row by id and text hash; a row that occurs several times counts once
    texts = base.join(todo, base["id"].eqNullSafe(todo["rep"]) & (base["h"] == todo["h"])).groupBy("group", "k", "size", "copies").agg(F.first("text").alias("text"))
    texts = chunk_units(texts, "group", "k", "size", verify_block)
    found = materialize(
        _by_unit(texts.select("unit", "side", "k", "copies", "text"), _verify_unit(n, threshold, need), "u binary, v binary, links bigint"),
        name="links",
    )
    final = connected_components(found.select("u", "v"))
    counted = found.groupBy(F.col("u").alias("k")).agg(F.sum("links").alias("links"))
    classes = reps.select("k", "rep", "h", "copies").join(final.select(F.col("node").alias("k"), "component"), "k", "left")
    classes = classes.join(counted, "k", "left").withColumn("component", F.coalesce("component", "k"))
    first = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "h"))
    named = classes.groupBy("component").agg(first.alias("first"), F.sum("copies").alias("class_size"))
    classes = classes.join(named, "component").select(
        "k",
        F.col("first.rep").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "class_size",
        F.col("first.rep").alias("keep_id"),
        F.col("first.h").alias("keep_h"),
    )
    return rows.select("id", "h", "k"), classes, base

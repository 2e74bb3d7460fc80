"""Nearest neighbours by a hierarchical k-means tree (operator 4).

The tree is fitted on a bounded sample; every row is put into a leaf. A query
visits leaves best bin first: a priority queue holds the open nodes by the
similarity of their centre, and the best is opened next. How many leaves are
visited is calibrated: for a bounded sample of queries the true neighbours are
found by brute force over all rows, and the visits are widened by a quarter
until the sample's recall reaches the wanted value.

Equal vectors are folded first: of a group only the ``k + 1`` smallest ids can
be among anyone's ``k`` nearest, so a vector shared by a third of all rows is
one row. Leaves meet their queries in units of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .common import ship, shuffle_partitions, sorted_groups


def usable_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: the rows that take part, with the vector as float64 bytes.
    Null vectors, zero vectors and those holding null, NaN or infinity do not;
    nor do null ids, or vectors of another length than most rows have: there is
    no cosine between vectors of different length."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall(v, lambda x: x == 0.0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("x"), bad.alias("bad"), zero.alias("zero")).where(
        "id is not null and x is not null and not coalesce(bad, true) and not coalesce(zero, true)"
    )
    common = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("x") == (common["n"] if common else 0))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(1)
            flat = np.asarray(col.flatten(), np.float64) + 0.0  # -0.0 becomes 0.0
            d = len(flat) // max(1, len(col))
            data = [flat[i * d : (i + 1) * d].tobytes() for i in range(len(col))]
            yield pa.record_batch([b.column(0), pa.array(data, pa.binary())], names=["id", "v"])

    ship(df.sparkSession)
    return rows.select("id", "x").mapInArrow(pack, "id bigint, v binary")


def fold_equal(rows: DataFrame, keep: int) -> DataFrame:
    """``key, v, ids``: one row per distinct vector with its ``keep`` smallest
    ids; ``key`` is the smallest. In two steps, so that a vector held by many
    rows is first cut down in many tasks."""
    salt = F.pmod(F.xxhash64("id"), F.lit(shuffle_partitions(rows.sparkSession)))
    rows = rows.withColumn("_s", salt)
    for by in (["v", "_s"], ["v"]):
        rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("_r") <= keep).drop("_r")
    return rows.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.get("ids", F.lit(0)).alias("key"), "v", "ids")


def _matrix(col) -> np.ndarray:
    values = col.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@dataclass
class Tree:
    """Node ``i`` has its children at ``children[i]`` (empty: a leaf), their
    centres in ``centres[i]``; ``leaf[i]`` numbers the leaves."""

    children: list[list[int]]
    centres: list[np.ndarray | None]
    leaf: list[int]
    leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row: the nearest child at every level."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            best = (x[rows] @ self.centres[node].T).argmax(axis=1)
            todo += [(child, rows[best == i]) for i, child in enumerate(self.children[node]) if (best == i).any()]
        return out

    def visits(self, q: np.ndarray, most: int) -> list[int]:
        """Leaves in the order of a best-bin-first search."""
        heap, out = [(-1.0, 0)], []
        while heap and len(out) < most:
            _, node = heappop(heap)
            if not self.children[node]:
                out.append(self.leaf[node])
                continue
            near = self.centres[node] @ q
            for child, s in zip(self.children[node], near.tolist()):
                heappush(heap, (-s, child))
        return out


def _split(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    """Spherical k-means; the cluster of each row."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centres)
    return (x @ centres.T).argmax(axis=1)


def build_tree(x: np.ndarray, leaf_size: int, branching: int = 8, rounds: int = 8, seed: int = 5) -> Tree:
    """Split unit rows until a node has at most ``leaf_size`` of them."""
    rng = np.random.default_rng(seed)
    tree = Tree([[]], [None], [-1], 0)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        near = _split(x[rows], branching, rounds, rng) if len(rows) > leaf_size else np.zeros(len(rows), int)
        groups = [rows[near == c] for c in np.unique(near)]
        if len(groups) < 2:
            tree.leaf[node], tree.leaves = tree.leaves, tree.leaves + 1
            continue
        centres = np.stack([x[g].mean(axis=0) for g in groups])
        norm = np.sqrt((centres * centres).sum(axis=1, keepdims=True))
        tree.centres[node] = centres / np.where(norm > 0, norm, 1)
        for g in groups:
            tree.children[node].append(len(tree.children))
            todo.append((len(tree.children), g))
            tree.children.append([]), tree.centres.append(None), tree.leaf.append(-1)
    return tree


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of one vector to each row, in double precision, the same way for
    every row wherever it stands. Vectors are brought to a like size by powers
    of two first, which rounds nothing and keeps squares of very large or
    small components within the range of doubles."""
    q = np.ldexp(q, -np.frexp(np.abs(q).max())[1])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    dot = (x * q).sum(axis=1)
    return dot / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


def _best(q: np.ndarray, rough: np.ndarray, x: np.ndarray, ids: list[list[int]], k: int) -> tuple[list[int], list[float]]:
    """The ``k`` nearest ids (ties to the smaller) of the rows ``x``; ``rough``
    are their similarities to within rounding."""
    if len(rough) > k:
        edge = np.partition(rough, len(rough) - k)[len(rough) - k]
        near = np.flatnonzero(rough >= edge - 1e-9)
    else:
        near = np.arange(len(rough))
    exact = cosines(q, x[near])
    found = sorted((-s, i) for s, r in zip(exact.tolist(), near.tolist()) for i in ids[r])[:k]
    return [i for _, i in found], [-s for s, _ in found]


def _search_unit(k: int):
    """Nearest rows of a unit for each of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in sorted_groups(batches, "unit"):
            is_query = np.array(unit.column("ids").is_null())
            rows, queries = unit.filter(pa.array(~is_query)), unit.filter(pa.array(is_query))
            if not len(rows) or not len(queries):
                continue
            x, ids = _matrix(rows.column("v")), rows.column("ids").to_pylist()
            ux = _unit(x)
            out = ([], [], [])
            for i in range(0, len(queries), 256):
                part = queries.slice(i, 256)
                qs = _matrix(part.column("v"))
                rough = _unit(qs) @ ux.T
                for key, q, r in zip(part.column("key").to_pylist(), qs, rough):
                    best, score = _best(q, r, x, ids, k)
                    out[0].extend([key] * len(best)), out[1].extend(best), out[2].extend(score)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["key", "id", "score"])

    return run


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def brute_force(rows: DataFrame, queries: list[tuple[int, bytes]], k: int) -> DataFrame:
    """``key, id, score, rank`` of the ``k`` nearest of all ``rows`` (key, v,
    ids) for a short list of queries (key, v), in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qs = _matrix(pa.array([v for _, v in shared.value], pa.binary()))
        for b in batches:
            if not b.num_rows:
                continue
            x, ids = _matrix(b.column(0)), b.column(1).to_pylist()
            rough = _unit(qs) @ _unit(x).T
            out = ([], [], [])
            for (key, _), q, r in zip(shared.value, qs, rough):
                best, score = _best(q, r, x, ids, k)
                out[0].extend([key] * len(best)), out[1].extend(best), out[2].extend(score)
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["key", "id", "score"])

    return _top(rows.select("v", "ids").mapInArrow(run, "key bigint, id bigint, score double"), k)


def calibrated_visits(tree: Tree, queries: list[tuple[int, bytes]], truth: dict[int, list[np.ndarray]], recall: float) -> tuple[int, float]:
    """Leaves to visit, widened by a quarter until the true neighbours found reach ``recall``;
    ``truth`` has the vectors of each query's neighbours."""
    needed = []
    for key, v in queries:
        near = truth.get(key, [])
        if near:
            order = {leaf: i for i, leaf in enumerate(tree.visits(_unit(np.frombuffer(v)[None])[0], tree.leaves))}
            needed += [order[leaf] for leaf in tree.assign(_unit(np.stack(near))).tolist()]
    if not needed:
        return tree.leaves, 1.0
    visits = 1
    while visits < tree.leaves and np.mean(np.array(needed) < visits) < recall:
        visits += -(-visits // 4)
    return min(visits, tree.leaves), float(np.mean(np.array(needed) < visits))


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = 0.95,
    sample: int = 20_000,
    calibration: int = 200,
    leaf_rows: int | None = None,
    block: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row for which ``is_query``
    (an expression on ``id``) holds, the ``k`` nearest other rows found by
    cosine, ties to the smaller id; all of them if there are fewer.

    ``leaf_rows`` is the most rows of a leaf, measured on the sample; by
    default four times the square root of the number of distinct vectors.
    The tree is fitted on at most ``sample`` distinct vectors and calibrated on
    at most ``calibration`` queries; every row is indexed and every query is
    answered. Unusable vectors (see ``usable_vectors``) take no part. Rows
    that repeat id and vector count once; an id with several vectors has each
    as a candidate, and as a query whose neighbours exclude that id. Columns
    other than id and vector are ignored. An empty table gives no rows.
    """
    spark = df.sparkSession
    ship(spark)
    usable = materialize(usable_vectors(df, id_col, vector_col).distinct(), name="vectors")
    rows = materialize(fold_equal(usable, k + 1), name="distinct-vectors")
    asked = usable.where(is_query)
    queries = materialize(asked.groupBy("v").agg(F.min("id").alias("key")), name="query-vectors")

    total = rows.count()
    chosen = rows.orderBy(F.xxhash64("v"), "key").limit(sample).select("v").collect()
    if not chosen:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    x = _unit(np.frombuffer(b"".join(r["v"] for r in chosen), np.float64).reshape(len(chosen), -1))
    tree = build_tree(x, max(8, int((leaf_rows or 4 * total**0.5) * len(chosen) / total)))

    tests = [(r["key"], bytes(r["v"])) for r in queries.orderBy(F.xxhash64("v"), "key").limit(calibration).collect()]
    truth: dict[int, list[np.ndarray]] = {}
    if tests:
        near = brute_force(rows, tests, k + 1).where(F.col("id") != F.col("key"))
        for r in near.join(usable.select("id", "v"), "id").select("key", "v").collect():  # calibration * (k + 1) rows
            truth.setdefault(r["key"], []).append(np.frombuffer(r["v"]))
    visits, _ = calibrated_visits(tree, tests, truth, recall)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = shared.value.assign(_unit(_matrix(b.column(1))))
                yield pa.record_batch([*b.columns, pa.array(leaf, pa.int64())], names=["key", "v", "ids", "leaf"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                lists = [shared.value.visits(q, visits) for q in _unit(_matrix(b.column(1)))]
                at = pa.array(np.repeat(np.arange(len(lists)), [len(o) for o in lists]))
                leaf = pa.array([leaf for o in lists for leaf in o], pa.int64())
                yield pa.record_batch([b.column(0).take(at), b.column(1).take(at), leaf], names=["key", "v", "leaf"])

    indexed = materialize(rows.select("key", "v", "ids").mapInArrow(place, "key bigint, v binary, ids array<bigint>, leaf bigint"), name="leaves")
    probes = materialize(queries.select("key", "v").mapInArrow(probe, "key bigint, v binary, leaf bigint"), name="probes")
    sizes = indexed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).alias("nv")).join(
        probes.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).alias("nq")), "leaf"
    )
    mine = lambda n: F.pmod(F.xxhash64("key"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    unit = F.concat_ws(":", "leaf", "a", "b").alias("unit")
    left = indexed.join(sizes, "leaf").withColumn("a", mine("nv")).withColumn("b", each("nq")).select(unit, "key", "v", "ids")
    right = probes.join(sizes, "leaf").withColumn("b", mine("nq")).withColumn("a", each("nv")).select(unit, "key", "v", F.lit(None).cast("array<bigint>").alias("ids"))
    found = left.union(right).repartition("unit").sortWithinPartitions("unit").mapInArrow(_search_unit(k + 1), "key bigint, id bigint, score double")
    best = _top(found, k + 1).drop("rank")

    answers = asked.join(queries, "v").select(F.col("id").alias("query_id"), "key").distinct().join(best, "key").where(F.col("id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        answers.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
    )

"""Connected components of an undirected edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, component`` for each node of ``edges`` (``u, v``, any orderable
    type); the component is its smallest node. Rows with a null end or equal
    ends are left out.

    Every round links each node's larger neighbours to its smallest one, then
    its smaller neighbours likewise, until nothing changes: a logarithmic
    number of rounds, each a join on the node with a written result, so no
    neighbourhood is gathered in one task and a lost executor costs one round.
    Smallest neighbours are found by a partial aggregate.
    """
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name="edges")
    mark = _mark(e)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        # large star: neighbours above a node move to its smallest neighbour
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its neighbours below it move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        e = materialize(small, name="edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 40)))).first()
    return tuple(row)

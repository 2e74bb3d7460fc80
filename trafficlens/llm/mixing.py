"""Mixing sources to target weights by weighted fair queueing (operator 6).

Every source plays its documents in a shuffled order, over and over up to
``max_repeats`` times. A document's virtual finish time is the number of its
source's tokens played up to its end, divided by the source's target. All
plays are sorted globally by their finish times and truncated where the total
budget is reached; at time 1 every source has just played its target.

Both orders, the shuffle and the mix, are global range sorts: rows are range-
partitioned and sorted, and a place is the number of rows in the ranges before
it plus its row number in its own. Running token counts are sums in two levels
in the same way: totals of the ranges, then a running sum inside one. The last
sort keys tell equal rows apart, so a source, an id or a text of any frequency
is split over many ranges. Only SQL functions are used; the totals of the
ranges are all that goes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .exact_dedup import row_hash

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """``src, source_size, weight, target`` from ``src, source_size``.

    Sources in the order of ``src`` take the weights in turn. The total is
    shared by weight; a source stops at ``max_repeats`` times its size and the
    excess is shared among the others by weight until none is above. That is
    one level: ``target = min(cap, level * weight)``. Going through the sources
    by cap / weight, the level is the rest of the total over the rest of the
    weights at the first source that does not reach its cap. The windows here
    run over one row per source.
    """
    ws = F.array(*[F.lit(float(w)) for w in weights])
    rank = F.row_number().over(Window.orderBy("last", "src"))
    t = sizes.withColumn("weight", F.get(ws, (rank - 1) % len(weights)))
    t = t.withColumn("cap", (F.col("source_size") * max_repeats).cast("double")).withColumn("full_at", F.col("cap") / F.col("weight"))
    order = Window.orderBy("full_at", "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    t = t.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    t = t.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    t = t.withColumn("level", F.min(F.when(F.col("full_at") > F.col("level"), F.struct("full_at", "level"))).over(everything)["level"])
    target = F.when(F.col("level").isNull() | (F.col("full_at") <= F.col("level")), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return t.select("src", "source_size", "weight", target.alias("target"))


def range_sorted(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows sorted globally, written, with ``_range`` and their row number
    ``_at`` in it. Ranges follow one another in the given order."""
    sort = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    table = materialize(sort, name=name)
    return table.withColumns({"_range": F.shiftright("_place", 33), "_at": F.col("_place").bitwiseAND((1 << 33) - 1)}).drop("_place")


def _shuffled(df: DataFrame, weights: Sequence[float], id_col: str, text_col: str, source_col: str, max_repeats: int, seed: str) -> DataFrame:
    """Narrow rows in the shuffled order of their source, with ``played``, the
    words of the source up to the end of the row, and the source's target."""
    base = df.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"), row_hash(df).alias("tie")
    )
    base = base.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    base = base.withColumn("key", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    # rows that are equal throughout may stand in any order, but must not all meet in one range
    rows = range_sorted(base.withColumn("copy", F.monotonically_increasing_id()), ["src", "key", "id", "size", "tie", "copy"], "mix-shuffled")
    ranges = rows.groupBy("src", "_range").agg(F.sum("size").alias("words"))
    sizes = ranges.groupBy("src").agg(F.sum("words").alias("source_size")).withColumn("last", F.col("src") == "")
    targets = source_targets(sizes, weights, max_repeats).drop("weight")
    up_to = Window.partitionBy("src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.withColumn("start", F.coalesce(F.sum("words").over(up_to), F.lit(0))).join(targets, "src").drop("words")
    inside = Window.partitionBy("src", "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = rows.join(starts, ["src", "_range"]).withColumn("played", F.col("start") + F.sum("size").over(inside))
    return timed.drop("start").withColumn("row", F.struct("_range", "_at")).drop("_range", "_at")


def _plays(rows: DataFrame, max_repeats: int) -> DataFrame:
    """The plays of the mix with their ``position`` 0, 1, 2, ...: all plays in
    a global sort by finish time, cut before the first one at which the words
    would exceed those of all rows once."""
    epoch = F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))
    plays = rows.where("target > 0").withColumn("epoch", epoch).withColumn("finish", (F.col("epoch") * F.col("source_size") + F.col("played")) / F.col("target"))
    order = ["finish", "src", "key", "epoch", "id", "size", "tie", "copy"]
    sort = range_sorted(plays.select(*order, "row"), order, "mix-plays")
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = sorted(sort.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")).toLocalIterator())
    words, counts = np.cumsum([0] + [r.words for r in ranges]), np.cumsum([0] + [r.n for r in ranges])
    over = next((i for i in range(len(ranges)) if words[i + 1] > total), len(ranges))
    cut, ahead = (ranges[over]._range, int(words[over])) if over < len(ranges) else (None, 0)
    offsets = df_of(sort, [(r._range, int(c)) for r, c in zip(ranges, counts)], "_range bigint, _offset bigint")
    placed = sort.join(offsets, "_range").withColumn("position", F.col("_offset") + F.col("_at")).drop("_offset")
    if cut is None:
        return placed
    # the budget runs out in this range: a running sum over its rows alone
    inside = Window.partitionBy("_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = sort.where(F.col("_range") == cut).withColumn("end", F.lit(ahead) + F.sum("size").over(inside))
    stop = edge.where(F.col("end") > total).agg(F.min("_at")).first()[0]
    return placed.where((F.col("_range") < cut) | ((F.col("_range") == cut) & (F.col("_at") < stop)))


def df_of(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def mix(
    df: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_repeats: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """One row per input row: ``<id_col>, source, size, source_size, target,
    times, taken, first_play``.

    ``size`` is the number of words (runs of non-space; null text: 0). Sources
    sort by code point, null last; a null source is a source of its own.
    ``target`` is the source's, ``times`` how often the mix plays the row,
    ``taken = times * size``, ``first_play`` the position of its first play in
    the mix (null if it has none). The budget is the sum of all sizes; plays
    stop before the first one that would exceed it. The shuffle is an md5 of
    seed and id, so reruns agree; rows that share an id are ordered by size
    and by a hash of all their columns. Rows without words take nothing from
    the budget and are played all the same. Other columns are ignored but for
    that hash. An empty table gives an empty result.
    """
    rows = materialize(_shuffled(df, weights, id_col, text_col, source_col, max_repeats, seed), name="mix-rows")
    played = _plays(rows, max_repeats).groupBy("row").agg(F.count(F.lit(1)).alias("times"), F.min("position").alias("first_play"))
    return rows.join(played, "row", "left").select(
        F.col("id").alias(id_col),
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce("times", F.lit(0)).cast("int").alias("times"),
        (F.coalesce("times", F.lit(0)) * F.col("size")).cast("long").alias("taken"),
        "first_play",
    )


def mixed_rows(
    df: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_repeats: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: a whole row of ``df`` for each play, sorted globally in
    the order of the mix. The plays are found on narrow rows; whole rows are
    joined to them once, by id and a hash of all columns."""
    rows = materialize(_shuffled(df, weights, id_col, text_col, source_col, max_repeats, seed), name="mix-rows")
    plays = _plays(rows, max_repeats).select("id", "tie", "position")
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(id_col).alias("_id"), row_hash(df).alias("_tie"))
    # rows that are equal in every column are one here, combined before they move
    whole = whole.groupBy("_id", "_tie").agg(F.first("_row").alias("_row"))
    met = whole.join(plays, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tie") == F.col("tie")))
    return met.repartitionByRange("position").sortWithinPartitions("position").select("_row.*")

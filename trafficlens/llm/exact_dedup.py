"""Exact duplicates by a tree merge of sorted digest runs (operator 10).

The rows are dealt to runs. A run is kept in slices, by digest range; a slice
is one sorted array of entries: digest, the row to retain, the row count. In
each round ``fan_in`` neighbouring runs are exchanged slice by slice, their
sorted arrays are merged (the sort underneath detects ascending runs and merges
them), and neighbours of equal digest are folded into one entry with the
retained row of all. After ``log(runs)`` rounds one run is left, spread over
all partitions by slice. Slices grow in number with the rows, so no array
holds more than some thousand entries at any level.

A digest held by a third of all rows is folded to one entry per run before it
moves, and the way back to the rows is a join on (digest, run), so no task sees
more of it than one run holds. Equal digests must also agree in length and in
an independent hash at every merge.

Only SQL functions: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .common import shuffle_partitions, text_or_empty

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGEST = ["_sha", "_len", "_xx"]
SLICE_ENTRIES = 2048  # entries of a slice of the last run, about


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only. All-ASCII texts (as many bytes as characters) take
    the plain ``lower``; others a character map."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(
        F.when(col.rlike("[A-Z]"), F.translate(col, UPPER, UPPER.lower())).otherwise(col)
    )


def with_digest(df: DataFrame, text_col: str, normalise=ascii_lower) -> DataFrame:
    """Adds the SHA-256 of the normalised text and, to verify it at every
    merge, its length and an independent 64-bit hash. Null text is empty."""
    return (
        df.withColumn("_norm", normalise(text_or_empty(text_col)))
        .withColumn("_sha", F.unhex(F.sha2(F.col("_norm"), 256)))
        .withColumn("_len", F.octet_length("_norm"))
        .withColumn("_xx", F.xxhash64("_norm"))
        .drop("_norm")
    )


def _entry(who: Column, n: Column) -> Column:
    return F.struct(*DIGEST, who.alias("who"), n.alias("n"))


def first_runs(rows: DataFrame, keep: str) -> DataFrame:
    """``_run, _slice, entries``: the sorted run slices of ``rows``, which has
    ``_who`` (compared to find the row to retain), the digest, run and slice."""
    pick = F.max if keep == "max" else F.min
    folded = rows.groupBy("_run", "_slice", *DIGEST).agg(pick("_who").alias("_who"), F.count(F.lit(1)).alias("_n"))
    return folded.groupBy("_run", "_slice").agg(F.sort_array(F.collect_list(_entry(F.col("_who"), F.col("_n")))).alias("entries"))


def merge_round(level: DataFrame, fan_in: int, keep: str) -> DataFrame:
    """Each ``fan_in`` neighbouring runs become one: a multiway merge of their
    sorted slices, then one entry for each digest."""
    met = level.groupBy(F.floor(F.col("_run") / F.lit(fan_in)).alias("_run"), "_slice").agg(F.collect_list("entries").alias("lists"))
    merged = met.select("_run", "_slice", F.sort_array(F.flatten("lists")).alias("all"))
    pick = F.array_max if keep == "max" else F.array_min
    same = lambda x, y: (x["_sha"] == y["_sha"]) & (x["_len"] == y["_len"]) & (x["_xx"] == y["_xx"])

    def fold(x: Column, i: Column) -> Column:
        # a digest stands once in each run, so its entries are among the next ``fan_in``
        group = F.filter(F.slice("all", i + 1, F.lit(fan_in)), lambda y: same(x, y))
        total = F.aggregate(group, F.lit(0).cast("bigint"), lambda t, y: t + y["n"])
        folded = F.struct(x["_sha"].alias("_sha"), x["_len"].alias("_len"), x["_xx"].alias("_xx"), pick(F.transform(group, lambda y: y["who"])).alias("who"), total.alias("n"))
        return F.when((i == 0) | ~same(x, F.get("all", F.greatest(i - 1, F.lit(0)))), folded)

    return merged.select("_run", "_slice", F.array_compact(F.transform("all", fold)).alias("entries"))


def merge_runs(rows: DataFrame, runs: int, fan_in: int, keep: str) -> tuple[DataFrame, DataFrame]:
    """The entries of the first runs (with their run), and those of the last
    one: one row per digest with ``keep`` and ``group_size``."""
    level = first = materialize(first_runs(rows, keep), name="digest-run")
    left = runs
    while left > 1:
        left = -(-left // fan_in)
        level = merge_round(level, fan_in, keep)
    entries = lambda df, *more: df.select(*more, F.inline("entries"))
    last = entries(level).select(*DIGEST, F.col("who").alias("keep"), F.col("n").alias("group_size"))
    return entries(first, "_run").select("_run", *DIGEST), last


def _placed(df: DataFrame, id_col: str, text_col: str, normalise, tie: Column, runs: int) -> DataFrame:
    """Narrow rows, written: id, ``_who``, digest, run and slice."""
    base = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"), tie.alias("_tie"))
    narrow = with_digest(base, "_text", normalise).drop("_text").withColumn("_at", F.monotonically_increasing_id())
    small = materialize(narrow, name="digests")
    slices = max(1, -(-small.count() // SLICE_ENTRIES))
    at = F.conv(F.substring(F.hex("_sha"), 1, 12), 16, 10).cast("bigint")
    # a null id loses to any other; rows of one id are told apart by a hash, equal rows by their place
    return small.withColumns({"_run": F.pmod(F.xxhash64("_at"), F.lit(runs)), "_slice": F.floor(at / F.lit((1 << 48) / slices))})


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns, with the places of nulls, which a hash skips."""
    columns = [F.to_json(f"`{c}`") if kind.startswith("map<") else F.col(f"`{c}`") for c, kind in df.dtypes]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def _who(keep: str) -> Column:
    known = F.col("_id").isNotNull() if keep == "max" else F.col("_id").isNull()
    return F.struct(known.alias("known"), F.col("_id").alias("id"), F.col("_tie").alias("tie"), F.col("_at").alias("at"))


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    fan_in: int = 8,
    runs: int | None = None,
    normalise=ascii_lower,
) -> DataFrame:
    """One row per input row: ``<id_col>, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their normalised forms are (A-Z lower-cased by
    default). Of equal texts the row with the smallest id stays
    (``keep="max"``: the largest). Null text is empty text; null ids lose to
    any other id, and a group of null ids alone retains one of them. If the
    retained id occurs on several rows of the group, exactly one of them is
    ``kept``. Other columns are ignored. An empty table gives an empty result.
    """
    runs = runs or max(fan_in, shuffle_partitions(df.sparkSession))
    tie = F.xxhash64(F.col(text_col).cast("string"))
    rows = _placed(df, id_col, text_col, normalise, tie, runs).withColumn("_who", _who(keep))
    first, last = merge_runs(rows, runs, fan_in, keep)
    back = first.join(last, DIGEST)
    found = rows.join(back, ["_run", *DIGEST])
    return found.select(
        F.col("_id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("_at") == F.col("keep.at")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


def keep_one(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "min",
    fan_in: int = 8,
    runs: int | None = None,
    normalise=ascii_lower,
) -> DataFrame:
    """The rows of ``df``, all columns, with one row of each group of equal
    texts: that which ``exact_dedup`` keeps. Of rows with the retained id and
    other columns that differ, the one with the smallest (``keep="max"``:
    largest) hash of the whole row stays, on any partitioning."""
    runs = runs or max(fan_in, shuffle_partitions(df.sparkSession))
    columns = [F.col(f"`{c}`") for c in df.columns]
    tie = row_hash(df)
    rows = _placed(df, id_col, text_col, normalise, tie, runs).withColumn("_who", _who(keep))
    _, last = merge_runs(rows, runs, fan_in, keep)
    winners = last.select(F.col("keep.id").alias("_id"), F.col("keep.tie").alias("_tie"))
    whole = df.select(F.struct(*columns).alias("_row"), F.col(id_col).alias("_own"), tie.alias("_hash"))
    # rows that are equal in every column are one here, combined before they move
    whole = whole.groupBy("_own", "_hash").agg(F.first("_row").alias("_row"))
    return whole.join(winners, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tie")), "left_semi").select("_row.*")

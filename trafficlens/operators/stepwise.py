"""Stepwise use of held-out rows: at every step the model knows all earlier
rows and predicts the next one (F5 with M4, rolling origin).

A linear model is its moments, and moments add up, so no step is refitted from
rows. One aggregate sums the rows before the cutoff, one the held-out rows by
blocks of consecutive steps; the block sums, added up in order, give the state
at the start of every block. Blocks then run apart: each step solves a system
as wide as the features, predicts, and adds its own row to the moments.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col
from .moments import Moments, collect_moments, fold_moments, ridge
from .timeseries import ordered

STEPS = 4096  # steps of a block


def rolling_origin(
    df: DataFrame,
    features: Sequence[str],
    label: str = "label",
    ts: str = "bucket",
    cutoff: str | None = None,
    last: str | None = None,
    reg: float = 0.0,
    intercept: bool = True,
    steps: int = STEPS,
) -> DataFrame:
    """``ts, label, prediction, n_train, coefficients, intercept`` of each row
    from the cutoff on, predicted by the least squares over all rows before it.

    ``cutoff`` is a timestamp literal, ``last`` an interval back from the
    latest row, as in ``load.time_cut``. One row per time. Rows with a null
    feature have no prediction, and rows with a null feature or label teach
    nothing. Without any earlier row the prediction is null. The moments of
    each block go through the driver: features squared numbers per ``steps``
    rows.
    """
    if (cutoff is None) == (last is None):
        raise ValueError("give exactly one of cutoff or last")
    names = [*features, label]
    narrow = df.select(ts, *[col(c).cast("double").alias(f"v{i}") for i, c in enumerate(names)]).where(col(ts).isNotNull())
    bound = F.lit(cutoff).cast("timestamp_ntz") if cutoff is not None else narrow.select(F.max(ts)).scalar() - F.expr(f"INTERVAL {last}")
    late = ordered(narrow.where(col(ts) >= bound), ts).withColumn("_block", F.floor(col("position") / steps))
    x, y = [f"v{i}" for i in range(len(features))], f"v{len(features)}"
    state = collect_moments(fold_moments(narrow.where(col(ts) < bound), x, y)).get(None, Moments.none(len(names)))
    own = collect_moments(fold_moments(late, x, y, "_block"))
    starts = {}
    for block in range(late.select(F.count_distinct("_block")).first()[0]):  # one state per block of steps
        starts[block] = state
        state = state + own.get(block, Moments.none(len(names)))
    shared = df.sparkSession.sparkContext.broadcast(starts)

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("position")
        m = shared.value[key[0]]
        values = part[[*x, y]].to_numpy(float)
        out = []
        for row in values:
            w, b = ridge(m, reg, intercept) if m.n else (np.full(len(x), np.nan), np.nan)
            out.append((float(row[:-1] @ w + b), m.n, w.tolist(), b))
            if not np.isnan(row).any():
                m = m + Moments(1, row, np.zeros((len(row), len(row))))
        made = pd.DataFrame(out, columns=["prediction", "n_train", "coefficients", "intercept"])
        return pd.concat([part[[ts, y]].rename(columns={y: "label"}).reset_index(drop=True), made], axis=1)

    schema = T.StructType(
        [
            late.schema[ts],
            T.StructField("label", T.DoubleType()),
            T.StructField("prediction", T.DoubleType()),
            T.StructField("n_train", T.LongType()),
            T.StructField("coefficients", T.ArrayType(T.DoubleType())),
            T.StructField("intercept", T.DoubleType()),
        ]
    )
    out = late.groupBy("_block").applyInPandas(run, schema)
    known = lambda c: F.when(~F.isnan(c), col(c))
    return out.withColumns({"label": known("label"), "prediction": known("prediction"), "intercept": known("intercept")})

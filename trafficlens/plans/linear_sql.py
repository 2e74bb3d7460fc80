"""Least squares in plain SQL, for the oracles: the normal equations of each
group as a long table (i, j, v), solved by Gauss-Jordan elimination, one CTE
per pivot. The systems are positive definite, so no rows are exchanged."""

from __future__ import annotations

from collections.abc import Sequence


def eliminate(name: str, size: int, keys: Sequence[str]) -> list[str]:
    """CTEs that solve the systems of table ``<name>0 (keys, i, j, v)`` with
    i, j = 1..size and the right-hand side at j = size + 1; the last one is
    ``<name>_solution (keys, i, v)``."""
    key = ", ".join(keys)
    a_key = ", ".join(f"a.{k}" for k in keys)
    same = lambda t: " AND ".join(f"{t}.{k} = a.{k}" for k in keys)
    out = []
    for k in range(1, size + 1):
        out.append(
            f"{name}{k} AS MATERIALIZED (SELECT {a_key}, a.i, a.j, "
            f"CASE WHEN a.i = {k} THEN a.v / d.v ELSE a.v - c.v * p.v / d.v END AS v FROM {name}{k - 1} AS a "
            f"JOIN {name}{k - 1} AS p ON {same('p')} AND p.i = {k} AND p.j = a.j "
            f"JOIN {name}{k - 1} AS c ON {same('c')} AND c.i = a.i AND c.j = {k} "
            f"JOIN {name}{k - 1} AS d ON {same('d')} AND d.i = {k} AND d.j = {k})"
        )
    out.append(f"{name}_solution AS (SELECT {key}, i, v FROM {name}{size} WHERE j = {size + 1})")
    return out


def ridge(name: str, source: str, keys: Sequence[str], features: Sequence[str], label: str, reg: str = "0", intercept: str = "true") -> list[str]:
    """CTEs up to ``<name> (keys, w, b)``: coefficients (a list) and intercept
    of the least squares over the rows of ``source`` for each key. ``reg`` and
    ``intercept`` are expressions over the keys; the penalty counts in units
    of the standard deviations of features and label."""
    p, key = len(features), ", ".join(keys)
    cells = []
    for i, x in enumerate(features, 1):
        for j, y in enumerate([*features, label], 1):
            penalty = f" + {reg} / stddev_pop({label}) * var_pop({x})" if i == j else ""
            cells.append(
                f"{{'i': {i}, 'j': {j}, 'v': CASE WHEN {intercept} THEN covar_pop({x}, {y}) ELSE avg({x} * {y}) END{penalty}}}"
            )
    means = ", ".join(f"avg({x})" for x in features)
    return [
        f"{name}0 AS MATERIALIZED (SELECT {key}, c.i AS i, c.j AS j, c.v AS v FROM "
        f"(SELECT {key}, unnest([{', '.join(cells)}]) AS c FROM {source} GROUP BY {key}))",
        *eliminate(name, p, keys),
        f"{name}_mean AS (SELECT {key}, [{means}] AS mx, avg({label}) AS my FROM {source} GROUP BY {key})",
        f"{name} AS (SELECT *, CASE WHEN {intercept} THEN my - list_sum(list_transform(range(1, {p + 1}), lambda q: w[q] * mx[q])) ELSE 0 END AS b "
        f"FROM (SELECT {key}, list(v ORDER BY i) AS w FROM {name}_solution GROUP BY {key}) JOIN {name}_mean USING ({key}))",
    ]


def predicted(features: Sequence[str]) -> str:
    return "b + " + " + ".join(f"w[{i}] * {x}" for i, x in enumerate(features, 1))

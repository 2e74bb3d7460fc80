"""Run registered queries next to their DuckDB oracle and compare them.

Used by the tests and by hand: ``python tests/oracle_compare.py [sf_dir] [key ...]``.
Columns are compared by name, rows as an order-insensitive multiset.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF01_DEFAULT = "/root/testdata/sf0.01"

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "TINYINT",
              "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
              "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def duck_type(spark_type: str) -> str:
    """A Spark type string in DuckDB's spelling."""
    if spark_type.startswith("array<") and spark_type.endswith(">"):
        return duck_type(spark_type[6:-1]) + "[]"
    if spark_type.startswith("decimal"):
        return spark_type.upper()
    return DUCK_TYPES.get(spark_type, spark_type.upper())


def types(spark_df, con, sql: str) -> tuple[dict, dict]:
    """Column types of both sides in DuckDB's names (no execution needed)."""
    s = {f.name: duck_type(f.dataType.simpleString()) for f in spark_df.schema.fields}
    rel = con.sql(sql)
    return s, dict(zip(rel.columns, [str(t) for t in rel.types]))


def compare(spark, con, key: str, sf_dir: str):
    from trafficlens.plans.registry import ORACLE
    from trafficlens.plans.registry import QUERIES

    df = QUERIES[key](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    a, b = digest(s_cols, s_rows), digest(o_cols, o_rows)
    return a == b, a, b, (s_cols, s_rows, o_cols, o_rows, types(df, con, ORACLE[key]))


def main(argv: list[str]) -> int:
    from trafficlens.plans.registry import ORACLE
    from trafficlens.runtime import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(ORACLE)
    if os.environ.get("TL_PLAIN_SESSION"):
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = local_session(8)
    if os.environ.get("TL_SESSION_TZ"):
        spark.conf.set("spark.sql.session.timeZone", os.environ["TL_SESSION_TZ"])
    con = duck(sf_dir)
    bad = 0
    for key in keys:
        try:
            ok, a, b, detail = compare(spark, con, key, sf_dir)
        except Exception as e:  # report and go on
            print(f"ERROR {key}: {type(e).__name__}: {str(e)[:800]}")
            bad += 1
            continue
        print(("OK   " if ok else "DIFF ") + key, a[0], b[0], "" if a[1] == b[1] else (a[1], b[1]))
        if not ok:
            bad += 1
            s_cols, s_rows, o_cols, o_rows, _ = detail
            so = sorted("|".join(_norm(v) for _, v in sorted(zip(s_cols, r))) for r in s_rows)
            oo = sorted("|".join(_norm(v) for _, v in sorted(zip(o_cols, r))) for r in o_rows)
            only_s = [x for x in so if x not in set(oo)][:3]
            only_o = [x for x in oo if x not in set(so)][:3]
            print("   spark only:", only_s)
            print("   oracle only:", only_o)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)

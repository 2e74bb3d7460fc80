"""Access-log text source (S1-S4) and the transform to the hits table.

A line is parsed by one ``regexp_replace`` that rewrites a matching line into
its 15 groups joined by ``\\x01``; a non-matching line comes back unchanged.
The rewrite is always shorter than the line it matched (it drops the spaces
between fields, the quotes and any trailing text), so ``rewritten != line``
is an exact match test and each line costs one regex pass. No Python runs per
row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col

# The 15 field names in log order, and the two line patterns.
RAW_FIELDS = [
    "timestamp", "elb", "client_port", "backend_port",
    "request_processing_time", "backend_processing_time", "response_processing_time",
    "elb_status_code", "backend_status_code", "received_bytes", "sent_bytes",
    "request", "user_agent", "ssl_cipher", "ssl_protocol",
]

# strict: the reference's own pattern, matched anywhere in the line (its first match wins).
STRICT_PATTERN = r'(\d{4}-\d{2}-\d{2}\w\d{2}:+\d.+\d\w) (\w\S+) (\S+) (\S+) (\S+) ([\d.]+[:\d]) ([\d.]+[:\d]) (\d{3}) (\d{3}) (\d+) (\d+) "(.+?)" "(.+?)" ([\w-]+) ([\w+\d.]+)'
# lenient: the documented field list, anchored at the start; -1 times, '-' codes
# and an empty agent are kept; trailing fields are ignored.
LENIENT_PATTERN = (
    r'(\S+) (\S+) (\S+) (\S+) (-1|[\d.]+) (-1|[\d.]+) (-1|[\d.]+) (\d+|-) (\d+|-) (\d+) (\d+) '
    r'"([^"]*)" "([^"]*)" (\S+) (\S+)'
)

# the ignored text around a match may hold any character, line terminators too
REST = r"(?s:.*)\z"

_SEP = "\u0001"
_DOUBLE_FIELDS = ("request_processing_time", "backend_processing_time", "response_processing_time")
_LONG_FIELDS = ("received_bytes", "sent_bytes")

def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text line scan of a file, directory or glob (S1) -> ``value string``."""
    return spark.read.text(path)


def _line_regex(mode: str) -> str:
    if mode == "lenient":
        return "^" + LENIENT_PATTERN + REST
    if mode == "strict":
        # leftmost match anywhere, as an unanchored find does
        return "^(?s:.*?)" + STRICT_PATTERN + REST
    raise ValueError("mode must be 'lenient' or 'strict'")


def parse_access_log(
    lines: DataFrame, col_name: str = "value", mode: str = "lenient", keep: Iterable[str] = ()
) -> DataFrame:
    """One typed row per input line, never fewer.

    Unmatched lines give all-null fields and ``is_valid = false``; ``keep``
    passes input columns through. Times become double, byte counts bigint,
    everything else stays text.
    """
    replacement = _SEP.join(f"${i}" for i in range(1, len(RAW_FIELDS) + 1))
    text = col(col_name)
    regex = _line_regex(mode)
    rewritten = F.regexp_replace(text, regex, replacement)
    # one element exploded: a barrier that filters on the parsed fields are not
    # pushed through, so the regex stays one evaluation per line under any filter
    rewritten_once = lines.select(*keep, text.alias("_line"), F.explode(F.array(rewritten)).alias("_rw"))
    staged = rewritten_once.select(
        *keep,
        "_line",
        F.split(col("_rw"), _SEP).alias("_f"),
        (col("_rw") != col("_line")).alias("is_valid"),
    )
    # a field holding the separator itself would shift the split; such rare
    # lines take their groups from regexp_extract instead (evaluated only then)
    clean = F.size(col("_f")) == F.lit(len(RAW_FIELDS))
    fields = []
    for i, name in enumerate(RAW_FIELDS):
        part = F.when(clean, F.get(col("_f"), F.lit(i))).otherwise(F.regexp_extract(col("_line"), regex, i + 1))
        v = F.when(col("is_valid"), part)
        if name in _DOUBLE_FIELDS:
            v = v.try_cast("double")
        elif name in _LONG_FIELDS:
            v = v.try_cast("bigint")
        fields.append(v.alias(name))
    return staged.select(*keep, *fields, F.coalesce(col("is_valid"), F.lit(False)).alias("is_valid"))


def rejects(lines: DataFrame, col_name: str = "value", mode: str = "lenient", keep: Iterable[str] = ()) -> DataFrame:
    """The raw text of lines the pattern does not match (S3)."""
    text = col(col_name)
    regex = _line_regex(mode)
    return lines.where(~F.coalesce(text.rlike(regex), F.lit(False))).select(*keep, text.alias(col_name))


def split_endpoint(
    df: DataFrame, column: str, ip_out: str, port_out: str, missing: str | None = None, drop: bool = True
) -> DataFrame:
    """``ip:port`` text -> two columns (P1, P2); the port is null without a colon.
    ``missing`` names a placeholder (``-``) that means no endpoint at all."""
    value = col(column)
    if missing is not None:
        value = F.when(value != F.lit(missing), value)
    parts = F.split(value, ":")
    out = df.withColumn("_ep", parts).withColumns(
        {ip_out: F.get(col("_ep"), F.lit(0)), port_out: F.get(col("_ep"), F.lit(1))}
    ).drop("_ep")
    return out.drop(column) if drop and column not in (ip_out, port_out) else out


def split_request(df: DataFrame, column: str = "request", drop: bool = True) -> DataFrame:
    """Request line -> ``request_type`` (method) and ``request_url``; the protocol is dropped."""
    out = df.withColumn("_rq", F.split(col(column), " ")).withColumns(
        {"request_type": F.get(col("_rq"), F.lit(0)), "request_url": F.get(col("_rq"), F.lit(1))}
    ).drop("_rq")
    return out.drop(column) if drop else out


def split_url(df: DataFrame, column: str = "request_url") -> DataFrame:
    """URL -> ``url`` (path) and ``get_params`` (query, null without ``?``;
    text after a second ``?`` is lost, as in the reference) (P4)."""
    return df.withColumn("_u", F.split(col(column), r"\?")).withColumns(
        {"url": F.get(col("_u"), F.lit(0)), "get_params": F.get(col("_u"), F.lit(1))}
    ).drop("_u")


# after date and time of day (hours and minutes at least): a signed offset, or a zone that starts with a letter
ZONE = r"-\d{1,2}-\d{1,2}[T\x20]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?\s*([+-]\d|[A-Za-z])"


def utc_wall_clock(text):
    """Time text -> UTC wall clock (P5). An offset or a zone name is applied;
    ``Z`` and no zone at all mean UTC. Null where the text is no time."""
    moment = text.try_cast("timestamp")
    micros = F.unix_micros(moment).cast("decimal(20,0)") / F.lit(1_000_000)
    shifted = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=micros.cast("decimal(18,6)"))
    wall = text.try_cast("timestamp_ntz")
    # the usual form, a digit and Z at the end, needs no search for a zone and no second cast
    usual = text.endswith("Z") & F.substring(text, -2, 1).between("0", "9")
    return F.when(usual, wall).when(text.rlike(ZONE), shifted).otherwise(wall)


def transform_log(raw: DataFrame, mode: str = "lenient") -> DataFrame:
    """Raw fields -> hits columns: endpoints split, request split, URL split, time typed.

    In lenient mode a backend of ``-`` (no backend reached) gives null ip and
    port; strict mode keeps the reference's split (ip ``-``, port null). Each
    field is split once into an array and the parts are read from it.
    """
    df = split_endpoint(raw, "client_port", "cl_ip", "cl_port")
    df = split_endpoint(df, "backend_port", "bck_ip", "bck_port", missing="-" if mode == "lenient" else None)
    df = df.withColumn("date_time", utc_wall_clock(col("timestamp"))).drop("timestamp")
    return split_url(split_request(df))


def read_access_log(spark: SparkSession, path: str | list[str], mode: str = "lenient") -> DataFrame:
    """Lines on disk -> hits table, the usual entry point."""
    return transform_log(parse_access_log(read_lines(spark, path), mode=mode), mode=mode)

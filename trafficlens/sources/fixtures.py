"""Test inputs derived by Spark from the driver's tables.

The reference ships no data. ``hits`` turns the ``events`` table into the
transformed access-log schema with one SQL text that DuckDB runs unchanged
(the oracle builds the same rows); ``log_lines`` renders those hits back into
raw load-balancer lines, with one garbage line every 101 events, so the parser
is tested on text it has to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import col
from ..runtime import scratch_path

# One SELECT over a table called ``events``; Spark substitutes a DataFrame for
# ``{events}``, DuckDB reads its registered view.
HITS_SELECT = """
SELECT event_id, ts AS date_time,
  concat('10.0.', cast(cast(floor(user_id / 256) AS int) AS string), '.', cast(user_id % 256 AS string)) AS cl_ip,
  cast(1024 + event_id % 50000 AS string) AS cl_port,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE concat('10.9.0.', cast(event_id % 8 AS string)) END AS bck_ip,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE '80' END AS bck_port,
  cast(event_id % 97 AS double) / 100000 AS request_processing_time,
  CASE WHEN event_id % 37 = 0 THEN cast(-1 AS double) ELSE cast(event_id % 1000 AS double) / 1000 END AS backend_processing_time,
  cast(event_id % 31 AS double) / 100000 AS response_processing_time,
  CASE WHEN event_id % 37 = 0 THEN '504' ELSE '200' END AS elb_status_code,
  CASE WHEN event_id % 37 = 0 THEN '0' ELSE '200' END AS backend_status_code,
  (event_id % 13) * 64 AS received_bytes,
  cast(floor(value * 100) AS bigint) AS sent_bytes,
  CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST' WHEN event_type = 'error' THEN 'DELETE' ELSE 'GET' END AS request_type,
  concat('https://shop.example:443/', event_type, '/', cast(event_id % 7 AS string)) AS url,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('k=', regexp_extract(props, '([0-9]+)', 1)) END AS get_params,
  CASE WHEN (user_id + event_id) % 3 = 0 THEN 'Mozilla/5.0 (Linux; Android 4.4) Mobile Safari/537.36'
       ELSE 'Mozilla/5.0 (Windows NT 6.1) Chrome/43.0' END AS user_agent,
  CASE WHEN event_id % 11 = 0 THEN '-' ELSE 'ECDHE-RSA-AES128-GCM-SHA256' END AS ssl_cipher,
  CASE WHEN event_id % 11 = 0 THEN '-' ELSE 'TLSv1.2' END AS ssl_protocol
FROM {events}
"""

HITS_COLUMNS = [
    "event_id", "date_time", "cl_ip", "cl_port", "bck_ip", "bck_port",
    "request_processing_time", "backend_processing_time", "response_processing_time",
    "elb_status_code", "backend_status_code", "received_bytes", "sent_bytes",
    "request_type", "url", "get_params", "user_agent", "ssl_cipher", "ssl_protocol",
]

GARBAGE_EVERY = 101


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_request_url(hits: DataFrame) -> DataFrame:
    """``request_url`` = URL plus ``?query`` when there is one."""
    return hits.withColumn(
        "request_url",
        F.when(col("get_params").isNull(), col("url")).otherwise(
            F.concat(col("url"), F.lit("?"), col("get_params"))
        ),
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transformed log table (plus ``request_url``) built from ``events``."""
    events = table(spark, sf_dir, "events")
    return with_request_url(spark.sql(HITS_SELECT, events=events))


def _time_field(c: str):
    return F.when(col(c) < 0, F.lit("-1")).otherwise(F.format_string("%.6f", col(c)))


def render_log_lines(hits_df: DataFrame) -> DataFrame:
    """Hits back to raw lines (``event_id``, ``value``) in the 15-field order."""
    backend = F.when(col("bck_ip").isNull(), F.lit("-")).otherwise(
        F.concat(col("bck_ip"), F.lit(":"), col("bck_port"))
    )
    line = F.concat_ws(
        " ",
        F.date_format(col("date_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"),
        F.lit("web-lb"),
        F.concat(col("cl_ip"), F.lit(":"), col("cl_port")),
        backend,
        _time_field("request_processing_time"),
        _time_field("backend_processing_time"),
        _time_field("response_processing_time"),
        col("elb_status_code"),
        col("backend_status_code"),
        col("received_bytes").cast("string"),
        col("sent_bytes").cast("string"),
        F.concat(F.lit('"'), col("request_type"), F.lit(" "), col("request_url"), F.lit(' HTTP/1.1"')),
        F.concat(F.lit('"'), col("user_agent"), F.lit('"')),
        col("ssl_cipher"),
        col("ssl_protocol"),
    )
    garbage = F.concat(F.lit("#garbage "), col("event_id").cast("string"))
    value = F.when(col("event_id") % GARBAGE_EVERY == 0, garbage).otherwise(line)
    return hits_df.select("event_id", value.alias("value"))


_WRITTEN: dict[tuple[str, str, str], str] = {}


def _written(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Render the lines once per application into the shared scratch folder.

    Log lines live in files in real use; reading them back also keeps the
    rendering expressions out of the parser's plan.
    """
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _WRITTEN:
        path = scratch_path(spark, f"log-{kind}")
        lines = render_log_lines(hits(spark, sf_dir))
        if kind == "text":
            lines.select("value").write.text(path)
        else:
            lines.write.parquet(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, value``: the rendered lines with their source event (tests join on it)."""
    return spark.read.parquet(_written(spark, sf_dir, "parquet"))


def log_text_path(spark: SparkSession, sf_dir: str) -> str:
    """A folder of plain text log files, one line per hit, as a load balancer writes them."""
    return _written(spark, sf_dir, "text")

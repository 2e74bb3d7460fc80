"""All registered queries of the library and their oracles."""

from . import cluster_oracle, cluster_queries, forecast, forecast_oracle, oracle, queries, sketch_queries, stream_queries

QUERIES = {**queries.QUERIES, **forecast.QUERIES, **stream_queries.QUERIES, **cluster_queries.QUERIES, **sketch_queries.QUERIES}
ORACLE = {**oracle.ORACLE, **forecast_oracle.ORACLE, **cluster_oracle.ORACLE}

"""Names, queries and SQL oracles of the log operators."""

from __future__ import annotations

from tidelog.plans import log_queries, schema_queries, stream_queries

QUERIES: dict = {**log_queries.QUERIES, **schema_queries.QUERIES, **stream_queries.QUERIES}
ORACLES: dict = {**log_queries.ORACLES, **schema_queries.ORACLES, **stream_queries.ORACLES}

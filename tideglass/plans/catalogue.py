"""All queries of the core and their SQL."""

from __future__ import annotations

from tideglass.plans import core_queries, filings, market, streams, time_sql

QUERIES = core_queries.QUERIES | market.QUERIES | filings.QUERIES | streams.QUERIES
ORACLE = core_queries.ORACLE | time_sql.ORACLE | market.ORACLE | filings.ORACLE | streams.ORACLE

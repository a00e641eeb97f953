"""All queries over the driver's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from . import more_queries

QUERIES = {**more_queries.QUERIES}
ORACLE_SQL = {**more_queries.ORACLE_SQL}

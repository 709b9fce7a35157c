"""All registered queries of the library and their SQL."""

from __future__ import annotations

from kinetrail.plans import audits, exports, selection, sources, tables, trajectory

QUERIES = {**trajectory.QUERIES, **tables.QUERIES, **exports.QUERIES, **selection.QUERIES, **audits.QUERIES, **sources.QUERIES}
ORACLE_SQL = {**trajectory.ORACLE_SQL, **tables.ORACLE_SQL, **exports.ORACLE_SQL, **selection.ORACLE_SQL, **audits.ORACLE_SQL, **sources.ORACLE_SQL}

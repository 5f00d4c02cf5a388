"""All registered queries: name -> (Spark callable, SQL twin or None)."""

from __future__ import annotations

from workload import queries_improvements, queries_landing, queries_oee, queries_tables

ALL = {**queries_oee.QUERIES, **queries_tables.QUERIES, **queries_improvements.QUERIES, **queries_landing.QUERIES}

"""All core queries and their SQL, by name."""

from __future__ import annotations

from sluice.plans import built, ingestion, records, training

QUERIES = ingestion.QUERIES | records.QUERIES | built.QUERIES | training.QUERIES
SQL = ingestion.SQL | records.SQL | built.SQL | training.SQL
FLAGSHIP = "p4_found"

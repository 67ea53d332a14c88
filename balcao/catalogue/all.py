"""All queries by name, and the SQL of each."""

from __future__ import annotations

from balcao.catalogue import oracle, queries, upkeep, upkeep_oracle

ALL: dict[str, queries.Query] = queries.ALL | upkeep.ALL
SQL: dict[str, str] = oracle.SQL | upkeep_oracle.SQL

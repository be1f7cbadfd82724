"""Registered queries: each module adds (query, SQL) pairs to the registry."""

from corpusloom.plans import registry
from corpusloom.plans import (  # noqa: F401  (imported to fill the registry)
    blend,
    cleaning,
    convert,
    dedup,
    filtering,
    langs,
    logs,
    longctx,
    mixture,
    pack,
    private,
    quality,
    toxic,
)

QUERIES = registry.QUERIES
SQL = registry.SQL

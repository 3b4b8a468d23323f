"""Every registered query with the SQL that states its result independently."""

from tenurelake.catalog import browsing, checks, marts, storage, streams, warehouse

_PARTS = [marts, warehouse, checks, browsing, storage, streams]

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}

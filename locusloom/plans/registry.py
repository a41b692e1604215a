"""All queries of the core library and their SQL twins."""

from __future__ import annotations

from locusloom.plans import features, howell, loci, orders, problems, reads, sources, streams, windows

_MODULES = (sources, reads, windows, loci, features, howell, orders, streams, problems)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL = {name: text for m in _MODULES for name, text in m.SQL.items()}

"""All registered queries of the library and their DuckDB equivalents."""

from __future__ import annotations

from waymark.plans import counts, files, network, outputs, places, references, rules, slanted, traffic

_ALL = network.QUERIES | traffic.QUERIES | rules.QUERIES | references.QUERIES | counts.QUERIES | places.QUERIES | outputs.QUERIES | files.QUERIES | slanted.QUERIES
QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLE_SQL = {name: sql for name, (_, sql) in _ALL.items() if sql}
FLAGSHIP = "flagship"

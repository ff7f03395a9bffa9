"""Every registered query and its oracle, gathered from the query modules."""

from palimpsest.queries import bitemporal, checks, finance, joins_windows, landings, surface

MODULES = [bitemporal, joins_windows, surface, checks, finance, landings]
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}

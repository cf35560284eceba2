"""Registered queries over the driver tables and their DuckDB counterparts."""

from catalog import checks, modules, scans

QUERIES = {**scans.QUERIES, **checks.QUERIES, **modules.QUERIES}
ORACLES = {**scans.ORACLES, **checks.ORACLES, **modules.ORACLES}

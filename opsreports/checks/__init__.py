"""Registered queries: each operator and report on the driver's tables, with its SQL twin."""

from opsreports.checks import aggregates, filters, joins, reports, scalars, sequences, sources, streams  # noqa: F401
from opsreports.checks.registry import QUERIES, SQL, Tables  # noqa: F401

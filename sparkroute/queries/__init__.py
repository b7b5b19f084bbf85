"""Registered queries: every operator over whole tables, each with its SQL counterpart."""

from sparkroute.queries import chunks, dynamic, jobs, keys, routing, scans, sinks, verify  # noqa: F401
from sparkroute.queries.registry import ORACLES, QUERIES  # noqa: F401

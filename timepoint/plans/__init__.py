"""Registered queries: table bindings, query functions and their SQL checks."""

from timepoint.plans import equity, ingest, matching, modelling, reliability, report, streams
from timepoint.plans.registry import CHECKS, QUERIES

__all__ = [
    "CHECKS",
    "QUERIES",
    "equity",
    "ingest",
    "matching",
    "modelling",
    "reliability",
    "report",
    "streams",
]

"""Registered queries over the driver's tables."""

from quadloom.plans import (
    changing,
    computing,
    documents,
    flowing,
    inferring,
    matching,
    scans,
    searching,
    shaping,
    storing,
    walking,
)
from quadloom.plans.registry import QUERIES, SQL

__all__ = [
    "QUERIES", "SQL", "changing", "computing", "documents", "flowing", "inferring", "matching",
    "scans", "searching", "shaping", "storing", "walking",
]

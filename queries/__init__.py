"""Registered queries: each library job bound to the supplied tables, next to SQL that states its result."""

from queries import alerts, dashboards, gold, layers, learning, operators, scoring, silver  # noqa: F401
from queries.common import REGISTRY, TRAINED  # noqa: F401

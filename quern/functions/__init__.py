"""All functions, registered under their names (see registry)."""

from quern.functions import aggregates, general, geometry, nested, numeric, temporal, text
from quern.functions.registry import FUNCTIONS, call

__all__ = ["FUNCTIONS", "aggregates", "call", "general", "geometry", "nested", "numeric", "temporal", "text"]

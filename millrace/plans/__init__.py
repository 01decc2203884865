"""All registered queries."""

from . import catalog, joins, reports, rules, shots  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401

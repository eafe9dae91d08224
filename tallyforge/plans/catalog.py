"""All driver queries of the library: importing the plan modules registers them."""

from tallyforge.plans import aggregates, joins, scalar, selection, swarm, telemetry, verify  # noqa: F401
from tallyforge.plans.registry import ORACLES, QUERIES  # noqa: F401

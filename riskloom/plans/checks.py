"""All registered queries."""

from riskloom.plans import (  # noqa: F401
    checks_aggregates,
    checks_credit,
    checks_models,
    checks_scores,
    checks_tables,
)
from riskloom.plans.registry import ORACLES, QUERIES  # noqa: F401

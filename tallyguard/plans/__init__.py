"""Registered plans over the given tables."""

from tallyguard.plans import models, monitoring, records, streams, transactions  # noqa: F401
from tallyguard.plans.registry import PLANS, SQL  # noqa: F401

"""Column expressions of feature preparation and scoring."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Ordinal codes of the merchant categories; everything else is 7.
CATEGORY_CODES = {
    "grocery": 0,
    "gas_station": 1,
    "restaurant": 2,
    "retail": 3,
    "online": 4,
    "electronics": 5,
    "pharmacy": 6,
    "other": 7,
}
UNKNOWN_CATEGORY = 7

# Fills of the optional features, and the scoring rule.
DEFAULT_AGE = 35
DEFAULT_RISK = 0.5
RULE_CUTOFF = 500.0
RULE_HIGH = 0.8
RULE_LOW = 0.2
FRAUD_THRESHOLD = 0.5

FEATURES = ["amount", "merchant_category", "hour_of_day", "day_of_week",
            "user_age", "location_risk_score"]
OPTIONAL_FEATURES = {"user_age", "location_risk_score"}


def without_nan(value: Column, dtype: str) -> Column:
    """NaN as null; other types pass through."""
    return F.nanvl(value, F.lit(None).cast(dtype)) if dtype in ("double", "float") else value


def category_code(category: Column) -> Column:
    """Ordinal code; unseen and null categories share the last code."""
    entries = [F.lit(x) for item in CATEGORY_CODES.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*entries), category),
                      F.lit(UNKNOWN_CATEGORY))


def rule_probability(amount: Column, cutoff: float = RULE_CUTOFF) -> Column:
    over = (amount > F.lit(cutoff)) & ~F.isnan(amount)
    return F.when(over, F.lit(RULE_HIGH)).otherwise(F.lit(RULE_LOW))


def confidence(probability: Column, mode: str) -> Column:
    """Distance from 0.5 as a band; single requests know one band more than batches."""
    distance = F.abs(probability - F.lit(0.5))
    band = F.when(distance > F.lit(0.3), "high").otherwise("medium")
    if mode == "single":
        return F.when(distance > F.lit(0.4), "very_high").otherwise(band)
    if mode == "batch":
        return band
    raise ValueError(f"unknown mode {mode!r}")

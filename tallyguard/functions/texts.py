"""Text classification columns: test names, statuses, latency bands, payload patterns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The first marker contained in a test name decides its category.
TEST_CATEGORIES = (
    ("Health Check", "Health Checks"),
    ("Prediction", "ML Predictions"),
    ("Validation", "Input Validation"),
    ("Performance", "Performance"),
    ("Documentation", "Documentation"),
    ("API Availability", "Availability"),
)
OTHER_CATEGORY = "Other"

# Upper limits of the latency bands in milliseconds.
LATENCY_BANDS = ((200.0, "excellent"), (500.0, "good"), (1000.0, "acceptable"))

# Patterns that never belong in an identifier or a category.
PAYLOAD_PATTERNS = {
    "sql_comment": r"(?i)['\"][^'\"]*;?\s*--",
    "sql_tautology": r"(?i)['\"]\s*or\s+['\"]?\w+['\"]?\s*=\s*['\"]?\w+",
    "sql_statement": r"(?i);\s*(drop|delete|insert|update|alter)\s",
    "script_tag": r"(?i)<\s*script",
    "script_url": r"(?i)javascript\s*:",
    "event_handler": r"(?i)<[^>]*\son[a-z]+\s*=",
}
OVERSIZED = "oversized"


def test_category(name: Column) -> Column:
    chain = F.lit(OTHER_CATEGORY)
    for marker, category in reversed(TEST_CATEGORIES):
        chain = F.when(name.contains(marker), category).otherwise(chain)
    return chain


def status_class(status: Column) -> Column:
    return (F.when(status.contains("FAIL"), "fail")
            .when(status.contains("ERROR"), "error")
            .otherwise("pass"))


def latency_band(ms: Column) -> Column:
    """Below 200, below 500, up to 1000, above."""
    (fast, first), (medium, second), (slow, third) = LATENCY_BANDS
    return (F.when(ms < F.lit(fast), first)
            .when(ms < F.lit(medium), second)
            .when(ms <= F.lit(slow), third)
            .when(ms.isNotNull(), "poor"))


def reasons(flags: dict[str, Column]) -> Column:
    """Names of the true flags, in order. Stays inside generated code (no lambda)."""
    named = [F.when(flag, F.lit(name)) for name, flag in flags.items()]
    return F.array_except(F.array(*named), F.array(F.lit(None).cast("string")))

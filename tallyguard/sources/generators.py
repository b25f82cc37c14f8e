"""Deterministic transaction generators.

Draws are hashes of a row id, so any executor can recompute any row. Each
generator takes its row ids from a range or from a given column.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyguard.functions import hashing as h

# Bounds and word lists of the generated rows.
AMOUNT = (10.0, 1000.0)
FRAUD_SHARE = 0.1
STRESS_CATEGORIES = ["grocery", "restaurant", "gas_station", "retail",
                     "electronics", "travel", "entertainment", "healthcare"]
POOL_CATEGORIES = ["restaurant", "grocery", "gas_station", "pharmacy", "retail",
                   "electronics", "clothing", "entertainment", "travel", "online"]
NIGHT_HOURS = [2, 3, 4, 23, 0, 1]
AGES = (18, 80)


def message_columns(row_id: Column, tps: int, start: datetime, seed: int = 42) -> dict[str, Column]:
    """Producer message of row i: paced at ``tps`` rows per second from ``start``."""
    second = F.floor(row_id / F.lit(tps)).cast("long")
    return {
        "transaction_id": F.format_string("tx_%06d", row_id),
        "amount": h.uniform_scaled(row_id, seed, *AMOUNT, digits=2),
        "merchant_id": F.concat(F.lit("m_"), h.uniform_int(row_id, seed + 1, 100, 999).cast("string")),
        "user_id": F.concat(F.lit("u_"), h.uniform_int(row_id, seed + 2, 1000, 9999).cast("string")),
        "timestamp": F.lit(start) + F.make_dt_interval(secs=second),
        "is_fraud": F.when(h.uniform(row_id, seed + 3) < F.lit(FRAUD_SHARE),
                           h.uniform_int(row_id, seed + 4, 0, 1)).otherwise(F.lit(0)),
    }


def gen_transactions(spark: SparkSession, tps: int, duration: int, seed: int = 42,
                     start: datetime = datetime(2024, 1, 1)) -> DataFrame:
    ids = spark.range(tps * duration)
    return ids.select(*[c.alias(n) for n, c in message_columns(F.col("id"), tps, start, seed).items()])


def stress_columns(row_id: Column, risky_share: float = 0.1, seed: int = 42) -> dict[str, Column]:
    """Request of the 10/90 mix of risky night and ordinary day transactions."""
    risky = h.uniform(row_id, seed) < F.lit(risky_share)

    def either(a: Column, b: Column) -> Column:
        return F.when(risky, a).otherwise(b)

    return {
        "transaction_id": F.concat(F.lit("stress_test_"), row_id.cast("string")),
        "amount": either(h.uniform_scaled(row_id, seed + 1, 500, 5000, 2),
                         h.uniform_scaled(row_id, seed + 1, 5, 500, 2)),
        "merchant_category": h.pick(row_id, seed + 2, STRESS_CATEGORIES),
        "hour_of_day": either(h.pick(row_id, seed + 3, NIGHT_HOURS), h.uniform_int(row_id, seed + 3, 8, 22)),
        "day_of_week": h.uniform_int(row_id, seed + 4, 0, 6),
        "user_age": h.uniform_int(row_id, seed + 5, *AGES),
        "location_risk_score": either(h.uniform_scaled(row_id, seed + 6, 0.7, 1.0, 3),
                                      h.uniform_scaled(row_id, seed + 6, 0.0, 0.3, 3)),
        "is_risky": risky,
    }


def uniform_columns(row_id: Column, seed: int = 42) -> dict[str, Column]:
    """Request of the uniform pool."""
    return {
        "transaction_id": F.concat(F.lit("load_test_"), row_id.cast("string")),
        "amount": h.uniform_scaled(row_id, seed + 1, 1, 2000, 2),
        "merchant_category": h.pick(row_id, seed + 2, POOL_CATEGORIES),
        "hour_of_day": h.uniform_int(row_id, seed + 3, 0, 23),
        "day_of_week": h.uniform_int(row_id, seed + 4, 0, 6),
        "user_age": h.uniform_int(row_id, seed + 5, *AGES),
        "location_risk_score": h.uniform_scaled(row_id, seed + 6, 0.0, 1.0, 3),
        "is_risky": F.lit(False),
    }


def gen_stress_mix(spark: SparkSession, n: int, spec: str = "stress", risky_share: float = 0.1,
                   seed: int = 42) -> DataFrame:
    row_id = F.col("id")
    columns = {"stress": lambda: stress_columns(row_id, risky_share, seed),
               "uniform": lambda: uniform_columns(row_id, seed)}[spec]()
    return spark.range(n).select(*[c.alias(name) for name, c in columns.items()])

"""Contract checks, quarantine and request-level guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tallyguard.functions import contract, texts
from tallyguard.operators import skew

BATCH_LIMIT = 100        # fixed value: a request with more rows is refused whole
QUALITY_GATE = 0.9       # fixed value: least share of valid rows for training
MAX_TEXT = 1000          # longest accepted identifier or category

# Answers that show a hostile request was refused.
SAFE_STATUS = (400, 422)
SAFE_STATUS_OVERSIZED = (400, 413, 422)


def _judge(df: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Rows with their verdict, and the typed columns."""
    cast, values = contract.with_casts(df)
    return cast.withColumns({"is_valid": contract.accepted(df, values),
                             "errors": texts.reasons(contract.violations(df, values))}), values


def validate_transactions(df: DataFrame) -> DataFrame:
    """Add ``errors`` (every broken rule) and ``is_valid``.

    ``is_valid`` is built from the fields, not from ``errors``, so that the array
    is pruned away where only the verdict is used.
    """
    return contract.without_casts(_judge(df)[0])


def valid_rows(df: DataFrame, seen: Observation) -> DataFrame:
    """The valid side alone; ``seen`` gets the number of all rows (``n``) and of valid ones (``ok``) while it is read."""
    judged, values = _judge(df.drop("is_valid", "errors"))
    judged = judged.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if("is_valid").alias("ok"))
    return contract.without_casts(judged.filter("is_valid").withColumns(values).drop("is_valid", "errors"))


def quarantine_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows in their contract types; invalid rows as they came, with their errors)."""
    judged, values = _judge(df.drop("is_valid", "errors"))
    valid = judged.filter("is_valid").withColumns(values).drop("is_valid", "errors")
    return contract.without_casts(valid), contract.without_casts(judged.filter("not is_valid"))


def batch_guard(df: DataFrame, key: str = "request_id", limit: int = BATCH_LIMIT,
                row_id: str = "transaction_id") -> DataFrame:
    """Add ``batch_size`` and ``accepted``: a request above the limit is refused whole.

    A row without a request is refused. One huge request is spread over many tasks.
    """
    sized = skew.with_group_totals(df, key, row_id, {"batch_size": F.count("*")})
    return sized.withColumn("accepted", F.coalesce(F.col("batch_size") <= F.lit(limit), F.lit(False)))


def data_quality_score(df: DataFrame, gate: float = QUALITY_GATE) -> DataFrame:
    """Share of valid rows and whether it reaches the gate."""
    score = F.try_divide(F.count_if("is_valid").cast("double"), F.count("*"))
    return df.agg(score.alias("score")).withColumn(
        "passed", F.coalesce(F.col("score") >= F.lit(gate), F.lit(False)))


def payload_screen(df: DataFrame, cols: list[str], max_len: int = MAX_TEXT) -> DataFrame:
    """Add ``reasons``: patterns of injected SQL or script, and oversized text, over all ``cols``."""
    def any_col(test) -> Column:
        return reduce(Column.__or__, [F.coalesce(test(F.col(c)), F.lit(False)) for c in cols])

    flags = {name: any_col(lambda c, p=pattern: c.rlike(p))
             for name, pattern in texts.PAYLOAD_PATTERNS.items()}
    flags[texts.OVERSIZED] = any_col(lambda c: F.length(c) > F.lit(max_len))
    return df.withColumn("reasons", texts.reasons(flags))


def safe_response(df: DataFrame) -> DataFrame:
    """Add ``safe`` from (status_code, kind, error): refused, or failed with an exception."""
    refused = F.when(F.col("kind") == "oversized",
                     F.col("status_code").isin(*SAFE_STATUS_OVERSIZED)
                     ).otherwise(F.col("status_code").isin(*SAFE_STATUS))
    return df.withColumn("safe", F.col("error").isNotNull() | F.coalesce(refused, F.lit(False)))


def required_fields_check(df: DataFrame, response: str, required: list[str]) -> DataFrame:
    """Add ``missing``: required keys that a response map lacks."""
    wanted = F.array(*[F.lit(name) for name in required])
    return df.withColumn("missing", F.array_except(wanted, F.map_keys(F.col(response))))


def parse_event_time(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """Add ``event_time`` and ``event_date`` from ISO text; unreadable text gives nulls."""
    parsed = F.coalesce(F.try_to_timestamp(F.col(col)),
                        F.try_to_timestamp(F.col(col), F.lit("yyyy-MM-dd")))
    return df.withColumns({"event_time": parsed, "event_date": F.to_date(parsed)})

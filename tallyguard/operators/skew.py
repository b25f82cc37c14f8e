"""Bringing a group's totals back to its rows when one group may hold much of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HOT_SHARE = 1000   # a key is hot above 1/1000 of all rows, so fewer than 1000 keys can be
SPREAD = 512       # tasks that a hot key is spread over


def with_group_totals(rows: DataFrame, key: str, spread_by: str, totals: dict[str, Column],
                      hot_share: int = HOT_SHARE, spread: int = SPREAD) -> DataFrame:
    """Add aggregates of each row's group; ``spread_by`` tells the rows of a group apart.

    Totals come from one map-side combined aggregation. Rows meet them in an
    equi-join on (key, salt): hot keys, of which there are fewer than
    ``hot_share``, are known from a broadcast of that proven size, and their
    rows are salted while their totals are repeated once per salt. All other
    keys keep salt 0 and one row of totals. A null key forms no group.
    """
    groups = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[c.alias(n) for n, c in totals.items()], F.count("*").alias("_size"))
    whole = groups.agg(F.sum("_size")).scalar()
    is_hot = F.col("_size") * F.lit(hot_share) > whole
    hot = F.broadcast(groups.filter(is_hot).select(key, F.lit(True).alias("_hot")))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    repeated = groups.select(key, *totals, F.explode(salts).alias("_salt"))
    salt = F.when(F.col("_hot"), F.pmod(F.hash(spread_by), F.lit(spread))).otherwise(F.lit(0))
    return (rows.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
            .join(repeated, [key, "_salt"], "left").drop("_salt"))

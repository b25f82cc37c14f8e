"""Exact ranks and running totals without sorting everything in one task.

Rows are combined to one per distinct value before the first shuffle. A value's 64
order-preserving bits are read as three digits; running totals are taken among the values of
one middle cell, among the middle cells of one top cell, and among the top cells. So a
window holds at most ``2 ** 22`` rows however dense the values lie, a hot key is
spread over its cells, and the distribution is built once and shuffled once for all of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SHIFTS = (42, 21)  # bits below a top cell, and below a middle cell
SMALLEST = 2.0 ** -1022  # of the doubles with a full fraction


def double_bits(value: Column) -> Column:
    """Integers in the order of doubles: infinities at the ends, NaN after all others, null for null.

    The magnitude is exponent and fraction as IEEE 754 lays them out; all steps are exact.
    """
    size = F.abs(value)
    guess = F.floor(F.log2(size))
    low = F.pow(F.lit(2.0), F.greatest(guess, F.lit(-1022)))
    exponent = F.when(size < low, guess - 1).when(size / 2 >= low, guess + 1).otherwise(guess)
    exponent = F.greatest(F.least(exponent, F.lit(1023)), F.lit(-1022))
    fraction = (size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(2.0 ** 52)
    normal = (exponent + 1023) * F.lit(1 << 52) + fraction.cast("long")
    tiny = (size * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    infinite = F.lit(2047 << 52)
    magnitude = (F.when(F.isnan(value), infinite + 1).when(size == F.lit(float("inf")), infinite)
                 .when(size == 0, F.lit(0).cast("long")).when(size < F.lit(SMALLEST), tiny).otherwise(normal))
    return F.when(value.isNull(), F.lit(None)).when(value < 0, -magnitude).otherwise(magnitude)


def time_bits(ts: Column) -> Column:
    """Microseconds of a time."""
    return F.unix_micros(ts.cast("timestamp"))


def _joined(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Join on equal ``names``, where null equals null; the columns of ``left`` and the others of ``right``."""
    right = right.withColumnsRenamed({n: f"_{n}_right" for n in names})
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_{n}_right")) for n in names])
    return left.join(right, same).drop(*[f"_{n}_right" for n in names])


def with_totals_below(dist: DataFrame, keys: list[str], value: str, weights: list[str], bits: Column) -> DataFrame:
    """Add ``<w>_below`` (weight of smaller values) and ``<w>_total`` per key group.

    ``dist`` has one row per (keys, value); ``bits`` are integers in the order of ``value``.
    Rows with null bits come first. Null keys are a group.
    """
    top, middle = "_top", "_middle"
    rows = dist.withColumn("_bits", bits).withColumns(
        {c: F.shiftright("_bits", s) for c, s in zip((top, middle), SHIFTS)}).drop("_bits")

    def summed(df: DataFrame, group: list[str], order: str) -> DataFrame:
        inside = Window.partitionBy(*group) if group else Window.partitionBy()
        before = inside.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        zero = {w: F.coalesce(F.sum(w).over(before), F.lit(0)) for w in weights}
        return df.withColumns({**{f"_{w}_in": c for w, c in zero.items()}, **{f"_{w}_all": F.sum(w).over(inside) for w in weights},
                               "_place": F.row_number().over(inside.orderBy(order))})

    def cells(df: DataFrame, *names: str) -> DataFrame:
        return df.filter("_place = 1").select(*keys, *names, *[F.col(f"_{w}_all").alias(w) for w in weights])

    rows = summed(rows, [*keys, middle], value)
    middles = summed(cells(rows, top, middle), [*keys, top], middle)
    tops = summed(cells(middles, top), keys, top).select(
        *keys, top, *[F.col(f"_{w}_in").alias(f"_{w}_top") for w in weights],
        *[F.col(f"_{w}_all").alias(f"{w}_total") for w in weights])
    middles = _joined(middles, tops, [*keys, top]).select(
        *keys, middle, *[f"{w}_total" for w in weights],
        *[(F.col(f"_{w}_in") + F.col(f"_{w}_top")).alias(f"_{w}_before") for w in weights])
    return _joined(rows, middles, [*keys, middle]).select(
        *dist.columns, *[f"{w}_total" for w in weights],
        *[(F.col(f"_{w}_in") + F.col(f"_{w}_before")).alias(f"{w}_below") for w in weights])


def values_at(df: DataFrame, value: str, keys: list[str], quantiles: dict[str, float]) -> DataFrame:
    """The element at 0-based index ``int(n * q)`` of each group's sorted values, and the mean.

    Not interpolated. Null and NaN are no values; infinities are the largest and the smallest. An empty
    global input answers 0.
    """
    dist = (df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*keys, value)
            .agg(F.count("*").alias("n")))
    ranked = with_totals_below(dist, keys, value, ["n"], double_bits(F.col(value).cast("double")))

    def at(q: float) -> Column:
        index = F.least(F.floor(F.col("n_total") * F.lit(q)), F.col("n_total") - 1)
        here = (F.col("n_below") <= index) & (index < F.col("n_below") + F.col("n"))
        return F.coalesce(F.max(F.when(here, F.col(value))), F.lit(0.0))

    mean = F.try_divide(F.sum(F.col(value) * F.col("n")), F.sum("n"))
    return ranked.groupBy(*keys).agg(
        F.coalesce(mean, F.lit(0.0)).alias("avg"),
        *[at(q).alias(name) for name, q in quantiles.items()])

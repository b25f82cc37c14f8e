"""What the operators of this subpackage share: staged tables and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyguard.session import scratch_dir

LISTED = 1 << 20  # row numbers that are sent to all tasks, 8 MB
WHITE = " \t\n\x0b\x0c\r"  # the characters [\x20\x09-\x0D]


_KEPT: dict = {}


def kept(make, *of):
    """``make(*of)``, made once: it lasts over a worker's tasks until another is asked for. A worker keeps one such cache."""
    # by identity: a broadcast model is the same object in all tasks of a worker, and the cache holds on to it
    key = (make, *(x if isinstance(x, (str, int)) else id(x) for x in of))
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make(*of), of
    return _KEPT[key][0]


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts the lineage: a lost executor costs the tasks that read the table, not
    those that made it, and what was drawn or numbered once stays as it was.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` written with a column of row numbers, and that column's name, which no other column has."""
    name = "row_no"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), label), name


def only(table: DataFrame, row: str, kept: DataFrame, label: str, listed: int | None = None) -> DataFrame:
    """The rows of ``table`` whose number ``row`` is in ``kept``, without that number.

    Where the rows that stay, or those that go, are ``LISTED`` or fewer (counted first), their numbers are sent to all
    tasks and no row is moved; else the rows are shuffled with all their columns.
    """
    listed = LISTED if listed is None else listed
    kept = stage(kept.select(row), label)
    dropped = stage(table.select(row).join(kept, row, "left_anti"), f"{label}-dropped")
    if dropped.count() <= listed:
        out = table.join(F.broadcast(dropped), row, "left_anti")
    elif kept.count() <= listed:
        out = table.join(F.broadcast(kept), row, "left_semi")
    else:
        out = table.join(kept, row, "left_semi")
    return out.drop(row)


def partitions(spark: SparkSession, rows: int, per_task: int) -> int:
    """Tasks for ``rows`` rows when a task may hold ``per_task`` of them; never under the session's number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def whole_text(text: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text), F.lit(""))


def _mark(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo") % F.lit(1 << 31))).first()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Alternating large and small stars: every node ties its larger neighbours, then
    itself and its smaller ones, to the smallest node it sees. The links end as stars,
    after about the logarithm of the longest path in rounds. Minima are combined before
    the shuffle and joined back, so a hub's links are never in one task, and each
    round is a written table of at most as many rows as the one before.
    """
    hi, lo = F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    now = stage(links.where("a != b").select(hi, lo).distinct(), "links")
    before = _mark(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = now.unionByName(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).withColumn("m", F.least("m", "hi"))
        large = both.join(least, "hi").where("lo > hi").select(
            F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo != m").select(
            F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = stage(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
        after = _mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components: not settled after {most_rounds} rounds")
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)

"""Exact deduplication by deterministic block naming.

A text without its white space is cut into blocks of a fixed number of characters.
Distinct blocks are sorted and numbered, so equal blocks, and only these, share an
integer. Adjacent pairs of integers are numbered in the same way, again and again,
until one integer stands for the whole text. Names come from compared contents: a
64-bit hash only carries a block's name back to the rows, and where two different
blocks share a hash, the rows fetch their names by the content.

Only distinct blocks are shuffled with their text, after each task has combined its
own repeats; everything else moves integers. A block held by a third of all rows is
one row of the names, and the rows that look it up are split by adaptive joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyguard.llm.common import numbered, only, stage, whole_text

BLOCK = 4096  # characters
ABSENT = -1


def without_white(text: Column) -> Column:
    """``text`` without every character of [\\x20\\x09-\\x0D]."""
    return F.regexp_replace(F.replace(text, F.lit(" "), F.lit("")), "[\\t-\\r]", "")


def _blocks(text: Column, size: int) -> Column:
    """The text in blocks; the empty text is one empty block."""
    cut = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(cut)


def _numbered(distinct: DataFrame, keys: list[str], label: str, keep: list[str]) -> DataFrame:
    """Integer names of distinct keys, by sorted order inside the partition that holds them."""
    named = distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())
    return stage(named.select(*keep, "name"), label)


def block_names(rows: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """(row, idx, name) of every block; ``rows`` is (row, norm), ``places`` (row, idx, h) has the blocks' hashes."""
    cut = rows.select("row", F.posexplode(_blocks(F.col("norm"), size)).alias("idx", "block"))
    cut = cut.withColumn("h", F.xxhash64("block"))
    named = _numbered(cut.select("h", "block").distinct(), ["h", "block"], "block-names", ["h"])
    shared = named.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    if not shared.head(1):
        return places.join(named, "h").select("row", "idx", "name")
    # different blocks share a hash: their rows fetch the names by the content
    shared = stage(shared, "block-hashes-shared")
    held = cut.join(shared, "h", "left_semi")
    by_text = _numbered(held.select("h", "block").distinct(), ["h", "block"], "block-names-shared", ["h", "block"])
    clear = places.join(shared, "h", "left_anti").join(named, "h").select("row", "idx", "name")
    return clear.unionByName(held.join(by_text, ["h", "block"]).select(
        "row", "idx", (-F.col("name") - 2).alias("name")))


def identities(rows: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """(row, blocks, name) of every row: equal (blocks, name) if and only if equal texts."""
    counts = places.groupBy("row").agg((F.max("idx") + 1).alias("blocks"))
    now = stage(block_names(rows, places, size).join(counts, "row"), "names-0")
    done = [now.where("blocks = 1").select("row", "blocks", "name")]
    now, level, width = now.where("blocks > 1"), 0, now.agg(F.max("blocks")).first()[0] or 1
    while width > 1:
        level += 1
        even = F.col("idx") % 2 == 0
        pairs = stage(now.groupBy("row", "blocks", F.floor(F.col("idx") / 2).cast("int").alias("idx")).agg(
            F.max(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(ABSENT)).alias("right")), f"pairs-{level}")
        names = _numbered(pairs.select("left", "right").distinct(), ["left", "right"], f"pair-names-{level}",
                          ["left", "right"])
        now = stage(pairs.join(names, ["left", "right"]).select("row", "blocks", "idx", "name"), f"names-{level}")
        width = -(-width // 2)
        ended = F.col("blocks") <= 1 << level
        done.append(now.where(ended).select("row", "blocks", "name"))
        now = now.where(~ended)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _grouped(rows: DataFrame, size: int) -> DataFrame:
    """(row, id, sha, group_size, best) for ``rows`` (row, id, t): best is the row that stays of equal texts."""
    rows = rows.select("row", "id", F.length("t").alias("chars"), without_white(F.col("t")).alias("norm"))
    about = stage(rows.select("row", "id", "chars", F.sha2(F.col("norm").cast("binary"), 256).alias("sha"), F.transform(
        _blocks(F.col("norm"), size), lambda b: F.xxhash64(b)).alias("hashes")), "texts")
    places = about.select("row", F.posexplode("hashes").alias("idx", "h"))
    named = about.drop("hashes").join(identities(rows.select("row", "norm"), places, size), "row")
    named = stage(named, "identities")
    best = F.max(F.struct(F.col("chars"), -F.col("id"), -F.col("row"), F.col("id").alias("id"), F.col("row").alias("row")))
    groups = stage(named.groupBy("blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "groups")
    return named.join(groups, ["blocks", "name"]).select("row", "id", "sha", "group_size", "best")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without their white space. Of equal texts the row with
    the most code points in the original text stays, then the one with the smallest id,
    then the first in the input. A null text is an empty one; a null id comes after all
    others and stays null in the result. Other columns, whatever their names, are not read.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), whole_text(text).alias("t"))
    return _grouped(rows, size).select(
        F.col("id").alias(doc_id), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns: one of each text.

    Rows are told apart by a number that is written with them once, not by their ids: rows that
    repeat an id, or have none, are kept or dropped by their texts like all others, and a rerun of a task
    decides alike.
    """
    table, row = numbered(docs, "exact-rows")
    groups = _grouped(table.select(F.col(row).alias("row"), F.col(doc_id).alias("id"), whole_text(text).alias("t")), size)
    return only(table, row, groups.where(F.col("row") == F.col("best.row")).select(F.col("row").alias(row)), "kept-exact")

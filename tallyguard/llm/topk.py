"""Exact top-k inner products: norm-sorted vectors, rotated partial sums, Cauchy-Schwarz bounds.

Vectors are rotated onto the principal axes of all of them, so the first few
coordinates hold most of an inner product. Candidates are dealt into groups by
descending length. Queries meet the group of the longest vectors first, which gives
each a k-th best score; a later group is skipped by every query whose length times the
group's longest can't reach that score. Inside a group, blocks of candidates are
scored on the leading coordinates alone, the rest is bounded by the product of the
residual lengths, and only what may still reach the k-th score is multiplied in full,
in integers. Bounds have slack for rounding, so nothing is lost.

Queries go in blocks to the groups they may need; no task holds more than a group and a
block, whose sizes are parameters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyguard.llm.common import stage

GROUP = 32_768   # candidates that one task holds
AT_ONCE = 2_048  # candidates scored together
BLOCK = 32_768   # queries that one task holds
QUERIES = 512    # queries scored together
LEAD = 0.9       # share of the energy that the leading coordinates hold
SLACK = 1e-6     # relative to the product of lengths


def integer_vectors(table: DataFrame, vec_id: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v, norm2): floor(scale * x) of every component; vectors null or with a null or non-finite one are left out."""
    x = F.col("x")
    whole = table.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    whole = whole.where(x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    ints = whole.select("id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
    return ints.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))


def _matrix(column, width: int) -> np.ndarray:
    """Lists of integers as rows; shorter ones end in zeros."""
    flat = column.flatten().to_numpy()
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(sizes), width), np.int64)
    if len(flat):
        out[np.repeat(np.arange(len(sizes)), sizes),
            np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _second_moments(table: DataFrame, width: int) -> np.ndarray:
    """The sum of v v' over all vectors: width x width numbers, added up in the tasks."""
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            for i in range(0, batch.num_rows, 10_000):
                m = _matrix(batch.column(0).slice(i, 10_000), width).astype(np.float64)
                total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width, dtype=np.int32)), pa.array(total.ravel())], ["at", "x"])

    rows = table.select("v").mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(width * width)
    for at, x in rows:
        out[at] = x
    return out.reshape(width, width)


def _best(ids: np.ndarray, scores: np.ndarray, k: int):
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class _Group:
    """Candidates by descending length, with what the bounds need."""

    def __init__(self, ids, vectors, axes, lead):
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        order = np.lexsort((ids, -norms))
        self.ids, self.whole, self.norms = ids[order], vectors[order].astype(np.float64), norms[order]
        rotated = self.whole @ axes
        self.head, self.rest = rotated[:, :lead], np.sqrt((rotated[:, lead:] ** 2).sum(axis=1))
        self.axes, self.lead = axes, lead

    def search(self, query_ids, queries, floors, k):
        """Yield (query number, ids, scores) of the k best of each query that reach its floor."""
        whole = queries.astype(np.float64)
        rotated = whole @ self.axes
        head, rest = rotated[:, :self.lead], np.sqrt((rotated[:, self.lead:] ** 2).sum(axis=1))
        norms = np.sqrt((whole ** 2).sum(axis=1))
        found = [(np.zeros(0, np.int64), np.zeros(0, np.float64)) for _ in queries]
        floors = floors.copy()
        for i in range(0, len(self.ids), AT_ONCE):
            part = slice(i, i + AT_ONCE)
            live = np.flatnonzero(norms * self.norms[i] * (1 + SLACK) >= floors)
            if not len(live):
                break
            bound = head[live] @ self.head[part].T + rest[live][:, None] * self.rest[part][None, :]
            bound += SLACK * norms[live][:, None] * self.norms[part][None, :]
            for q, row in zip(live.tolist(), bound >= floors[live][:, None]):
                at = np.flatnonzero(row) + i
                at = at[self.ids[at] != query_ids[q]]
                if not len(at):
                    continue
                scores = self.whole[at] @ whole[q]  # integers below 2 ** 53: exact
                ids, best = _best(np.concatenate([found[q][0], self.ids[at]]), np.concatenate([found[q][1], scores]), k)
                found[q] = ids, best
                if len(best) == k:
                    floors[q] = max(floors[q], best[-1])
        for q, (ids, best) in enumerate(found):
            yield q, ids, best


def _search(axes, lead, width, k):
    """For one group: the candidates' side and the queries' side; a row for each score kept."""
    def run(left, right):
        vectors = _matrix(left.column("v").combine_chunks(), width)
        ids = left.column("id").to_numpy()
        out = [[], [], []]
        if len(ids):
            group = _Group(ids, vectors, axes, lead)
            for i in range(0, right.num_rows, QUERIES):
                part = right.slice(i, QUERIES)
                asked = part.column("query_id").to_numpy()
                for q, found, best in group.search(asked, _matrix(part.column("v").combine_chunks(), width),
                                                   part.column("floor").to_numpy(), k):
                    out[0].append(np.full(len(found), asked[q]))
                    out[1].append(found)
                    out[2].append(best.astype(np.int64))
        columns = [pa.array(np.concatenate(o) if o else np.zeros(0, np.int64)) for o in out]
        return pa.table(columns, ["query_id", "vec_id", "score"])

    return run


def top_inner_products(table: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", vector: str = "embedding",
                       scale: int = 256, group: int = GROUP, block: int = BLOCK, lead_share: float = LEAD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each row whose id is divisible by ``every``.

    Scores are inner products of the integer vectors; ties go to the smaller id. Vectors of
    different length count as if the shorter ended in zeros, an empty one scores 0. A null id takes no
    part. Rows that repeat an id are candidates one by one, but not for a query of that id; such a query
    is asked once, with the largest of its vectors.
    """
    vectors = stage(integer_vectors(table, vec_id, vector, scale).where("id is not null"), "vectors")
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    result = "query_id long, vec_id long, score long"
    if not width:
        width = 1
    axes = np.linalg.eigh(_second_moments(vectors, width))
    axes, energy = axes[1][:, ::-1], np.maximum(axes[0][::-1], 0)
    lead = int(np.searchsorted(np.cumsum(energy), lead_share * energy.sum()) + 1) if energy.sum() else 1
    lead = min(lead, width)
    n_groups = max(1, -(-vectors.count() // group))
    dealt = vectors.repartitionByRange(n_groups, F.col("norm2").desc(), "id") if n_groups > 1 else vectors.coalesce(1)
    # equal numbers of rows in expectation; a group larger than twice the parameter is cut by the row's place
    dealt = stage(dealt.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"), "id", "v", "norm2")
                  .select(F.struct("part", F.floor(F.col("row").bitwiseAND((1 << 33) - 1) / (2 * group))).alias("g"), "id", "v", "norm2"), "groups")
    by_length = Window.orderBy(F.col("top").desc(), "g")  # as many rows as groups
    longest = stage(dealt.groupBy("g").agg(F.max("norm2").alias("top")).withColumn(
        "no", F.row_number().over(by_length) - 1), "group-lengths")
    dealt = dealt.join(longest, "g").select("no", "id", "v")
    queries = vectors.where(F.col("id") % every == 0).groupBy("id").agg(F.max(F.struct("norm2", "v")).alias("q"))
    queries = stage(queries.select(F.col("id").alias("query_id"), F.col("q.v").alias("v"), F.col("q.norm2").alias("norm2")), "queries")
    blocks = max(1, -(-queries.count() // block))
    queries = queries.withColumn("b", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    search = _search(axes, lead, width, k)

    def met(candidates: DataFrame, asked: DataFrame) -> DataFrame:
        spread = candidates.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        return spread.groupBy("no", "b").cogroup(asked.groupBy("no", "b")).applyInArrow(search, result)

    # the longest vectors first: they give every query a score that others have to reach
    floor = F.lit(float("-inf"))
    begun = stage(met(dealt.where("no = 0"), queries.select("query_id", "v", floor.alias("floor"), F.lit(0).alias("no"), "b")),
                  "first-group")
    found = begun
    if longest.count() > 1:
        reached = begun.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        reached = reached.where(F.col("n") >= k).select("query_id", F.col("least").cast("double").alias("floor"))
        asked = queries.join(reached, "query_id", "left").fillna(float("-inf"), ["floor"])
        asked = asked.withColumn("no", F.explode(F.sequence(F.lit(1), F.lit(longest.count() - 1)))).join(longest, "no")
        asked = asked.where(F.sqrt("norm2") * F.sqrt("top") * F.lit(1 + SLACK) >= F.col("floor"))
        found = begun.unionByName(met(dealt.where("no > 0"), asked.select("query_id", "v", "floor", "no", "b")))
    ranked = found.groupBy("query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))

"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Documents longer than a sequence are cut; whole pieces are sequences by themselves.
All others are items. Every task packs its own items best-fit, the largest first, and
emits the sequences that are nearly full. What is left, underfull sequences with their
content, are the items of the next round in an eighth of the tasks, dealt anew. Rounds
end in one task, or when no task of a round could join any two: then all but one of a
task's sequences are more than half full, and so are nearly all that are left. A task
holds at most ``PER_TASK`` items in any round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyguard.llm.common import stage, whole_text
from tallyguard.llm.encoders import encoder

CAPACITY = 2048
FULL = 8            # free tokens of a sequence that is emitted as nearly full
PER_TASK = 50_000   # items
FEWER = 8           # times fewer tasks in every round


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): the ids of each document and its end id, cut to the capacity.

    ``ids`` are unsigned 32-bit little-endian. Only documents longer than the capacity are cut;
    their first piece is the shorter one. A null or empty text has only its end id.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches):
        encode = encoder(tokenizer).encode
        for batch in batches:
            owner, piece, start, length, cut = [], [], [], [], []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(t) + end
                n = len(ids) // 4
                a, b, k = 0, n if n <= capacity else n % capacity or capacity, 0
                while a < n:
                    owner.append(doc)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    cut.append(ids[4 * a:4 * b])
                    a, b, k = b, b + capacity, k + 1
            for i in range(0, len(owner), 2000):
                part = slice(i, i + 2000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[part], batch.schema.field(0).type), pa.array(piece[part], pa.int32()),
                     pa.array(start[part], pa.int64()), pa.array(length[part], pa.int64()),
                     pa.array(cut[part], pa.binary())], ["doc_id", "piece", "start", "length", "ids"])

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of every item and the number of bins; the largest item first, each into the fullest bin it fits."""
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free_now, some = [], 0  # some: bit f is set while a bin with f free tokens is open
    place, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = some >> size
        if fits and size:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some ^= 1 << free
        else:
            b, free = len(free_now), capacity
            free_now.append(capacity)
        place[i], offset[i] = b, capacity - free
        free -= size
        free_now[b] = free
        if free:
            by_free[free].append(b)
            some |= 1 << free
    return place, offset, len(free_now)


def _round(capacity: int, full: int, number: int, last: bool):
    """Pack the bins of a partition's rows into new ones; ``done`` marks the rows of those that are emitted."""
    def run(batches):
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        bins = table.column("bin").to_numpy()
        ends = table.column("offset").to_numpy() + table.column("length").to_numpy()
        distinct, at = np.unique(bins, return_inverse=True)
        fill = np.zeros(len(distinct), np.int64)
        np.maximum.at(fill, at, ends)
        place, offset, n = best_fit(fill, capacity)
        total = np.bincount(place, fill, n).astype(np.int64)
        done = (total >= capacity - full) | last
        first = (number << 52) + (TaskContext.get().partitionId() << 30)
        for name, column in (("bin", first + place[at]), ("offset", table.column("offset").to_numpy() + offset[at]),
                             ("done", done[place[at]])):
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(column))
        yield from table.to_batches(max_chunksize=50_000)

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, full: int = FULL, per_task: int = PER_TASK) -> DataFrame:
    """``items`` with ``length`` from 1 to the capacity get sequence_id and offset; other columns come along.

    Sequences are gapless from 0. Which items share a sequence depends on how the input was dealt.
    Columns named sequence_id, offset, bin or done are replaced.
    """
    keep = [c for c in items.columns if c not in ("sequence_id", "offset", "bin", "done")]
    now = stage(items.select(*keep, F.monotonically_increasing_id().alias("bin"), F.lit(0).cast("long").alias("offset"),
                             F.lit(False).alias("done")), "pieces")
    schema = now.schema
    whole = F.col("length") == capacity
    # the numbers of the input's rows are below 2 ** 52 up to 2 ** 19 partitions; rounds begin there
    out = now.where(whole).select(*keep, F.col("bin").alias("sequence_id"), "offset")
    now, number = now.where(~whole), 0
    left = now.count()
    tasks = max(1, -(-left // per_task))
    while left:
        number += 1
        dealt = now.repartition(tasks, F.xxhash64("bin", F.lit(number))).sortWithinPartitions("bin", "offset")
        packed = stage(dealt.mapInArrow(_round(capacity, full, number, tasks == 1), schema), f"packed-{number}")
        out = out.unionByName(packed.where("done").select(*keep, F.col("bin").alias("sequence_id"), "offset"))
        now = packed.where("not done")
        before, left = left, now.select("bin").distinct().count()
        if tasks == 1 or not left:
            break
        joined = before - packed.select("bin").distinct().count()
        if not joined and tasks <= -(-left // per_task):
            break
        tasks = max(-(-tasks // FEWER), -(-left // per_task))
    return out.unionByName(now.select(*keep, F.col("bin").alias("sequence_id"), "offset")) if left else out


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed pieces of each sequence put together; a sequence has at most its capacity of ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row of ``docs``.

    Rows that repeat an id are documents of their own. A null id stays null. Other columns are not read.
    """
    cut = pieces(docs, tokenizer, capacity, end_id).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(cut, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

"""Ranked lexical search, reversed: the items wait in an index and the documents are the stream.

The index maps a term to the items that hold it. It is broadcast, and every document's
term counts go through it once: a term adds its share of the score to each of its
items. A task holds, for every item, a heap of the k best documents it has met; a
document enters only where it reaches the heap's last score. The heaps of all tasks
are merged in two steps, so no task meets the heaps of all others.

The index is cut into blocks of items with a bounded number of (item, term) pairs, and
the documents are read once for each block. Counts of documents, terms and holders of
a term are taken over all documents before any score.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyguard.llm.common import stage

POSTINGS = 1 << 20  # (item, term) pairs of one block, about 100 MB in a worker
MERGES = 256        # groups of tasks whose heaps are merged first
AT_ONCE = 1 << 21   # sums, and postings met, that a worker holds while it scores
#: ASCII letters and digits and all other characters make terms; only A-Z are lower-cased.
_FOLD = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, repeats included."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class _Index:
    """Items by term: ``starts[t]:starts[t + 1]`` of ``items`` are the items that hold term t."""

    def __init__(self, pairs: list[tuple[int, bytes]]):
        self.ids = sorted({item for item, _ in pairs})
        number = {item: i for i, item in enumerate(self.ids)}
        self.terms = {t: i for i, t in enumerate(sorted({bytes(t) for _, t in pairs}))}
        held = np.array([(self.terms[bytes(t)], number[item]) for item, t in pairs], dtype=np.int64).reshape(-1, 2)
        held = held[np.lexsort((held[:, 1], held[:, 0]))]
        self.items = held[:, 1]
        self.starts = np.searchsorted(held[:, 0], np.arange(len(self.terms) + 1))


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Distinct (item, term); rows that repeat an id are one item, rows without one are none."""
    def run(batches):
        for batch in batches:
            found = [(i, t) for i, s in zip(batch.column("item").to_pylist(), batch.column("said").to_pylist())
                     for t in set(terms(s))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in found], pa.int64()), pa.array([t for _, t in found], pa.binary())], ["item", "term"])

    asked = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).alias("said")).where("item is not null")
    return asked.mapInArrow(run, "item long, term binary").distinct()


def _counted(docs: DataFrame, index) -> DataFrame:
    """(doc, n, terms, tfs) of every document: its number of terms, and the counts of those that are in the index."""
    def run(batches):
        known = index.value.terms
        for batch in batches:
            sizes, ids, tfs, ends = [], [], [], [0]
            for said in batch.column("said").to_pylist():
                words = terms(said)
                sizes.append(len(words))
                held = Counter(map(known.get, words))
                held.pop(None, None)
                ids += held.keys()
                tfs += held.values()
                ends.append(len(ids))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, t))
                     for x, t in ((ids, pa.int32()), (tfs, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(sizes, pa.int64()), *lists], ["doc", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<long>")


class _Heaps:
    """The k best (score, document) of every item; a document without an id is the last of equals."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item = self.score = self.doc = np.zeros(0, np.int64)
        self.nameless = np.zeros(0, bool)
        self.floor = np.ones(items, np.int64)  # scores below it can't enter

    def push(self, item, score, doc, nameless):
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        doc, nameless = np.concatenate([self.doc, doc]), np.concatenate([self.nameless, nameless])
        order = np.lexsort((doc, nameless, -score, item))
        item = item[order]
        first = np.flatnonzero(np.concatenate(([True], item[1:] != item[:-1])))
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        kept = order[place < self.k]
        full = order[place == self.k - 1]
        self.floor[item[place == self.k - 1]] = score[full]
        self.item, self.score, self.doc, self.nameless = item[place < self.k], score[kept], doc[kept], nameless[kept]


def _scored(index, weights, documents: int, length: int, k: int, at_once: int):
    """Each task's heaps as (item, doc, score) rows."""
    def run(batches):
        at, weight = index.value, weights.value
        n_items, held = len(at.ids), np.diff(at.starts)
        heaps = _Heaps(n_items, k)
        for batch in batches:
            names = batch.column("doc")
            nameless, names = names.is_null().to_numpy(zero_copy_only=False), names.fill_null(0).to_numpy()
            ids, ends = batch.column("terms").flatten().to_numpy(), batch.column("terms").offsets.to_numpy()
            ends = ends - ends[0]
            tf = batch.column("tfs").flatten().to_numpy()
            m = np.array([10 + 90 * n * documents // length for n in batch.column("n").to_pylist()], np.int64)
            doc = np.repeat(np.arange(len(m)), np.diff(ends))
            share = weight[ids] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            met = np.concatenate(([0], np.cumsum(held[ids])))[ends]  # postings met before each document
            a = 0
            while a < len(m):
                b = int(np.searchsorted(met, met[a] + at_once, side="right")) - 1
                b = max(a + 1, min(b, a + max(1, at_once // n_items), len(m)))
                part = slice(ends[a], ends[b])
                times = held[ids[part]]
                of = np.repeat(np.arange(len(times)), times)
                posting = np.arange(len(of)) - np.repeat(np.cumsum(times) - times - at.starts[ids[part]], times)
                sums = np.zeros((b - a) * n_items, np.int64)
                np.add.at(sums, (doc[part][of] - a) * n_items + at.items[posting], share[part][of])
                sums = sums.reshape(b - a, n_items)
                row, item = np.nonzero(sums >= heaps.floor[None, :])
                if len(row):
                    heaps.push(item, sums[row, item], names[a + row], nameless[a + row])
                a = b
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(at.ids, np.int64)[heaps.item]), pa.array(heaps.doc, mask=heaps.nameless), pa.array(heaps.score)],
            ["item", "doc", "score"])

    return run


def _merged(heaps: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy("item", *by).orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", postings: int = POSTINGS,
                   at_once: int = AT_ONCE) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 for each item.

    Terms are runs of ASCII letters, ASCII digits and characters beyond ASCII, A-Z lower-cased;
    null and empty texts have none. With N documents that have a term, L terms in all of them,
    n terms in a document and df holders of a term, m = 10 + 90 n N div L, a term weighs
    w = floor(1000 ln((2 N + 2) / (2 df + 1))), and a document scores the sum of
    w ((10^9 tf) div (1000 tf + 8 m)) over the item's different terms. Equal scores go by
    ascending id, a null id last. Every row of ``docs`` is a document, also one that repeats an id.
    Rows of ``items`` that repeat an id are one item; items without an id, a term, or a document
    that scores are not in the result. Other columns are not read. ``postings`` bounds what is broadcast
    (a single item may exceed it), ``at_once`` what a task holds beside its heaps.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("said"))
    asked = stage(item_terms(items, item_id, item_text), "item-terms")
    blocks = -(-asked.count() // postings)
    found, documents, length = None, None, None
    for b in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        if not held:
            continue
        index = spark.sparkContext.broadcast(_Index([tuple(r) for r in held]))
        counts = stage(_counted(read, index), "term-counts")
        if documents is None:
            documents, length = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
            if not documents:
                break
        weights = np.zeros(len(index.value.terms), np.int64)
        for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        heaps = counts.where("size(terms) > 0").mapInArrow(
            _scored(index, spark.sparkContext.broadcast(weights), documents, length, k, at_once), "item long, doc long, score long")
        some = F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("some")
        heaps = stage(_merged(heaps.select("*", some), k, "some"), "heaps")
        found = heaps if found is None else found.unionByName(heaps)
    if found is None:
        found = spark.createDataFrame([], "item long, doc long, score long")
    return _merged(found.select("item", "doc", "score"), k).select(
        F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")

"""Toxicity scores of whole texts with the subword-bag classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tallyguard.llm import subword
from tallyguard.llm.common import whole_text

PER_CLASS = (2000, 1000)  # labelled rows to train on: not toxic, toxic
MOST_CHARS = 20_000       # longer texts are scored but not trained on
WINDOW = 8                # words averaged together
THRESHOLD = 0.7
AT_ONCE = 256             # texts scored together in a task


def labelled_sample(docs: DataFrame, labelled: DataFrame, per_class: tuple[int, ...], doc_id: str = "doc_id",
                    text: str = "text", most_chars: int = MOST_CHARS) -> tuple[list[str], list[int]]:
    """Texts and classes of at most ``per_class[c]`` documents per class c, those with the smallest hashed ids.

    ``labelled`` is (id, class). Ids labelled twice count with their largest class; a
    class outside the range, a null id, a null class or text, and texts over ``most_chars`` take no part.
    """
    classes = labelled.select(F.col(labelled.columns[0]).alias("id"), F.col(labelled.columns[1]).cast("int").alias("class"))
    classes = classes.where(F.col("class").between(0, len(per_class) - 1)).groupBy("id").agg(F.max("class").alias("class"))
    lengths = docs.select(F.col(doc_id).alias("id"), F.length(text).alias("chars")).where(f"chars <= {most_chars}")
    known = classes.join(lengths, "id").select("id", "class", F.xxhash64("id", F.lit(3)).alias("h")).distinct()
    picked = None
    for c, most in enumerate(per_class):
        part = known.where(F.col("class") == c).orderBy("h", "id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    # at most sum(per_class) ids
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(F.length("text") <= most_chars)
    rows = texts.join(F.broadcast(picked.select("id", "class")), "id").groupBy("id", "class").agg(
        F.min("text").alias("text")).orderBy("id").collect()
    return [r["text"] for r in rows], [r["class"] for r in rows]


def fit(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, window: int = WINDOW):
    """A model from ``labels`` (doc_id, toxic) of the documents that are not held out; None without both classes."""
    learn = labels.where("toxic is not null and doc_id is not null and crc32(cast(doc_id as string)) % 3 != 1")
    texts, classes = labelled_sample(docs, learn.select("doc_id", "toxic"), per_class)
    return subword.train(texts, classes, 2, window) if len(set(classes)) == 2 else None


def with_scores(docs: DataFrame, model, out: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the probability of class 1 in the window of each text that speaks most for it.

    A null text is scored as an empty one. Without a model every score is 0.
    """
    if out in docs.columns:
        raise ValueError(f"{out} is a column already")
    if model is None:
        return docs.withColumn(out, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x 2 floats
    at = docs.columns.index(text)

    def run(batches):
        model = shared.value
        for batch in batches:
            texts, scores = batch.column(at), []
            for i in range(0, len(texts), AT_ONCE):
                part = [t or "" for t in texts.slice(i, AT_ONCE).to_pylist()]
                scores += [(z[:, 1] - z[:, 0]).max() for z in model.many(part)]
            scores = 1 / (1 + np.exp(-np.clip(np.array(scores, dtype=np.float64), -700, 700)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, out])

    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, whatever its text; see ``with_scores``."""
    model = fit(docs, labels, per_class)
    scored = with_scores(docs.select("doc_id", "text"), model).select("doc_id", "score")
    return scored.select("doc_id", F.expr("coalesce(crc32(cast(doc_id as string)) % 3 = 1, false)").alias("held_out"),
                         "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS) -> DataFrame:
    """The rows of ``docs`` scored below the threshold, with all their columns."""
    out = "score"
    while out in docs.columns:
        out = "_" + out
    return with_scores(docs, fit(docs, labels, per_class), out).where(F.col(out) < THRESHOLD).drop(out)

"""Mixing to target weights with soft memberships.

A classifier learnt from a labelled table predicts every document's probabilities of
the domains. A document counts towards each domain with its tokens times that
probability. Nonnegative rates, one per document, are fitted by projected gradient
on the least squares between the domains' expected token totals and the targets.

All documents take every step together: a step needs only the totals of the domains
(as many numbers as domains), and a document's rate follows from its own
probabilities and the steps so far. So no rates are kept or shuffled between steps.
The metric is tokens per document, residuals are whitened by the second moments of the
documents whose rate isn't 0, and a step that doesn't bring the totals closer is halved.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyguard.llm import subword
from tallyguard.llm.common import kept, stage
from tallyguard.llm.encoders import Encoder
from tallyguard.llm.toxicity import AT_ONCE, labelled_sample

PER_DOMAIN = 1500  # labelled rows of each domain to train on
STEPS = 40
HALVINGS = 12
VOCABULARY = "byte_bpe_50k.json"  # of the tokens that count, a public file on every machine
CHUNKS = 700_000   # chunks whose measures a worker keeps from text to text, about 200 MB with what they are made of
FEWER = 250_000    # of them where other stages have left their traces in an executor's memory
LENGTH = 64        # characters of a chunk that is kept
FEW = 50_000       # chunks whose token ids it keeps beside them, for those that hold others
CLOSE = 1e-4       # of the total, the largest miss of a domain that ends the fit


def domain_model(docs: DataFrame, labelled: DataFrame, domains: list[str], per_domain: int = PER_DOMAIN):
    """Learn domains from ``labelled`` (doc_id, domain); None when fewer than two of them occur."""
    numbered = labelled.select("doc_id", F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain"))
                               .cast("int").alias("n")).where("n > 0 and doc_id is not null")
    texts, classes = labelled_sample(docs, numbered.select("doc_id", F.col("n") - 1), (per_domain,) * len(domains))
    if len(set(classes)) < 2:
        return None
    model = subword.train(texts, classes, len(domains), 0, rounds=60)
    # it has learnt from as much of each domain; the labelled table says how common they are
    known = {n - 1: c for n, c in numbered.groupBy("n").count().collect()}  # a row per domain
    model.bias = model.bias + np.log([max(known.get(d, 0), 0.5) for d in range(len(domains))])
    return model


class _Measured:
    """What a worker knows of the chunks it has met: their token ids, words and the sums of the words' logits.

    A text is looked up once, chunk by chunk; chunks end at spaces, so no word is in two of them.
    """

    def __init__(self, vocabulary: str, model, most: int = CHUNKS):
        self.encoder, self.model, self.most = Encoder(vocabulary, limit=FEW, words=most // 3), model, most
        self.numbers = subword.Numbers()
        self.rows = np.zeros((most, 2 + (0 if model is None else model.table.shape[1])))
        self.empty = None if model is None else model.word_rows([""])[0].astype(np.float32)

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray | None]:
        """(token ids, logits) of every text; of a text without words those of the empty word, without a model none."""
        split = [self.encoder.chunks(t) for t in texts]
        for chunks in split:
            chunks[0] = (chunks[0],)  # told apart from the others: it has no space before it
        numbers, sizes = self.numbers, np.array([len(chunks) for chunks in split])
        if len(numbers) > self.most:
            stay = self.most * 9 // 10  # the first seen, and so the common ones
            for c in [c for c, n in numbers.items() if n >= stay]:
                del numbers[c]
        first, numbers.new = len(numbers), []
        found = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        if len(numbers) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((len(numbers) - len(self.rows), self.rows.shape[1]))])
        for i in range(0, len(numbers.new), 20_000):
            part = numbers.new[i:i + 20_000]
            self.rows[first + i:first + i + len(part)] = self._measure(part)
        sums = np.add.reduceat(self.rows[found], np.cumsum(sizes) - sizes, axis=0)
        new = numbers.new
        for i in reversed([i for i, c in enumerate(new) if len(c if isinstance(c, str) else c[0]) > LENGTH]):
            del numbers[new[i]]  # a long one isn't kept: the last one takes its place
            last = new.pop()
            if i < len(new):
                new[i], numbers[last], self.rows[first + i] = last, first + i, self.rows[first + len(new)]
        counts, words = sums[:, 0].astype(np.int64), sums[:, 1:2]
        if self.model is None:
            return counts, None
        return counts, np.where(words > 0, sums[:, 2:] / np.maximum(words, 1), self.empty) + self.model.bias

    def _measure(self, chunks: list) -> np.ndarray:
        out = np.zeros((len(chunks), self.rows.shape[1]))
        most, count, short = subword.LONGEST, self.encoder.count, self.encoder.word_count  # bytes of a word that isn't cut
        counts, flat, words = [], [], []
        for c in chunks:
            if (n := short(c)) and len(c) <= most:  # one word, as most chunks are
                words.append(1)
                flat.append(c.lower())
            else:
                c, before = (c, " ") if isinstance(c, str) else (c[0], "")
                n = n or count(c, before)
                found = c.lower().split() if 4 * len(c) <= most or len(c) <= most and c.isascii() else subword.words_of(c)
                words.append(len(found))
                flat += found
            counts.append(n)
        out[:, 0] = counts
        if self.model is not None:
            out[:, 1] = words
            if flat:
                owner, rows = np.repeat(np.arange(len(chunks)), out[:, 1].astype(np.int64)), self.model.word_rows(flat).astype(np.float32)
                for k in range(rows.shape[1]):
                    out[:, 2 + k] = np.bincount(owner, rows[:, k], len(chunks))
        return out


def with_memberships(docs: DataFrame, model, domains: int, text: str = "text",
                     tokens: str = "_tokens", members: str = "_members", vocabulary: str | None = None,
                     chunks: int = CHUNKS) -> DataFrame:
    """``docs`` with the number of token ids of the whole text and the probabilities of the domains.

    ``chunks`` bounds how many a worker keeps; it changes no row.
    ``vocabulary`` is the path of a tokenizer's file, ``VOCABULARY`` if there is none. No end id is
    counted: an empty or null text has no tokens. Without a model all domains are equally likely.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path(VOCABULARY)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x domains floats
    at = docs.columns.index(text)

    def run(batches):
        measured = kept(_Measured, vocabulary, shared.value, chunks)
        for batch in batches:
            for i in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(i, AT_ONCE)
                counts, logits = measured.many([t or "" for t in part.column(at).to_pylist()])
                found = np.full((len(counts), domains), 1 / domains) if logits is None else subword.softmax(logits)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, domains, dtype=np.int32)), pa.array(found.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counts, pa.int64()), lists],
                                                 [*batch.schema.names, tokens, members])

    schema = T.StructType([*docs.schema.fields, T.StructField(tokens, T.LongType()),
                           T.StructField(members, T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(run, schema)


def _dot(members: Column, weights) -> Column:
    total = F.lit(0.0)
    for d, w in enumerate(weights):
        total = total + members[d] * F.lit(float(w))
    return total


def _rate(members: Column, start: float, steps: list[np.ndarray]) -> Column:
    """A document's rate after the steps: each moves it, and none leaves it below 0."""
    if not steps:
        return F.lit(float(start))
    k = len(steps[0])
    done = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
    return F.aggregate(done, F.lit(float(start)), lambda r, s: F.greatest(
        F.lit(0.0), r - sum((members[d] * s[d] for d in range(1, k)), members[0] * s[0])))


def fit_rates(table: DataFrame, targets: list[float], total: float | None = None, whole: int | None = None,
              tokens: str = "_tokens", members: str = "_members") -> tuple[float, list[np.ndarray]]:
    """Start and steps of the rates of ``table``, whose domains' totals shall be ``targets`` times ``total``.

    Without a total it is the one that keeps domain ``whole`` at its present size, or else the present total.
    """
    k, t, m = len(targets), F.col(tokens), F.col(members)
    shares = np.array(targets, dtype=float) / sum(targets)

    def totals(rate: Column):
        """The domains' totals at a rate, and the second moments of the documents it doesn't leave out."""
        kept = F.when(rate > 0, t).otherwise(F.lit(0))
        row = table.agg(F.sum(t), *[F.sum(t * m[a] * rate) for a in range(k)],
                        *[F.sum(kept * m[a] * m[b]) for a in range(k) for b in range(k)]).first()
        if not row[0]:
            return 0.0, None, None
        return float(row[0]), np.array(row[1:k + 1]), np.array(row[k + 1:]).reshape(k, k)

    start, steps = 1.0, []
    size, mass, moments = totals(F.lit(start))
    if not size:
        return start, steps
    goal = shares * (total if total else mass[whole] / shares[whole] if whole is not None else size)
    metric = np.linalg.pinv(moments, rcond=1e-9, hermitian=True)
    miss = mass - goal
    for _ in range(STEPS):
        if np.abs(miss).max() <= CLOSE * goal.sum():
            break
        step = np.linalg.pinv(moments, rcond=1e-9, hermitian=True) @ miss
        for _ in range(HALVINGS):
            _, mass, next_moments = totals(_rate(m, start, [*steps, step]))
            if (mass - goal) @ metric @ (mass - goal) < miss @ metric @ miss:
                break
            step = step / 2
        else:
            break  # no step is better: the targets can't be met more closely
        steps.append(step)
        miss, moments = mass - goal, next_moments
    return start, steps


def _copies(rate: Column, key: Column, seed: int) -> Column:
    """Whole copies, and one more with the probability of the rest, drawn from a hash of the row."""
    draw = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / F.lit(float(1 << 53))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("int")


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], whole: str | None = None,
          total: float | None = None, seed: int = 17) -> DataFrame:
    """(doc_id, tokens, members, rate, copies) for every row of ``docs``.

    ``members`` are the probabilities of the domains in the order of ``targets``. Rows with
    equal id and text draw the same copies; rows without tokens have a rate and copies too, by their probabilities.
    """
    domains = list(targets)
    model = domain_model(docs, labelled, domains)
    key = F.xxhash64("doc_id", "text").alias("key")
    table = stage(with_memberships(docs.select("doc_id", "text"), model, len(domains)).select(
        "doc_id", key, "_tokens", "_members"), "memberships")
    start, steps = fit_rates(table, list(targets.values()), total, domains.index(whole) if whole else None)
    rated = table.withColumn("rate", _rate(F.col("_members"), start, steps))
    return rated.select("doc_id", F.col("_tokens").alias("tokens"), F.col("_members").alias("members"), "rate",
                        _copies(F.col("rate"), F.col("key"), seed).alias("copies"))


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], whole: str | None = None,
        total: float | None = None, seed: int = 17) -> DataFrame:
    """``docs`` with every row as often as its rate says, with all its columns and no others."""
    domains, names = list(targets), docs.columns
    tokens, members, made = "_tokens", "_members", "_copy"
    while {tokens, members, made} & set(names):
        tokens, members, made = "_" + tokens, "_" + members, "_" + made
    model = domain_model(docs, labelled, domains)
    table = stage(with_memberships(docs, model, len(domains), tokens=tokens, members=members, chunks=FEWER), "mixed")
    start, steps = fit_rates(table, list(targets.values()), total, domains.index(whole) if whole else None, tokens, members)
    copies = _copies(_rate(F.col(members), start, steps), F.xxhash64("doc_id", "text"), seed)
    return table.withColumn(made, F.explode(F.array_repeat(F.lit(1), copies))).select(*names)

"""MinHash near-deduplication: universal hash minima, bands, verification, connected components.

A document is the set of its word shingles. Equal sets are one set from here on. Each
set has 128 minima of universal hashes, and rows that agree on a band of four of them
share a bucket. Of two sets at the threshold, 128 minima in 32 bands miss five pairs in
10^8. A pair from a bucket is compared by its signatures, at a bound that a linked pair
fails once in 10^9 cases, and then confirmed on the full sets of shingles.

No bucket is expanded into its pairs. First every set is compared with the first set of
its buckets, and components are taken of what is linked. Where a bucket still holds several
components, the sets outside its largest one are compared with the bucket inside tasks, in
blocks of bounded size: by signature, then on the full sets. A task emits a spanning forest of
the links it finds between components, so what is emitted grows with the sets, not their pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tallyguard.llm.common import components, stage, whole_text

MINIMA = 128
ROWS = 4         # minima of a band
GROUP = 1024     # sets of a bucket that a task compares with as many others
HELD = 1 << 21   # shingles that these sets have together, 16 MB
MISSED = 1e-9    # the share of linked pairs that the comparison of signatures may lose
SENT = 1 << 20   # document ids, 8 MB, that are sent to all tasks
WORDS = 500_000  # word hashes that a worker keeps
_ODD = np.uint64(0x9E3779B97F4A7C15)
_DRAWN = np.random.default_rng(20).integers(0, 1 << 64, (2, MINIMA), np.uint64)
_A, _B = _DRAWN[0] | np.uint64(1), _DRAWN[1]


class _Hashes(dict):
    """The hash of each word, kept up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 42)
        if len(self) < WORDS:
            self[word] = h
        return h


_WORDS = _Hashes()


def shingles(text: str | None, width: int) -> np.ndarray:
    """The different shingles of a text as sorted 64-bit hashes; fewer words than a shingle has are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        out = (out ^ hashes[j:j + len(out)]) * _ODD
        out ^= out >> np.uint64(32)
    return np.unique(out)


def minima(hashes: np.ndarray) -> np.ndarray:
    """The upper half of the least (a x + b) mod 2^64, for each of the universal hashes."""
    least = np.full(MINIMA, (1 << 64) - 1, np.uint64)
    for i in range(0, len(hashes), 1024):
        least = np.minimum(least, (_A[:, None] * hashes[None, i:i + 1024] + _B[:, None]).min(axis=1))
    return (least >> np.uint64(32)).astype(np.uint32)


def least_agreement(similarity: int) -> int:
    """The most minima that all but ``MISSED`` of the pairs at ``similarity`` per cent agree on."""
    p, lost = similarity / 100, 0.0
    for k in range(MINIMA + 1):
        lost += math.comb(MINIMA, k) * p ** k * (1 - p) ** (MINIMA - k)
        if lost > MISSED:
            return k
    return MINIMA


def signatures(docs: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(id, n, name, sig, held): size, 128-bit name and minima of a row's set; held is the text of a row without an id."""
    def run(batches):
        for batch in batches:
            ids, texts, size, name, sig = batch.column("id"), batch.column("text").to_pylist(), [], [], []
            for said in texts:
                found = shingles(said, width)
                size.append(len(found))
                name.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sig.append(minima(found).view(np.int32))
            held = pa.array([s if nameless else None for s, nameless in zip(texts, ids.is_null().to_pylist())], pa.string())
            flat = pa.array(np.concatenate(sig) if sig else np.zeros(0, np.int32))
            ends = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * MINIMA)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(size, pa.int64()), pa.array(name, pa.binary()), pa.ListArray.from_arrays(ends, flat), held],
                ["id", "n", "name", "sig", "held"])

    read = docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(text).alias("text"))
    return read.mapInArrow(run, "id long, n long, name binary, sig array<int>, held string")


def _rows(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, MINIMA)


def _likely(pairs: DataFrame, sets: DataFrame, similarity: int, bound: int) -> DataFrame:
    """The pairs (a, b) whose sizes allow a link and whose signatures agree on ``bound`` minima or more."""
    def run(batches):
        for batch in batches:
            near = (_rows(batch.column("x")) == _rows(batch.column("y"))).sum(axis=1) >= bound
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(near)) for c in ("a", "b")], ["a", "b"])

    sized = pairs.join(sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sig").alias("x")), "a").join(
        sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("y")), "b")
    sized = sized.where(100 * F.least("na", "nb") >= similarity * F.greatest("na", "nb"))
    return sized.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _whole_sets(ids: DataFrame, sets: DataFrame, docs: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(sid, shingles) of the wanted sets, from the text of a document that has each. Up to ``SENT`` ids go to all tasks."""
    wanted = stage(ids.join(sets, "sid").select("sid", "name", "least", "held"), "wanted-sets")
    holders = wanted.where("least is not null").select(F.col("least").alias("id"), "sid", "name")
    few = holders.select("id").distinct()
    few = F.broadcast(few) if wanted.count() <= SENT else few
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(text).alias("text")).join(few, "id", "left_semi")
    both = texts.join(holders, "id").select("sid", "name", "text").unionByName(
        wanted.where("least is null").select("sid", "name", F.col("held").alias("text")))

    def run(batches):
        for batch in batches:
            keep, sets_of = [], []
            for i, (name, said) in enumerate(zip(batch.column("name").to_pylist(), batch.column("text").to_pylist())):
                found = shingles(said, width)
                if xxhash.xxh3_128_digest(found.tobytes()) == name:  # rows that repeat an id may differ
                    keep.append(i)
                    sets_of.append(found.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sid").take(pa.array(keep, pa.int64())), pa.array(sets_of, pa.list_(pa.int64()))], ["sid", "shingles"])

    found = both.mapInArrow(run, "sid long, shingles array<long>")
    return stage(found.groupBy("sid").agg(F.first("shingles").alias("shingles")), "whole-sets")


def _confirmed(pairs: DataFrame, whole_of, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""
    ids = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    whole = whole_of(ids)
    met = pairs.join(whole.select(F.col("sid").alias("b"), F.col("shingles").alias("y")), "b").join(
        whole.select(F.col("sid").alias("a"), F.col("shingles").alias("x")), "a")
    both = F.size(F.array_intersect("x", "y"))  # both >= similarity of (x + y - both)
    return stage(met.where((100 + similarity) * both >= similarity * (F.size("x") + F.size("y"))).select("a", "b"), "links")


def _blocks(count: str, shingles_: str, group: int) -> Column:
    return F.greatest(F.ceil(F.col(count) / group), F.ceil(F.col(shingles_) / HELD))


def _apart(members: DataFrame, sets: DataFrame, roots: DataFrame, whole_of, similarity: int, bound: int, group: int) -> DataFrame | None:
    """(a, b): links between different components of a bucket, a spanning forest of those that a block of it holds."""
    rooted = members.join(roots.withColumnRenamed("node", "sid"), "sid", "left").join(sets.select("sid", "n", "sig"), "sid").select(
        "key", "sid", F.coalesce("root", "sid").alias("root"), "n", "sig")
    parts = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    open_ = parts.groupBy("key").agg(F.sum("c").alias("c"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"),
                                     F.max(F.struct("c", "n", "root")).alias("most"))
    # of two sets, one is the first of the bucket, with which the other was compared
    open_ = open_.where("parts > 1 and c > 2").withColumns({"pc": F.col("c") - F.col("most.c"), "pn": F.col("n") - F.col("most.n")})
    open_ = stage(open_.select("key", F.col("most.root").alias("main"), _blocks("c", "n", group).alias("targets"),
                               _blocks("pc", "pn", group).alias("probes")), "open-buckets")
    if not open_.head(1):
        return None
    held = stage(rooted.join(open_, "key"), "open-members")
    whole = whole_of(held.select("sid").distinct())
    held = held.join(whole, "sid")
    place = lambda n: F.pmod(F.xxhash64("sid"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = ["sid", "root", "n", F.transform("sig", lambda x: (x.bitwiseAND(F.lit(255)) - 128).cast("byte")).alias("sig"), "shingles"]
    targets = held.select("key", place("targets").alias("t"), every("probes").alias("p"), F.lit(False).alias("probe"), *own)
    probes = held.where("root != main").select("key", every("targets").alias("t"), place("probes").alias("p"), F.lit(True).alias("probe"), *own)

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        probe, sid, root, n = (table.column(c).to_numpy() for c in ("probe", "sid", "root", "n"))
        sig, lists = _rows(table.column("sig").chunk(0)), table.column("shingles").chunk(0)
        flat, ends = lists.flatten().to_numpy().view(np.uint64), lists.offsets.to_numpy()
        ends = ends - ends[0]
        target, part, found = np.flatnonzero(~probe), np.unique(root, return_inverse=True)[1], []
        for i in np.flatnonzero(probe):
            sizes = n[target]
            at = target[(part[target] != part[i]) & (100 * np.minimum(sizes, n[i]) >= similarity * np.maximum(sizes, n[i]))]
            at = at[(sig[at] == sig[i]).sum(axis=1) >= bound]
            mine = flat[ends[i]:ends[i + 1]]
            for k in range(0, len(at), 128):
                some = at[k:k + 128]
                some = some[part[some] != part[i]]
                if not len(some):
                    continue
                theirs = np.concatenate([flat[ends[j]:ends[j + 1]] for j in some])
                place_ = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
                both = np.add.reduceat(mine[place_] == theirs, np.concatenate(([0], np.cumsum(n[some])[:-1])), dtype=np.int64)
                for j in some[(100 + similarity) * both >= similarity * (n[some] + n[i])]:
                    if part[j] != part[i]:
                        found.append((min(sid[i], sid[j]), max(sid[i], sid[j])))
                        part[part == part[j]] = part[i]
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": a, "b": b})

    return stage(targets.unionByName(probes).groupBy("key", "t", "p").applyInArrow(run, "a long, b long").distinct(), "links-apart")


def _joined_roots(roots: DataFrame, more: DataFrame) -> DataFrame:
    """(node, root) after further links: components of the components that these touch."""
    own = lambda c: F.coalesce(F.col(f"{c}_root"), F.col(c)).alias(c)
    a, b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b"))
    tied = stage(components(more.join(a, "a", "left").join(b, "b", "left").select(own("a"), own("b")).distinct()), "roots-apart")
    tied = tied.select(F.col("node").alias("was"), F.col("root").alias("now"))
    moved = roots.join(tied, roots["root"] == tied["was"], "left").select("node", F.coalesce("now", "root").alias("root"))
    alone = tied.join(roots, tied["was"] == roots["node"], "left_anti").select(F.col("was").alias("node"), F.col("now").alias("root"))
    return moved.unionByName(alone)


def near_documents(docs: DataFrame, width: int = 4, similarity: int = 80, doc_id: str = "doc_id", text: str = "text",
                   group: int = GROUP) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are runs of characters outside [\\x20\\x09-\\x0D], A-Z lower-cased. The set of a text is its
    different ``width``-word shingles, or all its words as one shingle if there are fewer. Rows are linked
    whose sets' intersection is at least ``similarity`` per cent of their union; null texts and texts
    without a word have no set and are linked with nothing. component_id is the smallest id reachable, the
    row's own included; null ids don't count for it, and where no row of a component has an id it is null.
    A row is kept if it is the one that names its component, so rows that repeat an id share that, and
    rows without an id are kept only where no other has one. Other columns are not read.
    """
    bound = least_agreement(similarity)
    rows = stage(signatures(docs, width, doc_id, text), "signatures")
    sets = rows.where("n > 0").groupBy("name").agg(
        F.min("id").alias("least"), F.max("n").alias("n"), F.first("sig").alias("sig"), F.first("held", ignorenulls=True).alias("held"))
    sets = stage(sets.withColumn("sid", F.monotonically_increasing_id()), "sets")
    bands = F.array(*[F.xxhash64(F.lit(b), *[F.get("sig", F.lit(b + j)) for j in range(ROWS)]) for b in range(0, MINIMA, ROWS)])
    keyed = sets.select("sid", F.explode(bands).alias("key"))
    shared = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("sid").alias("least")).where("n > 1"), "buckets")
    members = stage(keyed.join(shared, "key").select("key", "sid", "least"), "members")
    whole_of = lambda ids: _whole_sets(ids, sets, docs, width, doc_id, text)
    star = members.where("sid != least").select(F.col("least").alias("a"), F.col("sid").alias("b")).distinct()
    links = _confirmed(stage(_likely(star, sets, similarity, bound), "likely-pairs"), whole_of, similarity)
    roots = components(links)
    more = _apart(members.select("key", "sid"), sets, roots, whole_of, similarity, bound, group)
    if more is not None and more.head(1):
        roots = _joined_roots(roots, more)
    rooted = sets.join(roots, sets["sid"] == roots["node"], "left").select("name", "least", F.coalesce("root", "sid").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("least").alias("class"))
    named = stage(rooted.join(classes, "root").select("name", "class"), "set-classes")
    own = F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("id"))
    return rows.select("id", "n", "name").join(named, "name", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))

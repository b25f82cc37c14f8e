"""SimHash near-deduplication with deletion-variant signatures.

A document's fingerprint has the bits that most of its word shingles' hashes have.
For links at up to ``distance`` bits, a fingerprint is cut into distance // 2 + 1
segments: of any two linked fingerprints one segment differs in at most one bit.
Every segment is indexed under its one-wildcard variants (the segment with one bit
deleted, with that bit's place), so two such segments share a variant. Equal keys are
brought together by a shuffle on distinct fingerprints, and verified by their bits.

A bucket of up to ``BUCKET`` fingerprints is verified in its task, which emits a
spanning set of links, never all pairs. The fingerprints of a larger bucket go on to
a second index of two-wildcard variants of the whole fingerprint: everything that
shares one of these is linked, at most four fingerprints do, and nothing is left out.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallyguard.llm.common import components, numbered, only, partitions, stage, whole_text

SEED = 42
BITS = 64
BUCKET = 1024  # fingerprints verified together in one task
CHUNK = 4096  # shingles whose bits are unpacked at once
PER_TASK = 2_000_000


def fingerprint(text: str, width: int) -> int:
    """The SimHash of the ``width``-word shingles of a text, repeats included, as an unsigned integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - width + 1].tolist()
        ends = ends[width - 1:].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends)]
    packed = np.array(hashes, dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(packed), CHUNK):
        part = packed[i:i + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    on = counts * 2 > len(packed)
    return int(np.packbits(on, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(row, id, fp) of ``docs``, row being 0 without such a column; fp is the fingerprint as a signed 64-bit integer."""
    rows = docs.select((F.lit(0) if row is None else F.col(row)).cast("long").alias("row"),
                       F.col(doc_id).cast("long").alias("id"), whole_text(text).alias("text"))

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, width) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(
                np.array(fps, dtype=np.uint64).view(np.int64))], ["row", "id", "fp"])

    return rows.mapInArrow(run, "row long, id long, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    n = distance // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _signed(bits: int):
    """A literal with these 64 bits."""
    return F.lit(bits - (1 << BITS) if bits >> (BITS - 1) else bits).cast("long")


def _variants(fps: DataFrame, distance: int) -> DataFrame:
    """(key, fp): every segment of every fingerprint with each one of its bits deleted."""
    keys = []
    for s, (first, bits) in enumerate(_segments(distance)):
        mask = (1 << bits) - 1
        value = F.shiftrightunsigned("fp", first).bitwiseAND(_signed(mask))
        for wild in range(bits):
            rest = value.bitwiseAND(_signed(mask & ~(1 << wild)))
            keys.append(F.xxhash64(F.lit(s), F.lit(wild), rest) if bits > 48 else
                        rest.bitwiseOR(F.lit((s * BITS + wild) << 48)))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _verified(fp: np.ndarray, distance: int) -> np.ndarray:
    """For each fingerprint of a bucket, one of its class: classes are joined by links inside the bucket."""
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance
    root = np.arange(len(fp))
    while True:
        least = np.where(near, root[None, :], len(fp)).min(axis=1)
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _bucket_links(distance: int, bucket: int):
    """Links inside the buckets of rows that come sorted by key; rows of larger buckets are passed on."""
    def some(key: np.ndarray, fp: np.ndarray):
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        small = np.repeat(sizes <= 16, sizes)
        for step in range(1, 16):
            a, b = slice(None, -step), slice(step, None)
            if len(key) <= step:
                break
            hit = (key[a] == key[b]) & small[a]
            hit &= np.bitwise_count(fp[a] ^ fp[b]) <= distance
            yield fp[a][hit], fp[b][hit]
        for i in np.flatnonzero(sizes > 16):
            group = fp[starts[i]:starts[i] + sizes[i]]
            root = _verified(group, distance)
            tied = root != np.arange(len(group))
            yield group[root[tied]], group[tied]

    def table(pairs, large):
        a = np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.uint64)])
        b = np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.uint64)])
        if len(a):
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            a, b = both[:, 0], both[:, 1]
        a, b = np.concatenate([a, large]), np.concatenate([b, large])
        flag = np.zeros(len(a), dtype=bool)
        flag[len(a) - len(large):] = True
        return pa.RecordBatch.from_arrays(
            [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(flag)], ["a", "b", "large"])

    def run(batches):
        held_key, held_fp, over = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
        for batch in batches:
            key = np.concatenate([held_key, batch.column("key").to_numpy()])
            fp = np.concatenate([held_fp, batch.column("fp").to_numpy().view(np.uint64)])
            if not len(key):
                continue
            large = np.zeros(0, np.uint64)
            if over is not None:  # the rest of a bucket already known to be large
                more = int(np.searchsorted(key, over, side="right"))
                large, key, fp = fp[:more], key[more:], fp[more:]
                if len(key):
                    over = None
            cut = int(np.searchsorted(key, key[-1], side="left")) if len(key) else 0
            pairs, big = _split(key[:cut], fp[:cut], bucket, some)
            large = np.concatenate([large, big])
            held_key, held_fp = key[cut:], fp[cut:]
            if len(held_key) > bucket:
                over, large = held_key[0], np.concatenate([large, held_fp])
                held_key, held_fp = held_key[:0], held_fp[:0]
            yield table(pairs, np.unique(large))
        pairs, big = _split(held_key, held_fp, bucket, some)
        yield table(pairs, np.unique(big))

    return run


def _split(key, fp, bucket, some):
    """Links of the buckets that fit, and the fingerprints of those that don't."""
    if not len(key):
        return [], np.zeros(0, np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    big = np.repeat(sizes > bucket, sizes)
    return list(some(key[~big], fp[~big])) if (~big).any() else [], fp[big]


def _whole_variants(fps: DataFrame, distance: int) -> DataFrame:
    """Links among the fingerprints of large buckets, by deleting ``distance`` bits of the whole."""
    full = (1 << BITS) - 1

    def run(batches):
        places = list(combinations(range(BITS), distance))
        masks = np.array([full & ~sum(1 << p for p in c) for c in places], dtype=np.uint64)
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for i in range(0, len(values), 64):
                part = values[i:i + 64]
                rest = (part[:, None] & masks[None, :]).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(len(masks), dtype=np.int32), len(part))),
                     pa.array(rest.view(np.int64)), pa.array(np.repeat(part, len(masks)).view(np.int64))],
                    ["wild", "rest", "fp"])

    keyed = fps.mapInArrow(run, "wild int, rest long, fp long")
    met = keyed.groupBy("wild", "rest").agg(F.collect_set("fp").alias("fps"))  # at most 2 ** distance of them
    met = met.where(F.size("fps") > 1).withColumn("a", F.array_min("fps"))
    return met.select("a", F.explode("fps").alias("b")).where("a != b").distinct()


def _classified(fps: DataFrame, distance: int, bucket: int) -> DataFrame:
    """(row, id, fp, root, component_id) for ``fps`` (row, id, fp); rows of one root are a class."""
    spark = fps.sparkSession
    fps = stage(fps, "fingerprints")
    distinct = stage(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    keyed = _variants(distinct.select("fp"), distance)
    n = partitions(spark, distinct.count() * BITS, PER_TASK)
    found = stage(keyed.repartition(n, "key").sortWithinPartitions("key").mapInArrow(
        _bucket_links(distance, bucket), "a long, b long, large boolean"), "bucket-links")
    links = found.where("not large").select("a", "b").distinct()
    large = found.where("large").select(F.col("a").alias("fp")).distinct()
    if large.head(1):
        links = links.unionByName(_whole_variants(large.repartition(n, "fp"), distance))
    roots = components(links)
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(rooted.join(classes, "root").select("fp", "root", "component_id"), "fingerprint-classes")
    return fps.join(named, "fp")


def near_classes(docs: DataFrame, width: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text",
                 bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Words are maximal runs of characters outside [\\x20\\x09-\\x0D], A-Z lower-cased. Fewer
    words than a shingle has are one shingle; no words, or a null text, give fingerprint
    zero, which links like any other. component_id is the smallest id reachable over
    fingerprints at ``distance`` or fewer differing bits; null ids don't count for it. Rows
    that repeat an id keep their own fingerprints. Other columns are not read.
    """
    return _classified(fingerprints(docs, width, doc_id, text), distance, bucket).select(
        F.col("id").alias(doc_id), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near(docs: DataFrame, width: int = 3, distance: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, with all its columns: the one with the smallest id, and the first of these.

    Rows are told apart by a number that is written with them once. A row without an id stays only where
    no other of its class has one.
    """
    table, row = numbered(docs, "near-rows")
    classes = _classified(fingerprints(table, width, doc_id, text, row), distance, BUCKET)
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row"))["row"].alias(row))
    return only(table, row, first, "kept-near")

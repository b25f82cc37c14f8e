"""Phrase collocation mining: Apriori levels counted by double-array tries.

Texts are turned once into shards: the words of a few documents as integers, with zeros
where a piece ends, and the shard's own vocabulary. Words are counted over all shards
and frequent ones numbered; a shard then carries the numbers of its frequent words.

Phrases of k words are found level by level. A candidate is a phrase that occurs, whose
shorter parts are frequent, and whose hash falls in a bucket that holds enough
occurrences of any phrases: each test can only pass too much, so no frequent phrase is
lost. A task sums the occurrences of the candidates in its shards, and a candidate goes with
its sum to the task of its part, as compressed columns. There all occurrences of a phrase
meet: buckets of the part alone, more of them than rows, drop most of what isn't frequent,
and the rest is dealt to tries of bounded size. numpy moves the states of all rows through a
trie together, a digit of a word's code at a time, and the accepting states are counted by
bincount. So the shards are read twice a level, however many candidates and tries there are.

What is sent to all tasks has a fixed bound: two bit maps of ``BUCKETS`` bits.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyguard.llm.common import stage

SHARD = 1 << 20    # words after which a task closes a shard
TRIE = 1 << 16     # rows counted by one trie, on average; about 70 MB while it is built
BUCKETS = 1 << 25  # hashed counts that tell which phrases can't be frequent: a byte each in a task, a bit each when sent
CHUNK = 1 << 20    # buckets in a row, a multiple of 8
WIDE = 24          # children from which a trie node has a span of its own
HELD = 1 << 18     # phrases that a task gathers before it passes them on
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _BREAKS, b"abcdefghijklmnopqrstuvwxyz" + b"." * len(_BREAKS))


def _planes(ids: np.ndarray) -> bytes:
    """32-bit integers, byte plane by byte plane, compressed."""
    return zstandard.compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _from_planes(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def _packed(words: list[np.ndarray]) -> bytes:
    """Rows of numbers in ascending order, as differences of the first column and byte planes of all, compressed."""
    columns = np.stack([np.diff(words[0], prepend=0), *words[1:]]).astype("<i8")
    return zstandard.compress(columns.view(np.uint8).reshape(len(words), -1, 8).transpose(0, 2, 1).tobytes(), 1)


def _unpacked(blob: bytes, k: int) -> list[np.ndarray]:
    first, *others = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(k, 8, -1).transpose(0, 2, 1).copy().view("<i8")[..., 0]
    return [np.cumsum(first), *others]


def _runs(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ascending order of rows of numbers, and which of them in that order differ from the one before."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([(c := column[order])[1:] != c[:-1] for column in columns])
    return order, new


def _distinct(words: list[np.ndarray], part: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray | None]:
    """Rows of numbers (of a part) without repeats, (parts and) rows in ascending order."""
    columns = words if part is None else [part, *words]
    order, new = _runs(columns)
    columns = [c[order[new]] for c in columns]
    return (columns, None) if part is None else (columns[1:], columns[0])


def _summed(columns: list[np.ndarray], times: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows of numbers without repeats in ascending order, and the sums of their times."""
    order, new = _runs(columns)
    return [c[order[new]] for c in columns], np.add.reduceat(times[order], np.flatnonzero(new))


class _Open:
    """The shard of one language that a task is filling."""

    def __init__(self):
        self.vocabulary = defaultdict(count().__next__)
        self.vocabulary[b"."]  # 0: a piece ends here
        self.tokens = []

    def add(self, texts: list[str]) -> int:
        raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_FOLD).replace(b".", b" . ")
        ids = np.fromiter(map(self.vocabulary.__getitem__, raw.split()), np.int64)  # spaces and tabs are all that is left to split at
        self.tokens.append(np.append(ids, 0))
        return len(ids)

    def close(self) -> dict:
        """Words by falling count: the commonest have the smallest numbers, which compress best."""
        tokens = np.concatenate(self.tokens)
        words = list(self.vocabulary)
        counts = np.bincount(tokens, minlength=len(words))
        order = np.argsort(-counts[1:], kind="stable") + 1
        order = order[counts[order] > 0]
        place = np.zeros(len(words), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        return {"tokens": _planes(place[tokens]), "words": [words[i].decode("utf-8", "surrogatepass") for i in order.tolist()],
                "counts": counts[order].tolist()}


def shards(docs: DataFrame, lang: str, text: str, size: int) -> DataFrame:
    """(shard, lang, tokens, words, counts): texts as places in the shard's own list of words, from 1, and 0 between pieces."""
    kind = pa.schema([("lang", pa.string()), ("tokens", pa.binary()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def run(batches):
        held, total = defaultdict(_Open), 0
        for batch in batches:
            by = defaultdict(list)
            for of, said in zip(batch.column("lang").to_pylist(), batch.column("said").to_pylist()):
                by[of].append(said)
            for of, texts in by.items():
                for some in slices(texts):
                    total += held[of].add(some)
                    if total >= size:
                        yield from closed(held)
                        held, total = defaultdict(_Open), 0
        yield from closed(held)

    def slices(texts):
        """Texts of about a million characters at a time: their words are objects for a moment."""
        some, chars = [], 0
        for t in texts:
            some.append(t)
            chars += len(t)
            if chars >= 1 << 20:
                yield some
                some, chars = [], 0
        if some:
            yield some

    def closed(held):
        for of, shard in held.items():
            yield pa.RecordBatch.from_pylist([{"lang": of} | shard.close()], schema=kind)

    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("said"))
    made = read.where("said is not null").mapInArrow(run, "lang string, tokens binary, words array<string>, counts array<long>")
    return stage(made.withColumn("shard", F.monotonically_increasing_id()), "shards")


def _numbered(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` with an ``id`` from 1, without gaps: places in a task behind those of the tasks before it."""
    placed = stage(rows.withColumns({"task": F.spark_partition_id(),
                                     "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), label)
    before = placed.groupBy("task").agg(F.count(F.lit(1)).alias("n")).withColumn(  # a row for each task
        "before", F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)))
    return stage(placed.join(before.select("task", F.coalesce("before", F.lit(0)).alias("before")), "task").withColumn(
        "id", F.col("before") + F.col("place") + 1).drop("task", "place", "before"), f"{label}-numbered")


def _with_numbers(made: DataFrame, words: DataFrame) -> DataFrame:
    """(shard, tokens, places, ids): which of a shard's words are frequent, and their numbers."""
    own = made.select("shard", "lang", F.posexplode("words").alias("at", "word")).join(
        words.select("lang", "word", "id"), ["lang", "word"]).select(F.col("shard").alias("of"), (F.col("at") + 1).alias("place"), "id")

    def run(known: pa.Table, shard: pa.Table) -> pa.Table:
        place, ids = known.column("place").to_numpy(), known.column("id").to_numpy()
        order, n = np.argsort(place), min(1, len(place))  # without frequent words there is nothing to count
        return pa.table({"shard": shard.column("shard")[:n], "tokens": shard.column("tokens")[:n],
                         "places": pa.array([place[order].astype("<i8").tobytes()] * n, pa.binary()),
                         "ids": pa.array([ids[order].astype("<i8").tobytes()] * n, pa.binary())})

    met = own.groupBy("of").cogroup(made.select("shard", "tokens").groupBy("shard"))
    return stage(met.applyInArrow(run, "shard long, tokens binary, places binary, ids binary"), "numbered-shards")


def _opened(batch):
    """(places of the words, number of each place or 0) of each shard."""
    for tokens, places, ids in zip(*(batch.column(c).to_pylist() for c in ("tokens", "places", "ids"))):
        tokens = _from_planes(tokens)
        numbers = np.zeros(int(tokens.max(initial=0)) + 1, np.int64)
        numbers[np.frombuffer(places, "<i8")] = np.frombuffer(ids, "<i8")
        yield tokens, numbers


def _bucket(words: list[np.ndarray], buckets: int) -> np.ndarray:
    """The bucket of each phrase, from the numbers of its words."""
    h = np.zeros(len(words[0]), np.uint64)
    for w in words:
        h = (h ^ w.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(buckets)).astype(np.int64)


def _passes(bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether each bucket's bit is set."""
    return (bits[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1).astype(bool)


def _eligible(tokens, numbers, k: int, shorter, buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places where a phrase of k words starts whose parts may all be frequent, and the numbers of its words."""
    words = numbers[tokens]
    n = max(0, len(words) - k + 1)
    good = np.ones(n, bool)
    for j in range(k):
        good &= words[j:j + n] > 0
    at = np.flatnonzero(good)
    if shorter is not None and len(at):
        for j in (0, 1):
            passed = _passes(shorter, _bucket([words[at + j + i] for i in range(k - 1)], buckets))
            at = at[passed]
    return at, [words[at + j] for j in range(k)]


def _bits(rows: DataFrame, buckets_of, least: int, buckets: int, chunk: int) -> np.ndarray:
    """A bit for each bucket: whether ``buckets_of`` the rows' batches named it ``least`` times or more."""
    small = np.uint8 if least < 128 else np.int64  # counts stop at least, so two of them fit

    def count_task(batches):
        total = np.zeros(buckets, small)
        for batch in batches:
            for found, times in buckets_of(batch):
                named, n = np.unique(found, return_counts=True)
                total[named] = np.minimum(total[named] + np.minimum(n * times, least), least)
        for c in range(0, buckets, chunk):
            part = total[c:c + chunk]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([zstandard.compress(part.tobytes(), 1)], pa.binary())],
                                                 ["chunk", "counts"])

    def sum_task(batches):
        total = {}
        for batch in batches:
            for c, blob in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                part = np.frombuffer(zstandard.decompress(blob), small)
                total[c] = np.minimum(total[c] + part, least) if c in total else part
        for c, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int64()), pa.array([np.packbits(part >= least).tobytes()], pa.binary())],
                                             ["chunk", "bits"])

    summed = rows.mapInArrow(count_task, "chunk long, counts binary").repartition("chunk").mapInArrow(sum_task, "chunk long, bits binary")
    out = np.zeros(-(-buckets // 8), np.uint8)
    for c, bits in summed.collect():  # a row for each chunk
        out[c // 8:c // 8 + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _candidates(numbered: DataFrame, k: int, shorter, least: int, buckets: int, chunk: int, parts: int) -> DataFrame:
    """(part, phrases): (w0, ..., w{k-1}, times) of all phrases that may be frequent, a row for each time a task passes on a part."""
    spark = numbered.sparkSession
    shorter = None if shorter is None else spark.sparkContext.broadcast(shorter)

    def buckets_of(batch):
        for tokens, numbers in _opened(batch):
            at, words = _eligible(tokens, numbers, k, shorter and shorter.value, buckets)
            yield _bucket(words, buckets), 1

    full = spark.sparkContext.broadcast(_bits(numbered, buckets_of, least, buckets, chunk))

    def observed(batches):
        held, size = [], 0
        for batch in batches:
            for tokens, numbers in _opened(batch):
                at, words = _eligible(tokens, numbers, k, shorter and shorter.value, buckets)
                passed = _passes(full.value, _bucket(words, buckets))
                at, words = at[passed], [w[passed] for w in words]
                key = tokens[at]
                for j in range(1, k):  # places are at most the shard's words, so two of them fit 64 bits
                    key = (key if j == 1 else np.unique(key, return_inverse=True)[1]) * np.int64(len(numbers)) + tokens[at + j]
                _, first, times = np.unique(key, return_index=True, return_counts=True)
                held.append([*(w[first] for w in words), times])
                size += len(first)
                if size >= HELD:
                    yield dealt(held)
                    held, size = [], 0
        if size:
            yield dealt(held)

    def dealt(held):
        *words, times = [np.concatenate(c) for c in zip(*held)]
        (part, *words), times = _summed([_bucket(words, parts), *words], times)
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        blobs = [_packed([c[a:b] for c in (*words, times)]) for a, b in zip(starts, [*starts[1:], len(part)])]
        return pa.RecordBatch.from_arrays([pa.array(part[starts]), pa.array(blobs, pa.binary())], ["part", "phrases"])

    found = stage(numbered.mapInArrow(observed, "part long, phrases binary"), f"candidates-{k}")
    for sent in (full, shorter):
        if sent is not None:
            sent.destroy()
    return found


class DoubleArray:
    """A trie of equally long rows of digits under 256, in two arrays.

    The child of state s by digit d is base[s] + d if check of that place is s. State 0 is the root.
    """

    def __init__(self, base: np.ndarray, check: np.ndarray):
        self.base, self.check = base, check

    @staticmethod
    def build(digits: np.ndarray) -> "DoubleArray":
        """``digits``: distinct rows in ascending order."""
        n, depth = digits.shape
        new = np.zeros((n, depth + 1), bool)
        new[:1] = True
        new[1:, 1:] = np.logical_or.accumulate(digits[1:] != digits[:-1], axis=1)
        node = np.cumsum(new, axis=0) - 1 + np.concatenate(([0], np.cumsum(new.sum(axis=0))))[:-1]  # numbered depth by depth
        row, level = np.nonzero(new[:, 1:].T)[::-1]
        parent, label = node[row, level], digits[row, level].astype(np.int64)  # of the nodes 1, 2, ... in their order
        children = np.bincount(parent, minlength=len(parent) + 1)
        base_of = DoubleArray._placed(children, np.cumsum(children) - children, label)  # children stand in their parents' order
        state = np.concatenate(([0], base_of[parent] + label))
        base = np.zeros(int(state.max(initial=0)) + 257, np.int32)
        check = np.full(len(base), -1, np.int32)
        base[state[children > 0]] = base_of[children > 0]
        check[state[1:]] = state[parent]
        return DoubleArray(base, check)

    @staticmethod
    def _placed(children, starts, labels) -> np.ndarray:
        """A base for every node with children, so that no two children share a place. Place 0 is the root's."""
        base = np.zeros(len(children), np.int64)
        wide = np.flatnonzero(children > WIDE)
        base[wide] = 1 + 256 * np.arange(len(wide))
        size = 1 + 256 * len(wide) + 2 * int(children[children <= WIDE].sum()) + 1024
        taken = np.zeros(size, bool)
        taken[0] = True
        of = np.repeat(np.arange(len(children)), children)
        taken[(base[of] + labels)[children[of] > WIDE]] = True
        owner, rng = np.zeros(size, np.int64), np.random.default_rng(1)
        for c in range(WIDE, 1, -1):
            left = np.flatnonzero(children == c)
            label, tries = labels[starts[left][:, None] + np.arange(c)], 0
            while len(left):
                tries += 1
                if tries % 32 == 0:  # too full for so many children: more room
                    taken, owner = (np.concatenate([x, np.zeros(2 * c * len(left) + 1024, x.dtype)]) for x in (taken, owner))
                at = rng.integers(1, len(taken) - 256, len(left))
                slots = at[:, None] + label
                fits = np.flatnonzero(~taken[slots].any(axis=1))
                owner[slots[fits]] = left[fits][:, None]
                fits = fits[(owner[slots[fits]] == left[fits][:, None]).all(axis=1)]
                taken[slots[fits]] = True
                base[left[fits]] = at[fits]
                rest = np.ones(len(left), bool)
                rest[fits] = False
                left, label = left[rest], label[rest]
        single = np.flatnonzero(children == 1)  # any free place will do
        free = np.flatnonzero(~taken[256:]) + 256
        free = np.concatenate([free, np.arange(len(taken), len(taken) + max(0, len(single) - len(free)))])[:len(single)]
        base[single] = free - labels[starts[single]]
        return base

    def step(self, states: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        to = self.base[states] + digits
        return np.where(self.check[to] == states, to, 0)

    def up(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states before, and the digits that led from them."""
        before = self.check[states]
        return before, states - self.base[before]


def _width(words: int) -> int:
    """Digits of a word's code."""
    return max(1, (max(words - 1, 1).bit_length() + 7) // 8)


def _digit(codes: np.ndarray, j: int, width: int) -> np.ndarray:
    return codes >> 8 * (width - 1 - j) & 255


def _counted(words: list[np.ndarray], times: np.ndarray, least: int) -> list[np.ndarray]:
    """[w0, ..., a]: the phrases among the rows that occur ``least`` times or more, counted by a trie of them all."""
    ids, codes = np.unique(np.stack(words), return_inverse=True)  # codes of words are their places in ids
    codes, width = codes.reshape(len(words), -1), _width(len(ids))
    trie = DoubleArray.build(np.stack([_digit(c, d, width) for c in _distinct(list(codes))[0] for d in range(width)], axis=1))
    states = np.zeros(len(times), np.int64)
    for code in codes:
        for d in range(width):
            states = trie.step(states, _digit(code, d, width))
    total = np.bincount(states, times).astype(np.int64)  # sums below 2^53 are exact
    at = np.flatnonzero((total >= least) & (total > 0))
    found, states = [total[at]], at
    for _ in words:
        code = np.zeros(len(at), np.int64)
        for d in range(width):
            states, digit = trie.up(states)
            code |= digit.astype(np.int64) << 8 * d
        found.insert(0, ids[code])
    return found


def _counted_part(words: list[np.ndarray], times: np.ndarray, least: int, parts: int, size: int):
    """[w0, ..., a] of the frequent phrases of a part, from some of its rows at a time, ``size`` on average."""
    cells = 2 * len(times)
    cell = _bucket(words, parts * cells) // parts  # of the hash, the part is what is left over
    enough = (np.bincount(cell, times) >= least)[cell]
    words, times, cell = [w[enough] for w in words], times[enough], cell[enough]
    tries = max(1, -(-len(times) // size))
    of = cell % tries  # all rows of a phrase have one cell
    order = np.argsort(of, kind="stable")
    for rows in np.split(order, np.searchsorted(of[order], np.arange(1, tries))):
        if len(rows):
            yield _counted([w[rows] for w in words], times[rows], least)


def frequent_phrases(numbered: DataFrame, k: int, shorter, least: int, trie_size: int, buckets: int, chunk: int) -> DataFrame:
    """(w0, ..., a) of the phrases of k words that occur ``least`` times or more."""
    parts = int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = [*(f"w{j}" for j in range(k)), "a"]

    def count_parts(batches):
        held = defaultdict(list)
        for batch in batches:
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("phrases").to_pylist()):
                held[part].append(blob)
        for part in list(held):
            *words, times = [np.concatenate(c) for c in zip(*(_unpacked(blob, k + 1) for blob in held.pop(part)))]
            for found in _counted_part(words, times, least, parts, trie_size):
                for i in range(0, len(found[0]), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 100_000]) for c in found], columns)

    candidates = _candidates(numbered, k, shorter, least, buckets, chunk, parts)
    return stage(candidates.repartition("part").mapInArrow(count_parts, ", ".join(f"{c} long" for c in columns)), f"phrases-{k}")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), in decimals of 38 digits."""
    big = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * big(a) * big(a), big(left) * big(right))


def _leading(rows: DataFrame, top: int, *within: Column) -> DataFrame:
    """The ``top`` rows of each language (and of ``within``) by score and a, with all that tie with the last of them."""
    order = Window.partitionBy("lang", *within).orderBy(F.col("score").desc(), F.col("a").desc())
    return rows.withColumn("place", F.rank().over(order)).where(F.col("place") <= top).drop("place")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000, lang: str = "lang",
                 text: str = "text", shard: int = SHARD, trie: int = TRIE, buckets: int = BUCKETS, chunk: int = CHUNK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A-Z are lower-cased; texts are cut into pieces at [.,;:!?\\x0A-\\x0D] and these into words at
    spaces and tabs. All counts are of one language (null: ``und``): n of all words, a of the phrase's
    occurrences inside pieces, overlaps included. Phrases of 2 to ``longest`` words with a >= ``least``
    are candidates. Of the cuts of a candidate into two parts that occur l and r times, the one with the
    lowest floor(1000000 a a / (l r)) counts, the shortest left part of equals. A candidate inside a longer
    one that occurs in at least ``share`` per cent of its places is dropped. Phrases are ranked by score
    and a, descending, then by their bytes. Null and empty texts hold nothing; every row counts, repeated
    ones too; other columns are not read.
    """
    made = shards(docs, lang, text, shard)
    vocabulary = made.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("v")).groupBy(
        "lang", F.col("v.words").alias("word")).agg(F.sum("v.counts").alias("a"))
    sizes = stage(made.select("lang", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n")).groupBy(
        "lang").agg(F.sum("n").alias("n")), "words-of-languages")
    words = _numbered(vocabulary.where(F.col("a") >= least), "frequent-words")
    numbered = _with_numbers(made, words)
    levels, shorter = {1: words.select(F.col("id").alias("w0"), "a")}, None
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for k in range(2, longest + 1):
        levels[k] = frequent_phrases(numbered, k, shorter, least, trie, buckets, chunk)
        if k < longest:
            named = lambda batch, k=k: [(_bucket([batch.column(f"w{j}").to_numpy() for j in range(k)], buckets), least)]
            shorter = _bits(levels[k], named, least, buckets, chunk)

    ranked = []
    for k in range(2, longest + 1):
        columns = [f"w{j}" for j in range(k)]
        of, cuts = levels[k], []
        for j in range(1, k):
            left, right = columns[:j], columns[j:]
            known = levels[j] if j > 1 else words.select(F.col("id").alias("w0"), "a", "lang")
            of = of.join(known.select(*left, F.col("a").alias(f"l{j}"), *(["lang"] if j == 1 else [])), left)
            of = of.join(levels[k - j].select(*[F.col(f"w{i}").alias(c) for i, c in enumerate(right)], F.col("a").alias(f"r{j}")), right)
            cuts.append(F.struct(_score(F.col("a"), F.col(f"l{j}"), F.col(f"r{j}")).alias("score"), F.lit(j).alias("cut"),
                                 F.col(f"l{j}").alias("l"), F.col(f"r{j}").alias("r")))
        of = of.withColumn("best", F.least(*cuts) if len(cuts) > 1 else cuts[0]).select("lang", *columns, "a", "best.l", "best.r", "best.score")
        around = [levels[m].select(*[F.col(f"w{i + j}").alias(c) for j, c in enumerate(columns)], F.col("a").alias("most"))
                  for m in range(k + 1, longest + 1) for i in range(m - k + 1)]
        if around:
            inside = reduce(DataFrame.unionByName, around).groupBy(*columns).agg(F.max("most").alias("most"))
            of = of.join(inside, columns, "left").where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("a"))).drop("most")
        of = _leading(_leading(of, top, F.pmod(F.xxhash64(*columns), F.lit(salts))), top)  # no task sorts a whole language, few phrases get their words
        for j, c in enumerate(columns):
            of = of.join(words.select(F.col("id").alias(c), F.col("word").alias(f"s{j}")), c)
        ranked.append(of.select("lang", F.concat_ws(" ", *[f"s{j}" for j in range(k)]).alias("phrase"), "a", "l", "r", "score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    best = reduce(DataFrame.unionByName, ranked).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

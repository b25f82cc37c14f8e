"""Near-duplicate lines over all documents: segment-partition edit join, DataFrame functions only.

Two lines are near when at most ``edits`` insertions, deletions and substitutions turn
one into the other. A line cut into edits + 1 segments keeps one of them unchanged in
every near line, shifted by a few places at most. So each distinct line is indexed under
its segments (with their number and the line's length), and probes the index of every
length up to ``edits`` shorter with the few substrings that can match there. Candidates are verified by a
banded bit-parallel edit distance: a column of 2 * edits + 1 cells is two bit vectors.

Repeats of a line are combined before the first shuffle. Where many lines share a
segment, they aren't paired at once: the shared segment is cut out and the rests are cut into
segments again, within the bucket, until buckets are small or the rests are a few
characters. Such rests aren't cut further: lines of one template that only differ there are
all paired, which grows with the square of their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyguard.llm.common import components, stage, whole_text

EDITS = 2
SHORTEST = 20  # characters; shorter lines are near at one edit
SHORT = 8      # characters; lines that are shorter still are near only when equal
BUCKET = 256   # lines that share a segment and are paired
CUT = "\x01"   # stands for a segment that was cut out
NO_ID = (1 << 63) - 1
LETTERS = " etaoinr"  # whose counts are compared before the lines are
SENT = 1 << 20  # ids of candidate lines, 8 MB, that are sent to all tasks
PLACE = 1 << 32
BLOCKS = 12    # of a line, looked for in the other one before their distance is computed


def _plans(edits: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(segment, shift, how much shorter the index line is) of a line's own segments, and of its probes.

    Of a near line, some segment has at most i edits to its left and edits - i to its right, i
    being its number: these bound by how much it can be shifted.
    """
    own = [(i, 0, 0) for i in range(edits + 1)]
    probes = [(i, shift, shorter) for shorter in range(edits + 1) for i in range(edits + 1)
              for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1)]
    return own, probes


def _parts(edits: int, plan: list[tuple[int, int, int]], chars: Column) -> list[tuple[int, int, Column, Column, Column]]:
    """(segment, shorter, length of the index line, start from 0, size) for each entry of a plan, of a line of ``chars``.

    A line of ``length`` characters has edits + 1 segments, the last ones a character longer if need be.
    """
    n, parts = edits + 1, []
    for i, shift, shorter in plan:
        length = chars - shorter
        long = length % n
        base = F.expr(f"(n - {shorter}) div {n}").cast("int")
        start = i * base + F.greatest(F.lit(0), F.lit(i - n) + long) + shift
        size = base + F.when(F.lit(i) >= F.lit(n) - long, 1).otherwise(0)
        parts.append((i, shorter, length, start, size))
    return parts


def _keyed(rows: DataFrame, edits: int, plan: list[tuple[int, int, int]], only: Column | None = None) -> DataFrame:
    """``rows`` (id, text, n, group, ...) once for each part of the plan that fits: with its ``key`` and its place ``p`` in the plan."""
    # n, the length, is a column, and the line is held in four bytes a character: counting characters reads
    # a whole line, for every part. The generator keeps its bytes from being made again for each of them.
    rows, keys = rows.select("*", F.explode(F.array(F.encode("text", "UTF-32"))).alias("wide")), []
    for i, shorter, length, start, size in _parts(edits, plan, F.col("n")):
        fits = (length > edits) & (start >= 0) & (start + size <= F.col("n"))
        if only is not None:
            fits = fits & (only == shorter)
        keys.append(F.when(fits, F.xxhash64(F.col("group"), F.lit(i), length, F.substr("wide", 4 * start + 1, 4 * size))))
    return rows.select("*", F.posexplode(F.array(*keys)).alias("p", "key")).where("key is not null").drop("wide")


def _pairs(index: DataFrame, probe: DataFrame, bucket: int, bottom: Column):
    """Candidate (a, b), and the keys of buckets with more index lines than ``bucket``.

    ``index`` is (key, id, ...), ``probe`` (key, id, shorter). Of a large bucket one line meets the
    probes, which marks its key and costs a row per probe.
    """
    from pyspark.sql import Window

    of_key = Window.partitionBy("key")
    counted = index.select("key", F.col("id").alias("a"), bottom.alias("bottom")).withColumns({
        "n": F.count(F.lit(1)).over(of_key), "least": F.min("a").over(of_key)})
    large = (F.col("n") > bucket) & ~F.col("bottom")
    kept = counted.where(~large | (F.col("a") == F.col("least"))).select("key", "a", large.alias("large"))
    met = kept.join(probe.select("key", F.col("id").alias("b"), "shorter"), "key")
    return stage(met.where("large or a != b and (shorter > 0 or a < b)").select(
        F.when(F.col("large"), F.lit(None)).otherwise(F.col("a")).alias("a"), "b",
        F.when(F.col("large"), F.col("key")).alias("key")).distinct(), "line-pairs")


def candidates(lines: DataFrame, edits: int, bucket: int) -> DataFrame:
    """Distinct (a, b): every near pair of ``lines`` (id, line, n), n being a line's length, and others that share a segment in place."""
    own, probes = _plans(edits)
    shorter = F.element_at(F.array(*[F.lit(d) for _, _, d in probes]), F.col("p") + 1)
    index = lines.select("id", F.col("line").alias("text"), "n", F.lit(0).cast("long").alias("group"))
    probe, found = index, None
    while True:
        indexed = _keyed(index, edits, own)
        probed = _keyed(probe, edits, probes, None if found is None else F.col("wanted"))
        pairs = _pairs(indexed.select("key", "id", "n"), probed.select("key", "id", shorter.alias("shorter")), bucket,
                       F.col("n") <= 3 * (edits + 1))
        cold = pairs.where("key is null").select("a", "b")
        found = cold if found is None else found.unionByName(cold)
        large = pairs.where("key is not null").select("key").distinct()
        if not large.head(1):
            return found.distinct()
        large = stage(large, "large-segments")

        def rest(rows, plan, *more):
            parts = _parts(edits, plan, F.col("n"))
            place = F.element_at(F.array(*[F.struct(start.alias("start"), size.alias("size")) for *_, start, size in parts]), F.col("p") + 1)
            rows = rows.join(large, "key", "left_semi").withColumn("s", place)
            without = F.concat(F.substr("text", F.lit(1), F.col("s.start")), F.lit(CUT),
                               F.substr("text", F.col("s.start") + F.col("s.size") + 1, F.col("n")))
            cut = rows.select("id", without.alias("text"), (F.col("n") - F.col("s.size") + 1).alias("n"), F.col("key").alias("group"), *more)
            return stage(cut.distinct(), "line-rests")

        index, probe = rest(indexed, own), rest(probed, probes, shorter.alias("wanted"))


def letter_counts(line: Column) -> Column:
    """How often each of ``LETTERS`` occurs, modulo 256, a byte each in one integer."""
    packed = F.lit(0).cast("long")
    for k, c in enumerate(LETTERS):
        count = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))  # ASCII: a byte each
        packed = packed.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(255)).cast("long"), 8 * k))
    return packed


def letters_apart(x: Column, y: Column) -> Column:
    """A lower bound of twice the edits between two lines, from their letter counts."""
    total = F.lit(0).cast("long")
    for k in range(len(LETTERS)):
        byte = [F.shiftrightunsigned(v, 8 * k).bitwiseAND(F.lit(255).cast("long")) for v in (x, y)]
        d = (byte[0] - byte[1]).bitwiseAND(F.lit(255).cast("long"))
        total = total + F.least(d, F.lit(256).cast("long") - d)
    return total


def parities(line: Column) -> Column:
    """Whether the characters of each of 64 classes occur an odd number of times in a line, a bit each in one integer.

    An edit takes a character from a class, adds one to a class, or both: lines at some edits differ in at most twice as many bits.
    """
    def bit(c: Column) -> Column:  # letters are told apart by their last five bits, digits and marks by the others
        code = F.ascii(c)
        return F.when(code < 64, code.bitwiseOR(F.lit(32))).otherwise(code.bitwiseAND(F.lit(31)))

    return F.aggregate(F.split(line, ""), F.lit(0).cast("long"), lambda s, c: s.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), bit(c))))


def _texts_of(pairs: DataFrame, lines: DataFrame, *more: str) -> DataFrame:
    """(id, line, ...) of the lines that occur in ``pairs`` (a, b). Up to ``SENT`` ids go to all tasks; beyond, the lines are shuffled by id."""
    ids = stage(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "candidate-ids")
    wanted = F.broadcast(ids) if ids.count() <= SENT else ids
    return stage(lines.select("id", "line", *more).join(wanted, "id", "left_semi"), "candidate-texts")


def _with_sides(pairs: DataFrame, table: DataFrame, **names: str) -> DataFrame:
    """``pairs`` (a, b) with columns of ``table`` for a and for b: ``names`` says how they are called on either side."""
    for i, side in enumerate("ab"):
        pairs = pairs.join(table.select(F.col("id").alias(side), *[F.col(c).alias(n.split()[i]) for c, n in names.items()]), side)
    return pairs


def blocks_met(x: Column, y: Column, edits: int) -> Column:
    """Whether all but ``edits`` of the blocks of ``x`` occur in ``y`` about where they stand in ``x``.

    It holds for all lines at up to so many edits: an edit changes one block at most and shifts others by one place.
    """
    met, n = F.lit(0), F.length(x)
    for i in range(BLOCKS):
        start = F.floor(n * i / BLOCKS).cast("int")
        size = F.floor(n * (i + 1) / BLOCKS).cast("int") - start
        around = F.substr(y, F.greatest(F.lit(1), start + 1 - edits), size + 2 * edits)
        met = met + F.contains(around, F.substr(x, start + 1, size)).cast("int")
    return met >= BLOCKS - edits


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Levenshtein distance of two character arrays if it is at most ``edits``, else a larger number.

    ``a`` has more than ``edits`` characters and the lengths differ by no more than ``edits``. Bit i of a
    column's vectors is the row i - edits off the diagonal; a step along ``b`` moves the
    band down one row. The distance is followed along the band's lowest diagonal to the
    last row, then along that row.
    """
    one = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)  # noqa: E731  x is computed once
    return one(F.struct(a.alias("a"), b.alias("b")), lambda p: _distance(p["a"], p["b"], edits, one))


def _distance(a: Column, b: Column, edits: int, one) -> Column:
    width = 2 * edits + 1
    mask, last = (1 << width) - 1, F.size(a)
    whole = lambda x: x.bitwiseAND(F.lit(mask).cast("long"))
    bit = lambda x, i: F.shiftrightunsigned(x, i).bitwiseAND(F.lit(1).cast("long")) if isinstance(i, int) else (
        F.call_function("shiftrightunsigned", x, i).bitwiseAND(F.lit(1).cast("long")))

    def step(s: Column, j: Column) -> Column:  # j counts the characters of b from 1
        char = F.get(b, j - 1)
        match = F.lit(0).cast("long")
        for i in range(width):
            same = F.coalesce(F.get(a, j - edits + i - 1) == char, F.lit(False))
            match = match + F.when(same, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
        return F.struct(s["up"].alias("up"), s["down"].alias("down"), s["d"].alias("d"), match.alias("m"), j.alias("j"))

    def move(s: Column) -> Column:
        up, down, m, j = s["up"], s["down"], s["m"], s["j"]
        diagonal = whole(whole(m.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(m).bitwiseOR(down))
        return F.struct(up.alias("up"), down.alias("down"), s["d"].alias("d"), diagonal.alias("g"), j.alias("j"))

    def settle(s: Column) -> Column:
        up, down, g, j = s["up"], s["down"], s["g"], s["j"]
        right = whole(down.bitwiseOR(F.bitwise_not(g.bitwiseOR(up))))
        left = g.bitwiseAND(up)
        row = last - j + edits
        along = bit(right, row) - bit(left, row)
        d = s["d"] + F.when(row >= 2 * edits, F.lit(1).cast("long") - bit(g, 2 * edits)).otherwise(along)
        shifted = F.shiftrightunsigned(g, 1)
        return F.struct(whole(left.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(right)))).alias("up"),
                        shifted.bitwiseAND(right).alias("down"), d.alias("d"))

    start = F.struct(F.lit(mask ^ ((1 << edits) - 1)).cast("long").alias("up"), F.lit(0).cast("long").alias("down"),
                     F.lit(edits).cast("long").alias("d"))
    end = F.aggregate(F.sequence(F.lit(1), F.size(b)), start,
                      lambda s, j: one(one(step(s, j), move), settle))
    return end["d"]


def near_lines(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST, bucket: int = BUCKET,
               doc_id: str = "doc_id", text: str = "text", short: int | None = None) -> DataFrame:
    """One row per distinct line: doc_id, line_no, copies, class_doc_id, class_line_no, links, and whether it is ``kept``.

    The shorter line of a pair says how many edits it may have: ``edits`` from ``shortest`` characters, one from
    ``short`` (more than ``edits``) to ``shortest``, none below; without ``short``, none below ``shortest``.

    A line stands for its first occurrence (smallest document id, then the line's place from
    0), and a class of lines linked over any number of steps for its first line, the one that is kept.
    ``links`` counts the different lines that are near. Lines of white space only are never
    compared. Documents without an id come last; rows that repeat an id are one document.
    """
    place = F.coalesce(F.col("doc"), F.lit(NO_ID)).cast("decimal(19,0)") * F.lit(PLACE).cast("decimal(11,0)") + F.col("pos").cast("decimal(11,0)")
    split = docs.select(F.col(doc_id).cast("long").alias("doc"), F.posexplode(F.split(whole_text(text), "\n")).alias("pos", "line"))
    occurrences = split.where(F.col("line").rlike("[^ \\t-\\r]"))
    lines = stage(occurrences.select("line", place.alias("place")).groupBy("line").agg(
        F.min("place").alias("place"), F.count(F.lit(1)).alias("copies")).withColumns(
            {"id": F.monotonically_increasing_id(), "n": F.length("line")}), "lines")
    long = lines.where(F.col("n") >= (shortest if short is None else short))
    pairs = candidates(long.where(F.col("n") >= shortest).select("id", "line", "n"), edits, bucket)
    allowed = F.lit(edits)
    if short is not None:  # a line a character longer than these may be near one of them
        few = candidates(long.where(F.col("n") <= shortest).select("id", "line", "n"), 1, bucket)
        pairs = pairs.unionByName(few).distinct()
        allowed = F.when(F.least(F.length("x"), F.length("y")) < shortest, 1).otherwise(edits)
    pairs = stage(pairs, "line-candidates")
    # most candidates differ by far more than the edits: counts of their letters tell, taken of these lines only
    texts = _texts_of(pairs, long)
    counts = stage(texts.select("id", letter_counts(F.col("line")).alias("c"), parities(F.col("line")).alias("o")), "letter-counts")
    close = _with_sides(pairs, counts, c="a_c b_c", o="a_o b_o").where(
        (F.bit_count(F.col("a_o").bitwiseXOR(F.col("b_o"))) <= 2 * edits) & (letters_apart(F.col("a_c"), F.col("b_c")) <= 2 * edits))
    close = stage(close.select("a", "b"), "close-lines")
    both = _with_sides(close, _texts_of(close, texts), line="x y")
    # meant to deal few bytes and much work to all tasks; the optimiser moves the distance below it, into the join
    both = both.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    near = blocks_met(F.col("x"), F.col("y"), edits) & (edit_distance(F.split("x", ""), F.split("y", ""), edits) <= allowed)
    links = stage(both.where(near).select("a", "b"), "line-links")
    degree = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).groupBy("id").agg(
        F.count(F.lit(1)).alias("links"))
    linked = lines.select("id", "place").join(components(links).withColumnRenamed("node", "id"), "id").join(degree, "id")
    first = linked.groupBy("root").agg(F.min("place").alias("class"))
    classed = stage(linked.join(first, "root").select("id", "class", "links"), "line-classes")
    out = lines.drop("line", "n").join(classed, "id", "left").withColumn("class", F.coalesce("class", "place"))
    number = lambda c: F.pmod(F.col(c), F.lit(PLACE).cast("decimal(11,0)"))
    owner = lambda c: F.nullif(F.expr(f"cast(({c} - pmod({c}, {PLACE}BD)) div {PLACE}BD as bigint)"), F.lit(NO_ID))
    return out.select(owner("place").alias("doc_id"), number("place").cast("int").alias("line_no"), "copies",
                      owner("class").alias("class_doc_id"), number("class").cast("int").alias("class_line_no"),
                      F.coalesce("links", F.lit(0)).alias("links"), (F.col("class") == F.col("place")).alias("kept"))


def line_dedup(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST, bucket: int = BUCKET,
               doc_id: str = "doc_id", text: str = "text", short: int | None = SHORT) -> DataFrame:
    """(doc_id, n_lines, n_kept, n_near, n_links, kept_lines) for every document id.

    ``n_lines`` counts the lines that aren't blank, ``kept_lines`` are the places of those that are
    the first of their class over all documents; n_near and n_links count, among the lines that
    occur here first, those with a near line and their links.
    """
    lines = near_lines(docs, edits, shortest, bucket, doc_id, text, short)
    own = lines.groupBy(F.col("doc_id").alias("owner")).agg(
        F.count(F.when(F.col("kept"), 1)).alias("n_kept"), F.count(F.when(F.col("links") > 0, 1)).alias("n_near"),
        F.sum("links").alias("n_links"),
        F.array_sort(F.collect_list(F.when(F.col("kept"), F.col("line_no")))).alias("kept_lines"))
    filled = F.regexp_count(whole_text(text), F.lit("[^ \\t-\\r][^\\n]*"))  # one match in each line that isn't blank
    all_docs = docs.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.sum(filled).alias("n_lines"))
    zero = F.lit(0).cast("long")
    return all_docs.join(own, all_docs["doc_id"].eqNullSafe(own["owner"]), "left").select(
        "doc_id", "n_lines", F.coalesce("n_kept", zero).alias("n_kept"), F.coalesce("n_near", zero).alias("n_near"),
        F.coalesce("n_links", zero).alias("n_links"),
        F.coalesce("kept_lines", F.array().cast("array<int>")).alias("kept_lines"))

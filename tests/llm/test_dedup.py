import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyguard.llm import exact_dedup, line_dedup, simhash
from tallyguard.llm.common import components, numbered, only
from tests.llm.data import CLASHING, awkward, frame, sentence

WHITE = re.compile("[\x20\x09-\x0D]")


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def classes(n, linked):
    """Root of each of n things by a plain look at all pairs."""
    parent = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(parent, i), find(parent, j)))
                parent[b] = a
    return [find(parent, i) for i in range(n)]


def test_components_match_a_walk(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    edges += [(500, i) for i in range(501, 560)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = sorted((find(parent, a), find(parent, b)))
        parent[y] = x
    assert got == {x: find(parent, x) for e in edges if e[0] != e[1] for x in e}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("size", [4096, 7])
def test_exact_groups_match_a_dictionary(docs, rows, size):
    groups = defaultdict(list)
    for i, t in rows:
        groups[WHITE.sub("", t or "")].append((i, t or ""))
    expected = []
    for norm, members in groups.items():
        keep = max(members, key=lambda m: (len(m[1]), m[0] is not None, -(m[0] or 0)))[0]
        for i, t in members:
            expected.append((i, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()))
    got = exact_dedup.exact_groups(docs, size=size).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(expected, key=key)
    assert sum(r.kept for r in got) == len(groups)


def test_exact_names_of_blocks_that_share_a_hash(spark, monkeypatch):
    """Names come from contents: with a hash of one bit they still tell all blocks apart."""
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.pmod(real(*c), F.lit(2)))
    texts = [(i, t) for i, t in enumerate(["abcdefgh", "abcdxfgh", "abcdefgh ", "zzzz", "abcd", "", "abcdefghi"])]
    got = exact_dedup.exact_groups(spark.createDataFrame(texts, "doc_id long, text string"), size=4).collect()
    assert sorted((r.doc_id, r.group_size) for r in got) == [(0, 2), (1, 1), (2, 2), (3, 1), (4, 1), (5, 1), (6, 1)]


def test_exact_stage_keeps_one_row_of_each_text(docs, rows):
    kept = exact_dedup.drop_exact(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    norm = lambda t: WHITE.sub("", t or "")
    assert sorted(norm(r.text) for r in got) == sorted({norm(t) for _, t in rows})
    assert {r.doc_id for r in got if r.text and norm(r.text) == norm(rows[0][1])} <= {i for i, _ in rows}
    assert all(r[c] == f"{c}!" for r in got for c in CLASHING)


def test_rows_that_repeat_an_id_are_told_apart(spark):
    """Different texts of one id all stay, equal ones don't, and a rerun decides alike."""
    docs = spark.createDataFrame([(1, "alpha", 5), (1, "beta", 6), (2, "gamma", 7), (2, "gamma", 8), (None, "delta", 9), (None, "delta", 9),
                                  (3, "be ta", 9)], "doc_id long, text string, row_no int").repartition(4).cache()
    for _ in range(2):
        got = exact_dedup.drop_exact(docs)
        assert got.columns == docs.columns
        assert sorted((r.text, r.doc_id) for r in got.collect()) == [("alpha", 1), ("be ta", 3), ("delta", None), ("gamma", 2)]
    words = "one two three four five six seven eight nine ten"
    near = spark.createDataFrame([(1, words), (1, "quite another text of other words"), (4, words), (None, words), (None, "x y z"), (None, "x y z")],
                                 "doc_id long, text string")
    assert sorted((r.text[:3], r.doc_id) for r in simhash.drop_near(near).collect()) == [("one", 1), ("qui", 1), ("x y", None)]


@pytest.mark.parametrize("dropped", [0, 1, 2, 40, 39, 20])
@pytest.mark.parametrize("listed", [None, 1, 0])
def test_only_the_numbered_rows_stay(spark, dropped, listed):
    """Few numbers, of the rows that stay or of those that go, are listed; with more of both, rows are shuffled."""
    docs = spark.createDataFrame([(i // 2 or None, f"text {i}") for i in range(40)], "doc_id long, text string").repartition(3)
    table, row = numbered(docs, "rows")
    kept = table.where(F.substring("text", 6, 2).cast("int") >= dropped).select(row)
    got = only(table, row, kept, "kept", **({} if listed is None else {"listed": listed}))
    assert got.columns == docs.columns
    assert sorted(r.text for r in got.collect()) == sorted(f"text {i}" for i in range(dropped, 40))


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact, simhash.drop_near])
def test_dedup_stages_move_no_texts_to_drop_a_few_rows(spark, drop):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the tables were large
    try:
        docs = spark.createDataFrame([(i, sentence(random.Random(i % 9), 30)) for i in range(30)], "doc_id long, text string")
        kept = drop(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
        assert kept.count() == 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plain_fingerprint(text, width):
    words = [w for w in re.split(b"[\x20\x09-\x0D]+", re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_near(got, rows, width, distance):
    fps = [plain_fingerprint(t, width) for _, t in rows]
    root = classes(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= distance)
    least = {}
    for r, (i, _) in zip(root, rows):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    expected = [(i, f"{fp:016x}", least.get(r)) for (i, _), fp, r in zip(rows, fps, root)]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([tuple(r) for r in got.collect()], key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("distance,bucket", [(2, 1024), (2, 1), (3, 1024), (0, 1024)])
def test_near_classes_match_all_pairs(docs, rows, distance, bucket):
    check_near(simhash.near_classes(docs, 3, distance, bucket=bucket), rows, 3, distance)


@pytest.mark.parametrize("bucket", [1024, 20, 2])
def test_dense_fingerprints_match_all_pairs(spark, monkeypatch, bucket):
    """Many fingerprints in few bits: small, middle and large buckets give the same classes."""
    rng = random.Random(2)
    fps = sorted({rng.getrandbits(64) & 0x0000_F000_0000_F01F | 0xABC for _ in range(400)} | {rng.getrandbits(64) for _ in range(200)})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    made = spark.createDataFrame(list(enumerate(signed)), "id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: made)
    got = {r.doc_id: r.component_id for r in simhash.near_classes(made, 3, 2, bucket=bucket).collect()}
    root = classes(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    assert got == dict(enumerate(root))


def test_near_stage_keeps_one_of_each_class(docs, rows):
    kept = simhash.drop_near(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    fps = [plain_fingerprint(t, 3) for _, t in rows]
    root = classes(len(rows), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    least = {}
    for r, (i, _) in zip(root, rows):
        least[r] = min(least.get(r, (True, 0)), (i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted(least.values())


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2, 4])
def test_banded_distance_matches_the_table(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = [rng.choice("abé") for _ in range(rng.randint(edits + 1, 14))]
        b = list(a)
        for _ in range(rng.randint(0, edits + 1)):
            kind, at = rng.randint(0, 2), rng.randrange(len(b) + 1)
            b[at:at + (kind != 1)] = [rng.choice("abé")] * (kind != 2)
        if abs(len(a) - len(b)) <= edits and len(b) > 0:
            pairs.append(("".join(a), "".join(b)))
    got = spark.createDataFrame(pairs, "a string, b string").select(
        "a", "b", line_dedup.edit_distance(F.split("a", ""), F.split("b", ""), edits).alias("d")).collect()
    for r in got:
        d = levenshtein(r.a, r.b)
        assert (r.d == d) if d <= edits else r.d > edits, r


def edited(rng, line, n):
    b = list(line)
    for _ in range(n):
        kind, at = rng.randint(0, 2), rng.randrange(len(b))
        b[at:at + (kind != 1)] = [rng.choice("abcdefgh")] * (kind != 2)
    return "".join(b)


def check_lines(spark, rows, edits, bucket):
    found = {}
    for i, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            if WHITE.sub("", line):
                found.setdefault(line, []).append((i is None, i, pos))
    lines = list(found)
    first = [min(found[x]) for x in lines]
    near = lambda a, b: (min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) <= edits and levenshtein(a, b) <= edits)
    linked = {(i, j) for i in range(len(lines)) for j in range(i) if near(lines[i], lines[j])}
    root = classes(len(lines), lambda i, j: (i, j) in linked)
    head = {}
    for r, f in zip(root, first):
        head[r] = min(head.get(r, f), f)
    degree = [sum(i in e for e in linked) for i in range(len(lines))]
    expected = sorted((f, len(found[x]), head[r], d, f == head[r]) for x, f, r, d in zip(lines, first, root, degree))
    got = line_dedup.near_lines(frame(spark, rows), edits, bucket=bucket).collect()
    assert sorted(((r.doc_id is None, r.doc_id, r.line_no), r.copies, (r.class_doc_id is None, r.class_doc_id, r.class_line_no),
                   r.links, r.kept) for r in got) == expected
    assert linked


@pytest.mark.parametrize("edits,bucket", [(2, 256), (2, 3), (1, 256)])
def test_near_lines_match_all_pairs(spark, edits, bucket):
    rng = random.Random(7)
    base = [sentence(rng, rng.randint(4, 9)) for _ in range(12)]
    lines = [edited(rng, b, rng.randint(0, 3)) for b in base for _ in range(9)] + base + ["short", "shors", "", "  ", "é" * 30, "é" * 31]
    lines += [f"posted by user {i:04d} on the first of may" for i in range(40)]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[5 * i:5 * i + 5])) for i in range(len(lines) // 5)] + [(None, "\n".join(base[:3])), (900, None)]
    rows.append(rows[0])
    check_lines(spark, rows, edits, bucket)


def test_short_lines_are_near_at_one_edit(spark):
    """Against all pairs, over the bounds at 8 and 20 characters."""
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (7, 8, 9, 12, 15, 18, 19, 20, 21, 30)]
    lines = sorted({x for b in base for x in [b, *(edited(rng, b, 1 + i % 2) for i in range(9))] if WHITE.sub("", x)})
    allowed = lambda n: 0 if n < 8 else 1 if n < 20 else 2
    expected = [sum(a != b and levenshtein(a, b) <= allowed(min(len(a), len(b))) for b in lines) for a in lines]
    got = line_dedup.line_dedup(spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_links for r in got} == dict(enumerate(expected))
    assert any(e for a, e in zip(lines, expected) if len(a) < 19)


def test_line_dedup_counts_per_document(spark, docs, rows):
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert set(got) == {i for i, _ in rows}
    for i in got:
        n = sum(bool(WHITE.sub("", x)) for j, t in rows if j == i for x in (t or "").split("\n"))
        assert got[i].n_lines == n and got[i].n_kept == len(got[i].kept_lines) <= n


def test_line_dedup_is_native(docs):
    """No Python on the executors."""
    plan = line_dedup.line_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert exact_dedup.exact_groups(none).collect() == []
    assert simhash.near_classes(none).collect() == []
    assert line_dedup.line_dedup(none).collect() == []
    assert exact_dedup.drop_exact(none).collect() == simhash.drop_near(none).collect() == []


def test_filters_drop_most_far_lines_and_no_near_ones(spark):
    """Lines of one template that differ in words of letters that are not the commonest ones were all compared."""
    rng = random.Random(8)
    pairs = []
    for _ in range(400):
        line = "".join(rng.choice("etaoin shrdlu 0123é漢") for _ in range(rng.randint(8, 90)))
        other = list(line)
        for _ in range(rng.randint(0, 2)):
            at, what = rng.randrange(len(other)), rng.choice(["", "m", "mm"])
            other[at] = other[at] + what[1:] if what == "mm" else what
        pairs.append((line, "".join(other), True))
    line = "the rest of the line is the same in all of them, and it is a long one: "
    for _ in range(400):
        word = lambda: "".join(rng.choice("bcdfghjklmpquvwxyz0123456789") for _ in range(5))
        i, j = rng.randrange(8, 30), rng.randrange(40, 60)
        pairs.append((line[:i] + word() + line[i:], line[:j] + word() + line[j:], False))
    x, y = F.col("x"), F.col("y")
    got = spark.createDataFrame(pairs, "x string, y string, near boolean").select(
        "near", (F.bit_count(line_dedup.parities(x).bitwiseXOR(line_dedup.parities(y))) <= 4).alias("even"),
        (line_dedup.letters_apart(line_dedup.letter_counts(x), line_dedup.letter_counts(y)) <= 4).alias("letters"),
        line_dedup.blocks_met(x, y, 2).alias("blocks")).collect()
    assert all(r.even and r.letters and r.blocks for r in got if r.near)
    assert all(r.letters for r in got if not r.near) and sum(r.even and r.blocks for r in got if not r.near) < 20
    blank = spark.createDataFrame([(1, "a\n \n\t\r\n b \x0b\n\n"), (2, None), (3, " \n"), (4, "x")], "doc_id int, text string")
    assert {r.doc_id: r.n_lines for r in line_dedup.line_dedup(blank).collect()} == {1: 2, 2: 0, 3: 0, 4: 1}

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyguard.llm import common, mixing, subword, toxicity
from tallyguard.llm.encoders import encoder
from tests.llm.data import CLASHING, awkward, frame, sentence

BAD = ["blastard", "vilescum", "dreckig"]


def labelled(spark, n=420, seed=8):
    """Documents, a third of them with bad words, some misspelt where they are held out."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.choice([4, 30, 200])).split()
        toxic = int(i % 3 == 0)
        for _ in range(6 * toxic):
            bad = rng.choice(BAD)
            if zlib.crc32(str(i).encode()) % 3 == 1:
                at = rng.randrange(2, len(bad) - 1)
                bad = bad[:at] + bad[at] + bad[at:]
            words.insert(rng.randrange(len(words) + 1), bad)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_grams_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "", "hello", "é" * 30, "x" * 500, "hello"]
    flat, sizes = subword.grams(words)
    ends = np.cumsum(sizes)
    for w, a, b in zip(words, ends - sizes, ends):
        alone, _ = subword.grams([w])
        assert (flat[a:b] == alone).all()
    assert ((flat >= 0) & (flat < subword.BUCKETS)).all()


def test_logits_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    model = subword.Model(rng.normal(size=(subword.BUCKETS, 2)).astype(np.float32), np.zeros(2), 4)
    texts = ["", "a", "a b c d e f g h i j k", "a a a a", sentence(random.Random(1), 500)]
    together = model.many(texts)
    for t, z in zip(texts, together):
        other = subword.Model(model.table, model.bias, 4)
        assert np.allclose(other.logits(t), z)
    assert [len(z) for z in together[:4]] == [1, 1, 5, 1]


@pytest.mark.parametrize("before", ["ab" * 30, "好" * 30, "好a" * 400, "éé-" * 9])
def test_an_insult_behind_a_long_run_is_read(before):
    """Only n-grams inside the insult have weight: they are met wherever the run holds it."""
    insult = "混蛋" if "好" in before else "blastard"
    found, _ = subword.grams([insult])
    plain, _ = subword.grams([before[:4]])
    table = np.zeros((subword.BUCKETS, 2), np.float32)
    table[np.setdiff1d(found, plain), 1] = 1
    model = subword.Model(table, np.zeros(2), 8)
    for text in (before + insult, before + insult + before, before + "-" + insult):
        assert model.logits(text)[:, 1].max() > 0.005 > model.logits(before)[:, 1].max()


def test_repeated_words_have_windows():
    """A late passage of words that all occurred before, and repeats, count."""
    rng = np.random.default_rng(2)
    model = subword.Model(rng.normal(size=(subword.BUCKETS, 2)).astype(np.float32), np.zeros(2), 4)
    words = "a bad b c d worse e f g h worst i".split()
    late = model.logits(" ".join([*words, "bad", "worse", "worst", "bad"]))
    assert np.allclose(late[-1], model.logits("bad worse worst bad")[0])
    bag = subword.Model(model.table, model.bias, 0)
    one, other = (bag.logits(w)[0] for w in ("x", "y"))
    assert np.allclose(bag.logits("x y x x")[0], (3 * one + other) / 4)


def test_pieces_cover_a_run():
    draw = random.Random(1)
    for letters, n in (("abcdefghijklmnop", 41), ("abcdefghijklmnop", 999), ("漢字仮名混文書読本", 14), ("é😀az漢ßñ語", 300), ("\ud800\udc01ab漢字", 90)):
        run = "".join(draw.choice(letters) for _ in range(n))
        raw, at = run.encode("utf-8", "surrogatepass"), 0
        for p in (x.encode("utf-8", "surrogatepass") for x in subword.pieces_of(run)):
            assert len(p) <= subword.LONGEST
            a = raw.find(p, max(0, at - subword.LONGEST))
            assert a == 0 or 0 <= a <= at - subword.LONG
            at = max(at, a + len(p))
        assert at == len(raw)
    assert subword.words_of("a " + "漢" * 13 + " b") == ["a", "漢" * 13, "b"]


def test_toxicity_on_held_out_documents(spark):
    rows, labels = labelled(spark)
    got = toxicity.toxicity(frame(spark, rows + [(None, None), (9999, "")]), label_frame(spark, labels), (200, 100)).collect()
    assert len(got) == len(rows) + 2
    truth = {i: t for i, _, t in labels}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    recall = sum(p for p, t in held if t) / sum(t for _, t in held)
    false = sum(p for p, t in held if not t) / sum(1 - t for _, t in held)
    assert recall >= 0.8 and false <= 0.05


def test_held_out_labels_are_never_learnt(spark):
    rows, labels = labelled(spark, 150)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    docs = frame(spark, rows)
    a, b = (toxicity.toxicity(docs, label_frame(spark, x)).collect() for x in (labels, flipped))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_toxicity_without_labels_or_documents(spark):
    none = label_frame(spark, [])
    docs = frame(spark, awkward(more=5))
    got = toxicity.toxicity(docs, none).collect()
    assert len(got) == docs.count() and {r.score for r in got} == {0.0}
    assert toxicity.toxicity(frame(spark, []), none).collect() == []
    assert toxicity.drop_toxic(docs, none).count() == docs.count()
    odd = label_frame(spark, [(None, None, 1), (0, None, None), (1, 1, 7), (2, 0, 0), (2, 0, 1)])
    assert len(toxicity.toxicity(docs, odd).collect()) == docs.count()


def test_toxic_stage_keeps_columns(spark):
    rows, labels = labelled(spark, 200)
    docs = frame(spark, rows)
    kept = toxicity.drop_toxic(docs, label_frame(spark, labels))
    assert kept.columns == docs.columns
    got = kept.collect()
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, label_frame(spark, labels)).collect()}
    assert {r.doc_id for r in got} == {i for i, p in scores.items() if not p}
    assert all(r[c] == f"{c}!" for r in got for c in CLASHING)


def members(spark, seed, n, k):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet(np.full(k, 0.3), n)
    t = rng.integers(0, 500, n)
    return spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p)], "_tokens long, _members array<double>"), t, p


@pytest.mark.parametrize("targets", [[0.5, 0.5], [0.95, 0.05], [0.2, 0.5, 0.3]])
def test_rates_reach_the_targets(spark, targets):
    table, t, p = members(spark, 3, 400, len(targets))
    start, steps = mixing.fit_rates(table, targets)
    r = np.full(len(t), start)
    for s in steps:
        r = np.maximum(0, r - p @ s)
    got = table.select(F.collect_list(mixing._rate(F.col("_members"), start, steps))).first()[0]
    assert np.allclose(sorted(got), sorted(r))
    reached = (t * r) @ p
    assert np.allclose(reached / t.sum(), targets, atol=2e-4) and (r >= 0).all()


def test_a_domain_kept_whole(spark):
    table, t, p = members(spark, 4, 300, 2)
    start, steps = mixing.fit_rates(table, [0.8, 0.2], whole=0)
    r = np.full(len(t), start)
    for s in steps:
        r = np.maximum(0, r - p @ s)
    mass = t @ p
    assert np.allclose((t * r) @ p, [mass[0], mass[0] / 4], rtol=2e-3)


def domain_rows(n=300, seed=9):
    rng = random.Random(seed)
    rows, domains = [], []
    for i in range(n):
        words = sentence(rng, rng.randint(5, 60)).split()
        junk = i % 4 == 0
        rows.append((i, " ".join(w + "%%%" for w in words) if junk else " ".join(words)))
        domains.append((i, "junk" if junk else "clean"))
    return rows, domains


def test_mix_draws_rows_by_their_rates(spark):
    rows, domains = domain_rows()
    docs = frame(spark, rows + [(None, None), (700, ""), rows[1]])
    known = spark.createDataFrame(domains[:200], "doc_id long, domain string")
    rated = mixing.rates(docs, known, {"clean": 0.9, "junk": 0.1}, whole="clean").collect()
    assert len(rated) == len(rows) + 3
    truth = dict(domains)
    right = [(r.members[0] > 0.5) == (truth[r.doc_id] == "clean") for r in rated if r.doc_id in truth]
    assert sum(right) / len(right) > 0.95
    mass = np.array([[r.tokens * r.rate * m for m in r.members] for r in rated]).sum(axis=0)
    assert abs(mass[0] / mass.sum() - 0.9) < 0.01
    assert all(abs(r.copies - r.rate) < 1 for r in rated)
    mixed = mixing.mix(docs, known, {"clean": 0.9, "junk": 0.1}, whole="clean")
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in rated)
    clean = {r.doc_id for r in mixed.select("doc_id").collect()} & {i for i, d in domains if d == "clean"}
    assert len(clean) > 0.95 * sum(d == "clean" for _, d in domains)


def test_mixing_counts_the_tokens_of_the_library(spark):
    """The targets are reached in real token ids, also where words are rich in them or a text has no spaces."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows, domains = domain_rows()
    rows += [(1000, "漢字かな" * 200), (1001, "Zm9vYmFy" * 100), (1002, ""), (1003, None)]
    known = spark.createDataFrame(domains[:200], "doc_id long, domain string")
    rated = mixing.rates(frame(spark, rows), known, {"clean": 0.9, "junk": 0.1}, whole="clean").collect()
    n = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    assert {r.doc_id: r.tokens for r in rated} == n
    mass = np.array([[n[r.doc_id] * r.rate * m for m in r.members] for r in rated]).sum(axis=0)
    assert np.allclose(mass / mass.sum(), [0.9, 0.1], atol=2e-4)


def test_chunks_are_measured_once_and_long_ones_are_not_kept():
    path = public_tokenizers.path(mixing.VOCABULARY)
    rng = np.random.default_rng(0)
    model = subword.Model(rng.normal(size=(subword.BUCKETS, 2)).astype(np.float32), np.array([0.5, -0.5]), 0)
    texts = ["", " ", " a", "a  b", " x y", "x" * 300 + " y " + "\u65e5\u672c\u8a9e" * 50, "a\n\nb \n c", "one,\ntwo. three.\nfour", " \t ",
             "\u039f\u0394\u039f\u03a3 \u03a3\u0391\u03a3. b", "<|endoftext|> hi", "don't we'll  'tis ...,", "a b a b " * 400]
    measured = mixing._Measured(path, model)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    for _ in range(2):
        counts, logits = measured.many(texts)
        assert counts.tolist() == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]
        assert np.allclose(logits, np.concatenate(model.many(texts)), atol=1e-6)
    assert max(len(c if isinstance(c, str) else c[0]) for c in measured.numbers) <= mixing.LENGTH
    assert sorted(measured.numbers.values()) == list(range(len(measured.numbers)))


def test_a_word_is_cut_into_ids_once_whatever_follows_it():
    path = public_tokenizers.path(mixing.VOCABULARY)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    measured, cut = mixing._Measured(path, None), []

    class Counted:
        def __init__(self, model):
            self.model = model

        def tokenize(self, piece):
            cut.append(piece)
            return self.model.tokenize(piece)

    measured.encoder.model = Counted(measured.encoder.model)
    texts = ["so wordly wordly, wordly. wordly!! wordly$$$ one\nwordly x wordly.\nwordly?", "wordly \u00e9t\u00e9'' \u00e9t\u00e9'll wordly's 'wordly' (wordly)",
             "\u00aawordly\u00ba### \u00fcber\u00df-- a_ b' c's d'' ... ,.;", "x\u00a0 \u00a0y \u2003 z w\u00a0", "\u3000a b", "a\t b", "a \tb"]
    counts, _ = measured.many(texts)
    assert counts.tolist() == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]
    cut.clear()
    measured.encoder.sizes.clear()
    assert measured.encoder.count("wordly", " ") == sum(measured.encoder.count(f"wordly{end}", " ") - measured.encoder.count(end, "")
                                                        for end in (",", ".", "!!", "$$$")) / 4
    assert cut.count(measured.encoder.letters[" "] + "wordly") == 1


def test_a_worker_keeps_one_large_cache():
    """Of the pipeline's stages, each would otherwise leave its own behind in every worker."""
    path = public_tokenizers.path(mixing.VOCABULARY)
    first = encoder(path)
    assert encoder(path) is first
    model = subword.Model(np.zeros((subword.BUCKETS, 2), np.float32), np.zeros(2), 0)
    model.many(["a"])
    assert len(common._KEPT) == 1 and encoder(path) is not first


def test_mixing_without_labels_or_documents(spark):
    known = spark.createDataFrame([], "doc_id long, domain string")
    targets = {"clean": 0.9, "junk": 0.1}
    docs = frame(spark, awkward(more=5))
    got = mixing.rates(docs, known, targets, whole="clean").collect()
    assert len(got) == docs.count() and all(r.rate >= 0 for r in got)
    assert mixing.rates(frame(spark, []), known, targets).collect() == mixing.mix(frame(spark, []), known, targets).collect() == []


def test_fewer_kept_chunks_change_no_count():
    path = public_tokenizers.path(mixing.VOCABULARY)
    plain = Tokenizer.from_file(path)
    rng = np.random.default_rng(3)
    model = subword.Model(rng.normal(size=(subword.BUCKETS, 2)).astype(np.float32), np.zeros(2), 0)
    few, many = mixing._Measured(path, model, 60), mixing._Measured(path, model)
    for _ in range(20):
        words = ["".join(rng.choice(list("abcdEé"), rng.integers(1, 9))) + str(rng.choice(["", ",", "!?", "\nx"])) for _ in range(80)]
        texts = [" ".join(words), "y" * 200 + " " + " ".join(words[:40]), "z" * 90]
        counts, logits = few.many(texts)
        assert counts.tolist() == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]
        assert np.allclose(logits, many.many(texts)[1])
        assert sorted(few.numbers.values()) == list(range(len(few.numbers)))
    assert len(few.numbers) < 60 + 200 < len(many.numbers)


def test_the_pipeline_keeps_fewer_chunks_from_task_to_task(spark, monkeypatch):
    asked, real = [], mixing.with_memberships
    monkeypatch.setattr(mixing, "with_memberships", lambda *a, **b: asked.append(b.get("chunks", mixing.CHUNKS)) or real(*a, **b))
    known = spark.createDataFrame([], "doc_id long, domain string")
    mixing.mix(frame(spark, awkward(more=5)), known, {"clean": 0.9, "junk": 0.1})
    assert asked == [mixing.FEWER] and mixing.FEWER < mixing.CHUNKS
    made = [common.kept(mixing._Measured, public_tokenizers.path(mixing.VOCABULARY), None, int(n)) for n in ("1000", "1000")]
    assert made[0] is made[1]

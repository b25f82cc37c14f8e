"""The registered queries of this subpackage, with the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyguard.llm import (chat, exact_dedup, lexical_search, line_dedup, minhash, mixing, packing, phrases,
                            simhash, token_counts, token_files, topk, toxicity)

TARGETS = {"clean": 0.95, "junk": 0.05}


def tokenizer(name: str) -> str:
    """Where a public vocabulary file is on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents: clean or junk by their quality."""
    return labels.select("doc_id", F.when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "junk").alias("domain"))


def op1_line_dedup(spark, sf_dir):
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op2_simhash(spark, sf_dir):
    return simhash.near_classes(table(spark, sf_dir, "documents"), width=3, distance=2)


def op3_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.read_back(chat.windows(turns.unionByName(more), tokenizer("byte_bpe_50k.json")))


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op6_topk(spark, sf_dir):
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op7_packing(spark, sf_dir):
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 2048, 0)


def op8_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), 1)


def op9_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op10_mixing(spark, sf_dir):
    rated = mixing.rates(table(spark, sf_dir, "documents"), quality_domains(table(spark, sf_dir, "labels")), TARGETS, whole="clean")
    return rated.select("doc_id", "tokens", *[F.col("members")[i].alias(f"p_{d}") for i, d in enumerate(TARGETS)], "rate", "copies")


def op11_lexical_search(spark, sf_dir):
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_minhash(spark, sf_dir):
    return minhash.near_documents(table(spark, sf_dir, "documents"), width=4, similarity=80)


def op13_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_line_dedup, op2_simhash, op3_chat_format, op4_toxicity, op5_exact_dedup, op6_topk, op7_packing, op8_token_files,
    op9_token_counts, op10_mixing, op11_lexical_search, op12_minhash, op13_phrases)}

WHITE = "[\\x20\\x09-\\x0D]"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

SQL: dict[str, str] = {
    "op5_exact_dedup": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '{WHITE}', '', 'g') AS norm
                   FROM documents),
        g AS (SELECT norm, count(*) AS group_size, arg_max(doc_id, (length(t), -doc_id)) AS keep_id FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)""",
    "op6_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                   FROM embeddings WHERE embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_lexical_search": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{TERM}') AS ws FROM documents),
        t AS (SELECT count(*) AS docs, CAST(sum(len(ws)) AS BIGINT) AS total FROM d WHERE len(ws) > 0),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({LOWER}, '{TERM}')) AS term FROM benchmark),
        c AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM d)
              WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM c, t GROUP BY term),
        s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
              FROM q JOIN c USING (term) JOIN w USING (term), t GROUP BY ALL),
        r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
              FROM s WHERE score > 0)
        SELECT * FROM r WHERE rank <= 10""",
    "op12_minhash": f"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, ws[i : i + 3] AS shingle FROM (
              SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 3))) AS i FROM d WHERE len(ws) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS met FROM s x JOIN s y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
        e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * met >= 80 * (x.n + y.n - met)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a) LEFT JOIN n USING (doc_id)""",
    "op13_phrases": f"""
        WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
        g AS (SELECT lang, ws[i : i + k - 1] AS ws, count(*) AS f FROM (
            SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i FROM p, (VALUES (1), (2), (3)) v(k)) GROUP BY ALL),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE len(ws) = 1 GROUP BY lang),
        c AS (SELECT * FROM g WHERE len(ws) > 1 AND f >= 10),
        s AS (SELECT c.lang, c.ws, c.f AS a, x.f AS l, y.f AS r, j,
                     CAST((1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
              FROM (SELECT *, unnest(generate_series(1, len(ws) - 1)) AS j FROM c) c
              JOIN g x ON x.lang = c.lang AND x.ws = c.ws[1 : j] JOIN g y ON y.lang = c.lang AND y.ws = c.ws[j + 1 :]),
        m AS (SELECT lang, ws, max(f) AS most FROM (SELECT lang, ws[1 : 2] AS ws, f FROM c WHERE len(ws) = 3
              UNION ALL SELECT lang, ws[2 : 3], f FROM c WHERE len(ws) = 3) GROUP BY lang, ws),
        b AS (SELECT lang, array_to_string(ws, ' ') AS phrase, a, l, r, score FROM s LEFT JOIN m USING (lang, ws)
              WHERE most IS NULL OR 100 * most < 50 * a
              QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, j) = 1),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
        SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000""",
}

"""Registered queries of the training-data operators: each applies one operator
with production parameters to its whole table."""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plexus.llm import codebooks, collocations, common, fingerprints, licenses, lmscore, mixing, mtree, neardup, packing, secrets, tokenfile, toxicity, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BACKOFF_ORDER = 3  # longest n-grams of the registered op6_stupid_backoff


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: id, start, tokens, CRC-32."""
    folder = common.shared_folder(spark, "token-files")
    return tokenfile.read_documents(tokenfile.write_token_files(table(spark, sf_dir, "documents"), TOKENIZER, folder))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), width=2).drop("cid")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of all documents: patterns and the randomness battery."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels that aren't held out."""
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_stupid_backoff(spark: SparkSession, sf_dir: str, order: int = 2) -> DataFrame:
    """Stupid-backoff scores of all documents under the counts of all others
    (registered with ``BACKOFF_ORDER``)."""
    return lmscore.backoff_scores(table(spark, sf_dir, "documents"), order)


def op7_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest inner products of every fiftieth vector with all others."""
    vectors = common.stored(mtree.integer_vectors(table(spark, sf_dir, "embeddings")), "integer-vectors")
    return mtree.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score FROM r WHERE k <= 5
"""


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents repeated to the target weights of their sources."""
    return mixing.replicate(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op10_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in dictionary-compressed archives, read back."""
    folder = common.shared_folder(spark, "archives")
    return warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"), folder)).drop("url")


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices, tags and expressions of all documents."""
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of each language, over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, unnest(pieces) AS piece FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
o AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
      FROM w, range(1, 6) t(k) WHERE len(ws) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS f FROM o GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT * FROM f WHERE f >= 100),
cuts AS (SELECT c.lang, c.phrase, c.k, c.f AS a, j, x.f AS l, y.f AS r, n,
                CAST((CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
         FROM c JOIN range(1, 5) t(j) ON j < c.k JOIN n ON n.lang = c.lang
         JOIN c x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:j], ' ')
         JOIN c y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1:], ' ')),
one AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS best FROM cuts),
kept AS (SELECT * FROM one WHERE best = 1 AND NOT EXISTS (
    SELECT 1 FROM c z WHERE z.lang = one.lang AND z.k > one.k AND 100 * z.f >= 100 * one.a AND contains(' ' || z.phrase || ' ', ' ' || one.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""


def op13_product_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors under codebooks fitted on all of them."""
    return codebooks.compressed(table(spark, sf_dir, "embeddings"))


def op13_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Plain Lloyd's rounds, unrolled: every part against every entry."""
    far = "xx - 2 * CAST(list_inner_product(p.x, b.x) AS BIGINT) + CAST(list_inner_product(b.x, b.x) AS BIGINT)"
    steps = [f"""
WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, len(embedding) // {parts} AS w,
                  list_transform(embedding, lambda x: floor({codebooks.SCALE} * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (SELECT r, k, e[k * w + 1:(k + 1) * w] AS x, CAST(list_inner_product(e[k * w + 1:(k + 1) * w], e[k * w + 1:(k + 1) * w]) AS BIGINT) AS xx
                   FROM v, range({parts}) t(k)),
b0 AS MATERIALIZED (SELECT k, r - 1 AS i, x FROM p WHERE r <= {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS MATERIALIZED (SELECT r, k, min({{'d': {far}, 'i': i}}) AS m FROM p JOIN b{n} b USING (k) GROUP BY r, k)")
        if n < rounds:
            steps.append(f"""
s{n} AS (SELECT k, m.i AS i, j, CAST(sum(x[j]) AS BIGINT) AS t, count(*) AS n FROM a{n} JOIN p USING (r, k), range(1, 1025) u(j) WHERE j <= len(x) GROUP BY ALL),
b{n + 1} AS MATERIALIZED (SELECT b.k, b.i, coalesce(y, b.x) AS x FROM b{n} b LEFT JOIN (
    SELECT k, i, list(CAST((t - ((t % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS y FROM s{n} GROUP BY k, i) USING (k, i))""")
    steps.append(f"""
c AS (SELECT r, string_agg(lower(printf('%02x', m.i)), '' ORDER BY k) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(CAST(z AS VARCHAR), ',' ORDER BY k, i, j)) AS codebooks_sha256
      FROM (SELECT k, i, unnest(range(1, len(x) + 1)) AS j, CAST(unnest(x) AS BIGINT) AS z FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN c USING (r), h""")
    return ",\n".join(steps).replace(",\n\nc AS", ",\nc AS")


def queries():
    found = {f.__name__: f for f in (
        op1_token_files, op2_near_duplicates, op3_order_minhash, op4_secret_scans, op5_toxicity, op6_stupid_backoff, op7_mtree_top_k,
        op8_source_mixing, op9_best_fit_packing, op10_warc_archives, op11_license_scans, op12_collocations,
        op13_product_codes)}
    return found | {"op6_stupid_backoff": partial(op6_stupid_backoff, order=BACKOFF_ORDER)}


def oracle_sql() -> dict[str, str]:
    return {"op7_mtree_top_k": OP7_SQL, "op12_collocations": OP12_SQL, "op13_product_codes": op13_sql()}

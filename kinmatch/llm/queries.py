"""The registered queries of the corpus operators and, where SQL can express them, their SQL twins."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmatch.llm import chat, clustering, divergence, exact_dedup, mixing, packing, quality, secrets, sentencepieces, simhash, token_counts, vector_search, warc
from kinmatch.llm.common import stage, table
from kinmatch.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.render(rows.unionByName(odd)))


ORACLES["op1_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *,
    length(regexp_replace(role, '\\|<s>|</s>|\[INST\]|\[/INST\]', '\0-', 'g')) AS role_chars,
    length(regexp_replace(text, '\\|<s>|</s>|\[INST\]|\[/INST\]', '\0-', 'g')) AS text_chars FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(role_chars + text_chars + length('<s>[INST] ') + length(' [/INST] ') + length('</s>'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@_query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"), words=3, threshold=2)
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


@_query
def op4_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = stage(vector_search.quantised(table(spark, sf_dir, "embeddings")), "quantised")
    return vector_search.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


ORACLES["op4_vector_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""


@_query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@_query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as domains: in the given tables a text says nothing about its source."""
    docs = table(spark, sf_dir, "documents")
    labelled = table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", F.col("lang").alias("domain")), "doc_id")
    return mixing.mix(docs, labelled).drop("_at")


@_query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op7_exact_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return warc.pages_of(warc.read(spark, folder))


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~quality.held_out())
    scored = quality.score(docs, quality.train(docs, labels))
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", predicted.alias("predicted"))


@_query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.fit(secrets.transition_counts(docs)))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id",
        number("assign"),
        number("access"),
        number("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


@_query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=1024, end=0)


@_query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=10, top_terms=10)


ORACLES["op12_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS MATERIALIZED (
  SELECT lang, source, no, term, count(*) AS n FROM (SELECT lang, source, no, unnest(w) AS term FROM d) GROUP BY ALL),
kept AS MATERIALIZED (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM words GROUP BY lang, term HAVING count(*) >= 10),
langs AS (SELECT lang, sum(n)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n, k.n AS in_lang
  FROM groups g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, sum(n) AS n FROM words GROUP BY ALL) c USING (lang, source, term)),
shares AS MATERIALIZED (
  SELECT lang, source, term, c.n, 1 + (1000000000::HUGEINT * (c.n + 2)) // (sum(c.n) OVER (PARTITION BY lang, source) + 2 * l.v) AS p,
    1 + (1000000000::HUGEINT * (in_lang + 2)) // (l.n + 2 * l.v) AS q
  FROM counts c JOIN langs l USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM shares WHERE n > 0 AND p > q),
rows AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN pairs p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, value::BIGINT AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 10
"""


@_query
def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, size=64, scale=256, seed=2)


def _clustering_sql(rounds: int) -> str:
    """One pair of tables a round: assignment and new centroids."""
    nearest = """a{i} AS MATERIALIZED (
  SELECT r, vec_id, v, c.k, list_sum(list_transform(list_zip(x.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
  FROM x, c{i} c QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c.k) = 1)"""
    moved = """c{j} AS MATERIALIZED (
  SELECT c.k, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN (
    SELECT k, list(s ORDER BY i) AS c FROM (
      SELECT k, i, CAST((sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS s
      FROM a{i}, range(1, 65) t(i) GROUP BY k, i) GROUP BY k) m USING (k))"""
    steps = [nearest.format(i=0)]
    for i in range(rounds):
        steps += [moved.format(i=i, j=i + 1), nearest.format(i=i + 1)]
    return f"""
WITH x AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(256 * e::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS k, v AS c FROM x QUALIFY k < 40),
{", ".join(steps)}
SELECT vec_id, k AS cluster, distance::BIGINT AS distance, CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)
"""


ORACLES["op13_clustering"] = _clustering_sql(5)


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)

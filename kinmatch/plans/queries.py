"""The registered queries: one per operator, each over whole test tables, with its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import blocking, evaluate, features, inference, quality, reports, tfidf, training
from ..operators.runs import PartRun
from ..operators.similarity import SimilarityIndex
from ..params import FEATURES, LinkParams
from ..session import delete, scratch, scratch_path, shared_folder, stage, tune
from ..sources import tables
from . import fixtures as fx
from . import sql

Query = Callable[[SparkSession, str], DataFrame]

PARAMS = LinkParams()
SMALL_TREES = replace(PARAMS, rounds=8, depth=4, step=0.3, min_leaf=5)
LINK_AT = 0.65

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, statement: str | None = None, *roots: str) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[name] = run
        if statement is not None:
            ORACLES[name] = sql.query(statement, *roots)
        return run

    return wrap


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/queries/{name}-{uuid.uuid4().hex}"


def r6(column: str) -> F.Column:
    return F.round(F.col(column), 6).alias(column)


def truth(spark: SparkSession, sf: str) -> DataFrame:
    return tables.ground_truth(fx.catalog_truth(spark, sf))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return blocking.block(*fx.catalog(spark, sf), PARAMS)


def of_sided(spark: SparkSession, sf: str, make: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``make`` of the pairs with both records' fields, staged slice by slice; the pairs are never all there."""
    return blocking.block(*fx.catalog(spark, sf), PARAMS, make=lambda *sides: make(features.both_sides(*sides)), name=name)


def by_formula(sided: DataFrame) -> DataFrame:
    """Pairs with a score by formula, so that any engine gets the same one."""
    prob = F.round((features.jaccard(F.col("nn1"), F.col("nn2")) + F.col("cosine")) / 2, 6)
    return sided.select("s1_id", "c_id", "pos", prob.alias("prob"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return of_sided(spark, sf, lambda sided: by_formula(sided).drop("pos"), "scored")


def links(spark: SparkSession, sf: str) -> DataFrame:
    return of_sided(spark, sf, lambda sided: inference.apply_threshold(by_formula(sided), LINK_AT), "links")


def matched(spark: SparkSession, sf: str) -> DataFrame:
    lists = links(spark, sf).groupBy("s1_id").agg(F.collect_list("c_id").alias("matched"))
    return lists


# ---------------------------------------------------------------- sources and sinks


@register(
    "read_source",
    "SELECT entity_id, business_name, business_address, country FROM p_raw WHERE src = 1",
    "p_raw",
)
def read_source(spark, sf):
    path = _path(spark, "source1")
    raw = fx.catalog_sources(spark, sf).where("src = 1").select(*tables.SOURCE_COLUMNS, "ord")
    tables.write_tsv(raw, path, "ord")
    return tables.read_source(spark, path).drop("ord")


@register("ground_truth", "SELECT s1_id, array_to_string(truth, ',') AS truth FROM p_truth", "p_truth")
def ground_truth(spark, sf):
    return truth(spark, sf).select("s1_id", F.array_join(F.sort_array("truth"), ",").alias("truth"))


@register(
    "ground_truth_sampled",
    """SELECT 'S1-' || o_orderkey AS s1_id, coalesce(array_to_string(truth, ','), '') AS truth
    FROM orders LEFT JOIN p_truth ON s1_id = 'S1-' || o_orderkey""",
    "p_truth",
)
def ground_truth_sampled(spark, sf):
    wanted = spark.read.parquet(f"{sf}/orders.parquet").select(F.format_string("S1-%d", "o_orderkey").alias("s1_id"))
    found = tables.ground_truth_of(truth(spark, sf), wanted)
    return found.select("s1_id", F.array_join(F.sort_array("truth"), ",").alias("truth"))


@register(
    "candidates_by_country",
    f"SELECT entity_id, business_name, business_address, {sql.country('country')} AS cc FROM p_raw WHERE src > 1",
    "p_raw",
)
def candidates_by_country(spark, sf):
    raw = fx.catalog_sources(spark, sf)
    both = tables.candidates_by_country(raw.where("src = 2"), raw.where("src = 3"))
    return both.select("entity_id", "business_name", "business_address", "cc")


@register(
    "explode_candidate_lists",
    "SELECT s1_id, c_id, pos::INT AS pos FROM p_pairs JOIN p_rec ON entity_id = s1_id WHERE cc = 'india'",
    "p_pairs",
    "p_rec",
)
def explode_candidate_lists(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    path = _path(spark, "candidates")
    tables.write_links(tables.candidate_lists(s1, pairs(spark, sf)), path)
    stored = tables.read_links(spark, path, tables.CANDIDATE_COLUMNS)
    return tables.explode_lists(stored, s1.where("cc = 'india'"))


@register("link_lists", "SELECT * FROM p_lists", "p_lists")
def link_lists(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    path = _path(spark, "links")
    tables.write_links(tables.link_lists(s1, links(spark, sf)), path)
    return tables.read_links(spark, path).drop("ord")


@register("candidate_lists", "SELECT * FROM p_cand_lists", "p_cand_lists")
def candidate_lists(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    return tables.candidate_lists(s1, pairs(spark, sf)).drop("ord")


def _stored_parts(spark, sf) -> DataFrame:
    """Link lists written by (country, order block), read back with a part number."""
    s1, _ = fx.catalog(spark, sf)
    lists = tables.link_lists(s1, links(spark, sf)).join(s1.select(F.col("entity_id").alias("source1_entity_id"), "cc"), "source1_entity_id")
    path = _path(spark, "parts")
    tables.write_parts(lists.withColumn("part", F.floor(F.col("ord") / 500).cast("int")), path)
    return spark.read.parquet(path)


@register(
    "link_parts",
    """SELECT source1_entity_id, matched_entity_ids, cc, (ord // 500)::INT AS part
    FROM p_lists JOIN p_rec ON entity_id = source1_entity_id""",
    "p_lists",
    "p_rec",
)
def link_parts(spark, sf):
    return _stored_parts(spark, sf).select("source1_entity_id", "matched_entity_ids", "cc", "part")




def _repeated_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Many rows per record: ordered items as part rows."""
    s1, _ = fx.catalog(spark, sf)
    parts = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.format_string("S1-%d", "l_partkey").alias("source1_entity_id"),
        F.format_string("S2-%d", "l_suppkey").alias("matched_entity_ids"),
        # the row's own text settles equal positions
        F.struct((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("at"), F.col("l_suppkey").alias("tie")).alias("part_id"),
    )
    return s1, parts


@register(
    "merge_parts",
    """SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids, (ids IS NOT NULL)::INT AS found
    FROM p_rec LEFT JOIN (SELECT sid, ids FROM (SELECT 'S1-' || l_partkey AS sid, 'S2-' || l_suppkey AS ids,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 100 + l_linenumber DESC, l_suppkey DESC) AS rn
    FROM lineitem) WHERE rn = 1) ON sid = entity_id WHERE src = 1""",
    "p_rec",
)
def merge_parts(spark, sf):
    return tables.merge_parts(*_repeated_parts(spark, sf)).drop("ord")


@register(
    "merge_parts_missing",
    """SELECT entity_id AS source1_entity_id FROM p_rec WHERE src = 1 AND entity_id NOT IN
    (SELECT 'S1-' || s_suppkey FROM supplier)""",
    "p_rec",
)
def merge_parts_missing(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    parts = spark.read.parquet(f"{sf}/supplier.parquet").select(
        F.format_string("S1-%d", "s_suppkey").alias("source1_entity_id"),
        F.lit("").alias("matched_entity_ids"),
        F.col("s_nationkey").alias("part_id"),
    )
    return tables.missing_parts(tables.merge_parts(s1, parts))


@register("merge_complete", "SELECT * FROM p_lists", "p_lists")
def merge_complete(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    parts = _stored_parts(spark, sf).withColumn("part_id", F.struct("cc", "part"))
    return tables.merge_complete(s1, parts).drop("ord")


# ---------------------------------------------------------------- text

_BOTH_RAW = """(SELECT entity_id, business_name AS t FROM p_raw UNION ALL SELECT entity_id, business_address FROM p_raw
    UNION ALL SELECT 'D' || doc_id, text FROM documents UNION ALL SELECT 'C' || conv_id || '-' || turn, text FROM conversations)"""


def _raw_texts(spark, sf) -> DataFrame:
    raw = fx.catalog_sources(spark, sf)
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    talk = spark.read.parquet(f"{sf}/conversations.parquet")
    return (
        raw.select("entity_id", F.col("business_name").alias("t"))
        .unionByName(raw.select("entity_id", F.col("business_address").alias("t")))
        .unionByName(documents.select(F.format_string("D%d", "doc_id").alias("entity_id"), F.col("text").alias("t")))
        .unionByName(talk.select(F.format_string("C%d-%d", "conv_id", "turn").alias("entity_id"), F.col("text").alias("t")))
    )


@register("normalize_text", f"SELECT entity_id, {sql.normalize('t')} AS text FROM {_BOTH_RAW}", "p_raw")
def normalize_text(spark, sf):
    return _raw_texts(spark, sf).select("entity_id", tx.normalize_tokens(F.col("t")).alias("text"))


@register("normalize_series", f"SELECT entity_id, {sql.normalize('t')} AS text FROM {_BOTH_RAW}", "p_raw")
def normalize_series(spark, sf):
    return _raw_texts(spark, sf).select("entity_id", tx.normalize(F.col("t")).alias("text"))


@register(
    "normalize_country",
    f"SELECT entity_id, {sql.country('country')} AS cc FROM (SELECT entity_id, chr(160) || ' ' || country || chr(9) AS country FROM p_raw)",
    "p_raw",
)
def normalize_country(spark, sf):
    untidy = F.concat(F.lit("  "), F.col("country"), F.lit("\t"))
    return fx.catalog_sources(spark, sf).select("entity_id", tx.normalize_country(untidy).alias("cc"))


@register("blocking_text", f"SELECT entity_id, {sql.BLOCKING_TEXT} AS text FROM p_rec UNION ALL SELECT entity_id, {sql.BLOCKING_TEXT} FROM d_rec", "p_rec", "d_rec")
def blocking_text(spark, sf):
    both = _all_records(spark, sf)
    return both.select("entity_id", tx.blocking_text(F.col("nn"), F.col("na")).alias("text"))


def _all_records(spark, sf) -> DataFrame:
    columns = ("entity_id", "src", "nn", "na", "cc")
    one = fx.normalized(fx.catalog_sources(spark, sf)).select(*columns)
    return one.unionByName(fx.normalized(fx.document_sources(spark, sf)).select(*columns))


@register(
    "blocking_text_column",
    """SELECT entity_id, trim(nn || ' ' || nn || ' ' || na) AS text FROM p_rec
    UNION ALL SELECT entity_id, trim(nn || ' ' || nn || ' ' || na) FROM d_rec""",
    "p_rec",
    "d_rec",
)
def blocking_text_column(spark, sf):
    return _all_records(spark, sf).select("entity_id", tx.blocking_text_column(F.col("nn"), F.col("na")).alias("text"))


@register("source_from_prefix", "SELECT entity_id, split_part(entity_id, '-', 1) AS source FROM p_raw", "p_raw")
def source_from_prefix(spark, sf):
    return fx.catalog_sources(spark, sf).select("entity_id", tx.source_of(F.col("entity_id")).alias("source"))


@register(
    "s1_semi_sample",
    """SELECT entity_id, nn, cc FROM p_rec WHERE src = 1 AND entity_id IN
    (SELECT 'S1-' || s_suppkey FROM supplier)""",
    "p_rec",
)
def s1_semi_sample(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    suppliers = spark.read.parquet(f"{sf}/supplier.parquet")
    ids = suppliers.select(F.format_string("S1-%d", "s_suppkey").alias("entity_id"))
    return training.semi_sample(s1, ids).select("entity_id", "nn", "cc")


def _by_order() -> F.Column:
    return F.floor(F.col("ord") / 64)


@register(
    "s1_slice",
    """SELECT entity_id, cc FROM (SELECT entity_id, cc, row_number() OVER (PARTITION BY cc ORDER BY ord) - 1 AS spot
    FROM p_rec WHERE src = 1 AND cc = 'us') WHERE spot >= 25 AND spot < 75""",
    "p_rec",
)
def s1_slice(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    return inference.slice_s1(s1, "us", 25, 75, _by_order()).select("entity_id", "cc")


# ---------------------------------------------------------------- candidate generation


def _space(spark, sf, params: LinkParams = PARAMS) -> tfidf.TermSpace:
    _, s23 = fx.catalog(spark, sf)
    return tfidf.TermSpace(blocking.docs(s23, {"name": F.col("nn")}), params)


def _cc() -> F.Column:
    return F.substring_index("corpus", ":", -1).alias("cc")


_TERM_ROWS = "SELECT entity_id, term, count(*) AS tf FROM (SELECT entity_id, unnest({terms}) AS term FROM {rec}) GROUP BY ALL"


def _dealt(texts: DataFrame, *key: str) -> DataFrame:
    """Texts dealt by their key before their terms are taken apart: counting a key's terms then moves no terms, and no task counts a whole file's."""
    return texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)


def _term_rows(records: DataFrame, field: str, analyzer: str) -> DataFrame:
    return (
        tx.explode_terms(_dealt(records.select("entity_id", field), "entity_id"), ["entity_id"], field, analyzer)
        .groupBy("entity_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


@register("tokens_ngrams", _TERM_ROWS.format(terms=sql.word_terms("nn || ' ' || na"), rec="d_rec"), "d_rec")
def tokens_ngrams(spark, sf):
    records = fx.normalized(fx.document_sources(spark, sf)).withColumn("t", F.concat_ws(" ", "nn", "na"))
    return _term_rows(records, "t", "word")


@register("char_trigrams", _TERM_ROWS.format(terms=sql.char_terms("nn || ' ' || na"), rec="d_rec"), "d_rec")
def char_trigrams(spark, sf):
    records = fx.normalized(fx.document_sources(spark, sf)).withColumn("t", F.concat_ws(" ", "nn", "na"))
    return _term_rows(records, "t", "char")


@register("fit_sample", "SELECT cc, id FROM pf_fit", "pf_fit")
def fit_sample(spark, sf):
    _, s23 = fx.catalog(spark, sf)
    return tfidf.fit_sample(blocking.docs(s23, {"name": F.col("nn")}), 300).select(_cc(), "id")


@register("vocabulary", "SELECT cc, term, df, total FROM pn_vocab UNION ALL SELECT cc, term, df, total FROM da_vocab", "pn_vocab", "da_vocab")
def vocabulary(spark, sf):
    _, d23 = fx.document_records(spark, sf)
    documents = tfidf.TermSpace(blocking.docs(d23, {"addr": F.col("na")}), PARAMS).vocab
    return _space(spark, sf).vocab.unionByName(documents).select(_cc(), "term", "df", "total")


@register("idf", "SELECT cc, term, round(idf, 6) AS idf FROM pn_vocab", "pn_vocab")
def idf(spark, sf):
    return _space(spark, sf).vocab.select(_cc(), "term", r6("idf"))


@register("idf_sampled", "SELECT cc, term, round(idf, 6) AS idf FROM pf_vocab", "pf_vocab")
def idf_sampled(spark, sf):
    return _space(spark, sf, replace(PARAMS, fit_sample=300)).vocab.select(_cc(), "term", r6("idf"))


_WEIGHTS = "SELECT id, term, round(w, 6) AS w FROM pn_w"


@register("tfidf_weights", _WEIGHTS + " WHERE src > 1", "pn_w")
def tfidf_weights(spark, sf):
    _, s23 = fx.catalog(spark, sf)
    docs = blocking.docs(s23, {"name": F.col("nn")})
    space = tfidf.TermSpace(docs, PARAMS)
    texts = _dealt(docs.select("corpus", "id", "text"), "corpus", "id")
    counts = tfidf.term_counts(texts, "word", ["corpus", "id"], [])
    return space.weigh(counts, ["corpus", "id"]).select("id", F.explode("vec").alias("t")).select(
        "id", "t.term", F.round("t.w", 6).alias("w")
    )


@register(
    "degenerate_country",
    """SELECT cc, count(DISTINCT entity_id) AS n, (SELECT count(*) FROM pn_vocab v WHERE v.cc = r.cc) +
    (SELECT count(*) FROM dn_vocab v WHERE v.cc = r.cc) AS n_terms
    FROM (SELECT * FROM p_rec UNION ALL SELECT * FROM d_rec) r WHERE src > 1 GROUP BY cc""",
    "pn_vocab",
    "dn_vocab",
    "p_rec",
    "d_rec",
)
def degenerate_country(spark, sf):
    candidates = _all_records(spark, sf).where("src > 1")
    space = tfidf.TermSpace(blocking.docs(candidates, {"name": F.col("nn")}), PARAMS)
    sizes = candidates.groupBy("cc").agg(F.count(F.lit(1)).alias("n"))
    terms = space.vocab.groupBy(_cc()).agg(F.count(F.lit(1)).alias("n_terms"))
    return sizes.join(terms, "cc", "left").fillna(0, ["n_terms"])


@register("rare_terms", "SELECT s1_id, term, round(w, 6) AS w FROM pn_q", "pn_q")
def rare_terms(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    docs = blocking.docs(s1, {"name": F.col("nn")})
    counts = tfidf.term_counts(_dealt(docs, "corpus", "id"), "word", ["corpus", "id"], [])
    kept = tfidf.rare_terms(F.col("vec"), PARAMS.rare_keep)
    return (
        _space(spark, sf).weigh(counts, ["corpus", "id"])
        .select(F.col("id").alias("s1_id"), F.explode(kept).alias("t"))
        .select("s1_id", "t.term", F.round("t.w", 6).alias("w"))
    )


@register(
    "tfidf_scores",
    """SELECT 'name' AS field, s1_id, c_id, round(score, 6) AS score FROM pn_topk
    UNION ALL SELECT 'addr', s1_id, c_id, round(score, 6) FROM pa_topk""",
    "pn_topk",
    "pa_topk",
)
def tfidf_scores(spark, sf):
    fields = {"name": F.col("nn"), "addr": F.col("na")}
    found = blocking.stream(*fx.catalog(spark, sf), fields, {"name": PARAMS.name_k, "addr": PARAMS.addr_k}, PARAMS)
    return found.select(F.substring_index("corpus", ":", 1).alias("field"), "s1_id", "c_id", r6("score"))


_RANKED = "SELECT s1_id, c_id, rank::INT AS rank, round(score, 6) AS score FROM "


def _ranked(found: DataFrame) -> DataFrame:
    return found.select("s1_id", "c_id", F.col("rank").cast("int").alias("rank"), r6("score"))


@register("topk_name", _RANKED + "pn_topk", "pn_topk")
def topk_name(spark, sf):
    return _ranked(blocking.name_stream(*fx.catalog(spark, sf), PARAMS))


@register("topk_addr", _RANKED + "pa_topk", "pa_topk")
def topk_addr(spark, sf):
    return _ranked(blocking.addr_stream(*fx.catalog(spark, sf), PARAMS))


@register("topk_two_phase", _RANKED + "pn_topk", "pn_topk")
def topk_two_phase(spark, sf):
    """Cells and slices so small that most lists are cut and most queries are ranked in two phases; same answer."""
    cut = replace(PARAMS, cell_postings=16, cell_queries=16, slice_pairs=64)
    return _ranked(blocking.name_stream(*fx.catalog(spark, sf), cut))


@register("block_name", _RANKED + "dn_topk", "dn_topk")
def block_name(spark, sf):
    return _ranked(blocking.name_stream(*fx.document_records(spark, sf), PARAMS))


@register("block_addr", _RANKED + "da_topk", "da_topk")
def block_addr(spark, sf):
    return _ranked(blocking.addr_stream(*fx.document_records(spark, sf), PARAMS))


@register("block_name_sampled", _RANKED + "pf_topk", "pf_topk")
def block_name_sampled(spark, sf):
    return _ranked(blocking.name_stream(*fx.catalog(spark, sf), replace(PARAMS, fit_sample=300)))


@register("block_name_trigrams", _RANKED + "pc_topk", "pc_topk")
def block_name_trigrams(spark, sf):
    return _ranked(blocking.name_stream(*fx.catalog(spark, sf), replace(PARAMS, analyzer="char")))


_EXACT = "SELECT s1_id, c_id, pos::INT AS pos, namesakes FROM "


@register("exact_name", _EXACT + "p_exact UNION ALL " + _EXACT + "d_exact", "p_exact", "d_exact")
def exact_name(spark, sf):
    one = blocking.exact_names(*fx.catalog(spark, sf), PARAMS.cap)
    return one.unionByName(blocking.exact_names(*fx.document_records(spark, sf), PARAMS.cap))


_GROUPS = """SELECT entity_id, src, cc, sha256(nn) AS name_group, namesakes FROM (SELECT *,
    count(*) FILTER (src > 1) OVER (PARTITION BY cc, nn) AS namesakes, count(*) FILTER (src = 1) OVER (PARTITION BY cc, nn) AS n_s1
    FROM {rec} WHERE nn <> '') WHERE namesakes > 0 AND n_s1 > 0"""


@register("exact_name_groups", f"{_GROUPS.format(rec='p_rec')} UNION ALL {_GROUPS.format(rec='d_rec')}", "p_rec", "d_rec")
def exact_name_groups(spark, sf):
    one = blocking.exact_name_groups(*fx.catalog(spark, sf))
    return one.unionByName(blocking.exact_name_groups(*fx.document_records(spark, sf)))


@register(
    "candidates_merged",
    "SELECT s1_id, c_id, pos::INT AS pos, via_exact::INT AS via_exact FROM d_pairs",
    "d_pairs",
)
def candidates_merged(spark, sf):
    return blocking.block(*fx.document_records(spark, sf), PARAMS).select("s1_id", "c_id", "pos", "via_exact")


@register(
    "pair_cosine",
    """SELECT s1_id, c_id, round(name_score, 6) AS name_score, round(addr_score, 6) AS addr_score,
    round(cosine, 6) AS cosine FROM p_pairs""",
    "p_pairs",
)
def pair_cosine(spark, sf):
    return pairs(spark, sf).select("s1_id", "c_id", r6("name_score"), r6("addr_score"), r6("cosine"))


@register(
    "block_all",
    """SELECT entity_id AS s1_id, coalesce(string_agg(c_id, ',' ORDER BY pos), '') AS candidates,
    count(c_id)::INT AS n FROM d_rec LEFT JOIN d_pairs ON s1_id = entity_id WHERE src = 1 GROUP BY entity_id
    UNION ALL SELECT entity_id, coalesce(string_agg(c_id, ',' ORDER BY pos), ''), count(c_id)::INT
    FROM p_rec LEFT JOIN p_pairs ON s1_id = entity_id WHERE src = 1 GROUP BY entity_id""",
    "d_rec",
    "d_pairs",
    "p_rec",
    "p_pairs",
)
def block_all(spark, sf):
    lists = None
    for s1, s23 in (fx.document_records(spark, sf), fx.catalog(spark, sf)):
        one = blocking.candidate_arrays(s1, blocking.block(s1, s23, PARAMS)).select(
            "s1_id", F.array_join("candidates", ",").alias("candidates"), F.size("candidates").alias("n")
        )
        lists = one if lists is None else lists.unionByName(one)
    return lists


@register(
    "block_single_stream",
    "SELECT s1_id, c_id, pos::INT AS pos, round(cosine, 6) AS cosine FROM pt_pairs",
    "pt_pairs",
)
def block_single_stream(spark, sf):
    return blocking.block_single(*fx.catalog(spark, sf), PARAMS).select("s1_id", "c_id", "pos", r6("cosine"))


# ---------------------------------------------------------------- pair features


def _set_features(*names: str) -> Query:
    def run(spark, sf):
        columns = features.set_scores()
        wanted = [F.round(columns[n], 6).alias(n) for n in names]
        return of_sided(spark, sf, lambda sided: sided.select("s1_id", "c_id", *wanted), "features")

    return run


def _string_features(*names: str) -> Query:
    def run(spark, sf):
        wanted = [r6(n) for n in names]
        return of_sided(spark, sf, lambda sided: features.string_scores(sided, names).select("s1_id", "c_id", *wanted), "features")

    return run


def _sided_sql(**columns: str) -> str:
    return "SELECT s1_id, c_id, " + ", ".join(f"round({c}, 6) AS {n}" for n, c in columns.items()) + " FROM p_sided"


register("feat_exact", _sided_sql(name_exact=sql.equal("nn1", "nn2"), addr_exact=sql.equal("na1", "na2")), "p_sided")(
    _set_features("name_exact", "addr_exact")
)
register(
    "feat_jaccard", _sided_sql(name_jaccard=sql.jaccard("nn1", "nn2"), addr_jaccard=sql.jaccard("na1", "na2")), "p_sided"
)(_set_features("name_jaccard", "addr_jaccard"))
register(
    "feat_country",
    _sided_sql(country_exact="CASE WHEN cc1 = cc2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"),
    "p_sided",
)(_set_features("country_exact"))
register(
    "feat_len_diff",
    _sided_sql(
        name_len_diff="abs(length(nn1) - length(nn2))::DOUBLE", addr_len_diff="abs(length(na1) - length(na2))::DOUBLE"
    ),
    "p_sided",
)(_set_features("name_len_diff", "addr_len_diff"))
register(
    "feat_common_tokens",
    _sided_sql(
        **{
            f"common_{name}_tokens": f"len(list_intersect(list_distinct({sql.toks(a)}), list_distinct({sql.toks(b)})))::DOUBLE"
            for name, a, b in (("name", "nn1", "nn2"), ("addr", "na1", "na2"))
        }
    ),
    "p_sided",
)(_set_features("common_name_tokens", "common_addr_tokens"))
register("feat_cosine", _sided_sql(tfidf_cosine="cosine"), "p_sided")(_set_features("tfidf_cosine"))
register(
    "feat_ratio",
    f"""SELECT s1_id, c_id, round({sql.ratio('nn1', 'nn2', 'nl')}, 6) AS name_ratio, round({sql.ratio('na1', 'na2', 'al')}, 6) AS addr_ratio
    FROM (SELECT *, {sql.lcs('nn1', 'nn2')} AS nl, {sql.lcs('na1', 'na2')} AS al FROM p_sided)""",
    "p_sided",
)(_string_features("name_ratio", "addr_ratio"))
register(
    "feat_token_sort",
    f"""SELECT s1_id, c_id, round({sql.ratio('a', 'b', 'l')}, 6) AS name_token_sort FROM (SELECT *, {sql.lcs('a', 'b')} AS l FROM
    (SELECT s1_id, c_id, {sql.sorted_text('nn1')} AS a, {sql.sorted_text('nn2')} AS b FROM p_sided))""",
    "p_sided",
)(_string_features("name_token_sort"))


def _token_set_sql(a: str, b: str, name: str) -> str:
    return f"""SELECT s1_id, c_id, round({sql.token_set(a, b)}, 6) AS {name} FROM (SELECT *, {sql.lcs('x', 'y')} AS l FROM
    (SELECT s1_id, c_id, {a}, {b}, {sql.token_set_parts(a, b)} FROM p_sided))"""


register(
    "feat_token_set",
    f"SELECT * FROM ({_token_set_sql('nn1', 'nn2', 'name_token_set')}) JOIN ({_token_set_sql('na1', 'na2', 'addr_token_set')}) USING (s1_id, c_id)",
    "p_sided",
)(_string_features("name_token_set", "addr_token_set"))
register(
    "feat_partial",
    "SELECT s1_id, c_id, round(partial, 6) AS name_partial FROM p_sided JOIN name_partials USING (nn1, nn2)",
    "p_sided",
    "name_partials",
)(_string_features("name_partial"))


_ALL_FEATURES = "SELECT s1_id, c_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in FEATURES) + " FROM p_features"


@register("pair_features_raw", _ALL_FEATURES, "p_features")
def pair_features_raw(spark, sf):
    path = scratch_path(spark, "stage/raw-records")
    records = stage(features.raw_records(fx.catalog_sources(spark, sf)), "raw-records", path)

    def make(pairs: DataFrame, *_: DataFrame) -> DataFrame:
        found = features.pair_features_raw(pairs.select("s1_id", "c_id", "cosine"), records)
        return found.select("s1_id", "c_id", *[r6(f) for f in FEATURES])

    made = blocking.block(*fx.catalog(spark, sf), PARAMS, make=make, name="features")
    delete(spark, path)
    return made


def featured(spark, sf) -> DataFrame:
    return of_sided(spark, sf, lambda sided: features.add_features(sided).select("s1_id", "c_id", "pos", *FEATURES), "features")


@register("pair_features", _ALL_FEATURES, "p_features")
def pair_features(spark, sf):
    return featured(spark, sf).select("s1_id", "c_id", *[r6(f) for f in FEATURES])


# ---------------------------------------------------------------- training


@register("stratified_sample", "SELECT entity_id, country FROM p_sample", "p_sample")
def stratified_sample(spark, sf):
    s1 = fx.catalog_sources(spark, sf).where("src = 1")
    return training.stratified_sample(s1, 120).select("entity_id", "country")


@register(
    "label_pairs",
    """SELECT s1_id, c_id, (EXISTS (SELECT 1 FROM p_truth_pairs t WHERE t.s1_id = p.s1_id AND t.c_id = p.c_id))::INT AS label
    FROM p_pairs p""",
    "p_pairs",
    "p_truth_pairs",
)
def label_pairs(spark, sf):
    return training.label_pairs(pairs(spark, sf), truth(spark, sf)).select("s1_id", "c_id", "label")


def _held(spark, sf) -> DataFrame:
    s1, _ = fx.catalog(spark, sf)
    return training.entity_holdout(s1.select(F.col("entity_id").alias("s1_id")), PARAMS.holdout)


@register("entity_holdout", "SELECT s1_id FROM p_held", "p_held")
def entity_holdout(spark, sf):
    return _held(spark, sf)


@register(
    "holdout_scores",
    "SELECT s1_id, c_id, prob FROM p_held LEFT JOIN p_scored USING (s1_id)",
    "p_held",
    "p_scored",
)
def holdout_scores(spark, sf):
    return training.holdout_scores(_held(spark, sf), scored(spark, sf))


_RECALL = """SELECT cc, count(p.c_id) AS found, count(t.c_id) AS actual, count(p.c_id) / greatest(count(t.c_id), 1) AS recall
    FROM p_rec r LEFT JOIN p_truth_pairs t ON t.s1_id = r.entity_id
    LEFT JOIN p_pairs p ON p.s1_id = t.s1_id AND p.c_id = t.c_id WHERE r.src = 1 GROUP BY cc"""


def _recall(spark, sf) -> DataFrame:
    s1, _ = fx.catalog(spark, sf)
    return training.blocking_recall(pairs(spark, sf), truth(spark, sf), s1)


@register("blocking_recall", f"SELECT cc, found, actual, round(recall, 6) AS recall FROM ({_RECALL})", "p_rec", "p_pairs", "p_truth_pairs")
def blocking_recall(spark, sf):
    return _recall(spark, sf).select("cc", "found", "actual", r6("recall"))


@register(
    "candidates_per_s1",
    """SELECT cc, round(count(c_id) / count(DISTINCT entity_id), 6) AS mean_candidates FROM (
    SELECT r.cc, r.entity_id, p.c_id FROM p_rec r LEFT JOIN p_pairs p ON p.s1_id = r.entity_id WHERE r.src = 1
    UNION ALL SELECT '*', r.entity_id, p.c_id FROM p_rec r LEFT JOIN p_pairs p ON p.s1_id = r.entity_id WHERE r.src = 1)
    GROUP BY cc""",
    "p_rec",
    "p_pairs",
)
def candidates_per_s1(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    return training.candidates_per_s1(pairs(spark, sf), s1).select("cc", r6("mean_candidates"))


@register(
    "pair_counts",
    """SELECT count(*) AS n_pairs, count(t.c_id) AS n_positive FROM p_pairs p
    LEFT JOIN p_truth_pairs t ON t.s1_id = p.s1_id AND t.c_id = p.c_id""",
    "p_pairs",
    "p_truth_pairs",
)
def pair_counts(spark, sf):
    return training.pair_counts(training.label_pairs(pairs(spark, sf), truth(spark, sf)))


def _labelled(spark, sf) -> DataFrame:
    known = truth(spark, sf)

    def labelled(sided: DataFrame) -> DataFrame:
        return training.label_pairs(features.add_features(sided).select("s1_id", "c_id", *FEATURES), known)

    return of_sided(spark, sf, labelled, "labelled")


def _importances(spark, model) -> DataFrame:
    weights = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(FEATURES, weights)), "feature string, importance double")


def _fitted(spark, table: Callable[[], DataFrame], early_stop: bool = True) -> DataFrame:
    """Importances of the trees fitted to ``table()``; its pairs go before the fit, and the fit's table after it."""
    with scratch(spark):
        with scratch(spark) as keep:
            train = keep(training.fit_columns(table(), PARAMS), "train")
        return _importances(spark, training.fit_table(train, PARAMS, early_stop))


@register("gbt_fit")
def gbt_fit(spark, sf):
    return _fitted(spark, lambda: training.split_pairs(_labelled(spark, sf), _held(spark, sf))[0])


@register("gbt_refit")
def gbt_refit(spark, sf):
    return _fitted(spark, lambda: _labelled(spark, sf), early_stop=False)


@register("train_accuracy")
def train_accuracy(spark, sf):
    train, _ = training.split_pairs(_labelled(spark, sf), _held(spark, sf))
    return training.train_accuracy(training.fit(train, SMALL_TREES), train)


@register("score_pairs")
def score_pairs(spark, sf):
    table = _labelled(spark, sf)
    train, held = training.split_pairs(table, _held(spark, sf))
    return training.score(training.fit(train, SMALL_TREES), held).select("s1_id", "c_id", "prob")


def _matcher(spark, sf) -> training.Matcher:
    s1, _ = fx.catalog(spark, sf)
    ids = s1.select(F.col("entity_id").alias("s1_id"))
    matcher, _ = training.train(_labelled(spark, sf), ids, truth(spark, sf), SMALL_TREES)
    return matcher


@register("model_bundle")
def model_bundle(spark, sf):
    path = _path(spark, "bundle")
    _matcher(spark, sf).save(path)
    loaded = training.Matcher.load(spark, path)
    links = inference.apply_threshold(training.score(loaded.model, featured(spark, sf)), loaded.threshold)
    return links.agg(F.count(F.lit(1)).alias("n_links")).select(
        "n_links", F.lit(loaded.threshold).alias("threshold"), F.lit(loaded.val_f05).alias("val_f05")
    )


# ---------------------------------------------------------------- evaluation


@register("f05_per_entity", "SELECT s1_id, round(f05, 6) AS f05 FROM p_f05", "p_f05")
def f05_per_entity(spark, sf):
    return evaluate.f05_per_entity(truth(spark, sf), matched(spark, sf)).select("s1_id", r6("f05"))


@register("macro_f05", "SELECT round(coalesce(avg(f05), 0), 6) AS macro_f05 FROM p_f05", "p_f05")
def macro_f05(spark, sf):
    return evaluate.macro_f05(truth(spark, sf), matched(spark, sf)).select(r6("macro_f05"))


@register("threshold_sweep", "SELECT threshold, round(score, 6) AS score FROM p_sweep", "p_sweep")
def threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(scored(spark, sf), truth(spark, sf)).select("threshold", r6("score"))


@register(
    "best_threshold",
    "SELECT threshold, round(score, 6) AS score FROM p_sweep ORDER BY round(p_sweep.score, 12) DESC, threshold LIMIT 1",
    "p_sweep",
)
def best_threshold(spark, sf):
    sweep = evaluate.threshold_sweep(scored(spark, sf), truth(spark, sf))
    return evaluate.best_threshold(sweep).select("threshold", r6("score"))


# ---------------------------------------------------------------- inference


@register("apply_threshold", "SELECT s1_id, c_id, pos::INT AS pos FROM p_links", "p_links")
def apply_threshold(spark, sf):
    return links(spark, sf).select("s1_id", "c_id", "pos")


@register("match_all")
def match_all(spark, sf):
    s1, s23 = fx.catalog(spark, sf)
    _, linked = inference.match(s1, s23, _matcher(spark, sf), PARAMS)
    return tables.link_lists(s1, linked).drop("ord")


@register("match_slice")
def match_slice(spark, sf):
    s1, s23 = fx.catalog(spark, sf)
    part = inference.slice_s1(s1, "india", 10, 60, _by_order())
    _, linked = inference.match_slice(s1, s23, _matcher(spark, sf), "india", 10, 60, PARAMS, _by_order())
    return tables.link_lists(part, linked).drop("ord")


@register(
    "match_parts",
    """SELECT CASE WHEN n > size THEN 'country:' || cc || ':' || (spot // size) ELSE 'countries:0' END AS part,
    count(*) AS n_records, CAST(1 AS BIGINT) AS n_attempts, CAST(0 AS BIGINT) AS n_other FROM (
    SELECT cc, row_number() OVER (PARTITION BY cc ORDER BY ord) - 1 AS spot, count(*) OVER (PARTITION BY cc) AS n,
    CAST(ceil(count(*) OVER () / 3.0) AS BIGINT) AS size FROM p_rec WHERE src = 1) GROUP BY part""",
    "p_rec",
)
def match_parts(spark, sf):
    """Matched in parts, broken off after two and started again: attempts a part, and records whose lists are not those of one whole run."""
    s1, s23 = (stage(records, "records") for records in fx.catalog(spark, sf))  # read by every part, normalised once
    matcher = _matcher(spark, sf)
    size = -(-s1.count() // 3)
    folder = _path(spark, "parts")
    PartRun(s1, s23, matcher, folder, size, PARAMS, _by_order()).go(most=2)
    run = PartRun(s1, s23, matcher, folder, size, PARAMS, _by_order())
    run.go()
    candidates, linked = inference.match(s1, s23, matcher, PARAMS)
    whole = tables.candidate_lists(s1, candidates).drop("ord").join(tables.link_lists(s1, linked).drop("ord"), "source1_entity_id")
    other = run.merged().select(*whole.columns).exceptAll(whole).select(F.col("source1_entity_id").alias("entity_id"), F.lit(1).alias("other"))
    attempts = run.manifest().groupBy("part").agg(F.count(F.lit(1)).alias("n_attempts"))
    counts = run.rows.join(other, "entity_id", "left").groupBy("part").agg(F.count(F.lit(1)).alias("n_records"), F.count("other").alias("n_other"))
    return counts.join(attempts, "part", "left")


@register("rescore")
def rescore(spark, sf):
    s1, s23 = fx.catalog(spark, sf)
    lists = tables.candidate_lists(s1, pairs(spark, sf)).drop("ord")
    return tables.link_lists(s1, inference.rescore(lists, s1, s23, _matcher(spark, sf))).drop("ord")


# ---------------------------------------------------------------- checks of ID lists


def _lines(spark, sf) -> DataFrame:
    return stage(fx.link_lines(spark, sf), "lines")


def _rows(spark, sf) -> DataFrame:
    return quality.parse_rows(_lines(spark, sf))


@register("check_header")
def check_header(spark, sf):
    """Link lists of all parts written with a good, a comma and a misnamed header."""
    s1, _ = fx.catalog(spark, sf)
    known = tables.truth_pairs(truth(spark, sf)).withColumn("pos", F.lit(1))
    lists = tables.link_lists(s1, known)
    paths = [_path(spark, "headed") for _ in range(3)]
    tables.write_links(lists.withColumnRenamed("source1_entity_id", "Source1_Entity_ID"), paths[0])
    lists.drop("ord").write.option("header", True).csv(paths[1])
    tables.write_links(lists.withColumnsRenamed({"source1_entity_id": "id", "matched_entity_ids": "matches"}), paths[2])
    headers, _ = tables.split_header(tables.read_lines(spark, paths))
    return quality.check_header(headers).distinct()


@register("check_malformed", "SELECT line FROM lines WHERE NOT contains(line, chr(9)) AND trim(line) <> ''", "lines")
def check_malformed(spark, sf):
    return quality.check_malformed(_lines(spark, sf)).select("line")


@register("check_duplicate_rows", "SELECT s1_id, count(*) AS n FROM link_rows GROUP BY s1_id HAVING count(*) > 1", "link_rows")
def check_duplicate_rows(spark, sf):
    return quality.check_duplicate_rows(_rows(spark, sf))


def _issue_sql(rule: str, column: str) -> str:
    return f"SELECT item AS {column} FROM issues WHERE rule = '{rule}'"


@register("check_duplicate_ids", _issue_sql("duplicate_ids", "s1_id"), "issues")
def check_duplicate_ids(spark, sf):
    return quality.check_duplicate_ids(_rows(spark, sf))


@register("check_self_match", _issue_sql("self_match", "c_id"), "issues")
def check_self_match(spark, sf):
    return quality.check_self_match(_rows(spark, sf))


@register("check_prefix", _issue_sql("prefix", "c_id"), "issues")
def check_prefix(spark, sf):
    return quality.check_prefix(_rows(spark, sf))


@register("check_unknown_ids", _issue_sql("unknown_ids", "c_id"), "issues")
def check_unknown_ids(spark, sf):
    return quality.check_unknown_ids(_rows(spark, sf), fx.catalog(spark, sf)[1])


@register("check_missing_s1", _issue_sql("missing_s1", "s1_id"), "issues")
def check_missing_s1(spark, sf):
    return quality.check_missing_s1(_rows(spark, sf), fx.catalog(spark, sf)[0])


@register("check_extra_s1", _issue_sql("extra_s1", "s1_id"), "issues")
def check_extra_s1(spark, sf):
    return quality.check_extra_s1(_rows(spark, sf), fx.catalog(spark, sf)[0])


def _candidate_rows(spark, sf) -> DataFrame:
    lists = blocking.block(
        *fx.catalog(spark, sf), PARAMS, make=lambda pairs, s1, _: blocking.candidate_arrays(s1, pairs), name="candidates"
    )
    return lists.withColumnRenamed("candidates", "ids")


@register("check_subset", _issue_sql("subset", "s1_id"), "issues")
def check_subset(spark, sf):
    return quality.check_subset(_rows(spark, sf), _candidate_rows(spark, sf))


@register(
    "list_summary",
    """SELECT count(*) AS n_rows, count(*) FILTER (len(ids) = 0) AS n_empty, count(*) FILTER (len(ids) > 0) AS n_listed
    FROM link_rows""",
    "link_rows",
)
def list_summary(spark, sf):
    return quality.list_summary(_rows(spark, sf))


def _issues(spark, sf) -> DataFrame:
    s1, s23 = fx.catalog(spark, sf)
    good = spark.createDataFrame([("source1_entity_id\tmatched_entity_ids",)], "line string")
    return stage(quality.issues(_lines(spark, sf), good, s1, s23, _candidate_rows(spark, sf)), "issues")


@register(
    "issue_examples",
    """SELECT rule, count(*) AS total, array_to_string(list_sort(list(item))[1:5], ', ') AS examples
    FROM issues GROUP BY rule""",
    "issues",
)
def issue_examples(spark, sf):
    return quality.issue_examples(_issues(spark, sf))


_RULES = ", ".join(f"('{rule}', '{severity}')" for rule, severity in quality.RULES)
_VERDICT = "CASE WHEN max((severity = 'error' AND total > 0)::INT) OVER () = 1 THEN 'FAIL' ELSE 'PASS' END AS verdict"


@register(
    "validation_report",
    f"""SELECT *, {_VERDICT} FROM (SELECT rule, severity, count(item) AS total
    FROM (VALUES {_RULES}) r(rule, severity) LEFT JOIN issues USING (rule) GROUP BY rule, severity)""",
    "issues",
)
def validation_report(spark, sf):
    return quality.validation_report(_issues(spark, sf))


@register(
    "validate",
    f"""SELECT *, {_VERDICT} FROM (
    SELECT file, r.rule, severity, CASE WHEN file = 'candidates' AND r.rule = 'subset' THEN -1 ELSE count(item) END AS total
    FROM (SELECT 'links' AS file, * FROM (VALUES {_RULES}, ('missing_file', 'error')) r(rule, severity)
    UNION ALL SELECT 'candidates', * FROM (VALUES {_RULES}, ('missing_file', 'warning')) r(rule, severity)) r
    LEFT JOIN issues i ON i.rule = r.rule AND file = 'links' GROUP BY file, r.rule, severity)""",
    "issues",
)
def validate(spark, sf):
    """The faulty link lines and the candidate lists, written as files and validated together."""
    s1, s23 = fx.catalog(spark, sf)
    links, lists = _path(spark, "links"), _path(spark, "lists")
    header = "\t".join(tables.LINK_COLUMNS)
    plain = {"header": True, "sep": "\x01", "quote": "", "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    fx.link_lines(spark, sf).select(F.col("line").alias(header)).write.options(**plain).csv(links)
    tables.write_links(tables.candidate_lists(s1, pairs(spark, sf)), lists)
    return quality.validate(spark, links, s1, lists, s23).drop("examples")


@register("source_ids", "SELECT DISTINCT entity_id FROM p_raw WHERE src > 1", "p_raw")
def source_ids(spark, sf):
    raw = fx.catalog_sources(spark, sf)
    paths = []
    for src in (2, 3):
        path = _path(spark, f"source{src}")
        tables.write_tsv(raw.where(F.col("src") == src).select(*tables.SOURCE_COLUMNS), path)
        paths.append(path)
    return tables.source_ids(spark, paths)


# ---------------------------------------------------------------- reports


@register(
    "reduction_ratio",
    """SELECT n_s1, n_s23, n_pairs, n_s1 * n_s23 AS n_possible, round(n_s1 * n_s23 / greatest(n_pairs, 1), 6) AS reduction
    FROM (SELECT count(*) FILTER (src = 1) AS n_s1, count(*) FILTER (src > 1) AS n_s23,
    (SELECT count(*) FROM p_pairs) AS n_pairs FROM p_rec)""",
    "p_rec",
    "p_pairs",
)
def reduction_ratio(spark, sf):
    s1, s23 = fx.catalog(spark, sf)
    report = reports.reduction_ratio(s1, s23, pairs(spark, sf))
    return report.withColumn("reduction", F.round("reduction", 6))


@register(
    "recall_ceiling",
    f"""SELECT sum(found)::BIGINT AS found, sum(actual)::BIGINT AS actual, round(sum(found) / sum(actual), 6) AS recall
    FROM ({_RECALL})""",
    "p_rec",
    "p_pairs",
    "p_truth_pairs",
)
def recall_ceiling(spark, sf):
    return reports.recall_ceiling(_recall(spark, sf)).withColumn("recall", F.round("recall", 6))


@register(
    "singleton_share",
    """SELECT count(*) AS n_s1, round(avg(CASE WHEN matched_entity_ids = '' THEN 1.0::DOUBLE ELSE 0 END), 6) AS singleton_share
    FROM p_lists""",
    "p_lists",
)
def singleton_share(spark, sf):
    s1, _ = fx.catalog(spark, sf)
    return reports.singleton_share(tables.link_lists(s1, links(spark, sf))).withColumn(
        "singleton_share", F.round("singleton_share", 6)
    )


@register(
    "truth_profile",
    """SELECT round(avg((len(truth) = 0)::INT), 6) AS singleton_share,
    round(avg(len(truth)) FILTER (len(truth) > 0), 6) AS links_per_linked FROM p_truth""",
    "p_truth",
)
def truth_profile(spark, sf):
    return reports.truth_profile(truth(spark, sf)).select(r6("singleton_share"), r6("links_per_linked"))


@register(
    "volume_profile",
    """SELECT src, cc, count(*) AS n_records FROM (SELECT src, cc FROM p_rec UNION ALL SELECT src, cc FROM d_rec)
    GROUP BY src, cc""",
    "p_rec",
    "d_rec",
)
def volume_profile(spark, sf):
    return reports.volume_profile(_all_records(spark, sf))


@register(
    "link_errors",
    """SELECT s1_id, c_id, 'false_positive' AS kind FROM p_links ANTI JOIN p_truth_pairs USING (s1_id, c_id)
    UNION ALL SELECT s1_id, c_id, 'false_negative' FROM p_truth_pairs ANTI JOIN p_links USING (s1_id, c_id)""",
    "p_links",
    "p_truth_pairs",
)
def link_errors(spark, sf):
    return reports.link_errors(links(spark, sf), tables.truth_pairs(truth(spark, sf)))


@register(
    "report",
    """SELECT *, round(n_found / greatest(n_true, 1), 6) AS recall, round(n_right / greatest(n_links, 1), 6) AS precision FROM (
    SELECT CASE WHEN grouping(src) = 1 THEN '*' ELSE src::VARCHAR END AS src, CASE WHEN grouping(cc) = 1 THEN '*' ELSE cc END AS cc,
      count(*) AS n_records, coalesce(sum(n_pairs), 0)::BIGINT AS n_pairs, coalesce(sum(n_links), 0)::BIGINT AS n_links,
      coalesce(sum(n_true), 0)::BIGINT AS n_true, coalesce(sum(n_found), 0)::BIGINT AS n_found, coalesce(sum(n_right), 0)::BIGINT AS n_right,
      count(*) FILTER (src = 1 AND coalesce(n_links, 0) = 0) AS n_single
    FROM (SELECT src, cc, e.* FROM p_rec r LEFT JOIN (
      SELECT s1_id, sum(pair) AS n_pairs, sum(link) AS n_links, sum(hit) AS n_true, sum(pair * hit) AS n_found, sum(link * hit) AS n_right
      FROM (SELECT s1_id, c_id, max(pair) AS pair, max(link) AS link, max(hit) AS hit FROM (
        SELECT s1_id, c_id, 1 AS pair, 0 AS link, 0 AS hit FROM p_pairs UNION ALL SELECT s1_id, c_id, 0, 1, 0 FROM p_links
        UNION ALL SELECT s1_id, c_id, 0, 0, 1 FROM p_truth_pairs) GROUP BY s1_id, c_id) GROUP BY s1_id) e
      ON r.src = 1 AND r.entity_id = e.s1_id) GROUP BY GROUPING SETS ((src, cc), (src), (cc), ()))""",
    "p_rec",
    "p_pairs",
    "p_links",
    "p_truth_pairs",
)
def report(spark, sf):
    s1, s23 = fx.catalog(spark, sf)
    found = reports.report(s1, s23, pairs(spark, sf), links(spark, sf), tables.truth_pairs(truth(spark, sf)))
    return found.withColumn("recall", F.round("recall", 6)).withColumn("precision", F.round("precision", 6))

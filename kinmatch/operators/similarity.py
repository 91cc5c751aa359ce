"""Exact top-K join by TF-IDF dot product.

The score of a query and a candidate is the dot product of the query's rarest terms with the
candidate's vector. Written naively this joins two posting lists term by term, and a term found
in a tenth of a country multiplies out. Four things keep the work down, none of which changes
the answer:

* Texts with the same vector are one candidate (its smallest K IDs are kept, no more can rank),
  and texts with the same kept terms and weights are one query.
* Each query knows a score it will reach: the K-th largest weight of one of its terms, times
  its own weight for it, raised to the K-th score of some likely candidates. Terms whose combined
  best case stays below that score never start a candidate, and a posting too light to reach it is
  not followed.
* Queries are dealt over blocks and the postings they ask for over cells, so no task holds a whole
  long list of either side.
* The pairs of a block and a cell meet in the arrays of one task (:mod:`.cellscores`) and only the best
  leave it; a query that may meet more than ``slice_pairs`` candidates is ranked over a slice of about as many first,
  whose K-th score is what all other candidates have to reach, and then over the best of both. How often a query and
  a posting move does not grow with the slices, nor with cells that are smaller than a task can hold.

Scores rank after rounding to nine digits, ties by ID.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import LinkParams
from ..session import delete, in_slices, scratch, scratch_path, slice_count, slice_of, stage
from . import cellscores, tfidf
from .cellscores import SLACK

GROUPS = 1024  # of corpora; many small corpora share a task
LEAST_BLOCKS = 16
MOST_SLICES = 8  # in which queries are scored; each has its share of the blocks
# blocks and cells of a group, unless those would hold more terms of queries or more postings than a task should
MOST_SPLITS = 16
FULL_BLOCK = 1 << 20
FULL_CELL = 1 << 21


def ranked(score: Column) -> Column:
    """The score in whole billionths, rounded half up."""
    return F.floor(score * 1e9 + 0.5)


def _top(df: DataFrame, group: list[str], score: str, tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(ranked(F.col(score)).desc(), tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class SimilarityIndex:
    """Candidate side: distinct vectors, their postings and per-term statistics.

    ``k_of`` maps the corpus prefix (the field name) to its K.
    """

    def __init__(self, docs: DataFrame, params: LinkParams, k_of: dict[str, int]):
        self.params = params
        self.k_of = k_of
        self.k_max = max(k_of.values())
        with scratch(docs.sparkSession) as keep:  # counts and vectors by text are of no use to queries
            self.space = tfidf.TermSpace(docs, params, keep)
            self.vectors, self.postings = self._written(docs, keep)
        self.stats = stage(self._stats(), "termstats")

    def k_column(self) -> Column:
        field = F.substring_index("corpus", ":", 1)
        pairs = [item for name, k in self.k_of.items() for item in (F.lit(name), F.lit(k))]
        return F.element_at(F.create_map(*pairs), field)

    def _written(self, docs: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
        """``(corpus, vn, ids)``, a vector's smallest IDs, and its postings ``(corpus, vn, n_ids, tid, w)``, both staged.

        Vectors are numbered in the order of their first ID, so the short number ``vn`` breaks
        ties exactly as the ID would. Only digests of vectors are grouped and sorted; the vector itself
        is that of the text whose first ID is also the vector's first, and is taken apart once.
        """
        per_text = self.space.weigh(self.space.counts, ["corpus", "tkey"]).select(
            "corpus", "tkey", F.transform("vec", lambda t: F.struct(t["tid"].alias("tid"), t["w"].alias("w"))).alias("vec")
        )
        per_text = stage(per_text.withColumn("vd", tfidf.digest(F.col("vec").cast("string"))), "textvectors")
        keyed = docs.select("corpus", "id", tfidf.digest(F.col("text")).alias("dg"))
        text_ids = (
            tfidf.first_ids(keyed, ["corpus", "dg"], "id", self.k_max)
            .groupBy("corpus", "dg")
            .agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .select("corpus", F.col("ids")[0].alias("tkey"), "ids")
        )
        rows = per_text.select("corpus", "tkey", "vd").join(text_ids, ["corpus", "tkey"]).select("corpus", "vd", F.explode("ids").alias("id"))
        ids = (
            tfidf.first_ids(rows, ["corpus", "vd"], "id", self.k_max)
            .groupBy("corpus", "vd")
            .agg(F.sort_array(F.collect_list("id")).alias("ids"))
            .orderBy(F.col("ids")[0])
            .select("corpus", F.monotonically_increasing_id().alias("vn"), "ids")
        )
        vectors = keep(ids, "vectors")
        firsts = vectors.select("corpus", F.col("ids")[0].alias("tkey"), "vn", F.size("ids").alias("n_ids"))
        postings = per_text.drop("vd").join(firsts, ["corpus", "tkey"]).select("corpus", "vn", "n_ids", F.explode("vec").alias("t"))
        return vectors, keep(postings.select("corpus", "vn", "n_ids", "t.tid", "t.w"), "postings")

    def _stats(self) -> DataFrame:
        """Per term: number of vectors, largest weight, weight of the K-th ID (0 when fewer)."""
        heavy = Window.partitionBy("tid").orderBy(F.col("w").desc(), "vn")
        kth = (
            self.postings.withColumn("at", F.row_number().over(heavy))
            .where(F.col("at") <= self.k_max)
            .withColumn("reached", F.sum("n_ids").over(heavy.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("tid")
            .agg(
                F.max("w").alias("w_max"),
                F.coalesce(F.max(F.when(F.col("reached") >= self.k_column(), F.col("w"))), F.lit(0.0)).alias("w_kth"),
            )
        )
        sizes = self.postings.groupBy("tid").agg(F.count(F.lit(1)).alias("n_vectors"))
        return kth.join(sizes, "tid")

    # ------------------------------------------------------------------ query side

    def query_texts(self, docs: DataFrame) -> DataFrame:
        """``(corpus, dg, qid, slots)``: kept terms of each distinct query text."""
        texts = (
            docs.withColumn("dg", tfidf.digest(F.col("text")))
            .groupBy("corpus", "dg")
            .agg(F.first("text").alias("text"))
        )
        counts = tfidf.term_counts(texts, self.params.analyzer, ["corpus", "dg"], [])
        kept = tfidf.rare_terms(F.col("vec"), self.params.rare_keep)
        slots = F.transform(kept, lambda t: F.struct(t["tid"].alias("tid"), t["w"].alias("w")))
        return (
            self.space.weigh(counts, ["corpus", "dg"])
            .select("corpus", "dg", slots.alias("slots"))
            .withColumn("qid", tfidf.digest(F.col("slots").cast("string")))
        )

    def _bounds(self, queries: DataFrame) -> DataFrame:
        """``(qn, qid, corpus, s, theta)``: a short number ``qn`` per query, its terms in falling order of their best case, and a score that it is sure to reach."""
        best = (
            queries.select("qid", "corpus", F.explode("slots").alias("s"))
            .join(self.stats, F.col("s.tid") == F.col("tid"))
            .select(
                "qid",
                "corpus",
                F.struct(
                    (F.col("s.w") * F.col("w_max")).alias("best"),
                    F.col("tid"),
                    F.col("s.w").alias("w"),
                    (F.col("s.w") * F.col("w_kth")).alias("sure"),
                    F.col("w_max").alias("w_max"),
                    F.col("n_vectors").alias("n_vectors"),
                ).alias("s"),
            )
            .groupBy("qid", "corpus")
            .agg(F.sort_array(F.collect_list("s"), asc=False).alias("s"))
        )
        theta = F.array_max(F.transform("s", lambda x: x["sure"])) - SLACK
        return best.select(F.monotonically_increasing_id().alias("qn"), "qid", "corpus", "s", theta.alias("theta"))

    def _plan(self, bounds: DataFrame) -> DataFrame:
        """``(qn, qid, corpus, s, slices, theta, lead, rest, rest_best)``.

        ``lead`` holds the terms that may start a candidate with the least weight a posting needs,
        ``rest`` the terms that only add to candidates found otherwise. ``slices`` stays as it is
        where ``bounds`` has it.
        """

        def total(items: Column) -> Column:
            return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + x["best"])

        carried = [c for c in bounds.columns if c == "slices"]
        marked = bounds.withColumn("all_best", total(F.col("s"))).select(
            "qn",
            "qid",
            "corpus",
            "theta",
            "s",
            *carried,
            F.transform(
                "s",
                lambda x, i: F.struct(
                    x["tid"].alias("tid"),
                    x["w"].alias("w"),
                    x["best"].alias("best"),
                    x["n_vectors"].alias("n_vectors"),
                    ((F.col("theta") - (F.col("all_best") - x["best"])) / x["w"]).alias("need"),
                    (total(F.slice(F.col("s"), i + 1, F.size("s"))) >= F.col("theta")).alias("leads"),
                ),
            ).alias("marked"),
        )
        leads = F.filter("marked", lambda x: x["leads"])
        rest = F.filter("marked", lambda x: ~x["leads"])
        met = F.aggregate(leads, F.lit(0).cast("long"), lambda acc, x: acc + x["n_vectors"])
        slices = F.col("slices") if carried else F.ceil(met / self.params.slice_pairs).alias("slices")
        return marked.select(
            "qn",
            "qid",
            "corpus",
            "s",
            "theta",
            slices,
            leads.alias("lead"),
            F.transform(rest, lambda x: F.struct(x["tid"].alias("tid"), x["w"].alias("w"))).alias("rest"),
            total(rest).alias("rest_best"),
        )

    @staticmethod
    def _slim(plan: DataFrame) -> DataFrame:
        """What :meth:`scores` and :meth:`_raised` need of the queries that may have an answer."""
        terms = F.transform("s", lambda x: F.struct(x["tid"].alias("tid"), x["w"].alias("w"), x["best"].alias("best"), x["n_vectors"].alias("n_vectors")))
        asked = plan.where((F.col("slices") > 0) & (F.size("lead") > 0))
        return asked.select("qn", "qid", "corpus", terms.alias("s"), "theta", "slices")

    def _cells(self, plan: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
        """``(plan, terms)``: the plan with its queries' ``group``, ``q_split``, ``c_split`` and ``block``, and ``(tid, blocks)``.

        A corpus is in one of ``GROUPS`` groups. The queries of a group are dealt over blocks of some number of terms,
        and the postings that they ask for over cells of some number of postings. Queries move to every cell and postings
        to every block that asks, so both are no more than ``MOST_SPLITS`` until tasks are full.
        """
        p = self.params
        grouped = plan.withColumn("group", F.pmod(F.xxhash64("corpus"), F.lit(GROUPS)))
        asked = (
            grouped.select("group", F.explode("s").alias("t"))
            .groupBy("group", "t.tid")
            .agg(F.count(F.lit(1)).alias("n_queries"), F.first("t.n_vectors").alias("n_vectors"))
        )
        sizes = asked.groupBy("group").agg(F.sum("n_queries").alias("n_slots"), F.sum("n_vectors").alias("n_postings"))
        # small inputs too are dealt over some tasks (``least`` blocks), if no block gets too small for that
        every = F.sum("n_slots").over(Window.partitionBy())
        block = F.least(F.lit(256 * p.cell_queries), F.greatest(F.lit(8 * p.cell_queries), every / least))

        def split(number: str, each: Column, full: int) -> Column:
            return F.least(F.ceil(F.col(number) / each), F.greatest(F.lit(MOST_SPLITS), F.ceil(F.col(number) / full)))

        splits = stage(
            sizes.select(
                "group",
                split("n_slots", block, FULL_BLOCK).alias("q_split"),
                split("n_postings", F.lit(64 * p.cell_postings), FULL_CELL).alias("c_split"),
            ),
            "cells",
        )
        dealt = grouped.join(F.broadcast(splits), "group").withColumn("block", F.pmod(F.xxhash64("qn"), F.col("q_split")))
        where = F.struct("group", "block", "c_split")
        terms = dealt.select(where.alias("block"), F.explode("s.tid").alias("tid")).groupBy("tid").agg(F.collect_set("block").alias("blocks"))
        return dealt, terms

    def scores(self, plan: DataFrame, of: Column | None = None, least: int = LEAST_BLOCKS) -> DataFrame:
        """``(qn, vn, n_ids, score)``: the best of each slice of every query (0: the first one, 1: all others), only of slices that ``of`` allows.

        Queries move to every cell of their group, postings to every block that asks for their term, and of the pairs only
        the best of a block and cell move, so what is shuffled does not grow with the pairs that are compared.
        """
        dealt, terms = self._cells(plan.where(F.col("slices") > 0), least)
        zero = F.lit(0).cast("long")
        asked = (
            dealt.withColumn("slice", F.explode(F.sequence(zero, F.least(F.col("slices") - 1, F.lit(1)))))
            .where(F.lit(True) if of is None else of)
            .withColumn("part", F.explode(F.sequence(zero, F.col("c_split") - 1)))
            .select(
                _cell(F.col("group"), F.col("block"), F.col("part")).alias("cell"),
                "qn",
                "slice",
                "slices",
                self.k_column().alias("k"),
                "theta",
                F.col("s.tid").alias("tids"),
                F.col("s.w").alias("ws"),
            )
        )
        offered = (
            self.postings.join(terms, "tid")
            .select("tid", "vn", "n_ids", "w", F.explode("blocks").alias("b"))
            .select(
                _cell(F.col("b.group"), F.col("b.block"), F.pmod(F.xxhash64("vn"), F.col("b.c_split"))).alias("cell"),
                "tid",
                "vn",
                "n_ids",
                "w",
            )
        )

        def best(asked: pa.Table, offered: pa.Table) -> pa.Table:
            return cellscores.best_in_cell(asked, offered)

        found = asked.groupBy("cell").cogroup(offered.groupBy("cell")).applyInArrow(best, cellscores.SCHEMA)
        # dealt by query alone, which serves the ranking over slices too
        return _top(found.repartition("qn"), ["qn", "slice"], "score", "vn", self.k_max).select("qn", "vn", "n_ids", "score")

    def _raised(self, plan: DataFrame, first: DataFrame) -> DataFrame:
        """The plan of sliced queries with ``theta`` raised to the score of the K-th ID of their ``first`` slice.
        """
        best = _top(first, ["qn"], "score", "vn", self.k_max).join(plan.select("qn", F.col("corpus")), "qn")
        upto = Window.partitionBy("qn").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
        reached = best.withColumn("reached", F.sum("n_ids").over(upto)).where(F.col("reached") >= self.k_column())
        kth = reached.groupBy("qn").agg((F.max("score") - SLACK).alias("kth"))
        bounds = plan.where("slices > 1").select("qn", "qid", "corpus", "s", "slices", "theta").join(kth, "qn", "left")
        return self._plan(bounds.withColumn("theta", F.greatest("theta", "kth")).drop("kth"))

    def sliced_scores(self, plan: DataFrame, least: int = LEAST_BLOCKS) -> DataFrame:
        """:meth:`scores` of all slices. The first slice of every query goes ahead, and what it reaches bounds the rest."""
        if plan.where("slices > 1").isEmpty():
            return self.scores(plan, None, least)
        first = stage(self.scores(plan, F.col("slice") == 0, least), "first-slices")
        raised = stage(self._slim(self._raised(plan, first)), "raisedplan")
        return first.unionByName(self.scores(raised, F.col("slice") > 0, least))

    def _best(self, plan: DataFrame, least: int = LEAST_BLOCKS) -> DataFrame:
        """``(qn, vn, score, before)``: the best vectors of a query, and how many IDs the strictly better ones have."""
        best = _top(self.sliced_scores(plan, least), ["qn"], "score", "vn", self.k_max).withColumn("at", ranked(F.col("score")))
        # IDs of strictly better vectors come first: behind K of them, or for more than what is left, none is looked up
        better = Window.partitionBy("qn").orderBy(F.col("at").desc()).rangeBetween(Window.unboundedPreceding, -1)
        best = best.withColumn("before", F.coalesce(F.sum("n_ids").over(better), F.lit(0)))
        return best.where(F.col("before") < self.k_max).select("qn", "vn", "score", "before")

    def _hits(self, best: DataFrame) -> DataFrame:
        """``(qn, hits)``: up to K ``(c_id, score)`` in order, of the :meth:`_best` vectors of a query."""
        left = (self.k_column() - F.col("before")).cast("int")
        rows = (
            best.join(self.vectors.select("vn", "corpus", "ids"), "vn")
            .where(left > 0)
            .select("qn", self.k_column().alias("k"), "score", F.explode(F.slice("ids", F.lit(1), left)).alias("c_id"))
        )
        listed = (
            _top(rows, ["qn"], "score", "c_id", self.k_max)
            .where("rank <= k")
            .groupBy("qn")
            .agg(F.sort_array(F.collect_list(F.struct("rank", "c_id", "score"))).alias("l"))
        )
        return listed.select("qn", F.transform("l", lambda x: F.struct(x["c_id"].alias("c_id"), x["score"].alias("score"))).alias("hits"))

    def _asked(self, docs: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
        """``(corpus, s1_id, qn)``, who asks what, and the slim plan of all queries, both staged, the plan at ``path``."""
        with scratch(docs.sparkSession) as keep:
            with scratch(docs.sparkSession) as held:  # texts go before the plan is joined
                texts = stage(self.query_texts(docs), "querytexts")
                plan = stage(self._slim(self._plan(self._bounds(texts.dropDuplicates(["qid"])))), "queryplan", path)
                keyed = docs.select("corpus", F.col("id").alias("s1_id"), tfidf.digest(F.col("text")).alias("dg"))
                asked = held(keyed.join(texts.select("corpus", "dg", "qid"), ["corpus", "dg"]).drop("dg"), "asked")
            return keep(asked.join(plan.select("qid", "qn"), "qid").drop("qid"), "asking"), plan

    def top_lists(self, docs: DataFrame, path: str | None = None) -> DataFrame:
        """``(corpus, s1_id, hits)``: up to K ``(c_id, score)`` in order, for query documents ``docs(corpus, id, text)`` that have any.

        Queries are scored and answered in slices, as both they and the postings they ask for move to cells, and the
        best of each cell move again; the best vectors of one slice are there at a time. Staged at ``path``, if given.
        """
        spark = docs.sparkSession
        path = path or scratch_path(spark, "stage/answers")
        with scratch(spark):
            whole = scratch_path(spark, "stage/queryplan")
            asking, plan = self._asked(docs, whole)
            n = slice_count(plan.count() * self.k_max, MOST_SLICES)
            parts = [scratch_path(spark, "stage/planslice") for _ in range(n)]
            plans = [stage(plan.where(slice_of("qn", i, n)), "planslice", part) for i, part in enumerate(parts)]
            delete(spark, whole)

            def answers(i: int) -> DataFrame:
                best = stage(self._best(plans[i], -(-LEAST_BLOCKS // n)), "best")
                delete(spark, parts[i])  # what is still to be scored is there, no more
                # answers lie by query already, so only who asks is moved to them
                return asking.where(slice_of("qn", i, n)).join(self._hits(best), "qn").drop("qn")

            return in_slices(spark, path, n, answers)

    def top_k(self, docs: DataFrame) -> DataFrame:
        """``(corpus, s1_id, c_id, rank, score)`` for query documents ``docs(corpus, id, text)``."""
        found = self.top_lists(docs).select("corpus", "s1_id", F.posexplode("hits").alias("at", "h"))
        return found.select("corpus", "s1_id", "h.c_id", (F.col("at") + 1).alias("rank"), "h.score")


def _cell(group: Column, block: Column, part: Column) -> Column:
    """One number for a block of queries and a cell of postings."""
    return F.shiftleft(group, 48) + F.shiftleft(block, 24) + part

"""Divergence between sources by three-dimensional cube partitioning.

Within a language, the groups (one a source) are cut into blocks and so are the terms. A slice, the
smoothed shares of one block of groups over one block of terms, is sent to every cell (group block,
group block, term block) that needs it. A cell computes the partial divergences of its pairs of
groups over its terms, and these are summed along the term axis.

All arithmetic is in integers: shares in units of 1e-9, divergences rounded down term by term.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinmatch.llm.common import arrow_settings, stage, text_or_empty

#: A term in UTF-8: ASCII letters, of which only A-Z have been lowered, and every character beyond ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")
LEAST_DOCS = 10
UNIT = 1_000_000_000
#: Groups and terms (on average) of a block.
GROUPS = 32
TERMS = 4096
#: Counts that a task holds before it hands them on: about 100 MB.
HELD = 600_000
#: A held count is occurrences << DOCS_BITS | documents.
DOCS_BITS = 40


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums (occurrences, documents) by language, source and term; a null term stands for the group itself."""
    held: dict[tuple[str, str], dict[bytes, int]] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in held.items():
            counts = terms.values()
            n, docs = [0, *(x >> DOCS_BITS for x in counts)], [0, *(x & (1 << DOCS_BITS) - 1 for x in counts)]
            of_group = [pa.array([x], pa.string()).take(pa.array([0] * len(n))) for x in (lang, source)]
            columns = [*of_group, pa.array([None, *terms], pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        for lang, source, text in zip(langs, sources, batch.column(2), strict=True):
            terms = held.setdefault((lang, source), {})
            before = len(terms)
            for term, n in Counter(m.group() for m in TERM.finditer(text.as_py().lower())).items():
                terms[term] = terms.get(term, 0) + (n << DOCS_BITS) + 1
            size += len(terms) - before
            if size > HELD:
                yield from hand_on()
                size = 0
    yield from hand_on()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents by group and term, and one row of null term for each group."""
    arrow_settings(docs.sparkSession)
    named = [text_or_empty(F.col(c).cast("string")).alias(c) for c in ("lang", "source")]
    slim = docs.select(*named, text_or_empty("text").cast("binary").alias("text"))
    parts = slim.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: str, terms: str) -> Column:
    """1 + floor(1e9 (count + 2) / (total + 2 terms)), exact; 1 where there is no term."""
    wide = lambda c: c.cast("decimal(20,0)")
    above, below = F.lit(UNIT).cast("decimal(10,0)") * wide(count + 2), wide(F.col(total) + 2 * F.col(terms))
    return F.when(below == 0, F.lit(1).cast("long")).otherwise(1 + F.call_function("div", above, below))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _cell(groups: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Partial sums of each pair of groups, over terms that some group of the cell has, less what two groups without the term are apart."""
        lang, i, j = (k.as_py() for k in key[:3])
        head = table.filter(table.column("term_id").is_null())
        body = table.filter(table.column("term_id").is_valid())
        order = np.argsort(head.column("group_id").to_numpy())
        ids, none = head.column("group_id").to_numpy()[order], head.column("p").to_numpy()[order]
        terms, column = np.unique(body.column("term_id").to_numpy(), return_inverse=True)
        shares = np.repeat(none[:, None], len(terms), axis=1)
        shares[np.searchsorted(ids, body.column("group_id").to_numpy()), column] = body.column("p").to_numpy()
        left, right, part = [], [], []
        for a in np.flatnonzero(ids // groups == i).tolist():
            others = np.flatnonzero((ids // groups == j) & (ids > ids[a]))
            p, q = shares[others], shares[a]
            base = (none[others] - none[a]) ** 2 // (none[others] + none[a])
            left.append(np.full(len(others), ids[a]))
            right.append(ids[others])
            part.append(((p - q) ** 2 // (p + q)).sum(axis=1) - len(terms) * base)
        columns = [pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (left, right, part)]
        return pa.Table.from_arrays([pa.array([lang] * len(columns[0]), pa.string()), *columns], ["lang", "a", "b", "part"])

    return run


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = 10, groups: int = GROUPS, terms: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others, and by which terms.

    ``docs`` is (text, lang, source, ...); null text, lang and source are ''. Terms are runs of ASCII
    letters and characters beyond ASCII, only A-Z lowered; a language keeps those in at least
    ``least_docs`` of its documents. A group's share of a kept term is 1 + floor(1e9 (count + 2) /
    (N + 2 V)), N its occurrences of the V kept terms. Part ``pair`` has every other source of the
    language with the divergence summed over the kept terms (0 without any), part ``term`` the
    ``top_terms`` that the group has more of than its language. Ranks: value descending, item
    ascending by UTF-8 bytes. A language with one source has no pair. Repeated rows count as often
    as they occur, a document of one long term has one; extra columns are ignored; an empty table
    gives an empty result.
    """
    counts = stage(term_counts(docs), "term-counts")
    in_lang = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
    kept = in_lang.where(F.col("docs") >= least_docs).select("lang", "term", "in_lang", F.monotonically_increasing_id().alias("term_id"))
    kept = stage(kept, "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("of_lang"))
    found = stage(counts.where("term IS NOT NULL").drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = counts.where("term IS NULL").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    known = known.na.fill(0, ["terms", "of_lang", "total"])
    within = Window.partitionBy("lang")
    number = F.row_number().over(within.orderBy("source")) - 1
    known = known.withColumn("group_id", number.cast("long")).withColumn("blocks", F.ceil(F.count("*").over(within) / groups))
    none = _share(F.lit(0).cast("long"), "total", "terms").alias("none")
    known = stage(known.select("*", F.greatest(F.lit(1), F.ceil(F.col("terms") / terms)).alias("term_blocks"), none), "groups")
    shares = found.join(known.select("lang", "source", "group_id", "total", "terms", "of_lang", "blocks", "term_blocks"), ["lang", "source"])
    shares = shares.withColumn("p", _share(F.col("n"), "total", "terms"))

    term_block = F.pmod(F.xxhash64("term_id"), F.col("term_blocks"))
    slices = shares.select("lang", "group_id", "blocks", term_block.alias("t"), "term_id", "p")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    heads = known.select("lang", "group_id", "blocks", every("term_blocks").alias("t"), F.lit(None).cast("long").alias("term_id"), F.col("none").alias("p"))
    own = F.floor(F.col("group_id") / groups)
    sent = slices.unionByName(heads).withColumn("with", every("blocks"))
    sent = sent.select("lang", F.least(own, "with").alias("i"), F.greatest(own, "with").alias("j"), "t", "group_id", "term_id", "p")
    arrow_settings(docs.sparkSession)
    parts = sent.groupBy("lang", "i", "j", "t").applyInArrow(_cell(groups), "lang string, a long, b long, part long")
    sums = stage(parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part")), "pair-sums")

    of = lambda side: known.select("lang", F.col("group_id").alias(side), F.col("source").alias(f"source_{side}"), F.col("none").alias(f"none_{side}"))
    pairs = sums.join(of("a"), ["lang", "a"]).join(of("b").join(langs.select("lang", "terms"), "lang", "left"), ["lang", "b"])
    value = F.col("part") + F.coalesce("terms", F.lit(0)) * _apart(F.col("none_a"), F.col("none_b"))
    both = F.explode(F.array(*(F.struct(F.col(f"source_{x}").alias("source"), F.col(f"source_{y}").alias("item")) for x, y in ("ab", "ba"))))
    pairs = pairs.select("lang", value.alias("value"), both.alias("s")).select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value")
    tops = shares.withColumn("q", _share(F.col("in_lang"), "of_lang", "terms")).where("p > q")
    tops = tops.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(tops.withColumn("rank", rank).where(F.col("rank") <= top_terms))

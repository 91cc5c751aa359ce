"""Checks of ID-list tables. Each check is a query that returns the offending rows.

Rows come from :func:`kinmatch.sources.tables.read_lines`: ``(line, ord)``. All rows of a repeated
record are checked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SPACE
from ..session import stage
from ..sources import tables
from ..sources.tables import CANDIDATE_COLUMNS, LINK_COLUMNS

EXAMPLES = 5

# Rules in reporting order, and whether one fails the table.
RULES = (
    ("encoding", "error"),
    ("header", "error"),
    ("malformed", "error"),
    ("duplicate_rows", "error"),
    ("duplicate_ids", "error"),
    ("self_match", "error"),
    ("prefix", "error"),
    ("unknown_ids", "error"),
    ("missing_s1", "error"),
    ("extra_s1", "error"),
    ("subset", "warning"),
)


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def check_encoding(lines: DataFrame) -> DataFrame:
    """Lines that are not valid UTF-8."""
    return lines.where(~F.is_valid_utf8("line"))


def check_header(headers: DataFrame, expected: tuple[str, str] = LINK_COLUMNS) -> DataFrame:
    """Header lines that are not the two expected names: ``(line, problem)``."""
    names = F.transform(F.split("line", "\t"), lambda c: F.lower(_trim(c)))
    problem = F.when(
        ~F.contains("line", F.lit("\t")) & F.contains("line", F.lit(",")), "comma separated"
    ).when(F.array_join(names, "\t") != "\t".join(expected), "unexpected header")
    return headers.select("line", problem.alias("problem")).where(F.col("problem").isNotNull())


def check_empty(headers: DataFrame) -> DataFrame:
    """One row when there is not even a header."""
    return headers.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("file is empty").alias("problem"))


def check_malformed(lines: DataFrame) -> DataFrame:
    """Lines with text but no tab."""
    return lines.where(~F.contains("line", F.lit("\t")) & (_trim(F.col("line")) != ""))


def parse_rows(lines: DataFrame) -> DataFrame:
    """``(s1_id, ids, ord)`` of the lines that have a tab; a blank list has no IDs."""
    rest = F.substring(F.col("line"), F.instr("line", "\t") + 1, F.length("line"))
    return lines.where(F.contains("line", F.lit("\t"))).select(
        F.substring_index("line", "\t", 1).alias("s1_id"),
        F.when(_trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",")).alias("ids"),
        "ord",
    )


def check_duplicate_rows(rows: DataFrame) -> DataFrame:
    return rows.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def check_duplicate_ids(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select("s1_id").distinct()


def listed_ids(rows: DataFrame) -> DataFrame:
    return rows.select("s1_id", F.explode("ids").alias("c_id"))


def check_self_match(rows: DataFrame) -> DataFrame:
    return listed_ids(rows).where(F.col("c_id").startswith("S1-")).select("c_id").distinct()


def check_prefix(rows: DataFrame) -> DataFrame:
    """IDs of no source; an empty item between commas is one."""
    return listed_ids(rows).where(~F.col("c_id").rlike("^S[123]-")).select("c_id").distinct()


def check_unknown_ids(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Well-formed IDs that ``targets(entity_id)`` does not have."""
    asked = listed_ids(rows).where(F.col("c_id").rlike("^S[23]-")).select("c_id").distinct()
    return asked.join(targets.select(F.col("entity_id").alias("c_id")), "c_id", "left_anti")


def check_missing_s1(rows: DataFrame, required: DataFrame) -> DataFrame:
    return required.select(F.col("entity_id").alias("s1_id")).join(rows, "s1_id", "left_anti").distinct()


def check_extra_s1(rows: DataFrame, required: DataFrame) -> DataFrame:
    known = required.select(F.col("entity_id").alias("s1_id"))
    return rows.select("s1_id").join(known, "s1_id", "left_anti").distinct()


def check_subset(links: DataFrame, candidates: DataFrame) -> DataFrame:
    """Records with a linked ID that is not among their candidates.

    The candidates of a record move as one list, not as a row each. An ID that is null is among none.
    """
    known = listed_ids(candidates).groupBy("s1_id").agg(F.collect_set("c_id").alias("_known"))
    stray = F.exists("ids", lambda x: F.coalesce(~F.array_contains("_known", x), F.lit(True)))
    return links.where(F.size("ids") > 0).join(known, "s1_id", "left").where(stray).select("s1_id").distinct()


def list_summary(rows: DataFrame) -> DataFrame:
    empty = F.size("ids") == 0
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(empty).alias("n_empty"), F.count_if(~empty).alias("n_listed")
    )


def issue_examples(issues: DataFrame) -> DataFrame:
    """``issues(rule, item)`` as ``(rule, total, examples)``: distinct items and the first five.

    Each task keeps its own first five before anything moves.
    """
    items = issues.distinct()
    order = Window.partitionBy("rule").orderBy("item")
    first = (
        items.withColumn("at", F.row_number().over(order))
        .where(F.col("at") <= EXAMPLES)
        .groupBy("rule")
        .agg(F.array_join(F.sort_array(F.collect_list("item")), ", ").alias("examples"))
    )
    return items.groupBy("rule").agg(F.count(F.lit(1)).alias("total")).join(first, "rule")


def issues(
    lines: DataFrame,
    headers: DataFrame,
    required: DataFrame,
    targets: DataFrame | None = None,
    candidates: DataFrame | None = None,
    expected: tuple[str, str] = LINK_COLUMNS,
) -> DataFrame:
    """Every finding of every rule as ``(rule, item)``.

    The ID-existence rule runs only when ``targets`` is given, the subset rule only with parsed
    ``candidates``.
    """
    rows = parse_rows(lines)
    found = {
        "encoding": check_encoding(lines).select(F.make_valid_utf8("line")),
        "header": check_header(headers, expected).select("problem").unionByName(check_empty(headers)),
        "malformed": check_malformed(lines).select("line"),
        "duplicate_rows": check_duplicate_rows(rows).select("s1_id"),
        "duplicate_ids": check_duplicate_ids(rows),
        "self_match": check_self_match(rows),
        "prefix": check_prefix(rows),
        "missing_s1": check_missing_s1(rows, required).select("s1_id"),
        "extra_s1": check_extra_s1(rows, required),
    }
    if targets is not None:
        found["unknown_ids"] = check_unknown_ids(rows, targets)
    if candidates is not None:
        found["subset"] = check_subset(rows, candidates)
    tables = [df.toDF("item").select(F.lit(rule).alias("rule"), "item") for rule, df in found.items()]
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.unionByName(table)
    return merged


def validation_report(found: DataFrame, skipped: tuple[str, ...] = ()) -> DataFrame:
    """``(rule, severity, total, verdict)`` for every rule; ``verdict`` is that of the whole table.

    Only errors fail it. A skipped rule is reported with a total of -1.
    """
    totals = found.distinct().groupBy("rule").agg(F.count(F.lit(1)).alias("total"))
    rules = found.sparkSession.createDataFrame(list(RULES), "rule string, severity string")
    report = rules.join(totals, "rule", "left").withColumn(
        "total", F.when(F.col("rule").isin(*skipped), -1).otherwise(F.coalesce("total", F.lit(0)))
    )
    failed = F.max(((F.col("severity") == "error") & (F.col("total") > 0)).cast("int")).over(Window.partitionBy())
    return report.withColumn("verdict", F.when(failed == 1, "FAIL").otherwise("PASS"))


# ---------------------------------------------------------------- both files in one go

FILES = {"links": LINK_COLUMNS, "candidates": CANDIDATE_COLUMNS}


def line_findings(lines: DataFrame) -> DataFrame:
    """``(s1_id, ids, found)`` of every line, in one scan: ``found`` has a ``(rule, item)`` for each rule that the line breaks by itself.

    ``ids`` is null for lines without a tab.
    """
    tab, line = F.contains("line", F.lit("\t")), F.col("line")
    rest = F.substring(line, F.instr("line", "\t") + 1, F.length("line"))
    ids = F.when(tab & (_trim(rest) == ""), F.array().cast("array<string>")).when(tab, F.split(rest, ","))

    def finding(rule: str, item: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), item.alias("item"))

    def of_ids(rule: str, keep) -> Column:
        return F.transform(F.filter(F.coalesce("ids", F.array().cast("array<string>")), keep), lambda c: finding(rule, c))

    whole = F.array(
        F.when(~F.is_valid_utf8("line"), finding("encoding", F.make_valid_utf8("line"))),
        F.when(~tab & (_trim(line) != ""), finding("malformed", line)),
        F.when(F.size("ids") != F.size(F.array_distinct("ids")), finding("duplicate_ids", F.col("s1_id"))),
    )
    found = F.concat(
        F.array_compact(whole),
        of_ids("self_match", lambda c: c.startswith("S1-")),
        of_ids("prefix", lambda c: ~c.rlike("^S[123]-")),
    )
    parsed = lines.select("line", F.when(tab, F.substring_index("line", "\t", 1)).alias("s1_id"), ids.alias("ids"))
    return parsed.select("s1_id", "ids", found.alias("found"))


def _missing(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def validate(
    spark: SparkSession, links: str, required: DataFrame, candidates: str | None = None, targets: DataFrame | None = None
) -> DataFrame:
    """``(file, rule, severity, total, examples, verdict)`` of a link file and, if there is one, a candidate file.

    ``required(entity_id)`` are the records that each file needs once; ``targets(entity_id)`` turns
    the check on that listed IDs exist. A missing link file is an error, a missing candidate file a
    warning; a file without a good header is not looked at further. Rules that were not run have a
    total of -1. Only errors fail the whole.

    Each file is scanned once for what a line shows by itself. The other rules meet in three
    exchanges for both files together: by record, by listed ID, and by pair.
    """
    found, skipped, parsed = [], [("candidates", "subset")], {}
    for file, path in (("links", links), ("candidates", candidates)):
        if path is None or _missing(spark, path):
            if path is not None:
                found.append(spark.createDataFrame([(file, "missing_file", path)], "file string, rule string, item string"))
            skipped += [(file, rule) for rule, _ in RULES]
            continue
        headers, lines = tables.split_header(tables.read_lines(spark, path))
        bad = check_header(headers, FILES[file]).select("problem").unionByName(check_empty(headers))
        if not bad.isEmpty():
            found.append(bad.select(F.lit(file).alias("file"), F.lit("header").alias("rule"), F.col("problem").alias("item")))
            skipped += [(file, rule) for rule, _ in RULES if rule != "header"]
            continue
        parsed[file] = stage(line_findings(lines).withColumn("file", F.lit(file)), f"validate-{file}")
    if targets is None:
        skipped += [(file, "unknown_ids") for file in FILES]
    if len(parsed) < len(FILES):
        skipped.append(("links", "subset"))

    if parsed:
        rows = reduce(DataFrame.unionByName, parsed.values())
        found.append(rows.select("file", F.explode("found").alias("f")).select("file", "f.rule", "f.item"))
        names = list(parsed)
        listed = rows.where("ids IS NOT NULL")
        one = {file: F.count_if(F.col("file") == file).alias(f"in_{file}") for file in names}

        def findings(of: DataFrame, item: str, rules: dict[tuple[str, str], Column]) -> DataFrame:
            hits = [F.when(holds, F.struct(F.lit(f).alias("file"), F.lit(r).alias("rule"))) for (f, r), holds in rules.items()]
            return of.select(F.explode(F.array_compact(F.array(*hits))).alias("h"), F.col(item).alias("item")).select("h.file", "h.rule", "item")

        needed = required.select(F.lit("required").alias("file"), F.col("entity_id").alias("s1_id"))
        by_record = listed.select("file", "s1_id").unionByName(needed)
        by_record = by_record.groupBy("s1_id").agg(F.count_if(F.col("file") == "required").alias("needed"), *one.values())
        rules = {}
        for f in names:
            n = F.col(f"in_{f}")
            rules |= {(f, "duplicate_rows"): n > 1, (f, "missing_s1"): (n == 0) & (F.col("needed") > 0), (f, "extra_s1"): (n > 0) & (F.col("needed") == 0)}
        found.append(findings(by_record, "s1_id", rules))

        ids = listed.select("file", "s1_id", F.explode("ids").alias("c_id"))
        if targets is not None:
            known = targets.select(F.lit("known").alias("file"), F.col("entity_id").alias("c_id"))
            by_id = ids.where(F.col("c_id").rlike("^S[23]-")).select("file", "c_id").unionByName(known)
            by_id = by_id.groupBy("c_id").agg(F.count_if(F.col("file") == "known").alias("known"), *one.values())
            found.append(findings(by_id, "c_id", {(f, "unknown_ids"): (F.col(f"in_{f}") > 0) & (F.col("known") == 0) for f in names}))
        if len(names) == len(FILES):
            by_pair = ids.groupBy("s1_id", "c_id").agg(*one.values())
            found.append(findings(by_pair, "s1_id", {("links", "subset"): (F.col("in_links") > 0) & (F.col("in_candidates") == 0)}))

    everything = stage(reduce(DataFrame.unionByName, found).distinct(), "findings")
    order = Window.partitionBy("file", "rule").orderBy("item")
    first = everything.withColumn("at", F.row_number().over(order)).where(F.col("at") <= EXAMPLES)
    first = first.groupBy("file", "rule").agg(F.array_join(F.sort_array(F.collect_list("item")), ", ").alias("examples"))
    totals = everything.groupBy("file", "rule").agg(F.count(F.lit(1)).alias("n")).join(first, ["file", "rule"])
    rules = [(f, r, "warning" if (f, r) == ("candidates", "missing_file") else severity) for f in FILES for r, severity in (("missing_file", "error"), *RULES)]
    report = spark.createDataFrame(rules, "file string, rule string, severity string").join(totals, ["file", "rule"], "left")
    off = F.concat_ws(" ", "file", "rule").isin(*(f"{f} {r}" for f, r in skipped))
    report = report.withColumn("total", F.coalesce("n", F.when(off, -1).otherwise(0).cast("long"))).fillna("", ["examples"])
    failed = F.max(((F.col("severity") == "error") & (F.col("total") > 0)).cast("int")).over(Window.partitionBy())  # one row a rule
    return report.select("file", "rule", "severity", "total", "examples", F.when(failed == 1, "FAIL").otherwise("PASS").alias("verdict"))

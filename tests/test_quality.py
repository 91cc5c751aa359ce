import pytest

from kinmatch.operators import quality
from kinmatch.sources import tables

LINES = [
    "source1_entity_id\tmatched_entity_ids",
    "S1-1\tS2-1,S3-1",
    "S1-1\tS2-1",
    "S1-2\tS2-1,S2-1",
    "S1-3\tS1-9",
    "S1-4\tX9-1",
    "S1-5\tS2-1,,S3-1",
    "S1-6\tS2-77",
    "S1-99\t",
    "S1-8 S2-1",
    "",
    "S1-9\t  ",
]


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("q") / "links.tsv"
    path.write_text("\n".join(LINES) + "\n")
    headers, lines = tables.split_header(tables.read_lines(spark, str(path)))
    required = spark.createDataFrame([(f"S1-{i}",) for i in range(1, 10)], "entity_id string")
    targets = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    candidates = spark.createDataFrame([(f"S1-{i}", ["S2-1"]) for i in range(1, 10)], "s1_id string, ids array<string>")
    return headers, lines, required, targets, candidates


def test_every_rule(world):
    headers, lines, required, targets, candidates = world
    found = quality.issues(lines, headers, required, targets, candidates)
    got = {}
    for row in found.collect():
        got.setdefault(row.rule, set()).add(row.item)
    assert got == {
        "malformed": {"S1-8 S2-1"},
        "duplicate_rows": {"S1-1"},
        "duplicate_ids": {"S1-2"},
        "self_match": {"S1-9"},
        "prefix": {"X9-1", ""},
        "unknown_ids": {"S2-77"},
        "missing_s1": {"S1-7", "S1-8"},
        "extra_s1": {"S1-99"},
        "subset": {"S1-1", "S1-3", "S1-4", "S1-5", "S1-6"},
    }
    report = {r.rule: r for r in quality.validation_report(found).collect()}
    assert report["prefix"].total == 2 and report["header"].total == 0 and report["header"].verdict == "FAIL"
    examples = {r.rule: r.examples for r in quality.issue_examples(found).collect()}
    assert examples["subset"] == "S1-1, S1-3, S1-4, S1-5, S1-6"


def test_warnings_do_not_fail(spark, world):
    only = spark.createDataFrame([("subset", "S1-1")], "rule string, item string")
    report = quality.validation_report(only, skipped=("unknown_ids",)).collect()
    assert {r.verdict for r in report} == {"PASS"}
    assert {r.rule: r.total for r in report}["unknown_ids"] == -1


def test_summary(world):
    row = quality.list_summary(quality.parse_rows(world[1])).first()
    assert tuple(row) == (9, 2, 7)


@pytest.mark.parametrize(
    "content,problem",
    [
        ("Source1_Entity_ID \tmatched_entity_ids\nS1-1\t\n", None),
        ("source1_entity_id,matched_entity_ids\nS1-1,\n", "comma separated"),
        ("id\tmatches\n", "unexpected header"),
        ("source1_entity_id\n", "unexpected header"),
    ],
)
def test_header(spark, tmp_path, content, problem):
    path = tmp_path / "x.tsv"
    path.write_text(content)
    headers, _ = tables.split_header(tables.read_lines(spark, str(path)))
    assert [r.problem for r in quality.check_header(headers).collect()] == ([problem] if problem else [])


def test_empty_file_and_bad_bytes(spark, tmp_path):
    path = tmp_path / "empty.tsv"
    path.write_text("")
    headers, _ = tables.split_header(tables.read_lines(spark, str(path)))
    assert quality.check_empty(headers).count() == 1
    latin = tmp_path / "latin.tsv"
    latin.write_bytes("source1_entity_id\tmatched_entity_ids\nS1-é\t\n".encode("latin-1"))
    assert quality.check_encoding(tables.read_lines(spark, str(latin))).count() == 1


def report(df):
    rows = df.collect()
    return {(r.file, r.rule): r.total for r in rows if r.total}, {r.verdict for r in rows}, {(r.file, r.rule): r.examples for r in rows}


def test_validate_both_files(spark, world, tmp_path):
    *_, required, targets, _ = world
    links, lists = tmp_path / "links.tsv", tmp_path / "lists.tsv"
    links.write_text("\n".join(LINES) + "\n")
    lists.write_text("source1_entity_id\tcandidate_entity_ids\n" + "".join(f"S1-{i}\tS2-1\n" for i in range(1, 10)))
    totals, verdict, examples = report(quality.validate(spark, str(links), required, str(lists), targets))
    assert totals == {
        ("links", "malformed"): 1, ("links", "duplicate_rows"): 1, ("links", "duplicate_ids"): 1, ("links", "self_match"): 1,
        ("links", "prefix"): 2, ("links", "unknown_ids"): 1, ("links", "missing_s1"): 2, ("links", "extra_s1"): 1,
        ("links", "subset"): 5, ("candidates", "subset"): -1,
    }
    assert verdict == {"FAIL"} and examples["links", "subset"] == "S1-1, S1-3, S1-4, S1-5, S1-6"
    good = tmp_path / "good.tsv"
    good.write_text("Source1_Entity_ID\t matched_entity_ids\n" + "".join(f"S1-{i}\t{'S2-1' if i < 5 else ''}\n" for i in range(1, 10)))
    totals, verdict, _ = report(quality.validate(spark, str(good), required, str(lists), targets))
    assert totals == {("candidates", "subset"): -1} and verdict == {"PASS"}


def test_validate_missing_and_bad_files(spark, world, tmp_path):
    *_, required, _, _ = world
    rules = [r for r, _ in quality.RULES]
    good = tmp_path / "good.tsv"
    good.write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\t\n" for i in range(1, 10)))
    off = {("candidates", r): -1 for r in rules} | {("links", "subset"): -1, ("links", "unknown_ids"): -1}
    totals, verdict, _ = report(quality.validate(spark, str(good), required))
    assert totals == off and verdict == {"PASS"}
    totals, verdict, _ = report(quality.validate(spark, str(good), required, str(tmp_path / "none.tsv")))
    assert totals == off | {("candidates", "missing_file"): 1} and verdict == {"PASS"}
    totals, verdict, _ = report(quality.validate(spark, str(tmp_path / "none.tsv"), required))
    assert totals["links", "missing_file"] == 1 and totals["links", "missing_s1"] == -1 and verdict == {"FAIL"}
    for name, text, problem in (("a", "", "file is empty"), ("b", "source1_entity_id,matched_entity_ids\nS1-1,S2-1\n", "comma separated")):
        (tmp_path / name).write_text(text)
        totals, verdict, examples = report(quality.validate(spark, str(tmp_path / name), required))
        assert totals["links", "header"] == 1 and totals["links", "malformed"] == -1 and verdict == {"FAIL"}
        assert examples["links", "header"] == problem

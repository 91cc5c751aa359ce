import random

import pandas as pd
import pytest

from kinmatch.sources import quoted, tables

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


@pytest.fixture()
def tiny_splits(spark):
    key, pack = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key), spark.conf.get(pack)
    spark.conf.set(key, "97b")
    spark.conf.set(pack, "1b")
    yield
    spark.conf.set(key, before[0])
    spark.conf.set(pack, before[1])


def rows(table):
    return [tuple(r) for r in table.orderBy("ord").drop("ord").collect()]


def by_pandas(path):
    frame = pd.read_csv(path, sep="\t", encoding="utf-8", dtype=str, keep_default_na=False)
    return [tuple(r) for r in frame.itertuples(index=False)]


def made_up(seed):
    """Fields with breaks, doubled quotes, tabs in quotes, quotes inside plain fields, and breaks longer than a split."""
    rng = random.Random(seed)
    pieces = ["a", "bc", " ", "é", "हि", "\n", '"', "\t", "\n\n", "x" * 40, "\n" + "y" * 150 + "\n"]
    lines = []
    for i in range(80):
        fields = [f"S1-{i}"]
        for _ in range(3):
            text = "".join(rng.choices(pieces, [9, 9, 5, 2, 2, 2, 2, 1, 1, 1, 0.5], k=rng.randint(0, 6)))
            plain = not any(c in text for c in '\n\t"') or rng.random() < 0.1
            fields.append("z" + text.replace("\n", "").replace("\t", "") if plain else '"' + text.replace('"', '""') + '"')
        lines.append("\t".join(fields))
    return HEAD + "\n".join(lines) + "\n"


@pytest.mark.parametrize("seed", range(3))
def test_equals_pandas(spark, tiny_splits, tmp_path, seed):
    path = tmp_path / "s.tsv"
    path.write_text(made_up(seed), encoding="utf-8")
    assert quoted.read_records(spark, str(path)).select("ord.block").distinct().count() > 10
    assert rows(tables.read_source(spark, str(path), quoted_breaks=True)) == by_pandas(path)


def test_several_files_and_odd_lines(spark, tiny_splits, tmp_path):
    texts = ["\n" + HEAD + 'S1-1\t"a\nb"\tc"d\tUS\n\n   \nS1-2\tx "y\t\tUS', HEAD, HEAD + 'S1-3\t"q ""r""\n"\t"s"t\tFR\r\n', ""]
    paths = []
    for k, text in enumerate(texts):
        paths.append(str(tmp_path / f"s{k}.tsv"))
        (tmp_path / f"s{k}.tsv").write_bytes(text.encode())
    got = rows(tables.read_source(spark, paths, quoted_breaks=True))
    assert got[:2] == by_pandas(paths[0]) == [("S1-1", "a\nb", 'c"d', "US"), ("S1-2", 'x "y', "", "US")]
    assert got[2:] == [("S1-3", 'q "r"\n', '"s"t', "FR")]  # text after a closing quote stays as the CSV reader keeps it


def test_open_quote_at_the_end_fails(spark, tiny_splits, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text(HEAD + "".join(f"S1-{i}\tname\taddress\tUS\n" for i in range(30)) + 'S1-99\t"open\tx\tUS\n')
    with pytest.raises(Exception, match="ends inside a quoted field"):
        tables.read_source(spark, str(path), quoted_breaks=True).collect()

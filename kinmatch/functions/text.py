"""Text normalisation and tokenising as column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Long form -> short form.
ABBREVIATIONS = {
    "corporation": "corp",
    "incorporated": "inc",
    "company": "co",
    "limited": "ltd",
    "private": "pvt",
    "road": "rd",
    "street": "st",
    "avenue": "ave",
    "boulevard": "blvd",
    "hospital": "hosp",
}

# Every Unicode space; the engine's own \s knows the ASCII ones only.
SPACE = r"\s\p{Z}\x85\x0B\x1C-\x1F"
WORD = r"\p{L}\p{N}_"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def _squash(raw: Column) -> Column:
    """Lower case, '&' spelled out, ASCII punctuation and spaces folded to single spaces."""
    spelled = F.replace(F.lower(F.coalesce(raw, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, rf"[\p{{Punct}}{SPACE}]+", " "))


def _abbreviate(text: Column, edge: str) -> Column:
    short = text
    for long, brief in ABBREVIATIONS.items():
        short = F.regexp_replace(short, f"(?<!{edge}){long}(?!{edge})", brief)
    # most values hold no long form at all: one scan decides
    return F.when(text.rlike("|".join(ABBREVIATIONS)), short).otherwise(text)


def normalize_tokens(raw: Column) -> Column:
    """Normalise; a long form counts only as a whole space-separated token."""
    return _abbreviate(_squash(raw), "[^ ]")


def normalize(raw: Column) -> Column:
    """Normalise; a long form counts wherever it stands between word edges. Used by the pipeline."""
    return _abbreviate(_squash(raw), f"[{WORD}]")


def normalize_country(raw: Column) -> Column:
    return F.lower(_strip(F.coalesce(raw, F.lit(""))))


def blocking_text(nn: Column, na: Column) -> Column:
    """Normalised name twice, then the address; whichever is there when one is empty."""
    both = F.concat_ws(" ", nn, nn, na)
    return F.when((nn != "") & (na != ""), both).when(nn != "", nn).otherwise(na)


def blocking_text_column(nn: Column, na: Column) -> Column:
    """The plain form: name, name, address joined and trimmed, even when a part is empty."""
    return F.trim(F.concat_ws(" ", nn, nn, na))


def source_of(entity_id: Column) -> Column:
    return F.substring_index(entity_id, "-", 1)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"([{WORD}]{{2,}})"), F.lit(1))


def padded_words(text: Column) -> Column:
    """Each word with one space on both sides."""
    return F.transform(
        F.array_remove(F.split(text, f"[{SPACE}]+"), ""), lambda w: F.concat(F.lit(" "), w, F.lit(" "))
    )


def _with_pairs(toks: Column) -> Column:
    """The words, and every pair of neighbours among them."""
    followed = F.greatest(F.size(toks) - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice(toks, F.lit(1), followed),
        F.slice(toks, F.lit(2), followed),
        lambda left, right: F.concat_ws(" ", left, right),
    )
    return F.concat(toks, pairs)


def _trigrams(padded: Column) -> Column:
    return F.flatten(
        F.transform(
            padded,
            lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))),
        )
    )


def explode_terms(df: DataFrame, keep: list[str], text: str, analyzer: str) -> DataFrame:
    """One row per term occurrence of ``text``: ``(keep..., term)``.

    'word' gives words of two or more characters and pairs of neighbours, 'char' the trigrams
    inside padded words. The text is split in a step of its own, so once per row.
    """
    split, expand = {"word": (words, _with_pairs), "char": (padded_words, _trigrams)}[analyzer]
    split_rows = df.select(*keep, split(F.col(text)).alias("_toks"))
    return split_rows.select(*keep, F.explode(expand(F.col("_toks"))).alias("term"))

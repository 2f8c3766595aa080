"""Column functions for text: stripping, the three coalescing flavours, cleaning and keyword matching."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The cleaning patterns, applied in this order: markup, emoji and control characters, then white space, then repeated marks.
TAGS = r"<[^>]+>"
EMOJI = r"\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}"
GARBLED = r"\x00-\x08\x0B\x0C\x0E-\x1F\x{FFFD}"
BLANK = r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
MARKS = "，。！？、；：,.!?;:'\""
REPEATED_MARK = rf"([{MARKS}])\1+"
EDGES = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


def strip(c: Column) -> Column:
    """Without white space of any script at both ends. Spark's trim knows the blank only."""
    return F.regexp_replace(c, EDGES, "")


def safe_text(c: Column) -> Column:
    """Null becomes empty, all else is stripped."""
    return F.coalesce(strip(c.cast("string")), F.lit(""))


def first_truthy(*columns: Column) -> Column:
    """The first that is neither null nor empty nor 0, else empty."""
    return F.coalesce(*[F.nullif(F.nullif(c.cast("string"), F.lit("")), F.lit("0")) for c in columns], F.lit(""))


def first_present(*columns: Column) -> Column:
    """The first that is not null, stripped; it may be empty."""
    return F.coalesce(*[strip(c.cast("string")) for c in columns], F.lit(""))


def first_nonblank(*columns: Column) -> Column:
    """The first that has more than white space, stripped, else empty."""
    return F.coalesce(*[F.nullif(strip(c.cast("string")), F.lit("")) for c in columns], F.lit(""))


def clean_text(c: Column) -> Column:
    """Tags, emoji and control characters become blanks, white space shrinks to one blank, runs of one mark to the mark. Null becomes empty."""
    # Printable ASCII fails the first range of a class, so that most characters are not tested against all ranges.
    blank, other = rf"[[^!-~]&&[ \t-\r{BLANK}]]", rf"[[^ -~]&&[\t-\r{BLANK}]]"
    out = F.regexp_replace(F.coalesce(c, F.lit("")), rf"{TAGS}|[[^ -~]&&[{EMOJI}{GARBLED}]]+", " ")
    # A single blank, which most white space is, needs no replacement.
    out = F.trim(F.regexp_replace(out, rf" {blank}+|{other}{blank}*", " "))

    def single(t: Column) -> Column:
        doubled = functools.reduce(Column.__or__, [F.contains(t, F.lit(m * 2)) for m in MARKS])
        return F.when(doubled, F.trim(F.regexp_replace(t, REPEATED_MARK, "$1"))).otherwise(t)

    return F.transform(F.array(out), single)[0]  # a variable, so that the text is computed once


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """df with more columns, each computed once a row: out of a generator, so that the optimizer doesn't copy them into what is built on them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_clean_text(texts: DataFrame, text_col: str, out: str) -> DataFrame:
    """texts with their cleaned text in `out`, those without any left out.

    The cleaned text comes out of a generator, so that the optimizer doesn't copy its expression into the filter and into what is built on it.
    """
    return texts.select("*", F.inline(F.array(F.struct(clean_text(F.col(text_col)).alias(out))))).filter(F.col(out) != "")


def matched(c: Column, terms: Sequence[str], low: Column | None = None) -> Column:
    """The terms that occur in the text, in the order given; with its lower-case form `low` also those that occur in that."""
    if low is not None and all(t == t.lower() for t in terms):
        c, low = low, None  # such a term is in both or in the latter only
    return F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(c, t) if low is None else F.contains(c, t) | F.contains(low, t))


def contains_any(c: Column, terms: Sequence[str]) -> Column:
    return F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(c, t))


def by_length(terms: Column) -> Column:
    """Terms in descending length, equal lengths in code point order."""
    return F.transform(F.array_sort(F.transform(terms, lambda t: F.struct((-F.length(t)).alias("n"), t.alias("t")))), lambda s: s["t"])


def joined(terms: Column) -> Column:
    return F.concat_ws(" | ", terms)

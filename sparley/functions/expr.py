"""Column expressions shared by rules, checks and plans. No Python runs on executors.

White space is every character of [\\s\\p{Z}], in Java's and RE2's reading alike.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import BLANKS

SPACE, SOLID = r"[\s\p{Z}]", r"[^\s\p{Z}]"
DATE_FORMATS = ("yyyy년M월d일", "yyyy年M月d日", "yyyy-M-d", "yyyyMMdd")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(col(c), f"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column | str, sentinels: Sequence[str] = BLANKS) -> Column:
    """Null, white space only, or a text that stands for a missing value."""
    return F.coalesce(strip(c).isin(*sentinels), F.lit(True))


def null_if_blank(c: Column | str, sentinels: Sequence[str] = BLANKS) -> Column:
    return F.when(~is_blank(c, sentinels), col(c))


def normalize_text(c: Column | str) -> Column:
    """Runs of spaces become one; null stays null."""
    return strip(F.regexp_replace(col(c), "  +", " "))


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A date, or null, after dropping a closing (...) and all spaces."""
    bare = F.regexp_replace(F.regexp_replace(col(c), rf"\([^)]*\){SPACE}*$", ""), f"{SPACE}+", "")
    return F.coalesce(*(F.try_to_date(bare, f) for f in formats))


def date_text(c: Column | str) -> Column:
    """yyyy-MM-dd where the text is a date, else the text."""
    return F.coalesce(F.date_format(parse_date(c), "yyyy-MM-dd"), col(c))


def first_match(rules: Iterable[tuple[Column, Column | str]], otherwise: Column | str | None = None) -> Column:
    """The value of the first rule whose condition is true; null conditions are false."""
    out = None
    for condition, value in rules:
        value = F.lit(value) if isinstance(value, str) else value
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(F.lit(otherwise) if otherwise is None or isinstance(otherwise, str) else otherwise)


def first_pattern(c: Column | str, patterns: Sequence[tuple[str, str]]) -> Column:
    """The label of the first pattern found in a text, or null."""
    return first_match((col(c).rlike(p), label) for p, label in patterns)


def mapped(c: Column | str, table: Mapping[str, str] | Sequence[tuple[str, str]]) -> Column:
    """The value of a small table, or the text itself."""
    pairs = table.items() if isinstance(table, Mapping) else table
    entries = F.create_map(*(F.lit(x) for pair in pairs for x in pair))
    return F.coalesce(F.try_element_at(entries, col(c)), col(c))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of a pattern; null where there is no match."""
    return F.when(col(c).rlike(pattern), F.regexp_extract(col(c), pattern, group))


def padded(c: Column | str, width: int = 6) -> Column:
    """Zeros in front up to a width; longer keys stay whole."""
    key = col(c).cast("string")
    return F.when(F.length(key) < width, F.lpad(key, width, "0")).otherwise(key)


def flag(c: Column | str, yes: str = "Y") -> Column:
    """True for yes; anything else, null too, is false."""
    return F.coalesce(col(c) == yes, F.lit(False))


def number(c: Column | str) -> Column:
    return col(c).try_cast("double")


def joined(*parts: Column | str) -> Column:
    """The parts that aren't null, with single spaces between, stripped."""
    return strip(F.concat_ws(" ", *map(col, parts)))

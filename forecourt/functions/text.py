"""Text cleaning as Column expressions. Missing is always NULL, never 0 or an empty text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TOKENS = ("", "-", "--", "暂无", "无", "面议", "待定", "null", "None", "nan", "NaN", "未披露")

# Fixed value: what a text that needs no squeezing is free of: all but ASCII signs, blanks, common Chinese letters and signs beyond the basic plane,
# none of which is white space. Written as what it is: searching for a negated class takes many times as long.
UNEVEN = r"[\x00-\x1f\x7f-\u4dff\ua000-\uffff]"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: str | Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once: a lambda's variable is never copied. It is evaluated outside generated code, and keeps
    its projection out of whole-stage code. For rules over many fields that is a gain: there they make one method of over 8,000
    bytes, which the JVM never compiles, so all of it runs many times slower. By itself a projection is cut into small methods."""
    return F.element_at(F.transform(F.array(as_column(value)), body), 1)


def blank_to_null(c: str | Column) -> Column:
    return let(c, lambda t: F.when(t != "", t))  # nullif() would put its argument into one more projection of whole-stage code


def extract(c: str | Column, pattern: str, group: int = 0) -> Column:
    """A group of the first match, NULL where nothing matches (regexp_extract gives an empty text there)."""
    return blank_to_null(F.regexp_extract(as_column(c), pattern, group))


def clean_text(c: str | Column) -> Column:
    """Runs of white space (full-width blanks too) become one blank, ends are trimmed, null tokens become NULL."""
    text = F.trim(F.regexp_replace(as_column(c).cast("string"), r"(?U)[\s　]+", " "))
    return let(text, lambda t: F.when(~t.isin(*NULL_TOKENS), t))


def squeeze(c: str) -> Column:
    """clean_text() of a column but for the null tokens; texts that hold no blanks but single ones within stay as they are. Without a lambda:
    known() of it, in the next projection, completes it."""
    text = F.col(c).cast("string")
    blanks = text.contains("  ") | text.startswith(" ") | text.endswith(" ")
    return F.when(blanks | text.rlike(UNEVEN), F.trim(F.regexp_replace(text, r"(?U)[\s　]+", " "))).otherwise(text)


def known(c: str) -> Column:
    """A squeezed text, NULL for null tokens."""
    return F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c))


def is_missing(c: str | Column) -> Column:
    return clean_text(c).isNull()


def city_of(t: Column) -> Column:
    """A cleaned text without one trailing 市, 区 or 县."""
    return blank_to_null(F.regexp_replace(t, "[市区县]$", ""))


def clean_city(c: str | Column) -> Column:
    return city_of(clean_text(c))


def relative_url(base: str | Column, href: str | Column) -> Column:
    """Absolute links pass; others are joined to the base with one slash (without a base they pass too)."""
    return let(clean_text(href), lambda link: absolute(base, link))


def absolute(base: str | Column, link: Column) -> Column:
    """relative_url() of a cleaned link."""
    base = as_column(base)
    joined = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.ltrim(link, F.lit("/")))
    return F.when(link.rlike("^(https?|file|local)://") | base.isNull() | (base == ""), link).otherwise(joined)

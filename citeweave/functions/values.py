"""Value rules as pure Column functions: fall-through, null printing, integer parsing, white space."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, with the separators that Java leaves out.
BLANK = r"(?U)[\s\x1c-\x1f]"


def truthy(c: Column, kind: str = "string") -> Column:
    """False for null and for the kind's empty value: '' , 0, or an array of no elements."""
    test = {"string": lambda: c != "", "number": lambda: c != 0, "array": lambda: F.size(c) > 0}[kind]()
    return F.coalesce(test, F.lit(False))


def first_truthy(*columns: Column, kind: str = "string") -> Column:
    """The first operand that is truthy, or the last operand whatever it is."""
    return reduce(lambda rest, c: F.when(truthy(c, kind), c).otherwise(rest), reversed(columns[:-1]), columns[-1])


def or_none(c: Column) -> Column:
    """A value as text, with null printed as None."""
    return F.coalesce(c.cast("string"), F.lit("None"))


def or_empty(c: Column, kind: str = "string") -> Column:
    return F.when(truthy(c, kind), c.cast("string")).otherwise(F.lit(""))


def try_int(c: Column, to: str = "bigint") -> Column:
    """Digits with an optional sign, trimmed; anything else is null."""
    text = F.regexp_replace(c, rf"^(?:{BLANK})+|(?:{BLANK})+$".replace("(?U)", ""), "")
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast(to))


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{BLANK}+", " "))


def strip_set(c: Column, characters: str) -> Column:
    return F.btrim(c, F.lit(characters))


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    """The first match's group, null without a match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))

"""Small building blocks of the column functions. None of them raises on bad input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that a number in text can't have but the cast would take, as in '5d', 'NaN', '0x1p3' and around it.
_NOT_IN_NUMBERS = "dDfFnNiIxXpP" + "".join(map(chr, [*range(1, 9), *range(14, 32)]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it, also in lambdas and branches; keeps long rules out of one generated method."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text(col: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(col, F.lit(""))


def blank(col: Column) -> Column:
    return F.trim(text(col)) == ""


def some(col: Column) -> Column:
    """Empty text becomes null, so that ``coalesce`` passes over it."""
    return F.when(col != "", col)


def rest_of(col: Column) -> Column:
    """All but the first character."""
    return F.substring(col, F.lit(2), F.length(col))


def take(col: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null if there is none or it is empty."""
    return some(F.regexp_extract(text(col), pattern, group))


def take_any(col: Column, patterns: list[str], group: int = 1) -> Column:
    """The group of the first pattern that matches, else empty text."""
    return F.coalesce(*(take(col, p, group) for p in patterns), F.lit(""))


def number(col: Column) -> Column:
    """Digits with a sign, point or exponent, else null. The column stands in it only once, so a chain of rules is not worked out again for a guard."""
    return F.translate(col, _NOT_IN_NUMBERS, "?" * len(_NOT_IN_NUMBERS)).try_cast("double")


def contains_any(col: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(col, F.lit(w))
    return out


def choose(rules: list[tuple[Column, object]], default: Column) -> Column:
    """The value of the first rule that holds."""
    out = default
    for cond, value in reversed(rules):
        out = F.when(cond, value if isinstance(value, Column) else F.lit(value)).otherwise(out)
    return out


def lookup(col: Column, table: dict[str, str]) -> Column:
    """Value of a literal map, null for other keys."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col)


def plain_spaces(col: Column) -> Column:
    """No-break spaces become spaces; ``\\s`` knows only the ASCII ones."""
    return F.translate(text(col), "\u00a0\u202f", "  ")

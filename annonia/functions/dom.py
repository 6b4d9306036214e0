"""Selectors over the elements of a parsed page, as column expressions.

A page is an array of elements in document order (``sources.html``). The subtree of an element is the run of
places from its own to its ``end``, so whether one stands in another is a comparison of numbers, and
whether an ancestor fits is a look at the flags of its ``path``. Each step of a selector turns the flags of
the step before into those of its own in one pass over the array, so work grows with elements times depth.

Selectors: tags, ``*``, ``#id``, ``.class``, ``[a]``, ``[a=v]``, ``[a^=v]``, ``[a*=v]``, ``[a$=v]``, ``[a~=v]``,
``:first-child``, ``:last-child``, ``:nth-child(n)``, ``:nth-of-type(n)``; blank, ``>``, ``+`` and ``~`` between steps;
commas between alternatives. Others raise ValueError. Null arrays select nothing."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from .base import let

_PART = re.compile(
    r"""\s*(?P<rel>[>+~])\s*|(?P<blank>\s+)|(?P<tag>\*|[A-Za-z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)"""
    r"""|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[\^$*~]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]"""
    r"""|:(?P<order>first-child|last-child|nth-child|nth-of-type)(?:\((?P<n>\d+)\))?""",
    re.X,
)
Fits = Callable[[Column], Column]
Steps = list[tuple[str, list["Test"]]]


class Test(NamedTuple):
    """What one part of a compound selector asks of an element: ``kind`` is tag, id, class, attr, last, nth or nth_of_tag."""

    kind: str
    value: str | int = ""
    name: str = ""
    op: str | None = None


def _test(m: re.Match) -> Test:
    if m["tag"]:
        return Test("tag", m["tag"].lower())
    if m["id"] or m["cls"]:
        return Test("id", m["id"]) if m["id"] else Test("class", m["cls"])
    if m["order"]:
        n = int(m["n"] or 1)
        return {"first-child": Test("nth", 1), "last-child": Test("last"), "nth-child": Test("nth", n), "nth-of-type": Test("nth_of_tag", n)}[m["order"]]
    return Test("attr", next((m[k] for k in ("dq", "sq", "bare") if m[k] is not None), ""), m["attr"].lower(), m["op"])


def _fits(test: Test) -> Fits:
    """A test as a column expression."""
    kind, value, name, op = test
    if kind in ("tag", "id", "nth", "nth_of_tag"):
        return lambda e: F.lit(True) if value == "*" and kind == "tag" else e[kind] == value
    if kind == "class":
        return lambda e: F.array_contains(e["classes"], value)
    if kind == "last":
        return lambda e: e["last"]
    got = lambda e: F.try_element_at(e["attrs"], F.lit(name))
    if op in ("^=", "*=", "$=", "~=") and not value:
        return lambda e: F.lit(False)
    tests: dict[str | None, Fits] = {
        None: lambda e: got(e).isNotNull(),
        "=": lambda e: got(e) == value,
        "^=": lambda e: F.startswith(got(e), F.lit(value)),
        "$=": lambda e: F.endswith(got(e), F.lit(value)),
        "*=": lambda e: F.contains(got(e), F.lit(value)),
        "~=": lambda e: F.array_contains(F.split(got(e), r"\s+"), value),
    }
    return tests[op]


@lru_cache(1024)
def value_test(test: Test) -> Callable[[str], bool]:
    """What a test asks of an attribute's value, in Python."""
    value, op = test.value, test.op
    if op is None or op == "=":
        return (lambda got: got == value) if op else lambda got: True
    if not value:
        return lambda got: False
    if op == "~=":
        return lambda got: value in re.split(r"[ \t\n\x0b\f\r]+", got)
    return {"^=": lambda got: got.startswith(value), "$=": lambda got: got.endswith(value), "*=": lambda got: value in got}[op]


def _held(test: Test, elements: list[dict]) -> list[bool]:
    """A test of elements in Python."""
    kind, value, name, _ = test
    if kind == "attr":
        fits = value_test(test)
        return [name in e["attrs"] and fits(e["attrs"][name]) for e in elements]
    if kind == "class":
        return [value in e["classes"] for e in elements]
    if kind == "last" or value == "*" and kind == "tag":
        return [kind == "tag" or e["last"] for e in elements]
    return [e[kind] == value for e in elements]


def _steps(selector: str) -> Steps:
    """(relation to the step before, tests) of each step."""
    steps: Steps = [("", [])]
    at, selector = 0, selector.strip()
    while at < len(selector):
        m = _PART.match(selector, at)
        if not m:
            raise ValueError(f"selector not understood at {selector[at:]!r}")
        if m["rel"] or m["blank"]:
            steps.append((m["rel"] or " ", []))
        else:
            steps[-1][1].append(_test(m))
        at = m.end()
    if not all(tests for _, tests in steps):
        raise ValueError(f"selector with an empty step: {selector!r}")
    return steps


@lru_cache(1024)
def alternatives(selector: str) -> list[Steps]:
    """The steps of each alternative; commas inside brackets don't part them."""
    return [_steps(s) for s in re.split(r",(?![^\[]*\])", selector)]


def _flags(elements: Column, steps: Steps) -> Column:
    """Whether each element fits the last step."""
    relation, tests = steps[-1][0], [_fits(t) for t in steps[-1][1]]

    def fits(e: Column) -> Column:
        out = tests[0](e)
        for t in tests[1:]:
            out = out & t(e)
        return F.coalesce(out, F.lit(False))

    if len(steps) == 1:
        return F.transform(elements, fits)
    related = {
        " ": lambda e, before: F.exists(e["path"], lambda p: F.get(before, p)),
        ">": lambda e, before: F.coalesce(F.get(before, e["parent"]), F.lit(False)),
        "+": lambda e, before: F.coalesce(F.get(before, e["prev"]), F.lit(False)),
    }
    if relation == "~":
        # the first sibling of each parent that fits the step before is enough
        heads = lambda before: F.filter(elements, lambda a: F.get(before, a["start"]))
        return let(_flags(elements, steps[:-1]), lambda before: let(heads(before), lambda h: F.transform(elements, lambda e: fits(e) & F.exists(h, lambda a: (a["parent"] == e["parent"]) & (a["start"] < e["start"])))))
    return let(_flags(elements, steps[:-1]), lambda before: F.transform(elements, lambda e: fits(e) & related[relation](e, before)))


def select(elements: Column, selector: str) -> Column:
    """All elements that fit, in document order."""
    flags = [_flags(elements, steps) for steps in alternatives(selector)]
    return let(F.array(*flags), lambda fs: F.filter(elements, lambda e: F.exists(fs, lambda f: F.get(f, e["start"]))))


def _plain_flags(elements: list[dict], steps: Steps) -> list[bool]:
    """``_flags`` of one page's elements in Python."""
    relation, tests = steps[-1]
    own = [all(x) for x in zip(*(_held(t, elements) for t in tests))]
    if len(steps) == 1 or not any(own):
        return own
    before = _plain_flags(elements, steps[:-1])
    heads: dict[int, int] = {}  # the first sibling of each parent that fits the step before
    if relation == "~":
        for e in elements:
            if before[e["start"]]:
                heads.setdefault(e["parent"], e["start"])
    related = {
        " ": lambda e: any(before[p] for p in e["path"]),
        ">": lambda e: e["parent"] >= 0 and before[e["parent"]],
        "+": lambda e: e["prev"] >= 0 and before[e["prev"]],
        "~": lambda e: heads.get(e["parent"], e["start"]) < e["start"],
    }[relation]
    return [o and related(e) for o, e in zip(own, elements)]


def places(elements: list[dict], selector: str) -> list[int]:
    """Places of all elements of a page that fit: ``select`` for the parser, which reads one page for all of its shape."""
    flags = [_plain_flags(elements, steps) for steps in alternatives(selector)]
    return [i for i, f in enumerate(zip(*flags)) if any(f)]


def inside(found: Column, element: Column) -> Column:
    """Those of ``found`` in the subtree of an element, itself left out."""
    return F.filter(found, lambda e: (e["start"] > element["start"]) & (e["start"] < element["end"]))


def has(found: Column, element: Column) -> Column:
    """Whether one of ``found`` stands in the subtree of an element."""
    return F.exists(found, lambda e: (e["start"] > element["start"]) & (e["start"] < element["end"]))


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def attr(element: Column, name: str) -> Column:
    return F.try_element_at(element["attrs"], F.lit(name))


def attrs(found: Column, name: str) -> Column:
    """The attribute of each element that has it."""
    return F.filter(F.transform(found, lambda e: attr(e, name)), lambda v: v.isNotNull())


def text(element: Column, strings: Column, sep: str | None = None) -> Column:
    """Text of an element: as it reads, blanks collapsed; or, with ``sep``, its trimmed pieces joined by it. Null for no element."""
    pieces = F.slice(strings, element["from"] + 1, element["to"] - element["from"])
    if sep is None:
        return F.trim(F.regexp_replace(F.array_join(pieces, ""), r"\s+", " "))
    inner = F.filter(pieces, lambda s: s != "\n")  # edges of blocks, half of all pieces
    trimmed = F.filter(F.transform(inner, lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")), lambda s: s != "")
    return F.array_join(trimmed, sep)


def texts(found: Column, strings: Column, sep: str | None = None) -> Column:
    return F.transform(found, lambda e: text(e, strings, sep))

"""One pass over a page's html: its elements, texts, links, label/value pairs, images.

Spark has no html reader, so this is the one helper in Python: Arrow batches through the standard
library's parser. Batches are kept small, as pages are large. The elements of a page come out as an array
in document order; each says how far its subtree goes, so that ``functions.dom`` can select among them
in column expressions. Texts are kept once for the page; an element holds a range of them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import dom, pages
from ..functions.base import text

#: An element: its place, the place after its subtree, its parent's, previous sibling's and ancestors' places, its number among all
#: siblings and among those of its tag, whether it is the last child, and its range of ``strings``.
ELEMENT = (
    "struct<start:int,end:int,depth:int,parent:int,prev:int,path:array<int>,nth:int,nth_of_tag:int,last:boolean,"
    "tag:string,id:string,classes:array<string>,attrs:map<string,string>,from:int,to:int>"
)
PARSED = f"title string, visible string, elements array<{ELEMENT}>, strings array<string>, links array<string>, images array<string>, pairs array<struct<label:string,value:string>>"
#: What an element that a selector found keeps.
FOUND = "array<struct<start:int,end:int,attrs:map<string,string>,from:int,to:int>>"
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_HIDDEN = {"script", "style", "template"}
_BLOCKS = {"address", "article", "aside", "blockquote", "br", "dd", "div", "dl", "dt", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
#: Tags whose start ends open elements, up to the nearest of the second set.
_ROWS = {"tr", "td", "th"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": (_ROWS, {"table"}),
    **{t: (_ROWS | {"thead", "tbody", "tfoot"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
    **{t: ({"p"}, {"td", "th", "li", "table", "button", "body"}) for t in _BLOCKS - {"li", "dt", "dd", "td", "th", "tr", "thead", "tbody", "tfoot", "br", "title"}},
}
_NEVER_INSIDE = {"p", "li", "dt", "dd", "td", "th", "tr", "option", "b", "i", "a", "span", "em", "strong"}


#: The two common spellings of a tag; all others are left to the standard library.
_PLAIN_START = re.compile(r'<([a-zA-Z][a-zA-Z0-9]*)((?:[ \n]+[a-zA-Z][a-zA-Z0-9_-]*="[^"]*")*)[ \n]*>')
_PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")
_PLAIN_ATTR = re.compile(r'([a-zA-Z][a-zA-Z0-9_-]*)="([^"]*)"')
_PLAIN = re.compile(rf"([^<]*)(?:{_PLAIN_END.pattern}|{_PLAIN_START.pattern})")
#: Tags whose content the library reads in another way, in one version or another.
_RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}


class _Page(HTMLParser):
    """The elements (as dicts), strings and children of one page."""

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[dict] = []
        self.children: list[list[int]] = []
        self.top: list[int] = []
        self.strings: list[str] = []
        self.open: list[int] = []
        self.open_tags: list[str] = []
        self.of_tag: list[dict[str, int]] = [{}]  # children of each tag, by one more than the parent's place
        self.hidden = 0
        self._read(source)
        while self.open:
            self._end()
        self._texts: dict[int, str] = {}
        # how many strings with text and how many block elements come before each place
        self._filled = list(accumulate((bool(s) and not s.isspace() for s in self.strings), initial=0))
        self._blocks = list(accumulate((e["tag"] in _BLOCKS for e in self.elements), initial=0))

    def _read(self, source: str) -> None:
        self.feed(source[self._scan(source) :])
        self.close()

    def _scan(self, source: str) -> int:
        """Reads texts and tags in the common spellings up to the first other thing, and says where that is."""
        at = 0
        while m := _PLAIN.match(source, at):
            data, end, start, attrs = m.groups()
            if start and start.lower() in _RAW:
                break
            if data:
                self.handle_data(unescape(data))
            if end:
                self.handle_endtag(end.lower())
            else:
                self.handle_starttag(start.lower(), self._attrs(attrs))
            at = m.end()
        return at

    @staticmethod
    def _attrs(source: str) -> list[tuple[str, str]]:
        return [(k.lower(), unescape(v)) for k, v in _PLAIN_ATTR.findall(source)] if source else []

    def updatepos(self, i, j):
        return j  # lines are not counted

    def parse_starttag(self, i):
        m = _PLAIN_START.match(self.rawdata, i)
        if m is None or (tag := m[1].lower()) in _RAW:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, self._attrs(m[2]))
        return m.end()

    def parse_endtag(self, i):
        m = _PLAIN_END.match(self.rawdata, i)
        if m is None or self.cdata_elem is not None:
            return super().parse_endtag(i)
        self.handle_endtag(m[1].lower())
        return m.end()

    def _end(self) -> None:
        e, tag = self.elements[self.open.pop()], self.open_tags.pop()
        if tag in _HIDDEN:
            self.hidden -= 1
        if tag in _BLOCKS:
            self.strings.append("\n")
        e["end"], e["to"] = len(self.elements), len(self.strings)

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS:
            ended, upto = _ENDS[tag]
            first = None
            for k in range(len(self.open_tags) - 1, -1, -1):
                if self.open_tags[k] in upto:
                    break
                if self.open_tags[k] in ended:
                    first = k
            if first is not None:
                while len(self.open) > first:
                    self._end()
        if tag in _BLOCKS:
            self.strings.append("\n")
        a = {k: v or "" for k, v in reversed(attrs)}  # of equal names the first counts
        parent = self.open[-1] if self.open else -1
        siblings = self.children[parent] if parent >= 0 else self.top
        i, at = len(self.elements), len(self.strings)
        of_tag = self.of_tag[parent + 1]
        of_tag[tag] = nth_of_tag = of_tag.get(tag, 0) + 1
        self.elements.append({
            "start": i, "end": i + 1, "depth": len(self.open), "parent": parent, "prev": siblings[-1] if siblings else -1, "path": self.open.copy(),
            "nth": len(siblings) + 1, "nth_of_tag": nth_of_tag, "last": True,
            "tag": tag, "id": a.get("id", ""), "classes": a["class"].split() if "class" in a else [], "attrs": a, "from": at, "to": at,
        })
        if siblings:
            self.elements[siblings[-1]]["last"] = False
        siblings.append(i)
        self.children.append([])
        self.of_tag.append({})
        if tag not in _VOID:
            self.open.append(i)
            self.open_tags.append(tag)
            if tag in _HIDDEN:
                self.hidden += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in self.open_tags:
            while self.open_tags[-1] != tag:
                self._end()
            self._end()

    def handle_data(self, data):
        if not self.hidden:
            self.strings.append(data)

    def text(self, i: int) -> str:
        if i in self._texts:
            return self._texts[i]
        e = self.elements[i]
        out = " ".join("".join(self.strings[e["from"] : e["to"]]).split())
        if len(out) < 200:  # long ones are not held for every element around them
            self._texts[i] = out
        return out

    def filled(self, i: int) -> bool:
        """Whether an element has text."""
        e = self.elements[i]
        return self._filled[e["to"]] > self._filled[e["from"]]

    def has_blocks(self, i: int) -> bool:
        return self._blocks[self.elements[i]["end"]] > self._blocks[i + 1]

    def inside(self, i: int, *tags: str) -> list[int]:
        return [k for k in range(i + 1, self.elements[i]["end"]) if self.elements[k]["tag"] in tags]


# ---- label/value pairs: each function yields (place in the page, elements of the label, elements of the value) ----

_Pair = tuple[int, tuple[int, ...], tuple[int, ...]]

_NO_KIDS, _NO_PARENTS = _VOID | _HIDDEN, {"table", "tbody", "thead", "tfoot", "tr", "dl", "select"}
_NO_LABELS = {"a", "li", "tr", "table", "ul", "ol", "img", "h1"}
_LABEL_WORDS, _VALUE_WORDS = ("label", "key", "name", "term"), ("value", "val", "data", "content", "detail")


def _grid(page: _Page, table: int) -> list[list[tuple[int, int, int]]]:
    """Rows of (cell, its first row, its first column); cells that span rows or columns stand in all of them."""
    nested = {k for t in page.inside(table, "table") for k in range(t, page.elements[t]["end"])}
    rows = [r for r in page.inside(table, "tr") if r not in nested]
    grid: list[dict[int, tuple[int, int, int]]] = [{} for _ in rows]
    for y, r in enumerate(rows):
        x = 0
        for c in (c for c in page.children[r] if page.elements[c]["tag"] in ("td", "th")):
            while x in grid[y]:
                x += 1
            wide, high = (max(1, min(int(v), 1000)) if (v := page.elements[c]["attrs"].get(n, "")).isdecimal() else 1 for n in ("colspan", "rowspan"))
            for dy in range(min(high, len(rows) - y)):
                for dx in range(wide):
                    grid[y + dy].setdefault(x + dx, (c, y, x))
            x += wide
    return [[row[x] for x in sorted(row)] for row in grid]


def _table_pairs(page: _Page, table: int) -> Iterator[_Pair]:
    """Pairs of a table of any width: cells by twos; under a row of headings each cell with its heading; rows below a cell that spans them with its text before theirs."""
    grid = _grid(page, table)
    is_head = lambda row: len(row) > 1 and all(page.elements[c]["tag"] == "th" for c, _, _ in row)
    heads = grid[0] if len(grid) > 1 and is_head(grid[0]) and not any(is_head(r) for r in grid[1:]) and all(len(r) == len(grid[0]) for r in grid) else None
    for y, row in enumerate(grid):
        if heads:
            if y:
                yield from ((c, (h,), (c,)) for (h, _, _), (c, first, _) in zip(heads, row) if first == y)
            continue
        cells = [c for k, (c, _, _) in enumerate(row) if k == 0 or row[k - 1][0] != c]  # a wide cell once
        group: tuple[int, ...] = ()
        spans = [c for c in cells if page.elements[c]["attrs"].get("rowspan", "1") not in ("", "0", "1")]
        if len(cells) > 2 and cells[0] in spans:
            group, cells = (cells[0],), cells[1:]
        for label, value in zip(cells[::2], cells[1::2]):
            yield value, (*group, label) if page.filled(label) else (), (value,)


def _list_pairs(page: _Page, dl: int) -> Iterator[_Pair]:
    """Terms with their descriptions; several descriptions of a term are joined."""
    label, values, at = None, [], dl
    for c in page.inside(dl, "dt", "dd"):
        if page.elements[c]["tag"] == "dt":
            if label is not None and values:
                yield at, (label,), tuple(values)
            label, values = c, []
        else:
            at = c
            values.append(c)
    if label is not None and values:
        yield at, (label,), tuple(values)


def _shape(page: _Page, i: int) -> tuple:
    e = page.elements[i]
    return e["tag"], tuple(e["classes"])


def _named(page: _Page, i: int, words: tuple[str, ...]) -> bool:
    return any(w in c.lower() for c in page.elements[i]["classes"] for w in words)


def _is_label(page: _Page, i: int) -> bool:
    return page.elements[i]["tag"] not in _NO_LABELS and page.filled(i) and not page.has_blocks(i)


def _sibling_pairs(page: _Page, parent: int) -> Iterator[_Pair]:
    """Pairs of repeated siblings: items of one shape that hold a label and a value, or labels and values by turns in one parent.

    One item is enough if the classes of its two elements say which is which."""
    if page.elements[parent]["tag"] in _NO_PARENTS:
        return
    turns = [c for c in page.children[parent] if page.elements[c]["tag"] not in _NO_KIDS and page.filled(c)]
    items: dict[tuple, list[tuple[int, int]]] = {}
    for c in turns:
        if len(page.children[c]) < 2:
            continue
        parts = [k for k in page.children[c] if page.filled(k)]
        if len(parts) == 2 and _is_label(page, parts[0]) and page.text(c).replace(" ", "") == (page.text(parts[0]) + page.text(parts[1])).replace(" ", ""):
            items.setdefault((_shape(page, c), *(_shape(page, k) for k in parts)), []).append((parts[0], parts[1]))
    for found in items.values():
        if len(found) > 1 or all(_named(page, i, w) for i, w in zip(found[0], (_LABEL_WORDS, _VALUE_WORDS))):
            yield from ((v, (label,), (v,)) for label, v in found)
    if len(turns) < 2 or len(turns) % 2:
        return
    shapes = [_shape(page, c) for c in turns]
    if shapes[0] != shapes[1] and shapes == shapes[:2] * (len(turns) // 2) and all(_is_label(page, c) for c in turns[::2]):
        if len(turns) > 2 or all(_named(page, i, w) for i, w in zip(turns, (_LABEL_WORDS, _VALUE_WORDS))):
            yield from ((v, (label,), (v,)) for label, v in zip(turns[::2], turns[1::2]))


#: What parts the texts of a label's and of a value's elements.
_BETWEEN = (" ", ", ")


def _pair_places(page: _Page) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """The elements of all labels and values in document order, each value once. They depend on the tags and on which texts are blank, on nothing else."""
    found: dict[int, tuple[tuple[int, ...], tuple[int, ...]]] = {}
    for i, e in enumerate(page.elements):
        if not page.children[i]:
            continue
        kind = _table_pairs if e["tag"] == "table" else _list_pairs if e["tag"] == "dl" else _sibling_pairs
        for at, label, value in kind(page, i):
            found.setdefault(at, (label, value))
    return [found[at] for at in sorted(found)]


def _pairs(page: _Page) -> list[tuple[str, str]]:
    """All pairs of the page in document order."""
    return [tuple(sep.join(map(page.text, x)) for sep, x in zip(_BETWEEN, pair)) for pair in _pair_places(page)]


# ---- pages of one shape ----

#: Attributes that belong to a page's shape; the values of all others are its own.
_STRUCTURE = {"class", "colspan", "rowspan"}
#: Pages of one shape in a batch from which on they are read together.
_MANY = 4
#: All bytes but those that tags begin and end with.
_NO_EDGES = bytes(b for b in range(256) if b not in b"<>")
#: Tags that every reader takes alike, whatever follows them.
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'=`<>]+)"""
_CLEAR_START = re.compile(rf"<([a-zA-Z][a-zA-Z0-9]*)((?:[ \n]+[a-zA-Z][a-zA-Z0-9_-]*(?:={_VALUE})?)*)[ \n]*>")
_CLEAR_ATTR = re.compile(rf"[ \n]([a-zA-Z][a-zA-Z0-9_-]*)(?:=({_VALUE}))?")
_DOCTYPE = re.compile(r"<!doctype[^<>]*>", re.I)
#: Tags and texts of the shapes held in a task; beyond it all are forgotten.
_HELD = 400_000


class _Model(_Page):
    """A page from tags and texts that were read apart. It knows which string is which text and which element is which tag."""

    def _read(self, source) -> None:
        tags, texts = source
        self.full = [bool(t.strip()) for t in texts]
        self.text_of: dict[int, int] = {}
        self.tag_of: list[int] = []
        for j, t in enumerate(texts):
            self.text_of[len(self.strings)] = j
            self.strings.append(t)
            kind, name, attrs = tags[j] if j < len(tags) else ("", "", {})
            if kind == "start":
                self.tag_of.append(j)
                self.handle_starttag(name, list(attrs.items()))
            elif kind == "end":
                self.handle_endtag(name)

    def run(self, start: int, to: int) -> list[int]:
        """Numbers of the texts in a range of strings, -1 for the edge of a block."""
        return [self.text_of.get(k, -1) for k in range(start, to)]


def _joined(texts: list[str], run: tuple[int, ...]) -> str:
    return " ".join("".join([texts[j] if j >= 0 else "\n" for j in run]).split())


class _Cut:
    """Many pages cut at their tags: the pieces of a page are its texts and tags by turns, as ranges of the bytes of all. Pages in which < and > don't
    take turns, or whose texts hold a reference (&), are one piece and not ``clear``."""

    def __init__(self, html: pa.StringArray):
        html = (html.fill_null("") if html.null_count else html).cast(pa.string())
        n, buffers = len(html), html.buffers()
        offsets = np.frombuffer(buffers[1], np.int32)[html.offset : html.offset + n + 1]
        self.data = data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        edges = np.flatnonzero((data == ord("<")) | (data == ord(">")))
        first = np.searchsorted(edges, offsets)
        counts = np.diff(first)
        self.clear = counts % 2 == 0
        opens = data[edges] == ord("<")
        if not (self.clear.all() and opens[::2].all()) or opens[1::2].any():
            turns = opens == ((np.arange(len(edges)) - np.repeat(first[:-1], counts)) % 2 == 0)
            self.clear &= np.diff(np.searchsorted(np.flatnonzero(~turns), first)) == 0
        references = np.flatnonzero(data == ord("&"))
        page = np.searchsorted(offsets, references, "right") - 1
        self.clear[page[(np.searchsorted(edges, references) - first[page]) % 2 == 0]] = False  # those in texts
        cuts = edges if self.clear.all() else edges[np.repeat(self.clear, counts)]
        cuts[1::2] += 1
        self.tags = _sums(np.where(self.clear, counts // 2, 0))  # the first tag of each page
        self.base = np.arange(n + 1) + 2 * self.tags  # and its first piece
        self.bounds = np.empty(len(cuts) + n + 1, np.int32)
        inner = np.ones(len(self.bounds), bool)
        inner[self.base] = False
        self.bounds[inner], self.bounds[self.base] = cuts, offsets
        self.tag_at = np.flatnonzero(inner)[::2]
        self.pieces = pa.StringArray.from_buffers(len(self.bounds) - 1, pa.py_buffer(self.bounds), pa.py_buffer(data))

    def texts(self, pages: np.ndarray, numbers: list[int]) -> tuple[list[list[str]], np.ndarray]:
        """The texts with the numbers, for all different rows of them, and which row each page has."""
        row, coded = np.zeros(len(pages), np.int64), []
        for j in numbers:
            coded.append(self.pieces.take(pa.array(self.base[pages] + 2 * j)).dictionary_encode())
            row = np.unique(row * len(coded[-1].dictionary) + coded[-1].indices.to_numpy(), return_inverse=True)[1]
        first = np.unique(row, return_index=True)[1]
        return [c.take(pa.array(first)).to_pylist() for c in coded], row

    def filled(self) -> np.ndarray:
        """1 for pieces with more than blanks."""
        out = np.diff(self.bounds) > 0
        maybe = np.flatnonzero(out)
        head = self.data[self.bounds[maybe]]
        maybe = maybe[(head <= 32) | (head > 126)]  # other characters are no blanks
        out[maybe] = [bool(t.strip()) for t in self.pieces.take(pa.array(maybe)).to_pylist()]
        return out.astype(np.int32)

    def odd(self, pieces: np.ndarray) -> np.ndarray:
        """Whether the pieces have other than visible ASCII characters."""
        odd = np.zeros(len(self.data) + 1, np.int32)
        np.cumsum((self.data - np.uint8(33)) > 93, out=odd[1:])
        return odd[self.bounds[pieces + 1]] != odd[self.bounds[pieces]]


def _sums(counts: np.ndarray) -> np.ndarray:
    """Where each of a row of lists begins, and the end of the last."""
    return np.append(0, np.cumsum(counts))


def _flat(lists) -> np.ndarray:
    return np.array(list(chain.from_iterable(lists)), np.int64)


def _groups(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(number, its places)"""
    order = np.argsort(numbers, kind="stable")
    values, first = np.unique(numbers[order], return_index=True)
    return zip(values.tolist(), np.split(order, first[1:]))


def _picked(lists: list[list], of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pages that have the list of a number each: the offsets of their items, the place of each among the items of all lists, and its page."""
    sizes = np.array([len(x) for x in lists], np.int64)
    many = sizes[of]
    offsets, pages = _sums(many), np.repeat(np.arange(len(of)), many)
    return offsets, (_sums(sizes)[of] - offsets[:-1])[pages] + np.arange(offsets[-1]), pages


def _gather(pieces: pa.StringArray, extra: list[str], place: np.ndarray) -> pa.StringArray:
    """Pieces by their places; places after the last one are those of ``extra``."""
    other = place >= len(pieces)
    out = pieces.take(pa.array(np.where(other, 0, place)))
    return pc.replace_with_mask(out, pa.array(other), pa.array(extra, pa.string()).take(pa.array(place[other] - len(pieces)))) if other.any() else out


def _list_array(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


class _Shapes:
    """Reads pages whose tags are all clear as a row of tags and a row of texts. What the tags decide is worked out on the first page of a shape and
    held for the others, of which only texts and attributes are taken. Pages of other spellings are left to ``_Page``."""

    def __init__(self, selectors: dict[str, str] = {}, attributes: tuple[str, ...] = ()):
        self.selectors, self.attributes = selectors, attributes
        #: what the selectors ask of values, by attribute; the answers are part of a tag's kind
        self.tests: dict[str, list[Callable[[str], bool]]] = {}
        for test in (t for s in selectors.values() for steps in dom.alternatives(s) for _, tests in steps for t in tests):
            if test.kind == "attr" and test.op:
                self.tests.setdefault(test.name, []).append(dom.value_test(test))
            elif test.kind == "id":
                self.tests.setdefault("id", []).append(test.value.__eq__)
        self._forget()

    def _forget(self) -> None:
        self.kinds: dict[tuple, int] = {}
        self.made: list[tuple[str, str, dict[str, str]]] = [("", "", {})]  # the first tag of each kind
        self.tags: dict[str, int] = {}  # kinds of the tags that have no values of their own; 0: not clear
        self.plans: dict[tuple, object] = {}
        self.marked: dict[bytes, int] = {}  # the numbers of plans by a page's marks, -1: not to be read by a plan
        self.numbered: list = []
        self.outlines: dict[str, tuple | None] = {}
        self.held = 0

    def _trim(self) -> None:
        if self.held > _HELD:
            self._forget()

    def _kind(self, tag: str) -> tuple[int, dict[str, str] | None]:
        """The number of a tag's kind, 0 if it is not clear, and its attributes if values of its own are among them."""
        quote = '"' if '"' in tag else "'"
        cut = tag.split(quote)
        outline = quote.join(cut[::2])  # the tag without its quoted values
        if (known := self.outlines.get(outline)) and "&" not in tag:
            names, asked, numbers = known
            values = cut[1::2]
            key = tuple([v if tests is None else tuple([t(v) for t in tests]) for v, tests in zip(values, asked)])
            if number := numbers.get(key):
                return number, dict(zip(names, values))
        own, attrs, number, whole, quoted = False, {}, 0, f"<{tag}>", True
        if m := _CLEAR_START.fullmatch(whole):
            kind, name, key = "start", m[1].lower(), []
            for k, v in _CLEAR_ATTR.findall(m[2]) if m[2] else ():
                k = k.lower()
                quoted = quoted and v[:1] == quote and k not in attrs
                if k not in attrs:  # of equal names the first counts
                    attrs[k] = v = unescape(v[1:-1] if v[:1] in "\"'" else v)
                    if k in _STRUCTURE:
                        key.append((k, v))
                    else:
                        own = True
                        key.append((k, *[t(v) for t in self.tests.get(k, ())]))
            key = (name, *key)
        elif m := _PLAIN_END.fullmatch(whole):
            kind, name = "end", m[1].lower()
            key = ("/", name)
        else:
            kind, name, key = "", "", ("",) if _DOCTYPE.fullmatch(whole) else None
        if key and (name == "title" or name not in _RAW | _HIDDEN):
            number = self.kinds.setdefault(key, len(self.made))
            if number == len(self.made):
                self.made.append((kind, name, attrs))
                self.held += 1
        if not own or not number:
            self.tags[tag] = number
            self.held += 1
        elif quoted and "&" not in tag:
            # other tags of the outline with values that the selectors see alike are of the same kind
            asked = [None if k in _STRUCTURE else self.tests.get(k, []) for k in attrs]
            numbers = self.outlines.setdefault(outline, (list(attrs), asked, {}))[2]
            numbers[tuple([v if tests is None else tuple([t(v) for t in tests]) for v, tests in zip(attrs.values(), asked)])] = number
            self.held += 2
        return number, attrs if own else None

    def _parts(self, source: str) -> tuple[tuple[int, ...], list[str], dict[int, dict[str, str]]] | None:
        """The tags' kinds, the texts around them and the attributes of tags with values of their own; None if tags and texts can't be told apart so."""
        parts = source.replace(">", "<").split("<")
        texts, tags = parts[::2], parts[1::2]
        if source.encode().translate(None, _NO_EDGES) != b"<>" * len(tags):
            return None
        kinds, given = list(map(self.tags.get, tags)), {}
        if None in kinds:
            for j, n in enumerate(kinds):
                if n is None:
                    kinds[j], attrs = self._kind(tags[j])
                    if attrs:
                        given[j] = attrs
        if "&" in source:
            for j, n in enumerate(kinds):
                if self.made[n][1] == "title" and "&" in texts[j + 1]:  # readers differ
                    return None
            texts = [unescape(t) if "&" in t else t for t in texts]
        return tuple(kinds), texts, given

    def _plan(self, key: tuple, kinds: tuple[int, ...], texts: list[str], given: dict, make: Callable):
        """What ``make`` has of the first page with the key; None if the tags of its shape are not to be read apart."""
        if key not in self.plans:
            tags = [(*self.made[n][:2], given[j]) if j in given else self.made[n] for j, n in enumerate(kinds)]
            titles = [j for j, t in enumerate(tags) if t[:2] == ("start", "title")]
            clear = 0 not in kinds and all(tags[j + 1 : j + 2] == [("end", "title", {})] for j in titles)
            self.plans[key] = make(_Model((tags, texts))) if clear else None
            self.held += 4 * len(kinds)
        return self.plans[key]

    # label/value pairs

    @staticmethod
    def _pair_plan(page: _Model):
        """How many pairs, the one text that each label and each value is made of, and those made of more."""
        pairs, single, rest = _pair_places(page), [], []
        for sep, side in zip(_BETWEEN, zip(*pairs)):
            for elements in side:
                runs = [tuple(page.run(page.elements[i]["from"], page.elements[i]["to"])) for i in elements]
                full = [[j for j in run if j >= 0 and page.full[j]] for run in runs]
                if len(full) == 1 and len(full[0]) == 1:
                    single.append(full[0][0])
                else:
                    rest.append((len(single), sep, runs))
                    single.append(0)
        return len(pairs), single, rest

    def _pairs_by(self, parts: tuple):
        kinds, texts, given = parts
        full = tuple(map(bool, map(str.strip, texts) if any(map(str.isspace, texts)) else texts))
        return self._plan((kinds, full), kinds, texts, given, self._pair_plan)

    def _one_pairs(self, source: str) -> list[str]:
        if (parts := self._parts(source)) and (plan := self._pairs_by(parts)):
            _, single, rest = plan
            out, texts = list(map(" ".join, map(str.split, [parts[1][j] for j in single]))), parts[1]
            for k, sep, runs in rest:
                out[k] = sep.join([_joined(texts, run) for run in runs])
            return out
        return list(chain.from_iterable(zip(*_pairs(_Page(source)))))

    def pairs(self, source: str) -> list[str]:
        """All labels of a page, then all values."""
        self._trim()
        return self._one_pairs(source)

    def pair_lists(self, html: pa.StringArray) -> pa.ListArray:
        """The pairs of many pages. Texts of pages of one shape are taken together, as pieces of the pages."""
        self._trim()
        cut = _Cut(html)
        chosen = self._chosen(cut, html, self._tags(cut)[0], cut.filled(), self._pairs_by)
        groups, rows = [], {}
        for p, at in _groups(chosen):
            if p < 0 or len(at) < _MANY:
                rows |= {i: self._one_pairs(html[i].as_py() or "") for i in at.tolist()}
            else:
                groups.append((self.numbered[p], at))
        count = np.zeros(len(html), np.int64)
        for (n, _, _), at in groups:
            count[at] = n
        for i, row in rows.items():
            count[i] = len(row) // 2
        offsets, many, extra = _sums(count), len(cut.pieces), []
        place = np.zeros(2 * offsets[-1], np.int64)  # of each label, then of each value: its piece, or after all pieces one of ``extra``
        for i, row in rows.items():
            for side in (0, 1):
                lo = side * offsets[-1] + offsets[i]
                place[lo : lo + count[i]] = many + len(extra) + np.arange(count[i])
                extra += row[side * count[i] : (side + 1) * count[i]]
        for (n, single, rest), at in groups:
            if not n:
                continue
            to = np.stack([offsets[at], offsets[-1] + offsets[at]])[:, :, None] + np.arange(n)  # side, page, pair
            place[to] = cut.base[at][None, :, None] + 2 * np.array(single).reshape(2, 1, n)
            for k, sep, runs in rest:
                numbers = sorted({j for run in runs for j in run if j >= 0})
                texts, row = cut.texts(at, numbers)
                text, edges = dict(zip(numbers, texts)), ["\n"] * (int(row.max()) + 1)
                made = [[" ".join("".join(x).split()) for x in zip(*(text[j] if j >= 0 else edges for j in run))] or [""] * len(edges) for run in runs]
                place[to[k // n, :, k % n]] = many + len(extra) + row
                extra += [sep.join(x) for x in zip(*made)] or [""]
        # blanks inside a piece are collapsed
        inner = np.flatnonzero(place < many)
        inner = inner[cut.odd(place[inner])]
        found = cut.pieces.take(pa.array(place[inner])).to_pylist()
        place[inner] = many + len(extra) + np.arange(len(inner))
        out = _gather(cut.pieces, extra + list(map(" ".join, map(str.split, found))), place)
        half = int(offsets[-1])
        return _list_array(offsets, pa.StructArray.from_arrays([out[:half], out[half:]], names=["label", "value"]))

    # many pages

    def _tags(self, cut: _Cut) -> tuple[np.ndarray, np.ndarray, list[dict[str, str] | None]]:
        """The kind of each tag, its number among the different tags, and the attributes of those with values of their own."""
        coded = cut.pieces.take(pa.array(cut.tag_at)).dictionary_encode()
        kinds, own = [], []
        for tag in coded.dictionary.to_pylist():
            tag = tag[1:-1]
            n, attrs = self.tags.get(tag), None
            if n is None:
                n, attrs = self._kind(tag)
            kinds.append(n)
            own.append(attrs)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return np.array(kinds, np.int32)[codes] if kinds else np.zeros(0, np.int32), codes, own

    def _chosen(self, cut: _Cut, html: pa.StringArray, kinds: np.ndarray, marks: np.ndarray, make: Callable) -> np.ndarray:
        """The number of each page's plan, -1 for those that are read one by one. A page's marks are the kinds of its tags and those given for its texts."""
        marks[cut.tag_at] = kinds
        whole, at, out = marks.tobytes(), (marks.itemsize * cut.base).tolist(), []
        for i, clear in enumerate(cut.clear.tolist()):
            if not clear:
                out.append(-1)
                continue
            key = whole[at[i] : at[i + 1]]
            p = self.marked.get(key)
            if p is None:
                parts = self._parts(html[i].as_py() or "")
                plan = make(parts) if parts else None
                p = self.marked[key] = len(self.numbered) if plan else -1
                if plan:
                    self.numbered.append(plan)
                self.held += len(key) // 4
            out.append(p)
        return np.array(out, np.int64)

    # elements that fit selectors

    def _found_plan(self, page: _Page):
        """For each selector (starts, ends, froms, tos, numbers of attributes, their names, their values), and the texts of ``strings``; the
        value of a tag's own attribute is (tag, name)."""
        model = page if isinstance(page, _Model) else None
        found = [dom.places(page.elements, s) for s in self.selectors.values()]
        kept = sorted(set(chain.from_iterable(range(page.elements[i]["from"], page.elements[i]["to"]) for i in chain.from_iterable(found))))
        at = {k: n for n, k in enumerate(kept)}
        columns = []
        for places in found:
            of = [page.elements[i] for i in places]
            froms = [at.get(e["from"], 0) for e in of]
            named = [[n for n in self.attributes if n in e["attrs"]] for e in of]
            values = [e["attrs"][n] if model is None or n in _STRUCTURE else (model.tag_of[e["start"]], n) for e, names in zip(of, named) for n in names]
            columns.append((
                [e["start"] for e in of], [e["end"] for e in of], froms, [f + e["to"] - e["from"] for f, e in zip(froms, of)],
                [len(x) for x in named], list(chain.from_iterable(named)), values,
            ))
        return columns, [model.text_of.get(k, -1) for k in kept] if model else kept

    def _found_by(self, parts: tuple):
        kinds, texts, given = parts
        return self._plan(kinds, kinds, texts, given, self._found_plan)

    def _one_found(self, source: str) -> tuple[list, list[str]]:
        if (parts := self._parts(source)) and (plan := self._found_by(parts)):
            _, texts, given = parts
            columns, run = plan
            return [(*c[:6], [v if type(v) is str else given[v[0]][v[1]] for v in c[6]]) for c in columns], [texts[j] if j >= 0 else "\n" for j in run]
        page = _Page(source)
        columns, kept = self._found_plan(page)
        return columns, [page.strings[k] for k in kept]

    def found(self, source: str) -> tuple[list, list[str]]:
        """The plan's columns with the attributes' values of the page, and the strings that the found elements hold."""
        self._trim()
        return self._one_found(source)

    def found_lists(self, html: pa.StringArray) -> tuple[pa.StructArray, pa.ListArray]:
        """The elements found on many pages, and their strings. Places are those of a page's plan; values and texts are taken together."""
        self._trim()
        cut = _Cut(html)
        kinds, codes, own = self._tags(cut)
        chosen = self._chosen(cut, html, kinds, np.zeros(len(cut.pieces), np.int32), self._found_by)
        used, local = np.unique(chosen[chosen >= 0], return_inverse=True)
        plans, extra, of = [self.numbered[p] for p in used], ["\n"], np.zeros(len(html), np.int64)
        of[chosen >= 0] = local
        for i in np.flatnonzero(chosen < 0).tolist():
            columns, strings = self._one_found(html[i].as_py() or "")
            of[i] = len(plans)
            plans.append((columns, [-2 - len(extra) + 1 - k for k in range(len(strings))]))
            extra += strings
        own_values, fixed = [a and a.get(n) for n in self.attributes for a in own], []
        number = {n: k * len(own) for k, n in enumerate(self.attributes)}
        found = []
        for s in range(len(self.selectors)):
            columns = [c[s] for c, _ in plans]
            offsets, pick, _ = _picked([c[0] for c in columns], of)
            start, end, from_, to, counts = (_flat(c[k] for c in columns)[pick] for k in range(5))
            _, pick, pages = _picked([c[6] for c in columns], of)
            names = pa.array(list(chain.from_iterable(c[5] for c in columns)), pa.string()).take(pa.array(pick))
            tag, base = [], []  # a value of a page's own: its tag, and where the values of its attribute begin; else where it stands in ``fixed``
            for v in chain.from_iterable(c[6] for c in columns):
                if type(v) is str:
                    tag.append(-1)
                    base.append(len(own_values) + len(fixed))
                    fixed.append(v)
                else:
                    tag.append(v[0])
                    base.append(number[v[1]])
            tag, place = np.array(tag, np.int64)[pick], np.array(base, np.int64)[pick]
            mine = tag >= 0
            place[mine] += codes[cut.tags[pages[mine]] + tag[mine]]
            found.append((offsets, start, end, from_, to, counts, names, place))
        values = pa.array(own_values + fixed, pa.string())
        lists = []
        for offsets, start, end, from_, to, counts, names, place in found:
            attrs = pa.MapArray.from_arrays(pa.array(_sums(counts), pa.int32()), names, values.take(pa.array(place)))
            ints = [pa.array(x, pa.int32()) for x in (start, end, from_, to)]
            lists.append(_list_array(offsets, pa.StructArray.from_arrays([*ints[:2], attrs, *ints[2:]], names=["start", "end", "attrs", "from", "to"])))
        offsets, pick, pages = _picked([run for _, run in plans], of)
        text = _flat(run for _, run in plans)[pick]
        many = len(cut.pieces)
        strings = _gather(cut.pieces, extra, np.where(text >= 0, cut.base[pages] + 2 * text, many - 1 - text))
        return pa.StructArray.from_arrays(lists, names=list(self.selectors)), _list_array(offsets, strings)


# ---- Arrow columns: flat values with offsets ----

_NUMBERS = ("start", "end", "depth", "parent", "prev", "nth", "nth_of_tag", "from", "to")


def _lists(lists: list[list], values: Callable[[list], pa.Array]) -> pa.ListArray:
    """A list array; its values are made of all items in a row."""
    return pa.ListArray.from_arrays(pa.array(list(accumulate(map(len, lists), initial=0)), pa.int32()), values(list(chain.from_iterable(lists))))


def _texts(lists: list[list[str]]) -> pa.ListArray:
    return _lists(lists, lambda x: pa.array(x, pa.string()))


def _maps(maps: list[dict[str, str]]) -> pa.MapArray:
    offsets = pa.array(list(accumulate(map(len, maps), initial=0)), pa.int32())
    keys, values = (pa.array(list(chain.from_iterable(x)), pa.string()) for x in ((m.keys() for m in maps), (m.values() for m in maps)))
    return pa.MapArray.from_arrays(offsets, keys, values)


def _element_column(elements: list[dict]) -> pa.StructArray:
    of = lambda name: [e[name] for e in elements]
    made = {n: pa.array(of(n), pa.int32()) for n in _NUMBERS}
    made |= {n: pa.array(of(n), pa.string()) for n in ("tag", "id")}
    made |= {"last": pa.array(of("last"), pa.bool_()), "path": _lists(of("path"), lambda x: pa.array(x, pa.int32())), "classes": _texts(of("classes")), "attrs": _maps(of("attrs"))}
    return pa.StructArray.from_arrays([made[f.name] for f in _element], names=[f.name for f in _element])


def _pair_column(pairs: list[tuple[str, str]]) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], names=["label", "value"])


_element = pa.struct(
    [(n, pa.int32()) for n in ("start", "end", "depth", "parent", "prev")]
    + [("path", pa.list_(pa.int32())), ("nth", pa.int32()), ("nth_of_tag", pa.int32()), ("last", pa.bool_()), ("tag", pa.string()), ("id", pa.string())]
    + [("classes", pa.list_(pa.string())), ("attrs", pa.map_(pa.string(), pa.string())), ("from", pa.int32()), ("to", pa.int32())]
)
#: The parsed columns: what each has of a page, and the Arrow column of many.
_READ: dict[str, tuple[Callable[[_Page], object], Callable[[list], pa.Array]]] = {
    "title": (lambda p: next((p.text(e["start"]) for e in p.elements if e["tag"] == "title"), ""), lambda x: pa.array(x, pa.string())),
    "visible": (lambda p: " ".join("".join(s for s in p.strings if s != "\n").split()), lambda x: pa.array(x, pa.string())),
    "elements": (lambda p: p.elements, lambda x: _lists(x, _element_column)),
    "strings": (lambda p: p.strings, _texts),
    "links": (lambda p: [e["attrs"]["href"] for e in p.elements if e["tag"] == "a" and e["attrs"].get("href")], _texts),
    "images": (lambda p: [e["attrs"]["src"] for e in p.elements if e["tag"] == "img" and e["attrs"].get("src")], _texts),
    "pairs": (_pairs, lambda x: _lists(x, _pair_column)),
}


#: Bytes of html read at once where little comes out of a page.
_BYTES = 1 << 21


def _portions(batches: Iterator[pa.RecordBatch], kept: list[str]) -> Iterator[tuple[list[pa.Array], pa.StringArray]]:
    """(the kept columns, html) of as many pages as hold about so many bytes."""
    for whole in batches:
        if not len(whole):
            continue
        html = whole.column("html")
        ends = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = np.unique([0, *np.searchsorted(ends, np.arange(_BYTES, ends[-1], _BYTES)), len(whole)]).tolist()
        for lo, hi in zip(at, at[1:]):
            yield [whole.column(c).slice(lo, hi - lo) for c in kept], html.slice(lo, hi - lo)


def _pairing(kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = _Shapes()
        for others, html in _portions(batches, kept):
            yield pa.record_batch([*others, shapes.pair_lists(html)], names=[*kept, "pairs"])

    return run


def _finding(kept: list[str], selectors: dict[str, str], attributes: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = _Shapes(selectors, attributes)
        for others, html in _portions(batches, kept):
            yield pa.record_batch([*others, *shapes.found_lists(html)], names=[*kept, "found", "strings"])

    return run


def _parsing(kept: list[str], columns: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    if columns == ("pairs",):
        return _pairing(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, len(whole), 128):
                batch = whole.slice(k, 128)
                read: list[list] = [[] for _ in columns]
                for source in batch.column("html").to_pylist():
                    p = _Page(source or "")
                    for out, c in zip(read, columns):
                        out.append(_READ[c][0](p))
                yield pa.record_batch([*(batch.column(c) for c in kept), *(_READ[c][1](x) for x, c in zip(read, columns))], names=[*kept, *columns])

    return run


def with_parsed(df: DataFrame, *columns: str) -> DataFrame:
    """The parsed columns in the place of ``html``; the table's others stay, so no parsed page needs a join. Null html gives empty fields."""
    df = df.withColumn("html", df["html"].cast("string"))
    kept = [c for c in df.columns if c != "html"]
    parsed = StructType.fromDDL(PARSED)
    schema = StructType([*(df.schema[c] for c in kept), *(parsed[c] for c in columns)])
    return df.mapInArrow(_parsing(kept, columns), schema)


def with_found(df: DataFrame, selectors: dict[str, str], *attributes: str) -> DataFrame:
    """In the place of ``html`` the elements that each selector finds, as fields of ``found``, with the attributes named, and their ``strings``:
    what ``dom.select`` gives of the parsed elements, without sending all of them to the expressions. Null html gives empty fields."""
    df = df.withColumn("html", df["html"].cast("string"))
    kept = [c for c in df.columns if c != "html"]
    made = StructType.fromDDL(f"found struct<{','.join(f'{n}:{FOUND}' for n in selectors)}>, strings array<string>")
    return df.mapInArrow(_finding(kept, selectors, attributes), StructType([*(df.schema[c] for c in kept), *made]))


def parse_pages(df: DataFrame, *columns: str) -> DataFrame:
    """Everything the jobs need from a page, in one parse, or only the columns named (with page_id and url). Null html gives empty fields."""
    return with_parsed(df.select(df["page_id"].cast("long"), df["url"].cast("string"), df["html"]), *(columns or _READ))


def extract_text(elements: Column, tag: str = "", css: str = "", ident: str = "", default: str = "", strings: Column | None = None) -> Column:
    """Text of the first element with the tag, class and id given."""

    def fits(e: Column) -> Column:
        out = (e["tag"] == tag) if tag else F.lit(True)
        out = out & F.array_contains(e["classes"], css) if css else out
        return out & (e["id"] == ident) if ident else out

    found = dom.first(F.filter(elements, fits))
    return F.when(found.isNull(), F.lit(default)).otherwise(text(dom.text(found, F.col("strings") if strings is None else strings)))


def spec_map(pairs: Column) -> Column:
    """Label/value rows as a map; the last of equal labels counts."""
    return pages.last_wins_map(F.filter(pairs, lambda p: p["label"] != ""))

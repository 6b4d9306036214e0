"""Selectors and label/value pairs against plain walks over a tree."""

import random

import pytest
from pyspark.sql import functions as F

from annonia.functions import dom, vocab
from annonia.operators import frontier
from annonia.sources import html



@pytest.fixture(autouse=True)
def columns(spark):
    global E, S
    E, S = F.col("elements"), F.col("strings")


def pages(spark, *docs):
    return html.parse_pages(spark.createDataFrame([(i, "u", d) for i, d in enumerate(docs)], "page_id long, url string, html string"))


def tree(seed, n=60):
    """A random page of div, p-free nested tags with classes, as html and as (tag, classes, parent, previous sibling)."""
    random.seed(seed)
    nodes, out = [], []

    def add(parent, depth):
        before = -1
        for _ in range(random.randint(1, 4)):
            if len(nodes) >= n:
                return
            tag, cls = random.choice(["div", "span", "b"]), random.sample("xyz", random.randint(0, 2))
            i = len(nodes)
            nodes.append((tag, cls, parent, before, i))
            out.append(f"<{tag} class='{' '.join(cls)}'>{i} ")
            if depth < 6 and random.random() < 0.6:
                add(i, depth + 1)
            out.append(f"</{tag}>")
            before = i

    while len(nodes) < n:
        add(-1, 0)
    return "".join(out), nodes


def plain(nodes, steps):
    """Numbers of the nodes that fit ((relation, tag, class), ...)."""
    first = {}
    for tag, _, parent, before, i in nodes:
        if before == -1 and parent == -1:
            first.setdefault(-1, i)

    def fits(i, k):
        rel, tag, cls = steps[k]
        t, c, parent, before, _ = nodes[i]
        if tag not in ("", t) or (cls and cls not in c):
            return False
        if k == 0:
            return True
        if rel == ">":
            return parent >= 0 and fits(parent, k - 1)
        if rel == "+":
            return before >= 0 and fits(before, k - 1)
        if rel == "~":
            while before >= 0:
                if fits(before, k - 1):
                    return True
                before = nodes[before][3]
            return False
        while parent >= 0:
            if fits(parent, k - 1):
                return True
            parent = nodes[parent][2]
        return False

    return [i for i in range(len(nodes)) if fits(i, len(steps) - 1)]


def test_selectors_against_plain_walk(spark):
    random.seed(1)
    made = [tree(k) for k in range(4)]
    # top-level runs of siblings: the generator starts each with no previous one, the page sees one row of siblings
    docs = [f"<main>{h}</main>" for h, _ in made]
    fixed = []
    for _, nodes in made:
        last, out = {}, []
        for tag, cls, parent, _, i in nodes:
            out.append((tag, cls, parent, last.get(parent, -1), i))
            last[parent] = i
        fixed.append(out)
    queries = []
    for _ in range(25):
        steps = [(random.choice([" ", ">", "+", "~"]), random.choice(["div", "span", "b", ""]), random.choice(["", "x", "y"])) for _ in range(random.randint(1, 3))]
        steps = [(r, t or ("" if c else "b"), c) for r, t, c in steps]
        text = "".join((f" {r} " if k and r != " " else " " if k else "") + t + (f".{c}" if c else "") for k, (r, t, c) in enumerate(steps))
        queries.append((text, steps))
    df = pages(spark, *docs)
    got = df.select("page_id", *(F.transform(dom.select(E, q), lambda e: e["start"] - 1).alias(f"q{k}") for k, (q, _) in enumerate(queries))).orderBy("page_id").collect()
    for row, nodes in zip(got, fixed):
        for k, (q, steps) in enumerate(queries):
            assert row[f"q{k}"] == plain(nodes, steps), q


def test_attributes_orders_and_texts(spark):
    doc = "<ul id=u><li data-x='A b'>one<li class='k'>two <b>bold</b><script>no</script></ul><a href=/q>q</a><a href='/s t'>s</a><a HREF=\"/d?a=1&amp;b=2\">d</a><a data-href=/no>n</a>"
    df = pages(spark, doc, None, "<li", "<p>a<p>b<div>c</p></div>")
    names = ["#u > li", "li:nth-child(2)", "li:last-child b", "[data-x~=b]", "a[href$='t']", "a[href], b", "li.k", "*:nth-of-type(3)"]
    row = df.select(*(dom.texts(dom.select(E, n), S, " ").alias(f"c{i}") for i, n in enumerate(names)), dom.attrs(dom.select(E, "a"), "href").alias("h")).collect()
    assert row[0][:-1] == (["one", "two bold"], ["two bold"], ["bold"], ["one"], ["s"], ["bold", "q", "s", "d"], ["two bold"], ["d"])
    assert row[0]["h"] == ["/q", "/s t", "/d?a=1&b=2"] and row[1][0] == [] and row[1]["h"] == []
    links = frontier.extract_links(spark.createDataFrame([(1, "u", doc)], "page_id long, url string, html string"))
    assert [r.href for r in links.orderBy("pos").collect()] == ["/q", "/s t", "/d?a=1&b=2"]
    assert df.select(dom.texts(dom.select(E, "p"), S)).collect()[3][0] == ["a", "b"]


@pytest.mark.parametrize("bad", ["", "a >", "> a", "a::b", "a[", "a:hover"])
def test_selectors_that_are_refused(spark, bad):
    with pytest.raises(ValueError):
        dom.select(E, bad)


def table(rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td{a}>{t}</td>" for t, a in row) + "</tr>" for row in rows) + "</table>"


def test_pairs_of_any_layout(spark):
    random.seed(2)
    docs, want = [], []
    for _ in range(30):
        rows, pairs = [], []
        for y in range(random.randint(1, 5)):
            n = random.randint(1, 3)
            row = []
            for x in range(n):
                label, value = f"l{y}.{x}", f"v{y}.{x}"
                row += [(label, ""), (value, random.choice(["", " colspan=2", " colspan=x", " rowspan=1"]))]
                pairs.append((label, value))
            if random.random() < 0.3:
                row.append(("left over", ""))
            rows.append(row)
        docs.append(table(rows))
        want.append(pairs)
    docs += [
        "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>",
        "<table><tr><th>A</th><td>1</td></tr><tr><th>B</th><td><table><tr><td>c</td><td>2</td></tr></table></td></tr></table>",
        "<table><tr><td rowspan=2>G</td><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table>",
        "<dl><dt>t<dd>1<dd>2<dt>u<dd>3</dl>",
        "<div><div class=r><b>k</b><i>v</i></div><div class=r><b>l</b><i>w</i></div></div>",
        "<div><div class=r><b>k</b><i>v</i></div></div>",
        "<div class=r><b class=label>k</b><i class=value>v</i></div>",
        "<div><b>k</b><i>v</i><b>l</b><i>w</i></div><ul><li><a>x</a><a>y</a></li><li><a>z</a><a>q</a></li></ul>",
        None,
    ]
    want += [[("A", "1"), ("B", "2")], [("A", "1"), ("B", "c 2"), ("c", "2")], [("G a", "1"), ("G b", "2")], [("t", "1, 2"), ("u", "3")], [("k", "v"), ("l", "w")], [], [("k", "v")], [("k", "v"), ("l", "w")], []]
    got = pages(spark, *docs).select("page_id", "pairs").orderBy("page_id").collect()
    for row, pairs in zip(got, want):
        assert [tuple(p) for p in row.pairs] == pairs, docs[row.page_id]


def test_long_words_stay_whole(spark):
    word = "a" * 3_000
    got = spark.range(1).select(vocab.format_title(F.lit(word))).first()[0]
    assert got == "A" + word[1:]

"""Pages whose tags are those of an earlier one are read by its plan: the same results, without another parse."""

import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from annonia.functions import details, dom
from annonia.plans import page_queries, record_queries  # noqa: F401  (the first registers the pages)
from annonia.sources import html

DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
PARTS = ['<div class="k v">', "</div>", '<P CLASS="Label" id="b">', "</p>", "</ p>", "<td>", "<td colspan=2>", "<td rowspan='2'>", "</td>", "<tr>", "</tr>", "<table>", "</table>", "<dl>", "<dt>", "<dd>", "<li>", "<ul>", "</ul>", "<ol class=ok-list>", "<b>", "</b>", "<i class='label'>", "<i class=value>", "</i>",
         "text", " a\nb", "\xa0", "&nbsp;", "&amp;", "&lt", "\x1f", "<", ">", '"', "<br/>", "<br>", "<img src=\"x&amp;y\">", "<a HREF='mailto:q' href=\"z\">", '<a href="tel:1">', "<a href=https://wa.me/2/>", "<a class=v-btn id=announcementUserInfo>", "<a href>", "</a>", "<script>", "</script>", "<template>",
         "<title>", "</title>", "<title>t&amp;</title>", "<title>é</title>", "<!-- c -->", "<!DOCTYPE html>", "<?pi>", '<p class="a"id="b">', '<td a="x>y">', '<p x="1" x="2">', "<p a=>", "&", "</>", "<textarea>", "</textarea>"]
WORDS = ["", "", "a", " b  c", "\n", "\xa0", "é è", "x&amp;y", "1 > 2", "p<q"]
SELECTORS = details.PLACE | details.CONTACT | {"orders": "li:nth-child(2), td ~ td", "ids": "#b, #u > a", "names": "[href], a[x='1'], [class~=v]", "next": "td + td, i.label + *"}


def random_pages(seed, n=500):
    """Pages of random tags, and of some shapes that come again with other texts and values."""
    rng = random.Random(seed)
    out = [None, "", "<", "x"]
    for _ in range(n):
        out.append("".join(rng.choices(PARTS, k=rng.randrange(1, 30))))
    clear = [p for p in PARTS if p.startswith("<") and p.endswith(">") and " id=" not in p and not p.startswith(("<!-", "<?", "<s", "</s", "<te", "</te", "</>", "</ ", "<ti", "</ti"))]
    for _ in range(n // 10):
        tags = rng.choices(clear, k=rng.randrange(1, 40))
        for _ in range(10):
            again = [t.replace("mailto:q", rng.choice(["mailto:q", "tel:3", "/z"])).replace("tel:1", f"tel:{rng.random()}") for t in tags]
            out.append("".join(rng.choice(WORDS[: rng.choice([3, 10])]) + t for t in again) + rng.choice(WORDS))
    rng.shuffle(out)
    return out


def plain_pairs(source):
    return [tuple(p) for p in html._pairs(html._Page(source or ""))]


def plain_found(source, attributes):
    p = html._Page(source or "")
    return [[(p.elements[i]["start"], p.elements[i]["end"], {n: v for n, v in p.elements[i]["attrs"].items() if n in attributes}, [s for s in p.strings[p.elements[i]["from"] : p.elements[i]["to"]] if s]) for i in dom.places(p.elements, s)] for s in SELECTORS.values()]


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_like_parsed_ones(spark, seed):
    docs = random_pages(seed)
    df = spark.createDataFrame(list(enumerate(docs)), "i int, html string").coalesce(1)
    got = {r.i: [tuple(p) for p in r.pairs] for r in html.with_parsed(df, "pairs").collect()}
    assert any(got.values()) and len(got) == len(docs)
    for i, doc in enumerate(docs):
        assert got[i] == plain_pairs(doc), doc


@pytest.mark.parametrize("seed", [3, 4])
def test_found_like_selected(spark, seed):
    docs = random_pages(seed)
    df = spark.createDataFrame(list(enumerate(docs)), "i int, html string").coalesce(1)
    rows = html.with_found(df, SELECTORS, "href", "x", "class").collect()
    assert len(rows) == len(docs)
    for r in rows:
        got = [[(e["start"], e["end"], e["attrs"], [s for s in r.strings[e["from"] : e["to"]] if s]) for e in r.found[n]] for n in SELECTORS]
        assert got == plain_found(docs[r.i], ("href", "x", "class")), docs[r.i]


def together(seed):
    """Many pages of each shape, all with the same blank texts."""
    rng = random.Random(seed)
    clear = [p for p in PARTS if p.startswith("<") and p.endswith(">") and not p.startswith(("<!-", "<?", "<s", "</s", "<te", "</te", "</>", "</ ", "<ti", "</ti", "<br/")) and not any(x in p for x in ('"id', "x>y", "=>"))] + ['<a href="/x?a=1&amp;b=2">', "<td>", "</td>", "<tr>", "<table>"]
    out = [None, ""]
    for _ in range(40):
        tags = ["<!DOCTYPE html>", "<title>", "</title>"] * rng.randrange(2) + rng.choices(clear, k=rng.randrange(1, 30))
        full = [rng.random() < 0.5 for _ in range(len(tags) + 1)]
        for n in range(rng.choice([1, 3, 30])):
            texts = [rng.choice(["a", f"{n} 000", " b  c ", "é\xa0è", "x\n", "=", "\u2003z"]) if f else rng.choice(["", " ", "\n", "\xa0"]) for f in full]
            values = [t.replace("mailto:q", rng.choice(["mailto:é", "tel:3", ""])).replace("tel:1", f"tel:{rng.random()}").replace("a=1", f"a={n}") for t in tags]
            out.append("".join(x + t for x, t in zip(texts, values)) + texts[-1])
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [8, 9, 10])
def test_pages_of_a_shape_are_read_together(monkeypatch, seed):
    docs = together(seed)
    want_pairs, want_found = [plain_pairs(d) for d in docs], [plain_found(d, ("href", "x", "class")) for d in docs]
    alone = []
    for name in ("_one_pairs", "_one_found"):
        monkeypatch.setattr(html._Shapes, name, lambda self, source, read=getattr(html._Shapes, name): alone.append(source) or read(self, source))
    whole = pa.array(["<p>", *docs, "x"], pa.string())
    for column in (whole.slice(1, len(docs)), pa.array(docs, pa.large_string())):
        pairs, shapes = html._Shapes(), html._Shapes(SELECTORS, ("href", "x", "class"))
        for _ in range(2):  # with no plan made, and with all
            assert [[(p["label"], p["value"]) for p in x] for x in pairs.pair_lists(column).to_pylist()] == want_pairs
            found, strings = shapes.found_lists(column)
            for doc, f, s, want in zip(docs, found.to_pylist(), strings.to_pylist(), want_found):
                assert [[(e["start"], e["end"], dict(e["attrs"]), [t for t in s[e["from"] : e["to"]] if t]) for e in f[n]] for n in SELECTORS] == want, doc
    assert len(alone) < len(docs)  # of eight readings


def test_selectors_in_python_like_columns(spark):
    docs = random_pages(5, 150)
    df = html.with_parsed(spark.createDataFrame(list(enumerate(docs)), "i int, html string"), "elements")
    rows = df.select("i", *(F.transform(dom.select(F.col("elements"), s), lambda e: e["start"]).alias(n) for n, s in SELECTORS.items())).collect()
    for r in rows:
        assert [r[n] for n in SELECTORS] == [dom.places(html._Page(docs[r.i] or "").elements, s) for s in SELECTORS.values()], docs[r.i]


def test_details_of_found_elements(spark):
    docs = [d.replace('class="k v"', 'class="__content ok-list"').replace("class='label'", 'class="mdi-map-marker __prepend"') for d in filter(None, random_pages(6, 200))]
    docs += ['<ul class=ok-list><li><b class=__prepend><i class=mdi-map-marker></i></b><b class=__content><u class=__title>A - <s>B </s></u></b></ul><a href="mailto: X@y">m</a><div id=announcementUserInfo><a class=v-btn>0 55 12 34 99</a></div>']
    df = spark.createDataFrame(list(enumerate(docs)), "i int, html string")
    s = F.col("strings")
    parsed = html.with_parsed(df, "elements", "strings").select("i", details.location(F.col("elements"), s).alias("l"), details.contact(F.col("elements"), s).alias("c"))
    found = html.with_found(df, details.PLACE | details.CONTACT, "href").select("i", details.location_of(F.col("found"), s).alias("l"), details.contact_of(F.col("found"), s).alias("c"))
    want, got = ({r.i: r for r in x.collect()} for x in (parsed, found))
    assert got == want and got[len(docs) - 1].l.commune == "B" and got[len(docs) - 1].c.phones == ["055123499"]


def test_one_parse_a_shape(monkeypatch):
    made = []

    class Counted(html._Model):
        def __init__(self, source):
            made.append(1)
            super().__init__(source)

    monkeypatch.setattr(html, "_Model", Counted)
    monkeypatch.setattr(html, "_Page", None)  # no page is parsed by itself
    docs = [f'<table><tr><td>Km</td><td class="v">{i} 000</td></tr></table><a href="tel:{i}">{i}</a>' for i in range(500)]
    shapes = html._Shapes({"calls": 'a[href^="tel:"]'}, ("href",))
    assert [shapes.pairs(d) for d in docs] == [["Km", f"{i} 000"] for i in range(500)] and len(made) == 1
    assert [(shapes.found(d)[0][0][6], shapes.found(d)[1]) for d in docs] == [([f"tel:{i}"], [f"{i}"]) for i in range(500)] and len(made) == 2


def test_shapes_held_are_bounded(monkeypatch):
    monkeypatch.setattr(html, "_HELD", 500)
    shapes, rng = html._Shapes(), random.Random(7)
    for k in range(300):
        doc = "".join(f'<b class="c{k}-{rng.randrange(9)}">k</b><i>{k}</i>' for _ in range(4))
        assert shapes.pairs(doc)[:4] in (['k'] * 4, []) and shapes.held < 1_000
        assert len(shapes.tags) < 600 and len(shapes.plans) < 60


@tables
def test_no_page_is_shuffled(spark):
    plan = record_queries.real_estate_records(spark, DIR)._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange" in x]
    assert len(exchanges) == 2 and all("REPARTITION_BY_NUM" in x and "o_orderkey" in x for x in exchanges)

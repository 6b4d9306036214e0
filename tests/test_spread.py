"""Rules that cost far more than reading a row don't run in as few tasks as the file has splits."""

import os
import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from annonia.functions import dates
from annonia.plans import compose, page_queries, record_queries, registry, source_queries  # noqa: F401  (these register their queries)
from annonia.sources import html

DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@tables
@pytest.mark.parametrize("name", ["detail_fields", "spec_grids", "spec_tables", "page_selectors", "parsed_pages", "prices", "relative_dates", "specs", "job_records_whole"])
def test_many_tasks_a_split(spark, name):
    assert registry.QUERIES[name](spark, DIR).rdd.getNumPartitions() >= compose.TASKS_A_SPLIT


@tables
def test_no_parsed_page_is_joined(spark):
    plan = record_queries.real_estate_records(spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Join")  # the top of the plan comes first


@tables
def test_spread_keeps_all_rows(spark):
    df = spark.read.parquet(f"{DIR}/orders.parquet")
    assert compose.spread(df).exceptAll(df).count() == 0 and compose.spread(df).count() == df.count()


class _Library(html._Page):
    """Every tag read by the standard library."""

    _scan = lambda self, source: 0
    updatepos, parse_starttag, parse_endtag = HTMLParser.updatepos, HTMLParser.parse_starttag, HTMLParser.parse_endtag


def test_common_spellings_are_read_like_others():
    parts = ['<div class="k v">', "</div>", '<P CLASS="Label" id="b">', "</p>", "</ p>", "<td>", "<td colspan=2>", "</td>", "<tr>", "<table>", "</table>", "<dl>", "<dt>", "<dd>", "<li>", "<ul>", "</ul>", "text", " a\nb", "&amp;", "&#x1;", "&lt", "<", ">", '"', "<br/>",
             '<img src="x&amp;y">', "<a HREF='q' href=\"z\">", "</a>", "<script>", "</script>", 'if (a<b) "</div>"', "<title>", "</title>", "<!-- c -->", "<!x>", "<?pi>", '<p class="a"id="b">', '<td a="x>y">', '<p x="1" x="2">', "<p a=>", "&", "</>", "<textarea>", "</textarea>"]
    rng = random.Random(1)
    for _ in range(600):
        source = "".join(rng.choices(parts, k=rng.randrange(1, 30)))
        a, b = html._Page(source), _Library(source)
        assert (a.elements, a.strings, html._pairs(a)) == (b.elements, b.strings, html._pairs(b)), source


def test_only_the_columns_asked_for(spark):
    df = spark.createDataFrame([(1, "u", "<p>x</p>", 7), (2, None, None, 8)], "page_id long, url string, html string, k int")
    assert html.parse_pages(df, "pairs", "title").columns == ["page_id", "url", "pairs", "title"]
    got = html.with_parsed(df, "strings").orderBy("k").collect()
    assert [(r.page_id, r.url, r.k, [s for s in r.strings if s.strip()]) for r in got] == [(1, "u", 7, ["x"]), (2, None, 8, [])]


def test_dates_without_a_day_are_not_read_with_a_pattern(spark):
    # a reader with a pattern throws for each text without a date, which cost more than all else
    at = F.to_date(F.lit("2026-01-15"))
    df = spark.createDataFrame([("12 mars 2024",), ("31 février 2024",), ("le 3 janv. 2025 puis 4 mai",), ("x",), (None,), ("29 feb 2024 10:20",), ("2024-02-30",)], "t string")
    out = df.select(dates.normalize_date(F.col("t"), at).alias("a"), dates.updated_on_date(F.concat(F.lit("mars 3, "), F.col("t"))).alias("b"), dates.glued_date(F.col("t"), at).alias("c"))
    assert "gettimestamp" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert [r.a for r in out.collect()] == ["2024-03-12", "31 février 2024", "2025-01-03", "x", "", "2024-02-29", "2024-02-30"]
    assert [r.c for r in out.collect()] == ["2024-03-12", None, "2025-01-03", None, None, "2024-02-29", None]

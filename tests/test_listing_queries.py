"""Every registered query of the listing jobs against its SQL in DuckDB."""

import glob
import os

import duckdb
import pytest

from annonia.plans import page_queries, record_queries, registry, rule_queries, source_queries, stored_queries, stream_queries  # noqa: F401  (these register their queries)

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    cur = con.execute(registry.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(repr([plain(r[names.index(c)]) for c in cols]) for r in cur.fetchall())
    assert got == want


def test_native_queries_have_no_python(spark):
    # what streams and stored tables give is read back from files: its plan says nothing of how it was made
    read_back = {n for n in registry.QUERIES if n.startswith("stream_")} | {"seen_batches", "stored_upserts"}
    for name in set(registry.QUERIES) - read_back - {"parsed_pages", "spec_tables", "page_selectors", "detail_fields", "spec_grids", "real_estate_records"}:
        plan = registry.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "MapInArrow" not in plan, name

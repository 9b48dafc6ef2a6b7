"""Every registered query against its SQL counterpart, and the shape of its plan."""

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from vitrine.plans.oracles import ORACLES
from vitrine.plans.queries import QUERIES as MAIN

# the optional training-data queries have tests of their own
QUERIES, SQL = MAIN, ORACLES


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_rows_match(spark, data, duck, name):
    _, problem = compare(spark, duck, data, QUERIES[name], SQL[name])
    assert problem is None


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 25 and df.count() == 200


@pytest.mark.parametrize("name", QUERIES)
def test_no_nested_loop_or_cross_join(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scan_reads_only_needed_columns(spark, data):
    text = plan(QUERIES["category_counts"](spark, data))
    assert "html" not in text
    text = plan(QUERIES["price_parse"](spark, data))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


@pytest.mark.parametrize("name", ["page_titles", "links_all", "products_full", "keyword_links", "product_images_long"])
def test_page_operators_parse_once_and_add_no_shuffle(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    tree = text.split("\n\n")[0]
    assert tree.count("MapInArrow") == 1
    # the only exchange is the spread of a one-row-group file over the cores
    assert tree.count("Exchange") <= 1

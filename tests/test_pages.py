"""Deep pages by an index of key ranges."""

import re

import pytest
from pyspark.sql import functions as F

from ratelake.operators import catalog


@pytest.fixture(scope="module")
def products(spark):
    keys = F.when(F.col("id") > 1, F.format_string("%06d", F.col("id") * 7919 % 20011))
    return spark.range(20_000).select(
        keys.alias("productId"), F.concat(F.lit("t"), "id").alias("title"), (F.col("id") % 100).cast("double").alias("price"),
        F.lit("b").alias("brand"), F.when(F.col("id") % 3 > 0, F.lit("Large tin")).alias("category"), F.lit("d").alias("description"),
        F.lit(1).alias("rating_count"), F.lit(4.0).alias("avg_rating"))


def test_same_pages_as_by_sorting(spark, products):
    index = catalog.page_index(products.where("productId is not null"), cell_rows=1_000)
    assert index.cells.count() == 20 and index.cells.agg(F.sum("n")).first()[0] == 19_998
    ids = sorted(r[0] for r in products.collect() if r[0])
    for page, limit in ((1, 20), (51, 20), (999, 20), (1000, 20), (1001, 20), (10**9, 100), (200, 100)):
        got = [r["productId"] for r in catalog.indexed_page(index, page, limit).collect()]
        assert got == ids[(page - 1) * limit:page * limit]
    search = {"category": "large", "min_price": 10, "max_price": 12}
    hits = sorted(r["productId"] for r in products.where("productId is not null and price between 10 and 12 and category is not null").collect())
    for page in (1, 2, 17, 40, 41, 50):
        assert [r["productId"] for r in catalog.indexed_page(index, page, 10, **search).collect()] == hits[(page - 1) * 10:page * 10]


def test_a_deep_page_reads_its_own_cells(spark, products):
    index = catalog.page_index(products, cell_rows=1_000)
    page = catalog.indexed_page(index, 900, 20)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_cell", plan)
    assert max(int(n) for n in re.findall(r"limit=(\d+)", plan)) < 2_500      # the cell's share, not 18,000
    found = re.search(r"_cell#\d+ >= (\d+)\), \(_cell#\d+ <= (\d+)\)", plan)
    assert int(found.group(2)) - int(found.group(1)) <= 1


def test_no_rows_and_repeated_keys(spark, products):
    index = catalog.page_index(products.limit(0))
    assert catalog.indexed_page(index, 3).count() == 0
    twice = catalog.page_index(products.unionByName(products), cell_rows=700)
    got = [r["productId"] for p in range(1, 401) if p in (1, 2, 399, 400) for r in catalog.indexed_page(twice, p, 100).collect()]
    want = sorted((r[0] or "" for r in twice.rows.select("productId").collect()))
    assert [g or "" for g in got] == want[:200] + want[39_800:]

"""Product texts move no more often than a step reads them."""

import statistics

from pyspark.sql import functions as F

from ratelake.operators import prepare
from ratelake.plans import tables as T
from ratelake.sources import views


def folder_of(spark, tmp_path):
    """Two parts share a key, two documents too; one part has no document and one document no part."""
    spark.createDataFrame([(k, f"name {k}", "Brand#1", "LARGE" if k % 2 else "SMALL", float(k)) for k in (1, 2, 2, 4, 5)],
                          "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double") \
        .write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(1, "one"), (2, "two"), (2, "zwei"), (4, None), (9, "nine")], "doc_id long, text string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 3.0, "2001-01-01"), (1, 2, 4.0, "2001-01-02"), (2, 2, 5.0, "2001-01-03")],
                          "l_orderkey long, l_partkey long, l_quantity double, l_shipdate string") \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7), (2, 8)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_facts_are_the_cleaned_products_without_texts(spark, tmp_path, rows):
    folder = folder_of(spark, tmp_path)
    facts, whole = T.product_facts(spark, folder), T.cleaned_products(spark, folder)
    assert "description" not in facts.columns
    assert rows(facts) == rows(whole, *facts.columns)
    assert [r[0] for r in rows(facts, "productId")] == ["1", "2", "2", "2", "2", "4", "5"]


def test_enriched_products_move_their_texts_once(spark, tmp_path, rows):
    folder = folder_of(spark, tmp_path)
    again = prepare.enrich_products(T.cleaned_products(spark, folder), prepare.item_rating_stats(views.ratings(spark, folder)))
    assert rows(T.enriched_products(spark, folder)) == rows(again)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        products = views.products(spark, folder)
        stats = prepare.item_rating_stats(views.ratings(spark, folder))
        plan = prepare.enrich_products(products, stats)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Parts, texts, lines and orders move once each, and the sums of ratings; the described products not again.
    assert plan.count("Exchange hashpartitioning(") == 5, plan


def test_given_items_search_alone_and_find_the_same(spark, rows):
    from ratelake.operators import content
    vectors = spark.createDataFrame(
        [(f"p{i:02}", [i % 3, 3 + i % 4], [0.6, 0.8]) for i in range(24)], "productId string, terms array<int>, weights array<double>")
    whole = rows(content.similar_items(vectors, 5, span=8))
    # "p13" has the vector of "p01", which searches for it.
    for wanted in (["p13", "p05", "none"], ["none"]):
        assert rows(content.similar_items(vectors, 5, only=wanted, span=8)) == [r for r in whole if r[0] in wanted]
    _, members = content.neighbour_search(vectors, 5, only=["p13"], span=8)
    assert rows(members) == [("p13", "p01")]


def test_rating_lines_are_written_compressed(spark, tmp_path):
    import glob
    from ratelake.plans.queries import sourcing
    folder = folder_of(spark, tmp_path)
    spark.read.parquet(f"{folder}/lineitem.parquet").selectExpr("*", "'R' AS l_returnflag") \
        .write.parquet(f"{folder}/flagged/lineitem.parquet")
    spark.read.parquet(f"{folder}/orders.parquet").write.parquet(f"{folder}/flagged/orders.parquet")
    path = sourcing._raw_rating_lines(spark, f"{folder}/flagged")
    files = glob.glob(f"{path.removeprefix('file://')}/part-*")
    assert files and all(f.endswith(".txt.gz") for f in files)
    assert spark.read.text(path).count() == 3


def test_prices_are_imputed_from_two_runs_of_the_source(spark):
    """The counts behind the medians read two written columns, not whatever makes the products."""
    made = spark.sparkContext.accumulator(0)

    def seen(c):
        made.add(1)
        return c

    data = [(str(i), float(i * 37 % 1000) if i % 3 else None, f"c{i % 4}" if i % 7 else None) for i in range(2000)]
    source = spark.createDataFrame(data, "productId string, price double, category string")
    products = source.withColumn("category", F.udf(seen, "string")("category"))
    got = {r["productId"]: r["price"] for r in prepare.impute_prices(products).collect()}
    assert made.value <= 2 * len(data)
    known = {}
    for _, price, category in data:
        if price is not None:
            known.setdefault(category, []).append(price)
    medians = {c: statistics.median(v) for c, v in known.items() if c is not None}
    column = [p if p is not None else medians.get(c) for _, p, c in data]
    overall = statistics.median(p for p in column if p is not None)
    assert got == {k: p if p is not None else medians.get(c, overall) for k, p, c in data}

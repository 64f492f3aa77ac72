"""Physical plans: what reaches the scan, and what is cut before a shuffle."""

from ratelake.operators import catalog, features, ingest, prepare, ranking
from ratelake.session import stage
from ratelake.sources import views

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    ratings = stage(views.ratings(spark, FOLDER))
    text = plan(prepare.in_time_window(ratings).select("userId", "timestamp"))
    assert "GreaterThanOrEqual(timestamp,946684800)" in text
    assert "ReadSchema: struct<userId:string,timestamp:bigint>" in text
    products = stage(views.products(spark, FOLDER))
    text = plan(catalog.price_between(products, 910, 950).select("productId"))
    assert "GreaterThanOrEqual(price,910.0)" in text and "description" not in text


def test_copies_are_cut_before_the_shuffle(spark):
    products = stage(views.products(spark, FOLDER))
    text = plan(ingest.first_per_product(products))
    assert text.index("Final") < text.index("Exchange") < text.rindex("Partial")
    pairs = spark.createDataFrame([("u", "p", 1.0, 1.0)],
                                  "userId string, productId string, rating double, prediction double")
    text = plan(ranking.top_by_prediction(pairs, 10))
    assert text.index("Exchange") < text.index("Partial")


def test_deduplication_uses_hash_aggregation(spark):
    text = plan(prepare.keep_highest_rating(stage(views.ratings(spark, FOLDER))))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Window" not in text


def test_top_n_is_no_full_sort(spark):
    text = plan(features.popular_items(stage(views.ratings(spark, FOLDER)), 500))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_no_python_in_cooccurrence(spark):
    text = plan(features.cooccurrence(stage(views.ratings(spark, FOLDER))))
    assert "Python" not in text and "MapInArrow" not in text

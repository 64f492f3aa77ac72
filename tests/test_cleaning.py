import json

from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.functions import scalar as S
from ratelake.operators import ingest, prepare, quality
from ratelake.operators.quantiles import dense_index, exact_quantiles

R = "userId string, productId string, rating double, timestamp bigint"
P = "productId string, title string, price double, brand string, category string, description string"


def test_price_texts(spark, rows):
    df = spark.createDataFrame([("$1,299.00",), ("from 14.99",), ("1.2.3",), ("-5",), ("",), (None,), ("14.99",)],
                               "t string")
    got = {r[0]: r[1] for r in df.select("t", S.parse_price("t")).collect()}
    assert got == {"$1,299.00": 1299.0, "from 14.99": 14.99, "1.2.3": None, "-5": 5.0, "": None, None: None,
                   "14.99": 14.99}


def test_epoch_by_table_and_by_row(spark):
    def run(values, per_row=False):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, timestamp string")
        return [r["timestamp"] for r in ingest.normalise_epoch(df, per_row).orderBy("i").collect()]

    assert run(["946684800", "1893456000", None, "junk"]) == [946684800, 1893456000, 0, 0]
    assert run(["1588687728923", None, "946684800000"]) == [1588687728, 0, 946684800]
    # One large stamp makes the whole table milliseconds; row by row the small one is kept.
    assert run(["1588687728923", "946684800"]) == [1588687728, 946684]
    assert run(["1588687728923", "946684800", "1588687728923.0"], True) == [1588687728, 946684800, 1588687728]


def test_rating_range_and_window(spark, rows):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (6.0,), (None,)], "rating double")
    assert rows(ingest.rating_in_range(df)) == [(1.0,), (5.0,)]
    ts = spark.createDataFrame([(946684799,), (946684800,), (1893456000,), (1893456001,), (None,)], "timestamp long")
    assert rows(prepare.in_time_window(ts)) == [(946684800,), (1893456000,)]


def test_highest_rating_then_latest(spark, rows):
    df = spark.createDataFrame([
        ("a", "x", 3.0, 10), ("a", "x", 3.0, 10), ("a", "x", 5.0, 5), ("a", "x", 5.0, 7), ("a", "x", 1.0, 99),
        ("b", "x", None, 3), ("b", "x", 2.0, 1), ("c", "x", None, 4), (None, "x", 1.0, 1)], R)
    assert rows(prepare.keep_highest_rating(df)) == [
        (None, "x", 1.0, 1), ("a", "x", 5.0, 7), ("b", "x", 2.0, 1), ("c", "x", None, 4)]


def test_conservation_of_cleaning(spark):
    df = spark.createDataFrame([("u%d" % (i % 7), "p%d" % (i % 11), float(i % 5 + 1), 946684700 + i * 20)
                                for i in range(200)], R)
    kept = prepare.keep_highest_rating(df)
    duplicates = quality.duplicate_count(df, ["userId", "productId"]).first()[0]
    assert df.count() - duplicates == kept.count()
    outside = kept.where(~S.in_window("timestamp")).count()
    assert prepare.clean_ratings(df).count() == df.count() - duplicates - outside


def test_price_imputation_order(spark, rows):
    df = spark.createDataFrame([
        ("1", "t", 10.0, "b", "A", "d"), ("2", "t", 20.0, None, "A", "d"), ("3", None, None, "b", "A", None),
        ("4", "t", None, "b", "B", "d"), ("5", "t", None, "b", None, "d"), ("6", "t", 0.0, "b", None, "d")], P)
    # Median of A is 15; the filled column 10, 20, 15, 0 has the median 12.5.
    want = [("1", 10.0), ("2", 20.0), ("3", 15.0), ("4", 12.5), ("5", 12.5), ("6", 0.0)]
    assert rows(prepare.clean_products(df), "productId", "price") == want
    filled = {r["productId"]: r for r in prepare.clean_products(df).collect()}
    assert (filled["3"]["title"], filled["3"]["description"], filled["5"]["category"], filled["2"]["brand"]) == (
        "Untitled", "", "Unknown", "Unknown")


def test_first_row_per_product(spark, rows):
    df = spark.createDataFrame([("1", None, 3.0), ("1", "b", 4.0), ("1", "a", 9.0), ("2", None, None),
                                (None, "z", 1.0)], "productId string, title string, price double")
    assert rows(ingest.first_per_product(df)) == [("1", "a", 9.0), ("2", None, None)]


def test_enrichment_defaults(spark, rows):
    df = spark.createDataFrame([("1",), ("2",)], "productId string")
    stats = spark.createDataFrame([("1", 3, 2.3449)], "productId string, rating_count long, avg_rating double")
    assert rows(prepare.enrich_products(df, stats)) == [("1", 3, 2.34), ("2", 0, 0.0)]
    assert rows(prepare.enrich_products(df)) == [("1", 0, 0.0), ("2", 0, 0.0)]


def test_price_buckets(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.01,), (200.0,), (250.0,), (None,), (-3.0,)], "p double")
    got = [r[0] for r in df.select(S.price_bucket("p")).collect()]
    assert got == [None, "<$10", "$10-25", "$100-200", "$100-200", None, None]


def test_half_even(spark):
    df = spark.createDataFrame([(0.03125,), (-0.00001,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(S.half_even("x", 4)).collect()]
    assert got == [0.0312, 0.0, 2.5, None] and str(got[1]) == "0.0"


def test_quantiles_by_cells_are_exact(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    # A third of all rows share one value of one group; others spread over signs and sizes.
    data = [("hot", 5.0)] * 700 + [("hot", float(v)) for v in rng.normal(0, 1e6, 400)] + \
        [("cold", float(v)) for v in rng.lognormal(0, 3, 333)] + [("one", -2.0), ("zero", 0.0), ("zero", 0.0)]
    df = spark.createDataFrame(data + [("hot", None), (None, 1.0)], "k string, v double").repartition(5)
    probabilities = {"q1": 0.25, "q2": 0.5, "q3": 0.95}
    got = {r["k"]: r for r in exact_quantiles(df, "v", probabilities, ["k"]).collect()}
    assert set(got) == {"hot", "cold", "one", "zero"}
    for k in got:
        values = [v for g, v in data if g == k]
        for name, p in probabilities.items():
            assert abs(got[k][name] - np.quantile(values, p)) <= 1e-9 * max(1, abs(got[k][name]))
    every = exact_quantiles(df, "v", probabilities).first()
    assert abs(every["q2"] - np.median([v for _, v in data] + [1.0])) < 1e-9


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(empty, "v", {"m": 0.5}).first()["m"] is None


def test_quantiles_digit_by_digit(spark, monkeypatch):
    """Cells too large to sort are cut again, whatever the numbers: close ones, tiny and huge ones, infinite ones, copies."""
    import numpy as np
    from ratelake.operators import quantiles
    rng = np.random.default_rng(11)
    sets = {"close": 1 + np.arange(3000) * 1e-15, "tiny": rng.random(500) * 1e-310, "wide": np.exp(rng.normal(0, 200, 2000)) * rng.choice([-1, 1], 2000),
            "ends": np.array([-np.inf] * 5 + [np.inf] * 5 + [0.0, -0.0, 1.7e308, -1.7e308, 5e-324]), "copies": np.repeat([3.0, 4.0, 5.0], 700)}
    rows = [(k, float(v)) for k, x in sets.items() for v in x]
    df = spark.createDataFrame(rows, "k string, v double").repartition(3)
    p = {"a": 0.01, "b": 0.5, "c": 0.77, "d": 1.0}
    seen = []
    kept = quantiles.stage
    monkeypatch.setattr(quantiles, "stage", lambda d, n: seen.append(n) or kept(d, n))
    monkeypatch.setattr(quantiles, "SORTED_ROWS", 3)
    monkeypatch.setattr(quantiles, "PARTS", 16)

    def want(x, q):
        x, at = np.sort(x), q * (len(x) - 1)
        lo, hi = x[int(np.floor(at))], x[int(np.ceil(at))]
        return lo if at == np.floor(at) or lo == hi else lo + (hi - lo) * (at - np.floor(at))

    got = {r["k"]: r for r in exact_quantiles(df, "v", p, ["k"]).collect()}
    assert len(seen) >= 4
    for k, x in sets.items():
        for name, q in p.items():
            assert got[k][name] == want(x, q) or np.isnan(want(x, q)) and np.isnan(got[k][name]), (k, name)
    every = exact_quantiles(df, "v", p).first()
    assert [every[n] for n in p] == [want(np.array([v for _, v in rows]), q) for q in p.values()]
    weighed = df.groupBy("k", "v").count()
    assert exact_quantiles(weighed, "v", p, weight="count").first() == every


def test_quantiles_have_no_large_task(spark):
    """Only counts by cell meet in one task, never the rows."""
    values = spark.range(0, 300_000, 1, 4).select((F.col("id") * 1.0 + 1).alias("v"))
    plan = exact_quantiles(values, "v", {"m": 0.5, "t": 0.9})
    assert plan.first()["m"] == 150_000.5
    todo, single = [plan._jdf.queryExecution().executedPlan()], []
    plan.collect()
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName() == "Exchange" and "SinglePartition" in node.toString().split("\n")[0]:
            single.append(node.metrics().apply("shuffleRecordsWritten").value())
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
    assert all(n < 10_000 for n in single), single


def test_dense_index(spark):
    words = ["Video > %05d" % (i * 37 % 5000) for i in range(5000)] + ["Ärger", "a", "Z", ""]
    df = spark.createDataFrame([(w,) for w in words], "v string").repartition(6)
    want = {w: i for i, w in enumerate(sorted(words, key=lambda w: w.encode()))}
    for size, group in ((100_000, 1000), (1000, 1000), (200, 3), (7, 50)):
        assert {r["v"]: r["index"] for r in dense_index(df, "v", cell_rows=size, group_cells=group).collect()} == want


def test_dense_index_has_as_many_ranges_as_the_rows_need(spark, rows):
    """More than a thousand ranges, none of them large; null first; nothing of nothing."""
    ids = spark.range(30_000).select(F.concat(F.lit("id"), "id").alias("v"))
    indexed = dense_index(ids, "v", cell_rows=20)
    assert rows(indexed) == [(v, i) for i, v in enumerate(sorted(f"id{i}" for i in range(30_000)))]
    odd = spark.createDataFrame([(None,), ("b",), ("",)], "v string")
    assert rows(dense_index(odd, "v", cell_rows=1)) == [(None, 0), ("", 1), ("b", 2)]
    assert dense_index(odd.limit(0), "v").count() == 0


def test_quantiles_shuffle_few_rows(spark):
    """Whatever the range: only values near a wanted rank are shuffled and sorted."""
    import numpy as np
    values = spark.range(0, 200_000, 1, 4).select((1 + F.col("id") * 1.5e-9).alias("v"))
    found = exact_quantiles(values, "v", {"m": 0.5, "t": 0.9})
    row = found.first()
    want = np.quantile(1 + np.arange(200_000) * 1.5e-9, [0.5, 0.9])
    assert abs(row["m"] - want[0]) < 1e-12 and abs(row["t"] - want[1]) < 1e-12
    found.collect()
    moved, todo = [], [found._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        if "QueryStage" in node.nodeName():
            node = node.plan()
        if node.nodeName() == "Exchange":
            moved.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert moved and max(moved) < 200_000 * 0.01


def test_lines_pages_and_quarantine(spark, tmp_path, rows):
    from ratelake.sources import raw
    lines = [json.dumps({"user_id": "u1", "parent_asin": "p1", "rating": 5, "timestamp": 1588687728923, "x": 1}),
             json.dumps({"user_id": "u2", "parent_asin": "p1", "rating": 9, "timestamp": 1588687728923}),
             json.dumps({"user_id": None, "parent_asin": "p1", "rating": 2, "timestamp": 1588687728923}),
             json.dumps({"parent_asin": "p1", "rating": 2.5, "user_id": "u3"}), '{"user_id": "broken', "", "[1]x"]
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    good, bad = raw.read_rating_lines(spark, str(tmp_path / "r.jsonl"))
    assert rows(ingest.parse_ratings(good)) == [("u1", "p1", 5.0, 1588687728), ("u3", "p1", 2.5, 0)]
    assert rows(bad) == [("[1]x",), ('{"user_id": "broken',)]

    products = [{"parent_asin": "p1", "title": "T", "price": 14.5, "store": "S", "categories": ["A", "B"],
                 "description": ["x", "y"]},
                {"parent_asin": "p2", "title": "T", "price": "$3", "store": None, "categories": [],
                 "description": "plain [text]"},
                {"parent_asin": "p3", "title": "T", "price": None, "categories": None, "description": []},
                {"parent_asin": "p1", "title": "T"}]
    (tmp_path / "p.jsonl").write_text("\n".join(map(json.dumps, products)))
    good, _ = raw.read_product_lines(spark, str(tmp_path / "p.jsonl"))
    assert rows(ingest.parse_products(good)) == [
        ("p1", "T", 14.5, "S", "A > B", "x y"), ("p2", "T", 3.0, None, None, "plain [text]"),
        ("p3", "T", None, None, None, None)]
    assert ingest.missing_fields(good.drop("store"), schemas.PRODUCT_FIELDS) == ["store"]

    page = {"status": "success", "data": [{"productId": "p1", "price": 1.5}],
            "pagination": {"total": 3, "page": 1, "limit": 1, "pages": 3}}
    (tmp_path / "pages.jsonl").write_text(json.dumps(page))
    pages = raw.read_pages(spark, str(tmp_path / "pages.jsonl"))
    assert rows(ingest.explode_pages(pages), "productId", "price") == [("p1", 1.5)]
    assert ingest.page_coverage(pages).first().asDict() == {
        "pages_seen": 1, "pages_announced": 3, "pages_needed": 3, "complete": False}


def test_expectations(spark, rows):
    df = spark.createDataFrame([("AB1", 1.0), ("ab_1", 7.0), (None, None), ("AB1", 2.0)], "id string, v double")
    e = quality.Expectation
    got = dict(rows(quality.expect(df, [
        e("pattern", "matches", "id", pattern="^[A-Z0-9]+$"), e("unique", "unique", "id"),
        e("mostly", "between", "v", 0.0, 5.0, mostly=0.6), e("all", "between", "v", 0.0, 5.0),
        e("none missing", "not_null", "v"), e("low bound", "rows_between", None, 4, 9),
        e("high bound", "rows_between", None, 0, 4), e("short", "rows_between", None, 5, 9),
        e("absent", "not_null", "nope")], "t"), "expectation", "passed"))
    assert got == {"pattern": False, "unique": False, "mostly": True, "all": False, "none missing": False,
                   "low bound": True, "high bound": True, "short": False, "absent": False}


def test_checks_on_empty_tables(spark):
    results = quality.check_all(spark.createDataFrame([], schemas.RATINGS),
                                spark.createDataFrame([], schemas.PRODUCTS))
    assert results.count() == 12
    assert not results.where("check = 'sparsity'").first()["passed"]


def test_summary_cuts_detail(spark):
    df = spark.createDataFrame([("d", "c", True, "x" * 500)], "dataset string, check string, passed boolean, detail string")
    assert len(quality.summary_rows(df).first()["detail"]) == 200

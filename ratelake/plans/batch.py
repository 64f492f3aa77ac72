"""Batch steps from raw files to recommendations.  A failed step raises."""

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelake.operators import content, factors, features, ingest, prepare, quality, ranking
from ratelake.session import stage
from ratelake.sources import models, raw, snapshots, tables


def _together(*steps) -> list:
    """Run independent writes at the same time, so that a small one does not wait for a large one."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(step) for step in steps]]


def stamp() -> str:
    return time.strftime("%Y%m%d_%H%M%S", time.gmtime())


def ingest_all(spark: SparkSession, root: str, rating_lines: str, product_lines: str, pages: str | None = None,
               sample_users: int | None = None, ingest_ts: str | None = None) -> dict:
    """Ratings, products and, if given, catalog pages to snapshots, each with an audit row.

    Lines that are no such records go to the table ``quarantine`` with their source and file.  A rerun with the same
    ``ingest_ts`` replaces that snapshot and its quarantined lines.  A file whose records all lack a key raises; an
    empty one gives empty tables.  All users stay unless
    ``sample_users`` asks for the most active ones.
    """
    ts = ingest_ts or stamp()
    # Each file is parsed once; good and bad lines are two views of the staged result.
    good, bad = raw.split_lines(stage(raw.rating_lines(spark.read, rating_lines), "rating_lines"))
    ingest.require_filled(good, "user_id", "parent_asin", "rating")
    good_products, bad_products = raw.split_lines(stage(raw.product_lines(spark.read, product_lines), "product_lines"))
    ingest.require_filled(good_products, "parent_asin")
    jobs = {"ratings": select_users(ingest.select_ratings(good), sample_users), "products": ingest.parse_products(good_products)}
    bad = bad.withColumn("source", F.lit("ratings")).unionByName(bad_products.withColumn("source", F.lit("products")))
    if pages:
        good_pages, bad_pages = raw.split_lines(stage(raw.page_lines(spark.read, pages), "page_lines"))
        jobs["api_products"] = ingest.explode_pages(good_pages)
        bad = bad.unionByName(bad_pages.withColumn("source", F.lit("api_products")))
    for name, df in jobs.items():
        rows, seen = tables.watched(df)
        path = snapshots.append_snapshot(rows, f"{root}/raw/{name}", ts)
        tables.append_audit(spark, root, f"{name}_source", f"ingest_ts={ts}", path, seen)
    snapshots.append_snapshot(bad, f"{root}/quarantine", ts)
    return {name: snapshots.load_latest(spark, f"{root}/raw/{name}") for name in jobs}


def select_users(records: DataFrame, sample_users: int | None) -> DataFrame:
    """Epoch seconds and the most active users.

    ``records`` is a staged table: its largest stamp and its user counts are read
    off single columns, so that the text is parsed only once.
    """
    ratings = ingest.normalise_epoch(records)
    return ingest.keep_top_users(ratings, sample_users) if sample_users else ratings


def validate(ratings: DataFrame, products: DataFrame, root: str | None = None) -> DataFrame:
    """All checks and all expectations as one table ``dataset, check, passed, detail``."""
    results = quality.summary_rows(quality.check_all(
        ratings, products, quality.RATING_EXPECTATIONS, quality.PRODUCT_EXPECTATIONS))
    if root:
        tables.write_table(results, root, "check_results")
        return tables.read_table(results.sparkSession, root, "check_results")
    return results


def prepare_all(ratings: DataFrame, products: DataFrame, root: str, enrichment: DataFrame | None = None,
                enrich: bool = False) -> tuple:
    """Clean both tables, add catalog ratings if asked, and store them."""
    def catalog():
        cleaned = prepare.clean_products(products)
        if enrich:
            cleaned = prepare.enrich_products(cleaned, enrichment)
        return tables.write_folder(cleaned, root, "cleaned_products")

    paths = _together(lambda: tables.write_folder(prepare.clean_ratings(ratings), root, "cleaned_ratings"), catalog)
    tables.publish(ratings.sparkSession, root, dict(zip(("cleaned_ratings", "cleaned_products"), paths)))
    return tables.load_cleaned(ratings.sparkSession, root)


def build_features(ratings: DataFrame, products: DataFrame, root: str, top_n: int = 500, buckets: int | None = None) -> dict:
    """The four feature tables and the registry, from stored cleaned tables; published in one step.

    With ``buckets``, users and interactions are stored by user, so that training sets join them without a shuffle.
    """
    spark, folders = ratings.sparkSession, {}

    def write(name, df):
        folders[name] = (tables.write_feature_folder(df, root, name, buckets) if name in tables.FEATURE_SETS
                         else tables.write_folder(df, root, name))
        return tables.read_folder(spark, folders[name])

    def items_and_interactions():
        base = stage(features.item_base(ratings, products), "item_base")
        items = write("item_features", features.encode_items(base))
        write("interaction_features", features.interaction_features(ratings, items))

    _together(items_and_interactions,
              lambda: write("user_features", features.user_features(ratings, products)),
              lambda: write("cooccurrence", features.cooccurrence(ratings, top_n)))
    stored = {name: tables.read_folder(spark, folders[name]) for name in tables.FEATURE_SETS}
    _together(lambda: write("feature_registry", tables.feature_registry(stored)),
              lambda: write("feature_totals", tables.registry_totals(stored)))
    tables.publish(spark, root, folders)
    return stored


def train_factors(ratings: DataFrame, root: str, grid: dict | None = None, folds: int = 3, k: int = 10,
                  seed: int = 42) -> dict:
    """Grid search, measures on a held-out split, and a last fit on all ratings; all of it logged."""
    train, test = factors.holdout_split(ratings, 0.2, seed)
    train = stage(train, "train")
    best, scores = factors.search_factors(train, grid, folds, seed, keep=stage)
    setting = {"rank": int(best.get("rank", 20)), "max_iter": int(best.get("maxIter", 15)),
               "reg": best.get("regParam", 0.1)}
    held_out = stage(factors.predict_factors(test, factors.fit_factors(
        train, seed=seed, keep=stage, **setting)), "held_out")
    metrics = {}
    for row in (ranking.errors(held_out), ranking.precision_at_k(held_out, k),
                ranking.recall_at_k(held_out, k), ranking.ndcg_at_k(held_out, k),
                scores.agg(F.min("cv_rmse").alias("cv_best_rmse"))):
        metrics.update(row.first().asDict())
    models.save_factors(factors.fit_factors(ratings, seed=seed, keep=stage, **setting), root)
    run_id = tables.log_run(ratings.sparkSession, root, "factors", {**setting, "seed": seed, "k": k}, metrics)
    return {"run_id": run_id, "params": setting, "metrics": metrics}


def train_content(products: DataFrame, ratings: DataFrame, root: str, top_k: int = 50) -> dict:
    """Item vectors, the neighbour table, and its measures; all of it logged."""
    known = stage(content.rated_products(products, ratings), "rated_products")
    vectors = stage(content.tfidf_vectors(content.item_profiles(known)), "vectors")
    models.save_neighbours(content.similar_items(vectors, top_k), root)
    neighbours = models.load_neighbours(ratings.sparkSession, root)
    metrics = {**content.coverage(products, ratings).select("coverage_pct").first().asDict(),
               **content.mean_top_similarity(neighbours, known).select("avg_top_similarity").first().asDict()}
    run_id = tables.log_run(ratings.sparkSession, root, "content", {"top_k": top_k}, metrics)
    return {"run_id": run_id, "metrics": metrics}

"""Times the batch steps at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each step runs three times in one session and the fastest run counts, so that JVM
start-up and first-time code generation are not part of the figures; ``first_runs`` has
the first ones, and ``rows`` the sizes of the tables before and after cleaning.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ratelake.operators import content, factors, features, ingest, store  # noqa: E402
from ratelake.plans import batch  # noqa: E402
from ratelake.session import build_session, scratch_path, stage  # noqa: E402
from ratelake.sources import raw, tables, views  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    times, firsts = {}, {}

    def timed(name, step):
        runs = []
        for _ in range(3):
            start = time.time()
            result = step()
            runs.append(time.time() - start)
        times[name], firsts[name] = round(min(runs), 3), round(runs[0], 3)
        return result

    # Inputs as stored tables, so that no step pays for the view over the order lines.
    ratings = stage(views.ratings(spark, FOLDER).repartition(int(CPUS)), "ratings")
    products = stage(views.products(spark, FOLDER).repartition(int(CPUS)), "products")
    root = scratch_path(spark, "bench")

    lines = scratch_path(spark, "lines")
    ratings.select(F.to_json(F.struct(
        F.col("userId").alias("user_id"), F.col("productId").alias("parent_asin"), "rating",
        (F.col("timestamp") * 1000).alias("timestamp"))).alias("value")).write.text(lines)
    timed("ingest_ratings", lambda: drain(batch.select_users(
        stage(ingest.select_ratings(raw.read_rating_lines(spark, lines)[0])), 10_000)))
    timed("validate", lambda: batch.validate(ratings, products, root))
    cleaned, catalog = timed("prepare", lambda: batch.prepare_all(ratings, products, root))
    stored = timed("build_features", lambda: batch.build_features(cleaned, catalog, root))
    timed("register_version", lambda: tables.register_version(spark, root, "v1"))
    timed("training_set", lambda: drain(store.training_set(
        stored["interaction_features"], stored["user_features"], stored["item_features"])))
    timed("cooccurrence", lambda: drain(features.cooccurrence(cleaned)))
    offsets = factors.fit_offsets(cleaned)
    offsets = factors.Offsets(stage(offsets.mean), stage(offsets.users), stage(offsets.items))
    timed("recommend_all_users", lambda: drain(factors.recommend(cleaned, cleaned, catalog, offsets)))
    vectors = timed("tfidf_vectors", lambda: stage(content.tfidf_vectors(
        content.item_profiles(content.rated_products(catalog, cleaned)))))
    timed("similar_items", lambda: drain(content.similar_items(vectors)))
    rows = {"ratings": ratings.count(), "products": products.count(), "cleaned_ratings": cleaned.count(),
            "cleaned_products": catalog.count()}
    print(json.dumps({"metric": "batch_steps_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "first_runs": firsts, "rows": rows,
                      "sf": os.path.basename(FOLDER.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()

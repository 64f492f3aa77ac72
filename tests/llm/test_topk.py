"""Exact top-k search: candidates are copied only to query blocks that can reach them."""

import numpy as np
from pyspark.sql import functions as F

from ratelake.llm import topk


def _staged(spark, lengths, floors):
    """Candidates of given lengths, queries of length 1 with given floors."""
    ints = spark.createDataFrame([(i, [int(x)], float(x)) for i, x in enumerate(lengths)], "vec_id long, v array<long>, length double")
    asked = spark.createDataFrame([(10_000 + i, [1], 1.0, float(f)) for i, f in enumerate(floors)],
                                  "vec_id long, v array<long>, length double, floor double")
    return ints, asked


def test_copies_of_candidates(spark):
    lengths = [2 ** (1 + i % 8) for i in range(800)]                # 100 candidates of each length 2 .. 256
    floors = [200.0] * 64 + [20.0] * 64                             # only 256; 32 and more
    candidates, queries = topk.deal(*_staged(spark, lengths, floors), block=1000, query_block=16)
    copies = {r["vec_id"]: r["count"] for r in candidates.groupBy("vec_id").count().collect()}
    for i, x in enumerate(lengths):
        assert copies.get(i, 0) == 4 * (x >= 200) + 4 * (x >= 20)   # four blocks of each need, not eight for all
    assert sum(copies.values()) == 100 * (8 + 3 * 4)                # 2,000 instead of 6,400
    # Every query meets each candidate that it can reach once, and no pair twice.
    pairs = candidates.alias("c").join(queries.alias("q"), ["bin", "salt", "need", "q_salt"]) \
        .select(F.col("c.vec_id").alias("c"), F.col("q.vec_id").alias("q"))
    assert pairs.count() == pairs.distinct().count() == 64 * 100 + 64 * 400


def test_extra_columns_with_clashing_names(spark):
    rng = np.random.default_rng(3)
    data = [(i, [float(x) for x in rng.normal(size=4) * 4.0 ** (i % 5)]) for i in range(300)]
    plain = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    odd = plain
    for name in ("length", "is_query", "v", "bin", "salt", "need", "q_salt", "floor", "salts", "bins", "b", "to", "needs", "query_id", "rank", "score"):
        odd = odd.withColumn(name, F.lit("x"))
    ints = {i: [int(np.floor(1024 * x)) for x in v] for i, v in data}
    want = set()
    for q in range(0, 300, 7):
        scores = sorted(((-sum(a * b for a, b in zip(ints[q], ints[c])), c) for c in ints if c != q))[:10]
        want |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(scores)}
    got = {tuple(r) for r in topk.top_products(odd, F.col("vec_id") % 7 == 0, block=32, query_block=4)
           .select("query_id", "rank", "vec_id", "score").collect()}
    assert got == want

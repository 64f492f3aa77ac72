"""Exact top-k inner products over integer vectors, longest vectors first.

Candidates are dealt into blocks of similar length, queries into blocks of bounded
size.  The longest vectors of all give every query a first floor under its
k-th score; a query goes only to blocks whose longest vector can reach
it.  Inside a block the candidates come in order of falling length.  Both sides
are rotated by the singular vectors of all candidates, so the first few
coordinates hold most of a product, and the Cauchy-Schwarz bound of the rest prunes.
What is left is scored exactly on the integers.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratelake.session import stage

SCALE = 1024
HEAD = 16
#: Longest vectors that set the first floors, candidates and queries of a block, candidates scored at a time.
SEEDS, BLOCK, QUERY_BLOCK, STEP = 1024, 8192, 4096, 1024
FOUND = "query_id long, vec_id long, score long"


def integers(vector: str = "embedding", scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: str = "embedding") -> Column:
    """No null and only finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, finite)


def matrix(lists, width):
    """Rows of a list column as a matrix, shorter rows filled with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    for i, (end, n) in enumerate(zip(np.cumsum(sizes), sizes)):
        out[i, :n] = flat[end - n:end]
    return out


def products(left, right):
    """Integer inner products; through floats only where those are exact."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2 ** 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


def gram(width: int, matrix):
    """Task body: the sum of the outer products of a partition's vectors, row by row."""

    def body(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column("v"), width).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()),
             pa.ListArray.from_arrays(pa.array(np.arange(width + 1) * width, pa.int32()), pa.array(total.ravel()))],
            names=["i", "sums"])

    return body


def floors(seed_ids, seeds, width, k, matrix, products):
    """Task body: each query's k-th best score among the seeds, or none with fewer seeds."""

    def body(batches):
        for batch in batches:
            score = products(matrix(batch.column("v"), width), seeds).astype(np.float64)
            own = batch.column("vec_id").to_numpy()[:, None] == seed_ids[None, :]
            score[own] = -np.inf
            kth = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(score), -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kth)], names=[*batch.schema.names, "floor"])

    return body


def search_block(width, k, rotation, head, step, matrix, products):
    """Task body: the best k candidates of a block for each query of a query block."""

    def body(table):
        import numpy as np
        import pyarrow as pa

        asks = table["is_query"].to_numpy().astype(bool)
        queries, found = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
        out = ([], [], [])
        if len(queries) and len(found):
            ids, x = found["vec_id"].to_numpy(), matrix(found["v"], width)
            length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
            order = np.lexsort((ids, -length))
            ids, x, length = ids[order], x[order], length[order]
            q, q_ids = matrix(queries["v"], width), queries["vec_id"].to_numpy()
            floor = queries["floor"].to_numpy().astype(np.float64)
            q_length = np.sqrt((q.astype(np.float64) ** 2).sum(1))
            qr, xr = q @ rotation, x @ rotation
            q_rest, x_rest = (np.sqrt((m[:, head:] ** 2).sum(1)) for m in (qr, xr))
            best_score = [np.zeros(0, np.int64)] * len(q)
            best_id = [np.zeros(0, np.int64)] * len(q)
            for a in range(0, len(ids), step):
                b = min(a + step, len(ids))
                # Room for rounding in the bounds; scores themselves are whole numbers.
                slack = 1e-9 * q_length * length[a] + 1e-6
                live = np.flatnonzero(q_length * length[a] + slack >= floor)
                if not len(live):
                    break
                bound = qr[live, :head] @ xr[a:b, :head].T + np.outer(q_rest[live], x_rest[a:b]) + slack[live, None]
                open_ = (bound >= floor[live, None]) & (q_ids[live, None] != ids[None, a:b])
                rows = np.flatnonzero(open_.any(1))
                columns = np.flatnonzero(open_.any(0))
                if not len(rows):
                    continue
                score = products(q[live[rows]], x[a:b][columns])
                for r, exact in zip(rows, score):
                    i, keep = live[r], open_[r, columns]
                    s = np.append(best_score[i], exact[keep])
                    n = np.append(best_id[i], ids[a:b][columns[keep]])
                    top = np.lexsort((n, -s))[:k]
                    best_score[i], best_id[i] = s[top], n[top]
                    if len(top) == k:
                        floor[i] = max(floor[i], float(s[top[-1]]))
            out = (np.repeat(q_ids, [len(s) for s in best_score]), np.concatenate(best_id), np.concatenate(best_score))
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), out)})

    return body


def deal(ints: DataFrame, asked: DataFrame, block: int, query_block: int) -> tuple:
    """Candidates and queries as rows ``bin, salt, need, q_salt, is_query, vec_id, v, floor``, one for each task they go to.

    Candidates of similar length share a bin (half a factor of two), queries that need candidates of similar length
    (floor over own length, in eighths, then up to a full block) a need; hash salts cut both to ``block`` and ``query_block`` rows.  A candidate is
    copied only to needs of which a query reaches its bin, a query only to bins that it reaches.
    """
    bin_ = F.when(F.col("length") > 0, F.floor(F.log2("length") * 2).cast("int")).otherwise(F.lit(-10_000))
    least = F.try_divide(F.col("floor"), F.col("length"))
    need = F.when((least > 0) & (least < float("inf")), F.floor(F.log2(least) * 8).cast("int")).otherwise(F.lit(-10_000))
    binned, needing = ints.select("vec_id", "v", bin_.alias("bin"), "length"), asked.withColumn("need", need)
    # Some thousand bins and needs at most: exponents of doubles.
    bins = binned.groupBy("bin").agg(F.max("length").alias("longest"), F.ceil(F.count(F.lit(1)) / block).alias("salts"))
    # Neighbouring needs share a block until it is full, so few queries make few blocks.
    before = Window.orderBy("need").rowsBetween(Window.unboundedPreceding, -1)
    cells = needing.groupBy(F.col("need").alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need")) \
        .withColumn("need", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / query_block))
    needs = cells.withColumn("q_salts", F.ceil(F.sum("n").over(Window.partitionBy("need")) / query_block)).drop("n")
    bins, needs = stage(bins, "bins"), stage(needs, "needs")
    needing = needing.withColumnRenamed("need", "cell")
    all_bins = bins.agg(F.collect_list(F.struct("bin", "longest", "salts")).alias("bins")).select("bins").scalar()
    reach = F.filter(F.col("bins"), lambda b: F.col("length") * b["longest"] * (1 + 1e-9) + 1e-6 >= F.col("floor"))
    reaching = needing.withColumn("bins", all_bins).withColumn("b", F.explode(reach)).join(needs, "cell")
    reached = stage(reaching.groupBy("need", F.col("b.bin").alias("bin"), F.col("b.salts").alias("salts"), "q_salts")
                    .agg(F.count(F.lit(1)).alias("n")).groupBy("bin", "salts").agg(
                        F.collect_list(F.struct("need", "q_salts")).alias("needs")), "reached")
    spot = F.xxhash64("vec_id")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    candidates = (binned.join(reached, "bin").withColumn("salt", F.pmod(spot, F.col("salts")))
                  .withColumn("to", F.explode("needs"))
                  .select("bin", "salt", F.col("to.need").alias("need"), F.explode(upto(F.col("to.q_salts"))).alias("q_salt"),
                          F.lit(False).alias("is_query"), "vec_id", "v", F.lit(None).cast("double").alias("floor")))
    queries = reaching.select(F.col("b.bin").alias("bin"), F.explode(upto(F.col("b.salts"))).alias("salt"), "need",
                              F.pmod(F.shiftright(spot, 20), F.col("q_salts")).alias("q_salt"),
                              F.lit(True).alias("is_query"), "vec_id", "v", "floor")
    return candidates, queries


def top_products(vectors: DataFrame, is_query: Column, k: int = 10, vector: str = "embedding", scale: int = SCALE,
                 head: int = HEAD, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest inner products, ties to the smaller ``vec_id``.

    Components become floor(scale * x).  Vectors that are null or hold null or non-finite components, and rows
    without a ``vec_id``, take no part; missing components of shorter vectors are zeros; scores must fit 64 bits.
    A query's own id is no candidate.  A query row that occurs twice asks once; other repeated rows are candidates
    each.  With fewer than ``k`` candidates all come back; an empty table gives no rows.
    """
    ints = vectors.where(usable(vector) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), integers(vector, scale).alias("v"), is_query.alias("is_query"))
    ints = stage(ints.withColumn("length", F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))), "vectors")
    n_queries, width, longest = ints.agg(F.count_if("is_query"), F.max(F.size("v")), F.max("length")).first()
    if not n_queries:
        return ints.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    width = max(width, 1)
    bodies = by_value(matrix, products)

    # Bounded by the square of the vectors' width.
    sums = ints.mapInArrow(gram(width, bodies[0]), "i int, sums array<double>").select("i", F.posexplode("sums")) \
        .groupBy("i", "pos").agg(F.sum("col").alias("s")).toArrow()
    square = np.zeros((width, width))
    square[sums["i"].to_numpy(), sums["pos"].to_numpy()] = sums["s"].to_numpy()
    rotation = np.ascontiguousarray(np.linalg.svd(square)[0])

    seeds = ints.orderBy(F.desc("length"), "vec_id").limit(SEEDS).select("vec_id", "v").toArrow()
    asked = stage(ints.where("is_query").select("vec_id", "v", "length").distinct().mapInArrow(
        floors(seeds["vec_id"].to_numpy(), matrix(seeds["v"], width), width, k, *bodies),
        "vec_id long, v array<long>, length double, floor double"), "queries")

    candidates, queries = deal(ints, asked, block, query_block)
    found = candidates.unionByName(queries).groupBy("bin", "salt", "need", "q_salt").applyInArrow(
        search_block(width, k, rotation, min(head, width), STEP, *bodies), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def by_value(*functions):
    """Let this module travel with the tasks, so that executors need no copy of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return functions


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

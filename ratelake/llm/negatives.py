"""Hard negatives from blocks along a Hilbert curve, chosen by interval bounds over zone maps.

Candidates are sorted by label and by their place on a Hilbert curve through the leading singular
directions, cut into blocks and written as Parquet with each block's zone map: the least and
largest value of every rotated dimension.  The interval product of an anchor and a zone map bounds
every score of the block from both sides.  A block is copied only to the groups of anchors that hold
one whose wanted range of scores it can reach; there the anchors that can't use it
are left out once more, and the rest is scored exactly on integers.

Two searches run this way: the best rows of the anchor's own label, then, for each of
them, the best rows of other labels inside its window of scores.
"""

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from ratelake.llm.topk import by_value as topk_by_value, gram, integers, matrix, usable
from ratelake.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256
#: Directions of the curve and bits of each.
CURVE_DIMS, CURVE_BITS = 8, 6
#: Candidates of a block, anchors of a group, candidates that a task takes for a group, anchors multiplied at once.
BLOCK, GROUP, LANE, STEP = 2048, 131_072, 262_144, 512
#: Zone maps that a task holds against a group.
ZONES = 4096
LEAST_LANES = 8


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of whole coordinates below ``2^bits`` on the Hilbert curve."""
    x = cells.astype(np.int64).copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        for i in range(x.shape[1]):
            inside = (x[:, i] & q) != 0
            swap = np.where(inside, 0, (x[:, 0] ^ x[:, i]) & (q - 1))
            x[:, 0] ^= np.where(inside, q - 1, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, x.shape[1]):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    while top > 1:
        turn ^= np.where(x[:, -1] & top, top - 1, 0)
        top >>= 1
    x ^= turn[:, None]
    place = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(x.shape[1]):
            place = (place << 1) | ((x[:, i] >> b) & 1)
    return place


def curve_places(width, rotation, spread, dims, bits, matrix):
    """Task body: adds each vector's place on the curve."""

    def body(batches):
        for batch in batches:
            x = matrix(batch.column("v"), width).astype(np.float64) @ rotation[:, :dims]
            cells = np.clip((x / spread[:dims] + 3) / 6 * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(cells, bits))],
                                             names=[*batch.schema.names, "place"])

    return body


def span(x):
    """Least and largest value of each dimension."""
    return x.min(0), x.max(0)


def reach(anchors, low, high):
    """Bounds of the products of each anchor with vectors between ``low`` and ``high``, with room for rounding."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    most = np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T
    slack = 1e-9 * most + 1e-6
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def scores(left, right):
    """Integer inner products; through floats only where those are exact."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2 ** 53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def first_of_each(rows, score, ids, k):
    """Order of the first ``k`` entries of each row: higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -score, rows))
    r = rows[order]
    new = np.append(True, r[1:] != r[:-1]) if len(r) else np.zeros(0, bool)
    rank = np.arange(len(r)) - np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
    return order[rank < k]


def cut_blocks(width, rotation, size, k, matrix):
    """Task body: cuts a sorted partition into blocks; a block's first row carries its zone map.

    An anchor gets the score of its ``k``-th best row of the same label in its own block, a floor for the search.
    """

    def finished(rows, number):
        x = matrix(rows["v"], width)
        low, high = span(x.astype(np.float64) @ rotation)
        n = len(x)
        label, ids = rows["label"].to_numpy(), rows["vec_id"].to_numpy()
        floor = np.full(n, np.nan)
        asks = np.flatnonzero(rows["is_anchor"].to_numpy(zero_copy_only=False))
        for a in range(0, len(asks), STEP):
            at = asks[a:a + STEP]
            found = scores(x[at], x).astype(np.float64)
            found[(label[at][:, None] != label) | (ids[at][:, None] == ids)] = -np.inf
            if n >= k:
                kth = np.partition(found, n - k, axis=1)[:, n - k]
                floor[at] = np.where(np.isfinite(kth), kth, np.nan)
        zone = lambda z: pa.array([z.tolist()] + [None] * (n - 1), pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, number), pa.int64()), *(rows[c].combine_chunks() for c in ("vec_id", "label", "v", "is_anchor", "place")),
             pa.array(floor, from_pandas=True), zone(low), zone(high)],
            names=["block", "vec_id", "label", "v", "is_anchor", "place", "floor", "low", "high"])

    def body(batches):
        number = TaskContext.get().partitionId() << 32
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while len(held) >= size:
                yield finished(held.slice(0, size).combine_chunks(), number)
                held, number = held.slice(size), number + 1
        if held is not None and len(held):
            yield finished(held.combine_chunks(), number)

    return body


def numbered(batches):
    """Task body: numbers the anchors of a partition."""
    part, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        rows = np.arange(n, n + batch.num_rows)
        n += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(rows), part), pa.int64()), pa.array((part << 33) + rows)],
            names=[*batch.schema.names, "part", "anchor"])


def choose_blocks(width, rotation, matrix, reach):
    """Task body: the blocks of a chunk of zone maps that some anchor of a group can use."""

    def body(table):
        import numpy as np
        import pyarrow as pa

        asks = table.filter(pa.array(table["low"].is_null()))
        zones = table.filter(pa.array(table["low"].is_valid()))
        if not len(asks) or not len(zones):
            return pa.table({"block": pa.array([], pa.int64()), "group": pa.array([], pa.int64())})
        flat = lambda c: np.array(zones[c].to_pylist(), np.float64).reshape(len(zones), -1)
        low, high = flat("low"), flat("high")
        first, last = (zones[c].to_numpy() for c in ("label_low", "label_high"))
        need = np.zeros(len(zones), bool)
        label, least, most, own = (asks[c].to_numpy() for c in ("label", "least", "most", "own"))
        a = matrix(asks["v"], width).astype(np.float64) @ rotation
        for s in range(0, len(a), 512):
            e = slice(s, s + 512)
            under, over = reach(a[e], low, high)
            meets = (over >= least[e, None]) & (under <= most[e, None])
            same = (label[e, None] >= first) & (label[e, None] <= last)
            other = (label[e, None] != first) | (label[e, None] != last)
            need |= (meets & np.where(own[e, None], same, other)).any(0)
        blocks = zones["block"].to_numpy()[need]
        return pa.table({"block": pa.array(blocks, pa.int64()),
                         "group": pa.array(np.full(len(blocks), table["group"][0].as_py()), pa.int64())})

    return body


class Search:
    """The best rows for the anchors of one group among the blocks of one lane, block after block."""

    def __init__(self, asks, width, rotation, k, own):
        import numpy as np

        self.k, self.own, self.width, self.rotation = k, own, width, rotation
        self.x = matrix(asks["v"], width)
        self.rotated = self.x.astype(np.float64) @ rotation
        self.anchor, self.ids, self.label = (asks[c].to_numpy() for c in ("anchor", "vec_id", "label"))
        # Ranges of scores wanted, one column each; a missing one is empty.
        lists = lambda c: np.array([r for r in asks[c].to_pylist()], np.float64).reshape(len(asks), -1)
        self.low, self.high = lists("lows"), lists("highs")
        self.found = [[] for _ in range(self.low.shape[1])]

    def add(self, block):
        order = np.argsort(block["vec_id"].to_numpy(), kind="stable")
        ids, label, x = block["vec_id"].to_numpy()[order], block["label"].to_numpy()[order], matrix(block["v"], self.width)[order]
        low, high = span(x.astype(np.float64) @ self.rotation)
        under, over = reach(self.rotated, low[None], high[None])
        useful = np.flatnonzero(((over >= self.low) & (under <= self.high)).any(1))
        n = len(x)
        for a in range(0, len(useful), STEP):
            rows = useful[a:a + STEP]
            s = scores(self.x[rows], x)
            same = self.label[rows][:, None] == label
            open_ = same & (self.ids[rows][:, None] != ids) if self.own else ~same
            for j, kept in enumerate(self.found):
                mask = open_ & (s >= self.low[rows, j, None]) & (s <= self.high[rows, j, None])
                if n > self.k and mask.any():
                    kth = np.partition(np.where(mask, s, np.iinfo(np.int64).min), n - self.k, axis=1)[:, n - self.k]
                    mask &= s >= kth[:, None]
                r, c = np.nonzero(mask)
                if len(r):
                    best = first_of_each(r, s[r, c], ids[c], self.k)
                    kept.append((rows[r[best]], s[r[best], c[best]], ids[c[best]]))
        for j, kept in enumerate(self.found):
            if sum(len(p[0]) for p in kept) > 4 * self.k * max(len(self.x), STEP):
                self.merge(j)

    def merge(self, j):
        """Keeps the best so far, and raises the floors of anchors that have enough."""
        if not self.found[j]:
            return None
        rows, s, ids = (np.concatenate(p) for p in zip(*self.found[j]))
        best = first_of_each(rows, s, ids, self.k)
        rows, s, ids = rows[best], s[best], ids[best]
        self.found[j] = [(rows, s, ids)]
        full = np.flatnonzero(np.bincount(rows, minlength=len(self.x)) == self.k)
        last = np.searchsorted(rows, full, side="right") - 1
        self.low[full, j] = np.maximum(self.low[full, j], s[last])
        return rows, s, ids

    def rows(self):
        for j in range(len(self.found)):
            merged = self.merge(j)
            if merged:
                rows, s, ids = merged
                yield pa.RecordBatch.from_arrays(
                    [pa.array(self.anchor[rows]), pa.array(np.full(len(rows), j), pa.int32()), pa.array(ids, pa.int64()), pa.array(s, pa.int64())],
                    names=["anchor", "wanted", "vec_id", "score"])


def search_lanes(width, rotation, k, own):
    """Task body for sorted rows: the anchors of each group and lane, then their blocks one after another."""

    def runs(batches, *names):
        """Slices of batches with equal values of the columns."""
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in names])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for a, b in zip(np.append(0, edges), np.append(edges, batch.num_rows)):
                yield tuple(key[:, a]), pa.Table.from_batches([batch.slice(a, b - a)])

    def whole(batches):
        """Joins slices that go on in the next batch."""
        now, parts = None, []
        for key, part in runs(batches, "group", "lane", "block"):
            if key != now and parts:
                yield now, pa.concat_tables(parts).combine_chunks()
                parts = []
            now = key
            parts.append(part)
        if parts:
            yield now, pa.concat_tables(parts).combine_chunks()

    def body(batches):
        search, place = None, None
        for (group, lane, block), part in whole(batches):
            if block == -1:
                if search:
                    yield from search.rows()
                search, place = Search(part, width, rotation, k, own), (group, lane)
            elif place == (group, lane):
                search.add(part)
        if search:
            yield from search.rows()

    return body


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 5,
                   low_percent: int = 80, high_percent: int = 100, vector: str = "embedding", scale: int = SCALE,
                   block: int = BLOCK, group: int = GROUP, lane: int = LANE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(scale * x).  An anchor's positives are its ``positives`` best other rows of the
    same label; for each, its ``negatives`` best rows of other labels whose score lies between
    ``low_percent`` and ``high_percent`` of the positive's score; higher scores first, ties to the smaller ``vec_id``.

    Rows whose id, label or vector is null, or whose vector holds null or non-finite components, take no part.
    Missing components of shorter vectors are zeros; scores must lie below 2^53.  Rows with the anchor's own id
    are no positives.  A negative positive_score has an empty window.  An anchor row that occurs twice asks once; other repeated rows are candidates each.  With
    fewer rows in a window all come back, an anchor without any has no row, and an empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                           F.col(vector).alias("_v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    ints = stage(given.where(usable("_v") & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        "vec_id", "label", integers("_v", scale).alias("v"), "is_anchor"), "vectors")
    largest = F.max(F.aggregate("v", F.lit(0).cast("long"), lambda s, x: F.greatest(s, F.abs(x))))
    n, n_anchors, width, largest = ints.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.max(F.size("v")), largest).first()
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    if not n_anchors:
        return ints.sparkSession.createDataFrame([], ", ".join(f"{c} {'int' if c == 'rank' else 'long'}" for c in names))
    width = max(width, 1)
    kind = "smallint" if largest < 2 ** 15 else "int" if largest < 2 ** 31 else "bigint"
    ints = ints.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    bodies = topk_by_value(gram, matrix)

    # Bounded by the square of the vectors' width.
    sums = ints.mapInArrow(bodies[0](width, bodies[1]), "i int, sums array<double>").select("i", F.posexplode("sums")) \
        .groupBy("i", "pos").agg(F.sum("col").alias("s")).toArrow()
    square = np.zeros((width, width))
    square[sums["i"].to_numpy(), sums["pos"].to_numpy()] = sums["s"].to_numpy()
    rotation, strength, _ = np.linalg.svd(square)
    rotation, spread = np.ascontiguousarray(rotation), np.sqrt(np.maximum(strength, 1e-9) / n)
    dims = min(CURVE_DIMS, width)

    shape = f"vec_id long, label long, v array<{kind}>, is_anchor boolean"
    placed = ints.mapInArrow(curve_places(width, rotation, spread, dims, CURVE_BITS, matrix), f"{shape}, place long")
    lanes = max(LEAST_LANES, -(-n // lane))
    curve = (placed.repartitionByRange(lanes, "label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id")
             .mapInArrow(cut_blocks(width, rotation, block, positives, matrix),
                         f"block long, {shape}, place long, floor double, low array<double>, high array<double>"))
    curve = stage(curve, "curve")
    zones = stage(curve.groupBy("block").agg(
        F.min("label").alias("label_low"), F.max("label").alias("label_high"),
        F.max("low").alias("low"), F.max("high").alias("high")), "zones")

    groups = -(-n_anchors // group)
    asks = (curve.where("is_anchor").groupBy("vec_id", "label", "v", "place").agg(F.max("floor").alias("floor"))
            .repartitionByRange(groups, "label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id")
            .mapInArrow(numbered, f"vec_id long, label long, v array<{kind}>, place long, floor double, part long, anchor long"))
    asks = stage(asks, "anchors")
    parts = asks.agg(F.max("part")).first()[0] + 1
    asks = asks.withColumn("group", F.floor(F.col("part") * groups / parts)).drop("part", "place")

    def search(asks: DataFrame, k: int, own: bool) -> DataFrame:
        """``anchor, wanted, vec_id, score``: best ``k`` rows of each of the ranges ``lows`` to ``highs`` of each anchor."""
        chunks = max(1, -(-(n // block + lanes) // ZONES))
        spot = F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk")
        chunk_list = F.sequence(F.lit(0), F.lit(chunks - 1))
        empty = F.lit(None).cast("array<double>")
        sides = asks.select(
            "group", F.explode(chunk_list).alias("chunk"), "v", "label", F.array_min("lows").alias("least"),
            F.array_max("highs").alias("most"), F.lit(own).alias("own"), F.lit(None).cast("long").alias("block"),
            F.lit(None).cast("long").alias("label_low"), F.lit(None).cast("long").alias("label_high"),
            empty.alias("low"), empty.alias("high")).unionByName(zones.select(
                F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"), spot,
                F.lit(None).cast(f"array<{kind}>").alias("v"), F.lit(None).cast("long").alias("label"),
                F.lit(None).cast("double").alias("least"), F.lit(None).cast("double").alias("most"),
                F.lit(own).alias("own"), "block", "label_low", "label_high", "low", "high"))
        needed = stage(sides.groupBy("group", "chunk").applyInArrow(
            choose_blocks(width, rotation, matrix, reach), "block long, group long"), "needed")
        copies = curve.join(needed, "block").select(
            "group", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int").alias("lane"), "block", "vec_id", "label", "v",
            F.lit(None).cast("long").alias("anchor"), empty.alias("lows"), empty.alias("highs"))
        first = asks.select(
            "group", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.lit(-1).cast("long").alias("block"),
            "vec_id", "label", "v", "anchor", "lows", "highs")
        dealt = first.unionByName(copies).repartition("group", "lane").sortWithinPartitions("group", "lane", "block")
        found = dealt.mapInArrow(search_lanes(width, rotation, k, own), "anchor long, wanted int, vec_id long, score long")
        best = Window.partitionBy("anchor", "wanted").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    endless = F.lit(float("inf"))
    friends = stage(search(asks.withColumn("lows", F.array(F.coalesce("floor", -endless))).withColumn("highs", F.array(endless)),
                           positives, True).select("anchor", F.col("rank").alias("place"), "vec_id", "score"), "positives")
    # Windows that no score can lie in are closed: the range from inf to -inf.
    open_ = F.col("score") >= 0
    edges = friends.select("anchor", (F.col("place") - 1).alias("wanted"),
                           F.when(open_, F.expr(f"(score * {low_percent} + 99) div 100").cast("double")).otherwise(endless).alias("low"),
                           F.when(open_, F.expr(f"score * {high_percent} div 100").cast("double")).otherwise(-endless).alias("high"))
    ranges = edges.groupBy("anchor").agg(*[
        F.array(*[F.coalesce(F.max(F.when(F.col("wanted") == j, F.col(c))), shut) for j in range(positives)]).alias(f"{c}s")
        for c, shut in (("low", endless), ("high", -endless))])
    enemies = search(asks.join(ranges, "anchor"), negatives, False)
    return (enemies.select("anchor", (F.col("wanted") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"),
                           F.col("score").alias("negative_score"))
            .join(friends.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
                  ["anchor", "place"])
            .join(asks.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select(*names))


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

"""Mixing sources to target weights with the Sainte-Laguë method.

Words are dealt in blocks of ``block_words``.  The sources' targets get blocks
by highest quotients target / (2k + 1); a source's blocks go to its shards the same way.
Inside a shard the documents stand in seeded order on one line of blocks, and the
shard's quota is taken as whole rounds of the line and one seeded run of
neighbouring blocks, round the end.  What a document gives follows from its
place on the line, so no block is ever a row.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ratelake.llm.runtime import WORD, fresh, quoted
from ratelake.session import stage

#: Words of a block, words of a shard, share of all words to take, most rounds of a source.
BLOCK_WORDS = 16
SHARD_WORDS = 1_000_000
SHARE = 1.5
ROUNDS = 2
#: Weights by position of the source's name in code point order, repeating, null last.
WEIGHTS = (3, 1, 2)


def word_count(text="text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def hash_number(*parts) -> Column:
    """A whole number below 2^32 from the MD5 of the parts, which any engine can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("/", *parts)), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, rounds: int = ROUNDS, weights=WEIGHTS) -> DataFrame:
    """``source_no, source, source_size, target`` from ``source, source_size`` (a row per source).

    Sources share ``share`` of all words by weight; none gets more than ``rounds`` times its
    size, and what is cut goes to the others by weight until none is above.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    named = sizes.withColumn("source_no", number).withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") - 1) % len(weights) + 1),
        "cap": F.col("source_size") * F.lit(float(rounds))})
    # If the sources in front, by cap per weight, are full, the others share this much per weight.  It grows
    # up to the first source that is not full and falls from there, so the largest holds.
    everything = Window.partitionBy()
    front = Window.orderBy(F.col("cap") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("cap").over(front), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(front), F.lit(0.0)))
    return named.withColumn("level", level).select(
        "source_no", "source", "source_size",
        F.least("cap", F.max("level").over(everything) * F.col("weight")).alias("target"))


def apportion(parties: DataFrame, keys: list, party: str, share: str, seats: Column, out: str) -> DataFrame:
    """Sainte-Laguë: ``keys, party, out`` with each party's seats among those with equal ``keys``.

    Rounding moves a party by half a seat at most.  That bounds its seats from both sides; the seats
    in between, about two a party, go by highest quotient share / (2k + 1), ties to the smaller ``party``.
    """
    group = Window.partitionBy(*keys)
    n, fair = F.count(F.lit(1)).over(group), F.try_divide(F.col(share), F.sum(share).over(group))

    def bound(sign):
        found = F.floor(fair * (F.col("_seats") + n * (sign * 0.5)) + (0.5 + sign * 1e-9))
        return F.greatest(F.coalesce(found, F.lit(0)), F.lit(0))

    bounded = (parties.withColumn("_seats", seats.cast("double")).withColumns({"_low": bound(-1), "_high": bound(1)})
               .withColumn("_left", F.col("_seats") - F.sum("_low").over(group)))
    best = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("_quotient"), party)
    asked = F.when(F.col("_high") > F.col("_low"), F.sequence("_low", F.col("_high") - 1))
    return (bounded.select(*keys, party, share, "_low", "_left", F.explode_outer(asked).alias("_k"))
            .withColumn("_quotient", F.col(share) / (F.col("_k") * 2 + 1))
            .withColumn("_place", F.row_number().over(best))
            .groupBy(*keys, party).agg((F.max("_low") + F.count_if(
                F.col("_k").isNotNull() & (F.col("_place") <= F.col("_left")))).alias(out)))


def _overlap(low, high) -> Column:
    return F.greatest(F.least(F.col("_end"), high) - F.greatest(F.col("_start"), low), F.lit(0))


def mix(docs: DataFrame, share: float = SHARE, rounds: int = ROUNDS, weights=WEIGHTS, seed: int = 42,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken``: the words that the mix takes of each row of ``docs``.

    ``size`` is the number of words; null and empty texts have none and give none.  Rows without a
    source form one source of their own, the last.  Ties and repeated rows stand in order of id and size, so
    reruns agree.  An empty table gives no rows; other columns are ignored, whatever their names.
    """
    seed = F.lit(seed)
    sized = stage(docs.select("doc_id", "source", word_count().alias("size")), "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, rounds, weights)
    sources = stage(sources.withColumn("n_shards", F.greatest(
        F.ceil(F.col("source_size") / shard_words), F.lit(1))), "sources")
    all_blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words)
    blocks = apportion(sources, [], "source_no", "target", all_blocks, "source_blocks")
    sources = sources.join(blocks, "source_no").withColumnRenamed("source", "_source")

    placed = (sized.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
              .withColumn("shard", hash_number(seed, F.lit("shard"), F.col("doc_id")) % F.col("n_shards")))
    shards = placed.groupBy("source_no", "shard").agg(
        F.sum("size").alias("shard_size"), F.max("source_blocks").alias("source_blocks"))
    quotas = (apportion(shards, ["source_no"], "shard", "shard_size", F.col("source_blocks"), "quota")
              .join(shards.drop("source_blocks"), ["source_no", "shard"])
              .withColumn("_blocks", F.greatest(F.ceil(F.col("shard_size") / block_words), F.lit(1))))
    whole = F.expr("quota div _blocks")
    quotas = quotas.select(
        "source_no", "shard", F.least(whole, F.lit(rounds)).alias("_rounds"), (F.col("_blocks") * block_words).alias("_line"),
        (F.when(whole < rounds, F.col("quota") % F.col("_blocks")).otherwise(0) * block_words).alias("_part"),
        (hash_number(seed, F.lit("start"), F.col("source_no"), F.col("shard")) % F.col("_blocks") * block_words).alias("_from"))

    line = Window.partitionBy("source_no", "shard").orderBy(
        hash_number(seed, F.lit("order"), F.col("doc_id")), "doc_id", "size")
    lined = placed.withColumn("_end", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_start", F.col("_end") - F.col("size")).join(quotas, ["source_no", "shard"])
    until = F.col("_from") + F.col("_part")
    taken = F.col("_rounds") * F.col("size") + _overlap(F.col("_from"), F.least(until, F.col("_line"))) \
        + _overlap(F.lit(0), until - F.col("_line"))
    return lined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, to the nearest whole number; columns as before.

    Rows that repeat an id come as often as their words together are taken, each.  Null and empty texts have no
    words and are not taken.  An empty table gives no rows; other columns stay as they are, whatever their names.
    """
    own, times = fresh("id", docs.columns), fresh("times", docs.columns)
    plan = mix(docs, **settings).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    copies = plan.select(F.col("doc_id").alias(own), F.expr("CAST(round(try_divide(taken, size)) AS INT)").alias(times)) \
        .where(F.col(times) > 0)
    return docs.join(copies, F.col("doc_id").eqNullSafe(F.col(own))) \
        .withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*quoted(docs))


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
named AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_no FROM sums),
weighted AS (
  SELECT *, [3.0, 1.0, 2.0][(source_no - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM named),
levels AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER f, 0)) /
            (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0)) AS level
  FROM weighted WINDOW f AS (ORDER BY cap / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
aimed AS (
  SELECT source_no, source, source_size, least(cap, max(level) OVER () * weight) AS target,
         greatest(ceil(source_size / 1000000), 1)::BIGINT AS n_shards FROM levels),
seats AS (SELECT round(sum(target) / 16)::BIGINT AS n FROM aimed),
quotients AS (
  SELECT source_no, target / (2 * k + 1) AS quotient FROM aimed, unnest(range((target / 16)::BIGINT + 8)) AS u(k)),
won AS (
  SELECT source_no, count(*) AS blocks FROM (
    SELECT source_no, row_number() OVER (ORDER BY quotient DESC, source_no) AS place FROM quotients), seats
  WHERE place <= n GROUP BY source_no),
placed AS (
  SELECT s.*, a.source_no, a.source_size, a.target, coalesce(w.blocks, 0) AS blocks,
         ('0x' || substr(md5('42/shard/' || doc_id), 1, 8))::BIGINT % a.n_shards AS shard,
         ('0x' || substr(md5('42/order/' || doc_id), 1, 8))::BIGINT AS place
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source LEFT JOIN won w USING (source_no)),
shards AS (
  SELECT source_no, shard, sum(size)::BIGINT AS shard_size, max(blocks) AS blocks FROM placed GROUP BY ALL),
shard_quotients AS (
  SELECT source_no, shard, blocks, shard_size / (2 * k + 1) AS quotient
  FROM shards, unnest(range((shard_size / 8)::BIGINT + 8)) AS u(k)),
quotas AS (
  SELECT source_no, shard, count(*) FILTER (place <= blocks) AS quota FROM (
    SELECT *, row_number() OVER (PARTITION BY source_no ORDER BY quotient DESC, shard) AS place FROM shard_quotients)
  GROUP BY source_no, shard),
lines AS (
  SELECT source_no, shard, quota, greatest(ceil(shard_size / 16), 1)::BIGINT AS n FROM quotas JOIN shards USING (source_no, shard)),
parts AS (
  SELECT source_no, shard, least(quota // n, 2) AS rounds, n * 16 AS line,
         CASE WHEN quota // n < 2 THEN quota % n ELSE 0 END * 16 AS part,
         ('0x' || substr(md5('42/start/' || source_no || '/' || shard), 1, 8))::BIGINT % n * 16 AS first FROM lines),
lined AS (
  SELECT *, sum(size) OVER (PARTITION BY source_no, shard ORDER BY place, doc_id, size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS until FROM placed)
SELECT doc_id, source, size, source_size, target,
       (rounds * size + greatest(least(until, least(first + part, line)) - greatest(until - size, first), 0)
        + greatest(least(until, first + part - line) - greatest(until - size, 0), 0))::BIGINT AS taken
FROM lined JOIN parts USING (source_no, shard)
"""

"""Sharding by extendible hashing.

Documents fall into buckets by the leading bits of their hash.  The directory
starts with one bucket; a bucket splits on the next bit only while it holds more bytes
than a shard may.  All depths of a level are worked out at once from a
histogram of hash prefixes; only rows in buckets that are still too large see the next level.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ratelake.session import stage

LIMIT_BYTES = 16 << 20
#: Bits of a level beyond what even shards would need.
SPARE_BITS = 4
#: Rows with equal hashes are told apart below so many leading bits.
SHARED_BITS = 12


def prefix(depth) -> Column:
    """The leading ``depth`` bits of the hash as a number."""
    return F.when(F.lit(depth) > 0, F.expr(f"shiftrightunsigned(hash, {64 - depth if depth else 0})")).otherwise(F.lit(0).cast("long"))


def hashed(docs: DataFrame) -> DataFrame:
    """``doc_id, bytes, hash``; the hash depends on id and text.

    Rows that are equal in both get random lower bits, written down once, so that they can be split too.
    """
    rows = stage(docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
                             F.xxhash64("doc_id", "text").alias("hash")), "hashes")
    equal = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("hash", F.lit(True).alias("equal"))
    low = F.lit((1 << (64 - SHARED_BITS)) - 1)
    spread = F.col("hash").bitwiseAND(F.bitwise_not(low)).bitwiseOR(
        F.xxhash64("hash", F.rand(7), F.rand(11)).bitwiseAND(low))
    return stage(rows.join(equal, "hash", "left").select(
        "doc_id", "bytes", F.when(F.col("equal"), spread).otherwise(F.col("hash")).alias("hash")), "hashed")


def directory(rows: DataFrame, limit_bytes: int) -> DataFrame:
    """``depth, prefix, shard_bytes, shard_docs`` of every shard of ``bytes, hash`` rows."""
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    done, open_, start, found = 0, rows, 0, []
    width = max(0, (total // limit_bytes).bit_length()) + SPARE_BITS
    while done < 64:
        end = min(64, done + width)
        cells = open_.groupBy(prefix(end).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
        depths = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("depth")
        nodes = stage(cells.select("cell", "bytes", "docs", depths)
                      .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {end} - depth)"))
                      .groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")), "nodes")
        # A bucket that fits, or cannot be split, is a shard if the one it came from was too large.
        fits = (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1) | (F.col("depth") == 64)
        large = nodes.where(~fits).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        child = nodes.where(fits).withColumn("parent", F.expr("shiftrightunsigned(prefix, 1)"))
        found.append(child.where(F.col("depth") > start).join(large, ["depth", "parent"], "left_semi").drop("parent"))
        if start == 0:
            found.append(child.where(F.col("depth") == 0).drop("parent"))
        rest = nodes.where(~fits & (F.col("depth") == end)).select(F.col("prefix").alias("cell"))
        if end == 64 or not rest.take(1):
            break
        open_ = stage(open_.withColumn("cell", prefix(end)).join(rest, "cell", "left_semi").drop("cell"), "open")
        # The large buckets at this depth are known to be too large; the next level starts with them.
        done, start, width = end, end, 8
    return reduce(DataFrame.unionByName, found)


def shard(docs: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """``doc_id, bytes, shard, depth, shard_bytes, shard_docs`` of every row of ``docs``.

    ``shard`` spells the leading bits of the shard's bucket.  No shard holds over ``limit_bytes`` bytes of text, but for
    a single row that is larger by itself.  Null text has no bytes; repeated rows are placed each, by chance; an
    empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows = hashed(docs)
    shards = stage(directory(rows.select("bytes", "hash"), limit_bytes), "directory")
    depths = [r[0] for r in shards.select("depth").distinct().collect()]      # 65 at most
    if not depths:
        return rows.select("doc_id", "bytes", F.lit("").alias("shard"), F.lit(0).alias("depth"),
                           F.lit(0).cast("long").alias("shard_bytes"), F.lit(0).cast("long").alias("shard_docs"))
    # A row belongs to the one depth whose prefix is in the directory.
    tried = rows.withColumn("d", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), prefix(d).alias("prefix")) for d in sorted(depths)])))
    placed = tried.select("doc_id", "bytes", F.col("d.depth").alias("depth"), F.col("d.prefix").alias("prefix")) \
        .join(shards, ["depth", "prefix"])
    name = F.when(F.col("depth") > 0, F.expr("substring(lpad(bin(prefix), 64, '0'), 65 - depth)")).otherwise("")
    return placed.select("doc_id", "bytes", name.alias("shard"), F.col("depth").cast("int").alias("depth"),
                         "shard_bytes", "shard_docs")

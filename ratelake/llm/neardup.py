"""Near-duplicate documents by circulant MinHash, banding, and an exact Jaccard check.

Two permutations of 32-bit numbers give all signature coordinates: the first
spreads the shingles, its image is shifted round by one fixed step per coordinate,
and the second permutation orders the shifted numbers.  Four neighbouring
coordinates make a band.

Documents with equal shingle sets are one class and travel as its number; ids come back at the end.
Inside a bucket no list of pairs is made.  First every member is held against
the bucket's smallest member.  Only buckets that still hold several
components go on: there, members outside the largest component meet the
others in blocks of bounded size.  Sets of hashes find the links there, and the words of both whole texts confirm each.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ratelake.llm import bytetext
from ratelake.llm.components import components
from ratelake.llm.runtime import fresh, quoted, small_batches
from ratelake.session import stage

BANDS = 32
ROWS_PER_BAND = 4
SHINGLE = 5
SIMILARITY = 75
#: A pair at the similarity bound agrees in about 96 of 128 coordinates.  A pair that agrees in so few that a pair at the
#: bound has lower odds of it isn't checked on texts.
ODDS = 1e-9
#: Outsiders and members of a bucket that meet at once, and shingles of either.
BLOCK = 256
BLOCK_SHINGLES = 1 << 18
#: Members of a bucket that learn of its largest component together.
SALTED = 512
#: Shingles of the blocks that a task takes together.
CHUNK = 1 << 20

SKETCH = "doc_id long, text_hash long, n_shingles long, digest_a long, digest_b long, lanes binary"
LINK = "u long, v long"


def sketches(words_per_shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS_PER_BAND):
    """Task body: set size, two digests of the set and the signature of each text, two bytes a coordinate."""
    text = bytetext

    def sketch(batches):
        for batch in batches:
            texts = text.byte_texts(batch.column("text"))
            for a, b in text.slices(texts):
                hashes, owner, ends = text.shingle_sets(texts[a:b], words_per_shingle)
                starts = np.append(0, ends[:-1])
                digests = [text.per_group_sum(text.mix(hashes ^ np.uint64(salt)), starts, ends).view(np.int64)
                           for salt in (0x51ED270B, 0x2545F4914F6CDD1D)]
                lanes = text.circulant_minima(hashes, starts, ends, bands * rows)
                offsets = np.zeros(len(starts) + 1, np.int32)
                np.cumsum(np.where(ends > starts, 2 * bands * rows, 0), out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(a, b - a) for c in ("doc_id", "text_hash")), pa.array(ends - starts, pa.int64()),
                     *map(pa.array, digests), pa.Array.from_buffers(
                         pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lanes)])],
                    names=["doc_id", "text_hash", "n_shingles", "digest_a", "digest_b", "lanes"])

    return sketch


def least_agreement(coordinates: int, similarity: int) -> int:
    """So many coordinates agree in a pair at the similarity, but for ``ODDS``."""
    p, odds = similarity / 100, 0.0
    for k in range(coordinates):
        odds += math.comb(coordinates, k) * p ** k * (1 - p) ** (coordinates - k)
        if odds > ODDS:
            return k
    return coordinates


def agreeing(least: int, similarity: int):
    """Task body: candidate pairs whose signatures agree and whose sizes allow the similarity."""
    def lanes(column):
        return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), -1)

    def check(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch.column(c).to_numpy() for c in ("u_n", "v_n"))
            good = 100 * np.minimum(n, m) >= similarity * np.maximum(n, m)
            good &= (lanes(batch.column("u_lanes")) == lanes(batch.column("v_lanes"))).sum(1) >= least
            yield batch.select(["u", "v"]).filter(pa.array(good))

    return check


def confirmed(words_per_shingle: int, similarity: int):
    """Task body: pairs of whole texts whose sets reach the similarity, first of hashes, then of words."""
    text = bytetext

    def check(batches):
        for batch in batches:
            left, right = text.byte_texts(batch.column("u_text")), text.byte_texts(batch.column("v_text"))
            good = np.zeros(batch.num_rows, bool)
            for i, pair in enumerate(zip(left, right)):
                hashes, _, ends = text.shingle_sets(pair, words_per_shingle)
                good[i] = text.similar(hashes[:ends[0]], hashes[ends[0]:], similarity) and text.similar(
                    *text.exact_sets(pair, words_per_shingle), similarity)
            yield batch.select(["u", "v"]).filter(pa.array(good))

    return check


def block_links(words_per_shingle: int, similarity: int):
    """Task body for many blocks: links between an outsider and a member of its block that join components."""
    text = bytetext

    def links(table):
        import numpy as np
        import pyarrow as pa

        table = table.sort_by([(c, "ascending") for c in ("bucket", "i", "j", "rep")])
        rep, label = table["rep"].to_numpy(), table["label"].to_numpy()
        outsider = table["outsider"].to_numpy().astype(bool)
        # The shingle sets of the chunk's texts, numbered densely.
        _, where, doc = np.unique(rep, return_index=True, return_inverse=True)
        texts = text.byte_texts(table["text"].take(pa.array(where)))
        hashes, ends = [], []
        for a, b in text.slices(texts):
            h, _, e = text.shingle_sets(texts[a:b], words_per_shingle)
            ends.append(e + sum(map(len, hashes)))
            hashes.append(h)
        code = np.unique(np.concatenate(hashes), return_inverse=True)[1]
        ends = np.concatenate(ends)
        starts = np.append(0, ends[:-1])
        size = ends - starts
        flag = np.zeros(code.max() + 1 if len(code) else 0, np.int32)
        parent = {}

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        key = np.stack([table[c].to_numpy() for c in ("bucket", "i", "j")])
        edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        u, v = [], []
        for first, last in zip(np.append(0, edges), np.append(edges, len(rep))):
            d = doc[first:last]
            every = np.concatenate([code[starts[k]:ends[k]] for k in d])
            run = np.append(0, np.cumsum(size[d])[:-1])
            for i in first + np.flatnonzero(outsider[first:last]):
                own = code[starts[doc[i]]:ends[doc[i]]]
                flag[own] = 1
                shared = np.add.reduceat(flag[every], run)
                flag[own] = 0
                for j in first + np.flatnonzero(100 * shared >= similarity * (len(own) + size[d] - shared)):
                    if root(label[i]) != root(label[j]) and text.similar(
                            *text.exact_sets([texts[doc[i]], texts[doc[j]]], words_per_shingle), similarity):
                        parent[root(label[i])] = root(label[j])
                        u.append(rep[i])
                        v.append(rep[j])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return links


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE, similarity: int = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS_PER_BAND, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Words are compared with A-Z in lower case.  Null, empty and blank texts have no shingles and
    stand alone.  Rows that repeat a ``doc_id`` are each returned; they count as one
    document, whose classes are joined, each with the links of its own text.  A null ``doc_id`` stands alone with a null component.
    An empty table gives no rows; other columns are ignored, whatever their names.
    """
    least = least_agreement(bands * rows, similarity)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    sketch = stage(small_batches(texts).mapInArrow(
        sketches(words_per_shingle, bands, rows), SKETCH), "sketches")
    set_key = ["digest_a", "digest_b", "n_shingles"]
    worded = sketch.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # Numbers are given once, as the classes are written; a class is shown by one row, that of its smallest id.
    classes = stage(worded.groupBy(*set_key).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("one"), F.first("lanes").alias("lanes"))
        .select(*set_key, "one.*", "lanes", F.monotonically_increasing_id().alias("rep")), "classes")

    key = lambda b: F.xxhash64(F.substring("lanes", b * (2 * rows) + 1, F.lit(2 * rows)))
    banded = classes.select("rep", "doc_id", "n_shingles", F.posexplode(
        F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), key)).alias("band", "key"))
    buckets = (banded.groupBy("band", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "rep")).alias("first"),
        F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "rep")).alias("y"))
        .where((F.col("n") > 1))
        # Bands with the same members need only one of their buckets.
        .groupBy("n", "x", "y", F.col("first.rep").alias("pivot")).agg(F.min(F.struct("band", "key")).alias("b"))
        .select("b.band", "b.key", "n", "pivot"))
    members = stage(banded.join(buckets, ["band", "key"]).select(
        F.xxhash64("band", "key").alias("bucket"), "n", "pivot", "rep", "n_shingles"), "members")

    sizes = classes.select("rep", "n_shingles", "lanes")
    pairs = members.where(F.col("rep") != F.col("pivot")).select(F.col("rep").alias("u"), F.col("pivot").alias("v")).distinct()
    for side in ("u", "v"):
        pairs = pairs.join(sizes.select(F.col("rep").alias(side), F.col("n_shingles").alias(f"{side}_n"),
                                        F.col("lanes").alias(f"{side}_lanes")), side)
    candidates = stage(pairs.mapInArrow(agreeing(least, similarity), LINK), "candidates")

    wanted = stage(members.where(F.col("n") > 2).select("rep").union(candidates.select("u")).union(
        candidates.select("v")).distinct(), "wanted")
    shown = classes.select("doc_id", "text_hash", "rep").join(wanted, "rep")
    # Rows that repeat an id and its text count once.
    texts = stage(texts.join(shown, ["doc_id", "text_hash"]).groupBy("doc_id", "text_hash").agg(
        F.first("rep").alias("rep"), F.first("text").alias("text")).select("rep", "text"), "texts")
    for side in ("u", "v"):
        candidates = candidates.join(texts.select(F.col("rep").alias(side), F.col("text").alias(f"{side}_text")), side)
    links = stage(candidates.mapInArrow(confirmed(words_per_shingle, similarity), LINK), "links")
    first = stage(components(links), "components")

    salts = lambda n: F.ceil(F.col(n) / SALTED)
    spot = F.xxhash64("rep")
    placed = stage(members.where(F.col("n") > 2).join(first.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "n", "rep", "n_shingles", F.coalesce("component", "rep").alias("label")), "placed")
    main = (placed.groupBy("bucket", "n", "label").agg(F.count(F.lit(1)).alias("k"), F.sum("n_shingles").alias("size"))
            .groupBy("bucket", "n").agg(F.max(F.struct("k", F.negative("label").alias("l"), "size")).alias("most"),
                                        F.sum("size").alias("size"), F.count(F.lit(1)).alias("labels"))
            .where(F.col("labels") > 1))
    blocks = lambda n, size: F.ceil(F.greatest(n / block, size / BLOCK_SHINGLES))
    # A large bucket's members meet its figures at many places.
    main = main.select("bucket", F.negative("most.l").alias("main"), blocks(F.col("n"), F.col("size")).alias("all_blocks"),
                       blocks(F.col("n") - F.col("most.k"), F.col("size") - F.col("most.size")).alias("out_blocks"),
                       F.explode(F.sequence(F.lit(0).cast("long"), salts("n") - 1)).alias("salt"))
    open_ = (placed.withColumn("salt", F.pmod(F.shiftright(spot, 40), salts("n"))).drop("n").join(main, ["bucket", "salt"])
             .withColumn("is_out", F.col("label") != F.col("main"))
             .withColumn("i", F.pmod(F.shiftright(spot, 20), F.col("out_blocks")))
             .withColumn("j", F.pmod(spot, F.col("all_blocks"))))
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    dealt = (open_.where("is_out").select("bucket", "rep", "n_shingles", "label", "i", F.explode(upto("all_blocks")).alias("j"), F.lit(True).alias("outsider"))
             .unionByName(open_.select("bucket", "rep", "n_shingles", "label", F.explode(upto("out_blocks")).alias("i"), "j",
                                       F.lit(False).alias("outsider")))
             .groupBy("bucket", "i", "j", "rep", "n_shingles", "label").agg(F.max("outsider").alias("outsider")))
    dealt = stage(dealt, "dealt")
    chunks = dealt.agg(F.ceil(F.sum("n_shingles") / CHUNK)).first()[0] or 1
    filled = dealt.join(texts, "rep").withColumn("chunk", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(chunks)))
    more = filled.groupBy("chunk").applyInArrow(block_links(words_per_shingle, similarity), LINK)
    joined = links.select("u", "v").union(stage(more, "more"))
    # A doc_id with several different texts joins their classes.
    numbers = classes.select(*set_key, "rep")
    homes = (worded.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1).drop("k")
             .join(worded, "doc_id").join(numbers, set_key).select("doc_id", "rep"))
    repeated = homes.join(homes.groupBy("doc_id").agg(F.min("rep").alias("least")), "doc_id").select(
        F.col("least").alias("u"), F.col("rep").alias("v"))
    final = stage(components(joined.union(repeated)).withColumnRenamed("node", "rep"), "final")
    # A component is named by the smallest id of its classes.
    named = final.join(classes.select("rep", "doc_id"), "rep")
    named = named.join(named.groupBy("component").agg(F.min("doc_id").alias("name")), "component").select("rep", "name")
    known = classes.select(*set_key, "rep", F.col("doc_id").alias("first_id")).join(named, "rep", "left").select(
        *(F.col(c).alias(f"_{c}") for c in set_key), F.coalesce("name", "first_id").alias("component"))

    same = F.col("doc_id").isNotNull()
    for c in set_key:
        same &= F.col(c) == F.col(f"_{c}")
    labelled = sketch.select("doc_id", *set_key).join(known, same, "left")
    return labelled.select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, with all its columns.

    That of the smallest id stays; among rows of the same id, that with the least hash of its columns, so reruns
    agree.  Rows without an id and rows without words stand alone and stay.  An empty table gives no
    rows; other columns stay as they are, whatever their names.
    """
    found = stage(near_duplicates(docs, **settings), "groups")
    out = docs.join(found.where(~F.col("kept")).select("doc_id").distinct(), "doc_id", "left_anti").select(*quoted(docs))
    rows, ids = found.agg(F.count("doc_id"), F.count_distinct("doc_id")).first()
    if rows == ids:
        return out
    # Rows of the same id are one document; rows without an id stay.
    place = fresh("place", docs.columns)
    least = Window.partitionBy("doc_id").orderBy(F.xxhash64(*[F.col(c) for c, (_, kind) in zip(quoted(docs), docs.dtypes) if "map<" not in kind]))
    one = out.where(F.col("doc_id").isNotNull()).withColumn(place, F.row_number().over(least)).where(F.col(place) == 1).drop(place)
    return one.unionByName(out.where(F.col("doc_id").isNull()))

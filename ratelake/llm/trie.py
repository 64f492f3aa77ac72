"""A trie of conversation prefixes as node tables with minimal perfect hashes.

A prefix is known by a digest of 128 bits: the exclusive or of a hash of each turn with its place.
Such digests add up in any order, so turns are put in order by ranges of (conversation, turn): a long
conversation goes over many tasks, and each task's part is carried on by one small table of parts.

Equal conversations become one path.  Paths are dealt to shards, a path of many turns in bands of
depth; every shard holds the ancestors of its nodes, up to the border of the band.  A shard lists its distinct
prefix digests, gives them slots by a minimal perfect hash whose slots hold the digest they stand for, scatters
what the rows bring into flat arrays, and adds it up along the parents' slots from the deepest node on.
What a path's deeper bands hold comes in at the last node of each band.  Sums of shards add up to those of the trie.
"""

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ratelake.llm.runtime import small_batches
from ratelake.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a shard, levels of a band, ids that are joined before they are hashed.
SHARD_ROWS, BAND, CHUNK_IDS = 1_000_000, 1024, 8192

NO_ID_HASH = hashlib.sha256(b"").hexdigest()


def batch_of(**columns):
    return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values()], names=list(columns))


def runs_of(keys):
    """First places of the runs of equal values."""
    return np.append(0, np.flatnonzero(keys[1:] != keys[:-1]) + 1) if len(keys) else np.zeros(0, np.int64)


def count_turns(batches):
    """Task body over sorted turns: the place of each among the turns of its conversation in this partition."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts = runs_of(conv)
        place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv)))) + 1
        if conv[0] == last:
            place[:starts[1] if len(starts) > 1 else None] += seen
        last, seen = conv[-1], place[-1]
        hashes, words = np.zeros((len(conv), 2), np.int64), np.zeros(len(conv), np.int64)
        for i, (role, text) in enumerate(zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())):
            role, text = role.encode(), text.encode()
            hashes[i] = np.frombuffer(hashlib.sha256(b"%d\n%b%b" % (len(role), role, text)).digest()[:16], np.int64)
            words[i] = len(text.split())
        yield batch_of(conv_id=conv, part=np.full(len(conv), part), place=place, ha=hashes[:, 0].copy(), hb=hashes[:, 1].copy(), words=words)


def add_digests(batches):
    """Task body over sorted rebuilt turns: digests of the prefixes, as far as this partition holds them."""
    part, last, held = TaskContext.get().partitionId(), None, np.zeros(2, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts = runs_of(conv)
        turn = np.stack([batch.column(c).to_numpy() for c in ("ga", "gb")])
        upto = np.bitwise_xor.accumulate(turn, axis=1)
        before = upto ^ turn
        carried = before[:, starts]
        if conv[0] == last:
            carried[:, 0] ^= held
        carried = np.repeat(carried, np.diff(np.append(starts, len(conv))), axis=1)
        upto, before = upto ^ carried, before ^ carried
        last, held = conv[-1], upto[:, -1].copy()
        yield batch_of(conv_id=conv, part=np.full(len(conv), part), depth=batch.column("depth"), words=batch.column("words"),
                       a=upto[0], b=upto[1], pa=before[0], pb=before[1])


class Slots:
    """A minimal perfect hash: every key has a slot of its own below their number, and each slot knows its key."""

    def __init__(self, a, b):
        import numpy as np

        self.levels, self.a, self.b = [], np.zeros_like(a), np.zeros_like(b)
        left, taken = np.arange(len(a)), 0
        while len(left):
            room = 2 * len(left)
            place = self.spread(a[left], b[left], len(self.levels)) % np.uint64(room)
            alone = np.bincount(place.astype(np.int64), minlength=room) == 1
            slot = np.cumsum(alone) - 1 + taken
            own = alone[place]
            at = slot[place[own]]
            self.a[at], self.b[at] = a[left[own]], b[left[own]]
            self.levels.append((room, alone, slot))
            taken += int(own.sum())
            left = left[~own]

    @staticmethod
    def spread(a, b, level):
        import numpy as np

        h = a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.view(np.uint64) ^ np.uint64(level * 0x2545F4914F6CDD1D & (2 ** 64 - 1))
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))

    def find(self, a, b):
        """The slot of each key, or -1 for a key without one."""
        import numpy as np

        out, left = np.full(len(a), -1), np.arange(len(a))
        for level, (room, alone, slot) in enumerate(self.levels):
            place = self.spread(a[left], b[left], level) % np.uint64(room)
            hit = alone[place]
            out[left[hit]] = slot[place[hit]]
            left = left[~hit]
        known = out >= 0
        known[known] = (self.a[out[known]] == a[known]) & (self.b[out[known]] == b[known])
        return np.where(known, out, -1)


def add_up(table):
    """Task body for a shard: what its nodes and all below them hold."""
    import numpy as np
    import pyarrow as pa

    column = {c: table[c].to_numpy() for c in ("a", "b", "depth", "n", "saved", "leaves")}
    order = np.lexsort((column["b"], column["a"]))
    a, b = column["a"][order], column["b"][order]
    one = order[np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))]      # a row of each distinct digest
    slots = Slots(column["a"][one], column["b"][one])
    of_row = slots.find(column["a"], column["b"])
    node = slots.find(column["a"][one], column["b"][one])
    n, saved, leaves, depth = (np.zeros(len(one), np.int64) for _ in range(4))
    for total, name in ((n, "n"), (saved, "saved"), (leaves, "leaves")):
        np.add.at(total, of_row, column[name])
    depth[node] = column["depth"][one]
    parent = np.full(len(one), -1)
    has = one[column["depth"][one] > 0]
    up = [table[c].take(pa.array(has)).to_numpy().astype(np.int64) for c in ("pa", "pb")]
    parent[node[column["depth"][one] > 0]] = slots.find(*up)
    by_depth = np.argsort(depth, kind="stable")
    edges = np.searchsorted(depth[by_depth], np.arange(depth.min(), depth.max() + 2))
    for first, last in zip(edges[-2:0:-1], edges[:0:-1]):                     # from the deepest level up to the second
        level = by_depth[first:last]
        level = level[parent[level] >= 0]
        np.add.at(saved, parent[level], saved[level])
        np.add.at(leaves, parent[level], leaves[level])
    return pa.table({"a": slots.a, "b": slots.b, "n": n, "saved": saved, "leaves": leaves})


def join_ids(chunk):
    """Task body over sorted ids: the ids of a node as text, so many at once."""

    def body(batches):
        for batch in batches:
            a, b, ids = (batch.column(c).to_numpy() for c in ("a", "b", "conv_id"))
            edges = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            out = []
            for first, last in zip(np.append(0, edges), np.append(edges, len(a))):
                for k in range(first, last, chunk):
                    out.append((a[k], b[k], ids[k], ",".join(map(str, ids[k:min(k + chunk, last)].tolist()))))
            yield batch_of(**{c: pa.array([r[i] for r in out], kind) for i, (c, kind) in enumerate(
                (("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())))})

    return body


def hash_ids(batches):
    """Task body over sorted texts of ids: one digest for each node, which grows text by text."""
    node, digest = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
            if (a, b) != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield id_rows(out)
    if node is not None:
        yield id_rows([(*node, digest.hexdigest())])


def id_rows(rows):
    kinds = (("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string()))
    return batch_of(**{c: pa.array([r[i] for r in rows], kind) for i, (c, kind) in enumerate(kinds)})


def rebuild(conversations: DataFrame, block: int = 20, most: int = 4) -> tuple:
    """Rebuilt turns ``conv_id, depth, words, ga, gb``, and a row for each conversation.

    A conversation c gets the first h turns of conversation c - c % block, then its own after its first h;
    h = crc32 of the decimal c, modulo ``most``.  The remainder has the sign of c, as in SQL.
    """
    given = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = given.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)) \
        .sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    turns = stage(small_batches(ordered).mapInArrow(
        count_turns, "conv_id long, part long, place long, ha long, hb long, words long"), "turns")

    # A row for each conversation and partition that holds turns of it.
    parts = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    by_part = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.withColumn("before", F.sum("n").over(by_part) - F.col("n"))
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumns({
        "base": F.col("conv_id") - F.col("conv_id") % block,
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % most})
    convs = convs.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    convs = stage(convs.select("conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "convs")
    parts = stage(parts.join(convs.drop("base"), "conv_id"), "parts")

    placed = turns.join(parts.drop("n"), ["conv_id", "part"]).withColumn("place", F.col("place") + F.col("before"))
    own = placed.where(F.col("place") > F.col("h")).select(
        "conv_id", (F.col("place") + F.col("taken") - F.col("h")).alias("depth"), "words", "ha", "hb")
    heads = placed.where(F.col("place") < most).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "words", "ha", "hb")
    lent = convs.where(F.col("taken") > 0).join(heads, "base").where(F.col("depth") <= F.col("taken")) \
        .select("conv_id", "depth", "words", "ha", "hb")
    rebuilt = own.unionByName(lent).select("conv_id", "depth", "words", F.xxhash64("depth", "ha", "hb").alias("ga"),
                                           F.xxhash64("hb", F.lit(7), "ha", "depth").alias("gb"))
    return rebuilt, convs.select("conv_id")


def prefix_trie(conversations: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """A row for each distinct prefix of the rebuilt conversations (see ``rebuild``), the textless root with them.

    ``conv_id`` smallest member; ``depth``; ``parent_conv_id`` the parent's smallest member; ``n_convs`` members;
    ``n_children``; ``n_leaves`` childless nodes of its subtree, itself with them; ``saved_tokens`` of its subtree: each
    node's (n_convs - 1) times the words of its last text; ``ends_sha256`` of the ids that end there, comma-joined.

    Turns stand by number, null first, ties by role and then text; repeated rows are turns each.  Null
    role and text are empty.  Rows without a ``conv_id`` belong to no conversation.  An empty table has no members
    and gives no rows.  Other columns are ignored, whatever their names.
    """
    rebuilt, convs = rebuild(conversations)
    ordered = rebuilt.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    rows = stage(ordered.mapInArrow(
        add_digests, "conv_id long, part long, depth long, words long, a long, b long, pa long, pb long"), "prefixes")

    parts = rows.groupBy("conv_id", "part").agg(F.max_by(F.struct("a", "b"), "depth").alias("own"), F.max("depth").alias("top"))
    ahead = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stage(parts.select("conv_id", "part", "top", F.col("own.a").alias("oa"), F.col("own.b").alias("ob"), *[
        F.coalesce(F.bit_xor(f"own.{c}").over(ahead), F.lit(0).cast("long")).alias(f"c{c}") for c in "ab"]), "parts")
    last = parts.groupBy("conv_id").agg(F.max_by(F.struct(
        (F.col("oa").bitwiseXOR(F.col("ca"))).alias("a"), (F.col("ob").bitwiseXOR(F.col("cb"))).alias("b"), "top"), "part").alias("e"))
    zero = F.lit(0).cast("long")
    ends = stage(convs.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"e.{c}", zero).alias(c) for c in ("a", "b", "top")]), "ends")
    # Equal conversations are one path, shown by the smallest.
    paths = ends.groupBy("a", "b").agg(F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("conv_id"), F.max("top").alias("path_top"))
    paths = stage(paths.select("conv_id", "copies", "path_top"), "paths")
    whole = lambda c, k: F.col(c).bitwiseXOR(F.col(k)).alias(c)
    rows = rows.join(parts.select("conv_id", "part", "ca", "cb").join(paths, "conv_id"), ["conv_id", "part"]).select(
        "conv_id", "copies", "path_top", "depth", "words", whole("a", "ca"), whole("b", "cb"), whole("pa", "ca"), whole("pb", "cb"))
    none = F.lit(None).cast("long")
    rows = stage(rows.unionByName(paths.select(
        "conv_id", "copies", "path_top", *[zero.alias(c) for c in ("depth", "words", "a", "b")], none.alias("pa"), none.alias("pb"))), "rows")

    # Equal digests must stand for one prefix: the same depth and the same parent.
    same = (F.min("depth") == F.max("depth")) & F.min("pa").eqNullSafe(F.max("pa")) & F.min("pb").eqNullSafe(F.max("pb"))
    nodes = rows.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("pa").alias("pa"), F.max("pb").alias("pb"),
        F.max("words").alias("words"), F.count(F.lit(1)).alias("n_rows"),
        F.when(same, F.lit(0)).otherwise(F.raise_error(F.lit("two prefixes share a digest"))).alias("checked"))
    nodes = stage(nodes.where(F.col("checked") == 0).drop("checked"), "nodes")
    children = nodes.where(F.col("depth") > 0).groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stage(nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")

    # What each path brings itself, and what each node takes off or adds once, at the path that shows it.
    level = F.expr(f"depth div {band}")
    own = rows.select("conv_id", "path_top", "depth", level.alias("band"), "a", "b", "pa", "pb", F.col("copies").alias("n"),
                      (F.col("copies") * F.col("words")).alias("saved"), zero.alias("leaves"))
    once = nodes.select("conv_id", none.alias("path_top"), "depth", level.alias("band"), "a", "b", "pa", "pb", zero.alias("n"),
                        (-F.col("words")).alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaves"))
    brought = own.unionByName(once)
    # Long paths: the sum of all deeper bands goes to the last node of a band.
    long_paths = paths.where(F.col("path_top") >= band).select("conv_id")
    below = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    tails = brought.join(long_paths, "conv_id").groupBy("conv_id", "band").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")) \
        .select("conv_id", "band", *[F.coalesce(F.sum(c).over(below), zero).alias(c) for c in ("saved", "leaves")])
    tails = own.where((F.col("path_top") >= band) & (F.col("depth") % band == band - 1)).drop("saved", "leaves", "n") \
        .join(tails, ["conv_id", "band"]).withColumn("n", zero)
    n_rows = rows.count()
    shards = max(1, -(-n_rows // shard_rows))
    dealt = brought.unionByName(tails).select("band", F.pmod(F.xxhash64("conv_id"), F.lit(shards)).alias("shard"),
                                              "a", "b", "pa", "pb", "depth", "n", "saved", "leaves")
    sums = dealt.groupBy("band", "shard").applyInArrow(add_up, "a long, b long, n long, saved long, leaves long") \
        .groupBy("a", "b").agg(F.sum("n").alias("n_convs"), F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    listed = ends.select("a", "b", "conv_id").repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id") \
        .mapInArrow(join_ids(CHUNK_IDS), "a long, b long, first long, ids string")
    digests = listed.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(hash_ids, "a long, b long, ends_sha256 string")
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(parents, ["pa", "pb"], "left").join(sums, ["a", "b"]).join(digests, ["a", "b"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(NO_ID_HASH)).alias("ends_sha256")))


TRIE_SQL = """
WITH given AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
             lambda c, x: list_reduce([xor(c, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
               lambda r, i: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM given)),
rebuilt AS (
  SELECT c.conv_id, 0 AS own, g.place, g.role, g.text FROM convs c JOIN given g ON g.conv_id = c.base AND g.place <= c.h
  UNION ALL SELECT c.conv_id, 1, g.place, g.role, g.text FROM convs c JOIN given g ON g.conv_id = c.conv_id AND g.place > c.h),
turns AS (
  SELECT conv_id, row_number() OVER w AS depth, md5(string_agg(md5(role) || md5(text), '') OVER w) AS prefix,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, place)),
ends AS (SELECT c.conv_id, coalesce(max(depth), 0) AS top FROM convs c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
steps AS (
  SELECT t.conv_id, depth, prefix, coalesce(lag(prefix) OVER (PARTITION BY t.conv_id ORDER BY depth), '') AS parent, words, top = depth AS is_end
  FROM turns t JOIN ends USING (conv_id)
  UNION ALL SELECT conv_id, 0, '', NULL, 0, top = 0 FROM ends),
nodes AS (
  SELECT prefix, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         any_value(words) AS words, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM steps GROUP BY prefix),
children AS (SELECT parent AS prefix, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
shown AS (
  SELECT s.conv_id, s.depth, s.prefix, coalesce(n.words * (n.n_convs - 1), 0) AS saved,
         CASE WHEN n.prefix IS NOT NULL AND c.prefix IS NULL THEN 1 ELSE 0 END AS leaf
  FROM steps s LEFT JOIN nodes n ON n.prefix = s.prefix AND n.conv_id = s.conv_id LEFT JOIN children c ON c.prefix = s.prefix),
sums AS (
  SELECT prefix, sum(below_saved)::BIGINT AS saved_tokens, sum(below_leaves)::BIGINT AS n_leaves FROM (
    SELECT prefix, sum(saved) OVER w AS below_saved, sum(leaf) OVER w AS below_leaves FROM shown
    WINDOW w AS (PARTITION BY conv_id ORDER BY depth DESC)) GROUP BY prefix)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.prefix = n.parent LEFT JOIN children c ON c.prefix = n.prefix JOIN sums s ON s.prefix = n.prefix
"""

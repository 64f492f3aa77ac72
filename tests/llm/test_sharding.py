"""Sharding against a directory that splits one bucket at a time."""

from collections import Counter, deque

import pytest
from pyspark.sql import functions as F

from ratelake.llm import sharding

FOLDER = "/root/testdata/sf0.01"


def split_one_at_a_time(rows, limit):
    """``(doc_id, bytes, shard, depth, shard_bytes, shard_docs)`` of ``(doc_id, bytes, hash)`` rows."""
    out, waiting = [], deque([("", rows)])
    while waiting:
        name, held = waiting.popleft()
        size = sum(r[1] for r in held)
        if size > limit and len(held) > 1 and len(name) < 64:
            for bit in "01":
                half = [r for r in held if format(r[2] % (1 << 64), "064b")[len(name)] == bit]
                if half:
                    waiting.append((name + bit, half))
        else:
            out += [(r[0], r[1], name, len(name), size, len(held)) for r in held]
    return Counter(out)


@pytest.mark.parametrize("limit", [1, 3_000, 20_000, 300_000, 1 << 40])
def test_same_shards_as_splitting_one_bucket_at_a_time(spark, limit):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)), F.xxhash64("doc_id", "text")).collect()]
    assert len({r[2] for r in rows}) == len(rows)               # no equal rows, whose lower bits are drawn
    want = split_one_at_a_time(rows, limit)
    assert len({w[2] for w in want}) > 1 or limit == 1 << 40
    got = Counter(tuple(r) for r in sharding.shard(docs, limit).select("doc_id", "bytes", "shard", "depth", "shard_bytes", "shard_docs").collect())
    assert got == want


def test_one_large_text_and_rows_without_bytes(spark):
    data = [(i, "x" * (5_000 if i == 3 else i % 4)) for i in range(200)] + [(500, None), (501, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    rows = [tuple(r) for r in docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)), F.xxhash64("doc_id", "text")).collect()]
    got = Counter(tuple(r) for r in sharding.shard(docs, 50).collect())
    assert got == split_one_at_a_time(rows, 50)

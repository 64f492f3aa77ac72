"""Byte-level BPE encoding and decoding with DuckDB inside each partition.

A text is cut into words by the pattern.  The distinct words of a batch become
token-position rows, one byte each; a recursive query joins neighbours with the merge
table and contracts each word's leftmost pair of least rank until no word has one.
Decoding joins token rows with the vocabulary and puts the pieces together in order.

DuckDB runs in the task's own process, in memory, on one thread; Spark deals out the texts.
"""

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratelake.llm import bytetext
from ratelake.llm.runtime import small_batches

#: Bytes of text that go through DuckDB at once, and words whose tokens a task remembers.
STEP_BYTES = 1 << 20
REMEMBERED = 600_000

ENCODED = "doc_id long, ids array<int>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

#: ``pos`` numbers the bytes of all words of a batch, so one order serves all of them.
MERGE = """
WITH RECURSIVE state(word, pos, token, done) AS (
  SELECT word, pos, token, false FROM start
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT s.word, s.pos, s.token, s.before,
            CASE WHEN s.next_word = s.word THEN (m.rank::BIGINT << 32) + s.pos END AS pair
     FROM (SELECT word, pos, token, lead(token) OVER o AS next, lead(word) OVER o AS next_word, lag(pos) OVER o AS before
           FROM state WHERE NOT done WINDOW o AS (ORDER BY pos)) s
     LEFT JOIN merges m ON m.first = s.token AND m.second = s.next),
   least AS (SELECT word, min(pair) AS best FROM pairs GROUP BY word)
   SELECT word, pos, CASE WHEN pos = (best & 4294967295) THEN (best >> 32)::INTEGER ELSE token END, best IS NULL
   FROM pairs JOIN least USING (word)
   WHERE best IS NULL OR before IS NULL OR before <> (best & 4294967295)))
SELECT word, token FROM state WHERE done ORDER BY pos
"""

DECODE = """
SELECT text, string_agg(piece, '' ORDER BY pos) AS decoded
FROM tokens JOIN pieces USING (token) GROUP BY text
"""


def read_ranks(path: str) -> dict:
    """Token bytes to rank, from a file of base64 tokens and ranks; read on the driver only."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge_table(ranks: dict) -> np.ndarray:
    """Rows (first, second, rank): each way to put a token together from two tokens."""
    rows = [(ranks[token[:k]], ranks[token[k:]], rank) for token, rank in ranks.items() for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks]
    return np.array(rows, np.int32).reshape(-1, 3)


class Codec:
    """The DuckDB connection of a task with its tables; ``merges`` may be left out for decoding."""

    def __init__(self, ranks, pattern, merges=None):
        import duckdb
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.byte_rank = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.words = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        tokens = list(ranks)
        pieces = pa.table({"token": pa.array([ranks[t] for t in tokens], pa.int32()),
                           "piece": pa.array([t.decode("latin-1") for t in tokens])})
        self.db.register("given", pieces)
        self.db.execute("CREATE TABLE pieces AS SELECT * FROM given")
        if merges is not None:
            self.db.register("given", pa.table({k: pa.array(merges[:, i]) for i, k in enumerate(("first", "second", "rank"))}))
            self.db.execute("CREATE TABLE merges AS SELECT * FROM given")

    def learn(self, words):
        """Remember the tokens of words that are new, as bytes of 32-bit numbers."""
        new = []
        for w in words:
            raw = w.encode()
            rank = self.ranks.get(raw)
            if rank is None:
                new.append((w, raw))
            else:
                self.words[w] = rank.to_bytes(4, "little")
        if not new:
            return
        sizes = np.array([len(raw) for _, raw in new])
        rows = np.frombuffer(b"".join(raw for _, raw in new), np.uint8)
        start = pa.table({"word": pa.array(np.repeat(np.arange(len(new), dtype=np.int32), sizes)),
                          "pos": pa.array(np.arange(len(rows))),
                          "token": pa.array(self.byte_rank[rows])})
        self.db.register("start", start)
        found = self.db.sql(MERGE).to_arrow_table()
        tokens = found["token"].to_numpy().astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(found["word"].to_numpy(), minlength=len(new)))
        at = 0
        for (w, _), end in zip(new, ends.tolist()):
            self.words[w] = tokens[at:end]
            at = end

    def encode(self, texts):
        """Token numbers of each text, as bytes of little-endian unsigned 32-bit numbers."""
        cut = [self.find(t) for t in texts]
        if len(self.words) > REMEMBERED:
            self.words.clear()
        self.learn({w for words in cut for w in words if w not in self.words})
        known = self.words
        return [b"".join([known[w] for w in words]) for words in cut]

    def decode(self, encoded):
        """The bytes of each text from its token numbers."""
        sizes = np.array([len(e) // 4 for e in encoded])
        flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
        self.db.register("tokens", pa.table({
            "text": pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)),
            "pos": pa.array(np.arange(len(flat), dtype=np.int32)), "token": pa.array(flat)}))
        out = [b""] * len(encoded)
        for text, decoded in self.db.execute(DECODE).fetchall():
            out[text] = decoded.encode("latin-1")
        return out


def _tasks(path: str, pattern: str):
    """A maker of codecs for task bodies; the vocabulary travels with the task, a few MB."""
    ranks = read_ranks(path)
    merges = merge_table(ranks)
    make = by_value(Codec)
    return lambda: make(ranks, pattern, merges)


def by_value(cls):
    """Let the class travel with the task, so that executors need no copy of this package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[cls.__module__])
    return cls


def id_lists(encoded):
    ends = np.cumsum([0] + [len(i) // 4 for i in encoded])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
        np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)))


def texts_of(column):
    return ["" if t is None else t for t in column.to_pylist()]


def steps(texts):
    return bytetext.slices(texts, STEP_BYTES)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``: null and empty texts have no ids; repeated rows are encoded each."""
    make, cut, read, lists = _tasks(path, pattern), steps, texts_of, id_lists

    def body(batches):
        codec = make()
        for batch in batches:
            texts = read(batch.column("text"))
            for a, b in cut(texts):
                ids = codec.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), lists(ids)], names=["doc_id", "ids"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(body, ENCODED)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, bytes`` from ``doc_id, ids``; null ids give no bytes, an id outside the vocabulary fails the task."""
    make = _tasks(path, pattern)

    def body(batches):
        codec = make()
        for batch in batches:
            given = [np.array([] if i is None else i, "<u4").tobytes() for i in batch.column("ids").to_pylist()]
            unknown = set(np.unique(np.frombuffer(b"".join(given), "<u4")).tolist()) - set(codec.ranks.values())
            if unknown:
                raise ValueError(f"ids outside the vocabulary: {sorted(unknown)[:5]}")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(codec.decode(given), pa.binary())], names=["doc_id", "bytes"])

    return small_batches(encoded.select("doc_id", "ids")).mapInArrow(body, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of ``docs``: encoded, then decoded from the ids.

    ``with_ids`` adds the column ``ids``.

    Null text counts as empty: no tokens, digests of nothing.  An empty table gives no rows; other columns are
    ignored, whatever their names.
    """
    make, cut, read, lists = _tasks(path, pattern), steps, texts_of, id_lists

    def body(batches):
        codec = make()
        for batch in batches:
            texts = read(batch.column("text"))
            for a, b in cut(texts):
                ids = codec.encode(texts[a:b])
                decoded = codec.decode(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                     pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                     *([lists(ids)] if with_ids else [])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(body, DIGESTS + ", ids array<int>" * with_ids)

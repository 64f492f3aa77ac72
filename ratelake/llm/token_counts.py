"""Token counts by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a slice of texts lie side by side in one array.  In
each round every pre-token merges its pair of lowest rank, wherever it occurs,
all in the same few array steps; what is left at the end is counted.
"""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratelake.llm import bytetext
from ratelake.llm.runtime import small_batches

REMEMBERED = 600_000
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def byte_letters() -> list:
    """The letter that stands for each byte: itself where it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


def read_tokenizer(path: str) -> dict:
    """Arrays of a byte-level BPE tokenizer file; read on the driver only."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    vocab = given["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in given["model"]["merges"]]
    first, second, merged = (np.array(x, np.int64) for x in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]))
    size = max(vocab.values()) + 1
    order = np.argsort(first * size + second, kind="stable")
    return {"bytes": np.array([vocab[c] for c in byte_letters()], np.int64), "size": size,
            "key": (first * size + second)[order], "rank": order.astype(np.int64), "merged": merged[order],
            "specials": [t["content"] for t in given["added_tokens"]]}


def count_symbols(words, model) -> np.ndarray:
    """How many tokens each word (bytes, not empty) has."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.zeros(len(words), np.int64)
    symbol = model["bytes"][np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    never = len(model["key"])
    while len(symbol):
        start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        pair = symbol * model["size"] + np.append(symbol[1:], 0)
        at = np.minimum(np.searchsorted(model["key"], pair), never - 1)
        known = (model["key"][at] == pair) & np.append(word[1:] == word[:-1], False)
        rank = np.where(known, model["rank"][at], never)
        lowest = np.minimum.reduceat(rank, start)
        length = np.diff(np.append(start, len(symbol)))
        done = lowest == never
        out[word[start[done]]] = length[done]
        hit = known & (rank == np.repeat(lowest, length))
        # Of overlapping hits (a run of one symbol) every other one merges, from the left.
        place = np.arange(len(hit))
        run = np.maximum.accumulate(np.where(hit & ~np.append(False, hit[:-1]), place, 0))
        hit &= (place - run) % 2 == 0
        symbol = np.where(hit, model["merged"][at], symbol)
        stay = ~np.append(False, hit[:-1]) & ~np.repeat(done, length)
        symbol, word = symbol[stay], word[stay]
    return out


def counter(model: dict, pattern: str, limit: int, count, remembered: int):
    """Task body: bytes and tokens of each text."""
    text = bytetext

    def body(batches):
        import regex

        find = regex.compile(pattern).findall
        special = regex.compile("|".join(map(regex.escape, sorted(model["specials"], key=len, reverse=True)))) \
            if model["specials"] else None
        known = {}
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            for a, b in text.slices(texts):
                cut, marks = [], []
                for t in texts[a:b]:
                    parts = special.split(t) if special else [t]
                    marks.append(len(parts) - 1)
                    cut.append(find(parts[0]) if len(parts) == 1 else [w for p in parts for w in find(p)])
                if len(known) > remembered:
                    known.clear()
                new = list({w for words in cut for w in words if w not in known})
                if new:
                    known.update(zip(new, count([w.encode() for w in new], model).tolist()))
                total = np.array([sum([known[w] for w in words]) + m for words, m in zip(cut, marks)], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([len(t.encode()) for t in texts[a:b]], pa.int64()),
                     pa.array(total), pa.array(total > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return body


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs``.

    A special token's string inside a text counts as that one token.  Null and empty texts have no
    tokens; repeated rows are counted each; an empty table gives no rows; other columns are ignored,
    whatever their names.
    """
    from ratelake.llm import bpe

    count = bpe.by_value(count_symbols)
    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        counter(read_tokenizer(path), pattern, limit, count, REMEMBERED), COUNTS)

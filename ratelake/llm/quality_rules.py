"""Quality rules: base counts, and a log-likelihood ratio of hashed byte n-grams.

Two multinomials over hashed byte trigrams are counted: one over all documents
(raw corpus) and one over the trusted ones.  A text's score is the mean, over
its trigrams, of log p(trusted) - log p(raw), so length does not matter.  A text
is kept when it passes the base rules and its score reaches ``threshold``.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratelake.llm import bytetext
from ratelake.llm.runtime import small_batches

BUCKET_BITS = 16
#: Mean log ratio, in nats per trigram, that a text must reach.
THRESHOLD = -0.5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in LONGS) + ", score double, base_failed boolean, kept boolean"


def count_grams(bits: int):
    """Task body: trigram counts of a partition, raw and trusted, one row per bucket that occurs."""
    text = bytetext

    def count(batches):
        raw, trusted = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in batches:
            texts = text.byte_texts(batch.column("text"))
            good = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            for a, b in text.slices(texts):
                s = text.Slice(texts[a:b])
                gram, inside = text.trigrams(s, bits)
                raw += np.bincount(gram[inside], minlength=1 << bits)
                which = np.repeat(good[a:b], s.text_end - s.text_start + 1)
                trusted += np.bincount(gram[1:len(which) + 1][which & inside[1:len(which) + 1]], minlength=1 << bits)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(raw[some]), pa.array(trusted[some])], names=["bucket", "raw", "trusted"])

    return count


def gram_weights(docs: DataFrame, trusted_ids: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray:
    """Log ratio of each of the 2^bits buckets, with add-one smoothing; all zero without trusted text.

    Every document is counted.  Only bucket sums reach the driver: 2^bits rows at most.
    """
    trusted = trusted_ids.select("doc_id").distinct().withColumn("trusted", F.lit(True))
    marked = docs.select("doc_id", "text").where(F.col("text").isNotNull()) \
        .join(trusted.hint("shuffle_hash"), "doc_id", "left") \
        .select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    sums = (small_batches(marked).mapInArrow(count_grams(bits), "bucket long, raw long, trusted long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).toArrow())
    raw, good = np.zeros(1 << bits), np.zeros(1 << bits)
    at = sums["bucket"].to_numpy()
    raw[at], good[at] = sums["raw"].to_numpy(), sums["trusted"].to_numpy()
    if not good.sum():
        return np.zeros(1 << bits, np.float32)
    size = 1 << bits
    return (np.log((good + 1) / (good.sum() + size)) - np.log((raw + 1) / (raw.sum() + size))).astype(np.float32)


def rate(weights: np.ndarray, bits: int, threshold: float, min_words: int, max_repeat: int):
    """Task body: counts, score and verdict of each text."""
    text = bytetext

    def score(batches):
        for batch in batches:
            texts = text.byte_texts(batch.column("text"))
            for a, b in text.slices(texts):
                s = text.Slice(texts[a:b])
                base, _ = text.base_figures(s)
                gram, inside = text.trigrams(s, bits)
                value = np.where(inside, weights[gram], 0).astype(np.float64)
                n = np.maximum(s.text_end - s.text_start - 2, 0)
                mean = text.per_group_sum(value, s.text_start, s.text_start + n) / np.maximum(n, 1)
                failed = (base["n_words"] < min_words) | \
                    (100 * base["n_repeat_words"] > max_repeat * base["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *(pa.array(base[c], pa.int64()) for c in LONGS),
                     pa.array(mean), pa.array(failed), pa.array(~failed & (mean >= threshold))],
                    names=["doc_id", *LONGS, "score", "base_failed", "kept"])

    return score


def rate_documents(docs: DataFrame, trusted_ids: DataFrame, bits: int = BUCKET_BITS, threshold: float = THRESHOLD,
                   min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """One row per row of ``docs``: base counts, ``score``, ``base_failed`` and ``kept``.

    ``trusted_ids`` holds the ``doc_id`` of the trusted documents.  Null text counts
    as empty and fails the base rules; without trusted text all scores are 0; repeated rows are rated each; an empty table gives no rows;
    other columns are ignored, whatever their names.
    """
    weights = gram_weights(docs, trusted_ids, bits)
    return small_batches(docs.select("doc_id", "text")).mapInArrow(
        rate(weights, bits, threshold, min_words, max_repeat_percent), SCHEMA)


def trusted_from_labels(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality") == 1).select("doc_id").distinct()


def keep_good(docs: DataFrame, trusted_ids: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    weights = gram_weights(docs, trusted_ids, settings.get("bits", BUCKET_BITS))
    bits = settings.get("bits", BUCKET_BITS)
    rater = rate(weights, bits, settings.get("threshold", THRESHOLD), settings.get("min_words", MIN_WORDS),
                 settings.get("max_repeat_percent", MAX_REPEAT_PERCENT))

    def filtered(batches):
        for batch in batches:
            kept = pa.concat_arrays([r.column("kept") for r in rater(iter([batch]))]) if batch.num_rows else None
            yield batch.filter(kept) if kept is not None else batch

    return small_batches(docs).mapInArrow(filtered, docs.schema)

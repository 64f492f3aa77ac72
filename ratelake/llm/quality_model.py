"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins.  Boosting goes round the features in turn; each
step fits a tree of two cuts to the gradients summed per bin and adds it to the
feature's lookup table.  The pairs that explain most of what is left get tables
over two coarser bins, grown the same way.  A score is the sum of one table entry per
feature and pair, so scoring is a few indexed additions.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ratelake.llm import bytetext
from ratelake.llm.runtime import small_batches
from ratelake.session import stage

FEATURES = ("log_words", "chars_per_word", "symbol_share", "upper_share", "digit_share", "stop_mark_share",
            "exclamation_share", "duplicate_line_share", "repeated_window_share", "distinct_word_share",
            "log_words_per_line", "sentence_share", "adjacent_equal_share", "one_char_word_share", "non_ascii_share",
            "symbol_word_share")
#: Labelled rows that the model is fitted on: at most so many, those with the smallest hash of their id.
MAX_ROWS = 40_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
RATE = 0.15

FEATURE_ROW = "doc_id long, features array<float>"


def describe():
    """Task body: the features of each text.  The empty text has all zeros."""
    text = bytetext
    marks = {"digit": b"0123456789", "stop": b".,;:?", "exclamation": b"!"}
    marks = {k: np.isin(np.arange(256), np.frombuffer(v, np.uint8)) for k, v in marks.items()}
    sign = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))

    def features(batches):
        for batch in batches:
            texts = text.byte_texts(batch.column("text"))
            for a, b in text.slices(texts):
                s = text.Slice(texts[a:b])
                base, words = text.base_figures(s)
                chars = np.maximum(base["word_chars"], 1)
                n = np.maximum(s.n_words, 1)
                size = np.maximum(s.text_end - s.text_start, 1)
                upper = s.per_text((s.bytes >= 65) & (s.bytes <= 90))
                letters = np.maximum(upper + s.per_text((s.bytes >= 97) & (s.bytes <= 122)), 1)
                same = np.zeros(len(words), bool)
                if len(words):
                    same[1:] = (words[1:] == words[:-1]) & (s.word_text[1:] == s.word_text[:-1])
                count = lambda flags: np.bincount(s.word_text[flags], minlength=s.n)
                _, first = np.unique(text.tagged(words, s.word_text), return_index=True)
                last = s.bytes[s.end - 1] if len(words) else np.zeros(0, np.uint8)
                columns = [
                    np.log1p(s.n_words), base["word_chars"] / n, base["n_symbols"] / chars, upper / letters,
                    s.per_text(marks["digit"][s.bytes]) / chars, s.per_text(marks["stop"][s.bytes]) / chars,
                    s.per_text(marks["exclamation"][s.bytes]) / chars,
                    base["n_dup_lines"] / np.maximum(base["n_lines"], 1), base["n_repeat_words"] / n,
                    np.bincount(s.word_text[first], minlength=s.n) / n,
                    np.log1p(s.n_words / np.maximum(base["n_lines"], 1)),
                    count(last == ord(".")) / n, count(same) / n, count(s.end - s.start == 1) / n,
                    s.per_text(s.bytes >= 128) / size, count(sign[last]) / n]
                flat = np.stack(columns, 1).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), rows_of(flat)], names=["doc_id", "features"])

    def rows_of(flat):
        ends = np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))

    return features


def _tree(gradient, hessian, rate, ridge=1.0):
    """Values per bin of the best tree of two cuts, and what it gains."""
    g, h = np.append(0, np.cumsum(gradient)), np.append(0, np.cumsum(hessian))
    n = len(gradient)

    def gain(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)

    i, j = np.triu_indices(n + 1)      # cuts before bins i and j; an empty part gains nothing
    total = gain(0, i) + gain(i, j) + gain(j, n)
    best = int(np.argmax(total))
    out = np.zeros(n)
    for a, b in ((0, i[best]), (i[best], j[best]), (j[best], n)):
        if b > a:
            out[a:b] = rate * (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out, float(total[best] - gain(0, n))


def _pair_tree(gradient, hessian, rate, ridge=1.0):
    """A tree that cuts one feature once and, on each side, the other twice."""
    best = None
    for axis in (0, 1):
        g = gradient if axis == 0 else gradient.T
        h = hessian if axis == 0 else hessian.T
        for cut in range(1, len(g)):
            low, a = _tree(g[:cut].sum(0), h[:cut].sum(0), rate, ridge)
            high, b = _tree(g[cut:].sum(0), h[cut:].sum(0), rate, ridge)
            base = g[:cut].sum() ** 2 / (h[:cut].sum() + ridge) + g[cut:].sum() ** 2 / (h[cut:].sum() + ridge)
            if best is None or a + b + base > best[0]:
                table = np.concatenate([np.tile(low, (cut, 1)), np.tile(high, (len(g) - cut, 1))])
                best = a + b + base, table if axis == 0 else table.T
    return best[1], best[0]


def fit(x, y, bins=BINS, pair_bins=PAIR_BINS, pairs=PAIRS, rounds=ROUNDS, rate=RATE):
    """Lookup tables from feature rows ``x`` and labels ``y`` (0 or 1); None without any row."""
    if not len(y):
        return None
    x, y = np.asarray(x, np.float32), np.asarray(y, np.float64)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) for c in x.T]
    coarse = [np.unique(np.quantile(c, np.linspace(0, 1, pair_bins + 1)[1:-1], method="higher")) for c in x.T]
    place = [np.searchsorted(c, v) for c, v in zip(cuts, x.T)]
    rough = [np.searchsorted(c, v) for c, v in zip(coarse, x.T)]
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = {"intercept": float(np.log(share / (1 - share))), "cuts": cuts, "coarse": coarse,
             "tables": [np.zeros(len(c) + 1) for c in cuts], "pairs": []}
    score = np.full(len(y), model["intercept"])

    def slopes():
        p = 1 / (1 + np.exp(-score))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, at in enumerate(place):
            g, h = slopes()
            n = len(cuts[f]) + 1
            step, _ = _tree(np.bincount(at, g, n), np.bincount(at, h, n), rate)
            model["tables"][f] += step
            score += step[at]

    def cells(a, b):
        width = len(coarse[b]) + 1
        return rough[a] * width + rough[b], (len(coarse[a]) + 1, width)

    g, h = slopes()
    found = []
    for a in range(len(cuts)):
        for b in range(a + 1, len(cuts)):
            at, shape = cells(a, b)
            n = shape[0] * shape[1]
            if min(shape) > 1:
                _, gain = _pair_tree(np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape), rate)
                found.append((-gain, a, b))
    chosen = [(a, b) for _, a, b in sorted(found)[:pairs]]
    tables = {p: 0.0 for p in chosen}
    for _ in range(rounds // 4):
        for p in chosen:
            at, shape = cells(*p)
            n = shape[0] * shape[1]
            g, h = slopes()
            step, _ = _pair_tree(np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape), rate)
            tables[p] = tables[p] + step
            score += step.ravel()[at]
    model["pairs"] = [(*p, t) for p, t in tables.items()]
    return model


def predict(model, x):
    """Scores from 0 to 1: additions of table entries; 0.5 without a model."""
    if model is None:
        return np.full(len(x), 0.5)
    score = np.full(len(x), model["intercept"])
    for f, table in enumerate(model["tables"]):
        score += table[np.searchsorted(model["cuts"][f], x[:, f])]
    for a, b, table in model["pairs"]:
        score += table[np.searchsorted(model["coarse"][a], x[:, a]), np.searchsorted(model["coarse"][b], x[:, b])]
    return 1 / (1 + np.exp(-score))


def scorer(model, predict):
    """Task body: scores of feature rows."""

    def scores(batches):
        for batch in batches:
            lists = batch.column("features")
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(predict(model, x))], names=["doc_id", "score"])

    return scores


def held_out(doc_id="doc_id"):
    """True for rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(features: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **settings):
    """The model of the labelled rows outside the held-out third.

    An id with several labels counts as good when at least half of them are; null
    labels and null ids are left out.  The fit takes the ``max_rows`` rows with the
    smallest hash of their id, which bounds what the driver gets.
    """
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg((F.avg(F.col("quality").cast("double")) >= 0.5).cast("int").alias("_label")))
    rows = (features.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("features"))
            .limit(max_rows).select("features", "_label").toArrow())
    if not rows.num_rows:
        return None
    x = np.stack(rows["features"].to_numpy()).astype(np.float32)
    return fit(x, rows["_label"].to_numpy(), **settings)


def text_features(docs: DataFrame) -> DataFrame:
    """``doc_id, features``: one row per document; null text counts as empty."""
    return small_batches(docs.select("doc_id", "text")).mapInArrow(describe(), FEATURE_ROW)


def score_documents(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, **settings) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Only features of the text enter a score.  Null and empty texts get the score of
    their (zero) features; without labels every score is 0.5; repeated rows are scored each;
    other columns are ignored, whatever their names.
    """
    features = stage(text_features(docs), "features")
    model = learn(features, labels, max_rows, **settings)
    scored = features.mapInArrow(scorer(model, by_value(predict)), "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def by_value(function):
    """A copy of a plain function that is sent to tasks with its code."""
    import types

    return types.FunctionType(function.__code__, {"np": np, "__builtins__": __builtins__}, function.__name__)


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, with all their columns."""
    features = stage(text_features(docs), "features")
    model = learn(features, labels, **settings)
    rate, body = by_value(predict), describe()

    def filtered(batches):
        for batch in batches:
            if batch.num_rows:
                lists = pa.concat_arrays([r.column("features") for r in body(iter([batch]))])
                x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
                batch = batch.filter(pa.array(rate(model, x) >= 0.5))
            yield batch

    return small_batches(docs).mapInArrow(filtered, docs.schema)

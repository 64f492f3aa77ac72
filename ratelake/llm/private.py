"""Personal data: fixed forms, and identifiers in other forms that are found by the words around them.

E-mail addresses, IP addresses, card numbers and phone numbers of the fixed forms are found in every
text; they are the seeds.  What looks like an identifier but has none of the forms is a candidate.  The words
around a seed or candidate are its patterns: the two words before it, the three words before it, and the words on
both sides.  Spark scores the graph of patterns and instances in rounds: a pattern's confidence in a kind is the
score of its instances of that kind, over all seeds, half of the candidates and all ordinary words that stand in its place anywhere;
a candidate's score comes from the confident patterns it stands in; accepted candidates
strengthen further patterns.  In the end, candidates in the place of a confident pattern are marked.

How often ordinary words stand in a pattern's place is counted over all documents.  A fixed table of flags, of a
size that doesn't depend on the data, says in the tasks which places may belong to a pattern that matters.
"""

import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from ratelake.llm import bytetext
from ratelake.llm.runtime import small_batches
from ratelake.session import stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
#: Different instances of its kind that a pattern needs; least confidence of a pattern and least score of an accepted
#: candidate, in thousandths; rounds of scoring.
SUPPORT, CONFIDENT, ACCEPTED, ROUNDS = 3, 500, 500, 4
#: Most confidence of a pattern.
SUREST = 990
#: Bits of the number of flags.
FLAG_BITS = 22
#: Patterns that a task counts before it passes them on.
COUNTED = 1 << 20

EMAIL_NAME = re.compile(r"[A-Za-z0-9._%+-]+\Z")
EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A number can't match from its middle if it doesn't from its start, so only starts are tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NAME_LETTER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: What a candidate of each kind must look like.
SHAPES = (re.compile(r"[^@(\[]+(?:@|\(at\)|\[at\])[^@(\[]+"), re.compile(r"(?=.*[0-9])[0-9A-Fa-f]*(?:[.:][0-9A-Fa-f]*){3,}"),
          re.compile(r"(?:[0-9][ ./-]?){12,19}"), re.compile(r"\(?(?:[0-9][ ()./-]{0,2}){6,15}"))
EDGE = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"

SPAN = "kind int, first long, last long"
FOUND = (f"row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans array<struct<{SPAN}>>, "
         "seen array<struct<kind int, shapes int, first long, last long, instance long, patterns array<long>>>")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text):
    """Leftmost addresses that don't overlap: for each @, the name that ends there and the host behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in NAME_LETTER:
            first -= 1
        host = EMAIL_HOST.match(text, at + 1) if first < at else None
        if host:
            yield first, host.end()
            done = host.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text):
    """``(kind, first, last)`` of the fixed forms by kind and place, in code points."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def instance(kind_text):
    """What tells instances apart: letters and digits, lower-cased."""
    plain = "".join(c for c in kind_text.lower() if c.isalnum())
    return int.from_bytes(hashlib.blake2b(plain.encode(), digest_size=8).digest(), "little", signed=True)


def shapes_of(text):
    """One bit for each kind that the text may be."""
    return sum(1 << k for k, shape in enumerate(SHAPES) if shape.fullmatch(text))


def candidates(slice_, words_first, words_last, is_number, lead, text_no, text):
    """``(first word, last word, first, last)`` of what may be an identifier in a text: one word, or numbers side by side."""
    raw = slice_.bytes
    origin = lead[slice_.text_start[text_no]]
    k = words_first
    while k < words_last:
        j = k
        if is_number[k]:
            while j + 1 < words_last and is_number[j + 1] and slice_.start[j + 1] == slice_.end[j] + 1 and raw[slice_.end[j]] == 32:
                j += 1
        first, last = int(lead[slice_.start[k]] - origin), int(lead[slice_.end[j]] - origin)
        piece = text[first:last]
        head = len(piece) - len(piece.lstrip(EDGE.replace("(", "") if is_number[k] else EDGE))
        piece = piece.strip(EDGE.replace("(", "") if is_number[k] else EDGE)
        yield k, j, first + head, first + head + len(piece), piece
        k = j + 1


def find(batches):
    """Task body: base spans of each text, and every seed and candidate with its instance and its patterns."""
    part, row = TaskContext.get().partitionId() << 33, 0
    empty = np.zeros(256, bool)
    digit = empty.copy()
    digit[48:58] = True
    numeric = digit.copy()
    numeric[[40, 41, 43, 45, 46, 47]] = True
    for batch in batches:
        all_texts = bytetext.byte_texts(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for a, b in bytetext.slices(all_texts):
            texts = all_texts[a:b]
            s = bytetext.Slice(texts, lower=True)
            words = s.word_hashes()
            contexts = [c.view(np.int64) for c in bytetext.contexts(s, words)]
            lead = np.append(0, np.cumsum((s.bytes & 0xC0) != 0x80))
            sums = lambda flags: np.append(0, np.cumsum(flags[s.bytes]))
            digits, numbers = (c[s.end] - c[s.start] for c in (sums(digit), sums(numeric)))
            at = np.append(0, np.cumsum(s.bytes == 64))
            ats = at[s.end] - at[s.start]
            is_number = (digits > 0) & (numbers == s.end - s.start)
            # An address in words: (at) or [at].
            hints = np.append(0, np.cumsum((s.bytes == 97) & np.isin(np.roll(s.bytes, 1), [40, 91]) & (np.roll(s.bytes, -1) == 116)))
            hopeful = is_number | (digits >= 4) | (ats > 0) | (hints[s.end] > hints[s.start])
            rows = []
            for i, raw in enumerate(texts):
                first_word, last_word = int(s.first[i]), int(s.last[i])
                some = np.flatnonzero(hopeful[first_word:last_word]) + first_word
                text = raw.decode() if len(some) or b"@" in raw or b"+" in raw or digit[np.frombuffer(raw, np.uint8)].any() else ""
                base = base_spans(text)
                marks = ",".join(f"{KINDS[k]}:{x}:{y}" for k, x, y in base)
                seen = []
                if base or len(some):
                    origin = lead[s.text_start[i]]
                    starts = lead[s.start[first_word:last_word]] - origin
                    ends = lead[s.end[first_word:last_word]] - origin
                    taken = np.zeros(last_word - first_word, bool)

                    def patterns(k, j):
                        return [int(c[at]) for c, at in ((contexts[0], k), (contexts[1], k), (contexts[2], k)) if c[at] and (c is not contexts[2] or k == j)]

                    for kind, x, y in base:
                        k = max(int(np.searchsorted(starts, x, side="right")) - 1, 0)
                        j = max(int(np.searchsorted(starts, y, side="left")) - 1, k)
                        taken[k:j + 1] = True
                        seen.append((kind, 0, x, y, instance(text[x:y]), patterns(first_word + k, first_word + j)))
                    for run in np.split(some, np.flatnonzero(np.diff(some) > 1) + 1) if len(some) else []:
                        for k, j, x, y, piece in candidates(s, int(run[0]), int(run[-1]) + 1, is_number, lead, i, text):
                            if not taken[k - first_word:j + 1 - first_word].any() and (shapes := shapes_of(piece)):
                                seen.append((-1, shapes, x, y, instance(piece), patterns(k, j)))
                    del starts, ends
                count = np.bincount([k for k, _, _ in base], minlength=4) if base else [0] * 4
                rows.append((part + row, ids[a + i], *map(int, count), hashlib.sha256(marks.encode()).hexdigest(),
                             [dict(kind=k, first=x, last=y) for k, x, y in base],
                             [dict(zip(("kind", "shapes", "first", "last", "instance", "patterns"), r)) for r in seen]))
                row += 1
            yield found_rows(rows)


def found_rows(rows):
    span = pa.struct([("kind", pa.int32()), ("first", pa.int64()), ("last", pa.int64())])
    sight = pa.struct([("kind", pa.int32()), ("shapes", pa.int32()), ("first", pa.int64()), ("last", pa.int64()),
                       ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
    kinds = [pa.int64()] * 6 + [pa.string(), pa.list_(span), pa.list_(sight)]
    names = ["row", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "seen"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def flag_of(patterns: np.ndarray, bits: int) -> np.ndarray:
    return patterns.view(np.uint64) >> np.uint64(64 - bits)


def count_places(flags: np.ndarray, bits: int):
    """Task body: how often each pattern with a flag has a word in its place, whatever word."""

    def count(batches):
        keys, n = [], 0

        def counted():
            value, times = np.unique(np.concatenate(keys), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(value), pa.array(times.astype(np.int64))], names=["pattern", "n"])

        for batch in batches:
            texts = bytetext.byte_texts(batch.column("text"))
            for a, b in bytetext.slices(texts):
                s = bytetext.Slice(texts[a:b], lower=True)
                for c in bytetext.contexts(s, s.word_hashes()):
                    c = c[c != 0].view(np.int64)
                    c = c[flags[flag_of(c, bits)]]
                    keys.append(c)
                    n += len(c)
            if n > COUNTED:
                yield counted()
                keys, n = [], 0
        if n:
            yield counted()

    return count


def confident_patterns(edges: DataFrame, places: DataFrame, support: int, confident: int, accepted: int, rounds: int) -> DataFrame:
    """``pattern, kind, confidence``: patterns that a kind's instances stand in, scored in rounds.

    ``edges`` holds each ``pattern, instance`` once, with ``kind`` of a seed (-1: candidate) and ``shapes``.  Scores are
    whole thousandths.
    """
    known = edges.where("kind >= 0").select("instance", "kind").distinct().withColumn("score", F.lit(1000).cast("long"))
    # Seeds and ordinary words in the place count once each, candidates half: nobody knows what they are.
    crowd = edges.groupBy("pattern").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("kind") >= 0).alias("n_seeds"))
    ordinary = F.greatest(F.coalesce("n", F.lit(0)) - F.col("times"), F.lit(0))
    size = stage(crowd.join(places, "pattern", "left").select(
        "pattern", (F.col("n_all") + F.col("n_seeds") + 2 * ordinary).alias("halves")), "sizes")
    links = edges.select("pattern", "instance").distinct()
    shown = edges.where("kind < 0").select("pattern", "instance", F.explode(F.sequence(F.lit(0), F.lit(len(KINDS) - 1))).alias("kind"), "shapes") \
        .where(F.expr("shapes & shiftleft(1, kind)") != 0).drop("shapes").distinct()
    scored, before, patterns = known, None, None
    for _ in range(rounds):
        weights = links.join(scored, "instance").groupBy("pattern", "kind").agg(
            F.sum("score").alias("score"), F.count(F.lit(1)).alias("support"))
        patterns = stage(weights.join(size, "pattern").withColumn("confidence", F.expr(f"least(2 * score div (halves + 2), {SUREST})"))
                         .where((F.col("support") >= support) & (F.col("confidence") >= confident))
                         .select("pattern", "kind", "confidence"), "patterns")
        # A candidate is wrong only if all its patterns are.
        doubt = F.sum(F.log(1 - F.col("confidence") / 1000.0))
        new = shown.join(patterns, ["pattern", "kind"]).groupBy("instance", "kind").agg(
            F.floor(F.round(1000 * (1 - F.exp(doubt)), 6)).alias("score")).where(F.col("score") >= accepted)
        scored = stage(known.unionByName(new.join(known, ["instance", "kind"], "left_anti")), "scored")
        now = scored.agg(F.count(F.lit(1)), F.sum("score"), F.bit_xor(F.xxhash64("instance", "kind", "score"))).first()
        if now == before:
            break
        before = now
    return patterns


def find_private(docs: DataFrame, support: int = SUPPORT, confident: int = CONFIDENT, accepted: int = ACCEPTED,
                 rounds: int = ROUNDS, flag_bits: int = FLAG_BITS) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every row of ``docs``.

    The counts and the digest are of the fixed forms; ``spans`` lists these and the ones found by context, ``n_added``
    of them.  A span is ``kind:start:end`` in code points, end exclusive, by kind and start.  A found span touches no
    word of a fixed one; if patterns of several kinds find it, the most confident wins, ties to
    the first kind.  Words are compared with A-Z in lower case; a pattern's words lie in the same text.

    Null text is empty and has no spans; very long texts and words are read whole, in linear time; repeated rows are
    searched each and their instances count once; an empty table gives no rows; other columns are ignored, whatever their names.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = stage(small_batches(texts).mapInArrow(find, FOUND), "found")
    seen = found.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    edges = stage(seen.select("instance", "kind", "shapes", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance").agg(
        F.max("kind").alias("kind"), F.max("shapes").alias("shapes"), F.count(F.lit(1)).alias("times")), "edges")
    # Only patterns with enough instances can matter; their flags are at most 2^flag_bits.
    hopeful = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= support)
    flags = np.zeros(1 << flag_bits, bool)
    # The bits that flag_of takes, as a number from 0.
    place = F.shiftrightunsigned("pattern", 64 - flag_bits)
    flags[hopeful.select(place.alias("flag")).distinct().toArrow()["flag"].to_numpy()] = True
    places = small_batches(texts.select("text")).mapInArrow(count_places(flags, flag_bits), "pattern long, n long") \
        .groupBy("pattern").agg(F.sum("n").alias("n"))
    chosen = edges.join(hopeful.select("pattern"), "pattern")
    patterns = confident_patterns(stage(chosen, "chosen"), places, support, confident, accepted, rounds)

    marked = (seen.where("kind < 0").drop("kind").withColumn("pattern", F.explode("patterns")).join(patterns, "pattern")
              .where(F.expr("shapes & shiftleft(1, kind)") != 0)
              .groupBy("row", "first", "last").agg(F.max(F.struct("confidence", F.negative("kind").alias("k"))).alias("best"))
              .select("row", F.struct(F.negative("best.k").cast("int").alias("kind"), "first", "last").alias("span"))
              .groupBy("row").agg(F.collect_list("span").alias("added")))
    names = F.array(*map(F.lit, KINDS))
    shown = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["first"], x["last"])
    every = F.when(F.col("added").isNull(), F.col("spans")).otherwise(F.sort_array(F.concat("spans", F.coalesce("added", F.array()))))
    return found.drop("seen").join(marked, "row", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.array_join(F.transform(every, shown), ",").alias("spans"),
        F.coalesce(F.size("added"), F.lit(0)).cast("long").alias("n_added"))

"""Array code over the bytes of many texts at once; runs inside tasks.

Texts are laid out in one byte array, each between separators, so that words,
lines and windows of all of them come from a few passes over the array.  White
space is single bytes, so words are found exactly in UTF-8.  Equality of words, lines and
windows is decided on 64-bit hashes.  The module is pickled by value, so
executors need no copy of this package.
"""

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Texts are taken together up to this many bytes; a longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 5)
#: Prime and base of each hash of bytes.  Modulo a power of two, texts of a known build share their hash.
_FIELDS = ((2147483647, 1_300_728_119), (2147483629, 1_961_563_417))
#: Sums of so many bytes' terms stay below 2^64 without a remainder taken.
_UNREDUCED = 1 << 24
_powers = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h):
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    return h ^ (h >> U(32))


def _row(base, prime, n):
    """1, base, base^2, ... modulo the prime."""
    out = np.ones(n, U)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * U(pow(base, done, prime)) % U(prime)
        done += step
    return out.astype(np.uint32)


def powers(n):
    """For each field, powers of the base and of its inverse; kept for slices of the usual size only."""
    size = max(n, SLICE_BYTES * 2)
    made = _powers.get(size) or [tuple(_row(b, prime, size) for b in (base, pow(base, -1, prime))) for prime, base in _FIELDS]
    if size == SLICE_BYTES * 2:
        _powers[size] = made
    return made


def slices(texts, limit=SLICE_BYTES):
    """Ranges of whole texts of about ``limit`` bytes."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def byte_texts(column):
    """The values of a string column as bytes; null is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if t is None else t for t in column.cast(kind).to_pylist()]


class Slice:
    """Texts side by side with their words: where each starts and ends, and the words of each text."""

    def __init__(self, texts, lower=False):
        self.n = len(texts)
        self.bytes = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.bytes = LOWER[self.bytes]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, self.n)
        self.text_end = np.cumsum(sizes)              # place of the separator behind each text
        self.text_start = self.text_end - sizes + 1
        self.filled = ~SPACE[self.bytes]
        edge = np.diff(self.filled.view(np.int8))
        self.start = np.flatnonzero(edge == 1) + 1
        self.end = np.flatnonzero(edge == -1) + 1
        self.first = np.searchsorted(self.start, self.text_start)   # of each text's words
        self.last = np.searchsorted(self.start, self.text_end)
        self.n_words = self.last - self.first
        self.word_text = np.repeat(np.arange(self.n), self.n_words)
        self._prefix = None

    def hashes(self, start, end):
        """A hash of the bytes of each range."""
        if self._prefix is None:
            self._power, self._prefix = powers(len(self.bytes)), []
            letters = self.bytes.astype(U) + U(1)
            for (prime, _), (power, _) in zip(_FIELDS, self._power):
                terms = letters * power[:len(letters)]
                if len(terms) > _UNREDUCED:
                    terms %= U(prime)
                prefix = np.zeros(len(terms) + 1, U)
                np.cumsum(terms, out=prefix[1:])
                self._prefix.append(prefix)
        parts = [(prefix[end] - prefix[start]) % U(prime) * inverse[start] % U(prime)
                 for prefix, (prime, _), (_, inverse) in zip(self._prefix, _FIELDS, self._power)]
        return mix(parts[0] << U(32) | parts[1])

    def word_hashes(self):
        return self.hashes(self.start, self.end)

    def windows(self, word_hash, size):
        """Hash and text of each window of ``size`` words inside one text, and the place of its first word."""
        count = len(word_hash) - size + 1
        if count <= 0:
            return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = np.flatnonzero(self.word_text[:count] == self.word_text[size - 1:])
        total = np.zeros(count, U)
        for k in range(size):
            total = total * _BASE + word_hash[k:k + count]
        return mix(total[inside]), self.word_text[inside], inside

    def per_text(self, flags):
        """How many of the flagged bytes each text has."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.text_end] - total[self.text_start]

    def lines(self):
        """Start and end of each line, with the text it belongs to."""
        breaks = np.flatnonzero(self.bytes == 10)
        start, end = breaks[:-1] + 1, breaks[1:]
        return start, end, np.searchsorted(self.text_end, start, side="left")


def tagged(hash_, text):
    """Hashes that are equal only inside the same text."""
    return mix(hash_ + (text.astype(U) + U(1)) * U(0xA24BAED4963EE407))


def per_group_sum(values, starts, ends):
    """Sums of consecutive ranges, each summed by itself; empty ranges give 0."""
    out = np.zeros(len(starts), values.dtype)
    some = ends > starts
    if some.any():
        # Ranges follow each other without gaps between the filled ones' values, or gaps are cut off here.
        edges = np.stack([starts[some], ends[some]], 1).ravel()
        padded = np.append(values, values[:1] * 0)
        out[some] = np.add.reduceat(padded, edges)[::2]
    return out


def base_figures(s: Slice):
    """Per text: words, code points in words, symbols, duplicate lines, words in repeated 5-word windows."""
    lead = (s.bytes & 0xC0) != 0x80
    symbol = np.isin(s.bytes, np.frombuffer(b"#*$%&|<>", np.uint8))
    start, end, text = s.lines()
    worded = np.searchsorted(s.start, end) > np.searchsorted(s.start, start)
    start, end, text = start[worded], end[worded], text[worded]
    n_lines = np.bincount(text, minlength=s.n)
    _, firsts = np.unique(tagged(s.hashes(start, end), text), return_index=True)
    words = s.word_hashes()
    gram, gram_text, place = s.windows(words, 5)
    _, where, times = np.unique(tagged(gram, gram_text), return_inverse=True, return_counts=True)
    again = place[times[where] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 5, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return {
        "n_words": s.n_words,
        "word_chars": s.per_text(lead & s.filled),
        "n_symbols": s.per_text(symbol),
        "n_dup_lines": n_lines - np.bincount(text[firsts], minlength=s.n),
        "n_repeat_words": np.bincount(s.word_text[covered], minlength=s.n),
        "n_lines": n_lines,
    }, words


def trigrams(s: Slice, bits):
    """Bucket of the three bytes from each place on, and whether they lie inside one text."""
    b = s.bytes.astype(np.uint32)
    code = np.zeros(len(b), np.uint32)
    code[:-2] = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    gram = (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
    text = np.repeat(np.arange(s.n), s.text_end - s.text_start + 1)   # from the first text's first byte
    inside = np.zeros(len(b), bool)
    place = np.arange(1, len(b))
    inside[1:] = place + 2 < s.text_end[text]
    return gram.astype(np.int64), inside


def contexts(s: Slice, words):
    """For each word, hashes of the two and of the three words before it, and of the words on both sides; 0 where there are none."""
    n = len(words)
    out = []
    for before, after, salt in ((2, 0, 0x2545F4914F6CDD1D), (3, 0, 0x9E6C63D0676A9A99), (1, 1, 0xD1342543DE82EF95)):
        key = np.zeros(n, U)
        if n > before + after:
            slot = np.arange(before, n - after)
            slot = slot[(s.word_text[slot - before] == s.word_text[slot]) & (s.word_text[slot + after] == s.word_text[slot])]
            total = np.zeros(len(slot), U)
            for k in [*range(-before, 0), *range(1, after + 1)]:
                total = total * _BASE + words[slot + k]
            key[slot] = np.maximum(mix(total ^ U(salt)), U(1))
        out.append(key)
    return out


def shingle_sets(texts, size):
    """Distinct shingles of each text, lower-cased: hashes in text order, their text, and the end of each text's run."""
    s = Slice(texts, lower=True)
    words = s.word_hashes()
    gram, owner, _ = s.windows(words, size)
    few = np.flatnonzero((s.n_words > 0) & (s.n_words < size))
    if len(few):
        whole = np.zeros(len(few), U)
        for k in range(size - 1):
            has = s.n_words[few] > k
            whole[has] = whole[has] * _BASE + words[s.first[few][has] + k] + U(k + 1)
        gram, owner = np.append(gram, mix(whole ^ U(0x1F83D9ABFB41BD6B))), np.append(owner, few)
    _, first = np.unique(tagged(gram, owner), return_index=True)
    order = first[np.argsort(owner[first], kind="stable")]
    return gram[order], owner[order], np.cumsum(np.bincount(owner[order], minlength=s.n))


def word_lists(texts):
    """The words of each text, lower-cased."""
    return [t.lower().split() for t in texts]


def exact_sets(texts, size):
    """Distinct shingles of each text as numbers, equal in all texts only for equal words: per text, its sorted numbers."""
    words = word_lists(texts)
    known = {}
    flat = np.fromiter((known.setdefault(w, len(known)) for t in words for w in t), np.int64, sum(map(len, words)))
    counts = np.array([len(t) for t in words], np.int64)
    owner = np.repeat(np.arange(len(texts)), counts)
    code, n_codes = flat, len(known) + 1
    few = np.flatnonzero((counts > 0) & (counts < size))
    short = {}
    if len(flat) >= size:
        inside = np.flatnonzero(owner[:len(flat) - size + 1] == owner[size - 1:])
        code = flat[inside]
        for k in range(1, size):
            # Numbers of pairs stay dense, so they never outgrow 64 bits.
            code = np.unique(code * (len(known) + 1) + flat[inside + k], return_inverse=True)[1]
        n_codes, whose = len(np.unique(code)), owner[inside]
    else:
        code, whose, n_codes = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    order = np.lexsort((code, whose))
    code, whose = code[order], whose[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (whose[1:] != whose[:-1])
    code, whose = code[new], whose[new]
    edges = np.searchsorted(whose, np.arange(len(texts) + 1))
    sets = [code[a:b] for a, b in zip(edges[:-1], edges[1:])]
    for i in few:
        sets[i] = np.array([n_codes + short.setdefault(tuple(words[i]), len(short))])
    return sets


def similar(a, b, percent):
    """100 * intersection >= percent * union, for sorted sets that are not empty."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _permute(x):
    """A bijection of 32-bit numbers."""
    x = x * np.uint32(0x9E3779B1)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA77)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE3D)
    return x


def circulant_minima(hashes, starts, ends, coordinates):
    """The low 16 bits of each coordinate's minimum; texts without shingles left out.

    The first permutation is the spread hash itself, cut to 32 bits; coordinate k shifts it
    round the circle by k steps before the second permutation.
    """
    some = ends > starts
    spread = (mix(hashes ^ U(0x3C6EF372FE94F82B)) >> U(32)).astype(np.uint32)
    edges = starts[some]
    out = np.zeros((int(some.sum()), coordinates), np.uint16)
    if len(edges):
        with np.errstate(over="ignore"):
            for k in range(coordinates):
                shifted = _permute(spread + np.uint32((k * 0x6C8E9CF5) & 0xFFFFFFFF))
                least = np.minimum.reduceat(shifted, edges)
                out[:, k] = (least ^ (least >> np.uint32(16))).astype(np.uint16)
    return out

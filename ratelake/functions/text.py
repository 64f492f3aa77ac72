"""Tokens and word pairs of item texts."""

from pyspark.sql import Column, functions as F

from ratelake.functions.scalar import as_col

# The default English stop words of Spark ML's StopWordsRemover that
# have no apostrophe (words split there anyway).
# Pass another list to the operators to use it instead.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now cannot could ought would
""".split())


def tokens(text, ascii_only: bool = False) -> Column:
    """Lower-case words of two or more word characters, in order."""
    word = r"(\w\w+)" if ascii_only else r"(?U)(\w\w+)"
    return F.regexp_extract_all(F.lower(as_col(text)), F.lit(word), F.lit(1))


def drop_words(words, stop_words) -> Column:
    if not stop_words:
        return as_col(words)
    return F.filter(as_col(words), lambda w: ~w.isin(*stop_words))


def unigrams_and_bigrams(words) -> Column:
    """The words followed by every pair of neighbours joined by a space."""
    words = as_col(words)
    pairs = F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))),
        lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
    return F.concat(words, F.array_compact(pairs))

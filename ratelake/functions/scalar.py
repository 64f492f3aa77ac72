"""Column expressions.  They are all native, so they stay in generated code."""

from pyspark.sql import Column, functions as F, types as T

SECONDS_PER_DAY = 86400
# A table is in milliseconds when its largest stamp is above the first mark.  One
# stamp alone can be older than that, so single rows use the second (1973 in
# milliseconds, the year 5138 in seconds).
TABLE_MILLISECOND_MARK = 1e12
ROW_MILLISECOND_MARK = 1e11

# Accepted epoch-second window (2000-01-01 to 2030-01-01).
TIMESTAMP_MIN = 946684800
TIMESTAMP_MAX = 1893456000

# Rating scale.
RATING_MIN, RATING_MAX = 1.0, 5.0

# Right-closed price bins and their labels.
PRICE_EDGES = (0, 10, 25, 50, 100, 200)
PRICE_LABELS = ("<$10", "$10-25", "$25-50", "$50-100", "$100-200")


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c, digits: int) -> Column:
    """Round half to even in binary floating point; ``-0.0`` becomes ``0.0``."""
    scale = F.lit(float(10 ** digits))
    return F.rint(as_col(c) * scale) / scale + F.lit(0.0)


def int_div(c, divisor: int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", as_col(c), F.lit(divisor).cast("bigint"))


def parse_price(c) -> Column:
    """Digits and dots of a price text as a number; null when that is none."""
    return F.regexp_replace(as_col(c).cast("string"), "[^0-9.]", "").try_cast("double")


def to_number(c) -> Column:
    """Number or null; a text that spells NaN counts as missing."""
    number = as_col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def text_list(c) -> Column:
    """A JSON list of strings held as text; null when the text is no such list."""
    c = as_col(c)
    return F.when(c.startswith("["), F.from_json(c, T.ArrayType(T.StringType())))


def category_path(c) -> Column:
    """List of category names as one path; ``""`` for an empty or missing list."""
    return F.coalesce(F.array_join(as_col(c), " > "), F.lit(""))


def description_text(listed, plain=None, limit: int = 300) -> Column:
    """List of paragraphs (or one plain text) cut to ``limit`` characters."""
    joined = F.array_join(as_col(listed), " ")
    whole = joined if plain is None else F.coalesce(joined, as_col(plain))
    return F.substring(whole, 1, limit)


def empty_to_null(c) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def whole_seconds(c) -> Column:
    """Epoch stamp of any type as a bigint; unreadable or missing stamps give 0."""
    c = as_col(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"),
                      F.lit(0).cast("bigint"))


def date_time_seconds(c) -> Column:
    """Epoch second of a date-time text; null for numbers and for anything else."""
    c = as_col(c).cast("string")
    return F.when(c.try_cast("double").isNull(), F.unix_seconds(c.try_cast("timestamp")))


def epoch_seconds(ts, largest=None) -> Column:
    """Milliseconds to seconds, judged by the table's ``largest`` stamp or else by the row's own."""
    ts = as_col(ts)
    in_ms = ts > F.lit(ROW_MILLISECOND_MARK) if largest is None else largest > F.lit(TABLE_MILLISECOND_MARK)
    return F.when(in_ms, int_div(ts, 1000)).otherwise(ts)


def day_number(ts) -> Column:
    return int_div(ts, SECONDS_PER_DAY)


def calendar_date(ts) -> Column:
    """UTC date of an epoch second, whatever the session time zone."""
    return F.date_from_unix_date(F.floor(as_col(ts) / SECONDS_PER_DAY).cast("int"))


def month_start(year, month) -> Column:
    return F.make_date(as_col(year), as_col(month), F.lit(1))


def in_window(ts) -> Column:
    return as_col(ts).between(TIMESTAMP_MIN, TIMESTAMP_MAX)


def scale_rating(c, lo: float = RATING_MIN, hi: float = RATING_MAX) -> Column:
    return half_even((as_col(c) - lo) / (hi - lo), 4)


def clip(c, lo: float, hi: float) -> Column:
    """Null stays null (``least`` and ``greatest`` would skip it)."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(lo))), F.lit(float(hi))))


def price_bucket_index(c) -> Column:
    """Position of the right-closed bin of a price clipped to the outer edges; 0 has none."""
    price = clip(c, PRICE_EDGES[0], PRICE_EDGES[-1])
    found = F.lit(None).cast("int")
    for i in reversed(range(len(PRICE_LABELS))):
        found = F.when((price > PRICE_EDGES[i]) & (price <= PRICE_EDGES[i + 1]), F.lit(i)).otherwise(found)
    return found


def price_bucket(c) -> Column:
    index = price_bucket_index(c)
    label = F.lit(None).cast("string")
    for i, name in enumerate(PRICE_LABELS):
        label = F.when(index == i, F.lit(name)).otherwise(label)
    return label


def bin_index(c, lo, hi, bins: int) -> Column:
    """Equal-width bin from ``lo`` to ``hi``, the last one closed.

    When all values are equal the range is widened by one half on either side.
    """
    c, flat = as_col(c), lo == hi
    low = F.when(flat, lo - 0.5).otherwise(lo)
    span = F.when(flat, F.lit(1.0)).otherwise(hi - lo)
    return F.least(F.floor((c - low) * F.lit(float(bins)) / span), F.lit(bins - 1).cast("bigint")).cast("int")


def text_profile(title="title", category="category", brand="brand", description="description",
                 description_chars: int = 100) -> Column:
    def part(c):
        return F.coalesce(as_col(c), F.lit(""))

    space = F.lit(" ")
    return F.concat(part(title), space, part(category), space, part(brand), space,
                    F.substring(part(description), 1, description_chars))


def display(c, chars: int) -> Column:
    return F.substring(F.coalesce(as_col(c), F.lit("Unknown")), 1, chars)


def hash_place(keys, seed: int = 42, digits: int = 15) -> Column:
    """A seeded place below ``16 ** digits`` of a key, from MD5 so that any engine can draw the same order."""
    text = F.concat_ws("|", *[as_col(k) for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def holdout_bucket(keys, seed: int = 42) -> Column:
    """Bucket 0..9999 of a key, the same on any engine."""
    return F.pmod(hash_place(keys, seed, 8), F.lit(10000))

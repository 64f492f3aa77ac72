"""Checks and expectations over the rating and product tables.

Every check result is a row ``dataset, check, passed, detail``; the numbers
behind it come from the ``*_profile`` operators, which are one-row tables.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ratelake import schemas
from ratelake.functions import scalar as S
from ratelake.operators.quantiles import exact_quantiles

NULL_LIMIT_PCT = 30.0
SPARSE_ABOVE_PCT = 90.0
EMPTY_CATEGORY_SHARE = 0.5


def _one_row(df: DataFrame):
    """A one-row table as one struct column, for use in other expressions."""
    return df.select(F.struct(*df.columns).alias("v")).scalar()


def _present(df: DataFrame, column: str) -> str:
    """SQL test for a value; NaN counts as missing, as nulls do."""
    if dict(df.dtypes)[column] in ("double", "float"):
        return f"(`{column}` is not null and not isnan(`{column}`))"
    return f"(`{column}` is not null)"


def _pct(part, whole, digits):
    return S.half_even(F.try_divide(part * F.lit(100.0), whole), digits)


# -- profiles ---------------------------------------------------------------

def _null_measures(df: DataFrame) -> list:
    return [F.expr("count(1) as n")] + [
        F.expr(f"count_if({_present(df, c)}) as c{i}") for i, c in enumerate(df.columns)]


def _null_rows(df: DataFrame) -> str:
    """SQL list of ``column, null_count, null_pct`` over the ``_null_measures``."""
    pct = "rint(try_divide((n - c{i}) * 100.0D, n) * 100.0D) / 100.0D"
    rows = (f"struct('{c}' as column, n - c{i} as null_count, {pct.format(i=i)} as null_pct)"
            for i, c in enumerate(df.columns))
    return f"array({', '.join(rows)})"


def null_profile(df: DataFrame) -> DataFrame:
    """``column, null_count, null_pct`` of every column, in one pass."""
    return df.agg(*_null_measures(df)).selectExpr(f"inline({_null_rows(df)})")


def total_nulls(df: DataFrame) -> DataFrame:
    return null_profile(df).agg(F.sum("null_count").alias("nulls_left"))


def duplicate_count(df: DataFrame, subset=None) -> DataFrame:
    """Rows beyond the first of each group of equal rows; nulls are equal to each other."""
    return (df.groupBy(*(subset or df.columns)).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates")))


def _range_measures() -> list:
    return [F.expr(f"count_if(not coalesce(rating between {S.RATING_MIN}D and {S.RATING_MAX}D, false)) "
                   "as n_out_of_range")]


def rating_range_profile(ratings: DataFrame) -> DataFrame:
    """Rows whose rating is missing or outside the scale."""
    return ratings.agg(*_range_measures())


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and share (1 dp) of each non-null value; the total is that of the counts, not a window."""
    counts = (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n")))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", _pct(F.col("n"), total, 1))


def _timestamp_measures() -> list:
    ts = "try_cast(timestamp as bigint)"
    return [F.expr(f"count_if({ts} is null) as n_no_time"),
            F.expr(f"count_if({ts} not between {S.TIMESTAMP_MIN} and {S.TIMESTAMP_MAX}) as n_out_of_window"),
            F.expr(f"date_from_unix_date(cast(floor(min({ts}) / 86400) as int)) as min_date"),
            F.expr(f"date_from_unix_date(cast(floor(max({ts}) / 86400) as int)) as max_date")]


def timestamp_profile(ratings: DataFrame) -> DataFrame:
    return ratings.agg(*_timestamp_measures()).withColumnRenamed("n_no_time", "n_null")


def price_profile(products: DataFrame) -> DataFrame:
    price = S.to_number("price")
    marks = _one_row(exact_quantiles(products.select(price.alias("price")), "price",
                                     {"p50": 0.5, "p95": 0.95}))
    table = products.select(price.alias("price"), marks.alias("marks"))
    return table.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("price").isNull(), 1)).alias("n_null"),
        F.count(F.when(F.col("price") < 0, 1)).alias("n_negative"),
        F.count(F.when(F.col("price") == 0, 1)).alias("n_zero"),
        F.count(F.when(F.col("price") > F.col("marks.p95") * 3, 1)).alias("n_outliers"),
        S.half_even(F.max("marks.p50"), 2).alias("p50"),
        S.half_even(F.max("marks.p95"), 2).alias("p95"))


def key_profile(ratings: DataFrame) -> DataFrame:
    """Rows, distinct rows, distinct pairs, users and items of the log in one scan.

    Equal rows are counted first, then pairs, so each step shrinks in the map tasks.
    """
    rows = ratings.groupBy("userId", "productId", "rating", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    pairs = rows.groupBy("userId", "productId").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("n_distinct_rows"),
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_distinct("userId").alias("n_users"), F.count_distinct("productId").alias("n_items"),
        F.coalesce(F.sum(F.when(F.col("userId").isNotNull(), F.col("n"))), F.lit(0)).alias("n_user_rows"),
        F.coalesce(F.sum(F.when(F.col("productId").isNotNull(), F.col("n"))), F.lit(0)).alias("n_item_rows"))


def sparsity_of(keys: DataFrame, keep: bool = False) -> DataFrame:
    """Sparsity (%) and mean rows per user and item, from a ``key_profile``; null when empty."""
    cells = F.col("n_users").cast("double") * F.col("n_items")
    kept = ["n_rows", "n_distinct_rows", "n_pairs"] if keep else []
    return keys.select(
        *kept, "n_users", "n_items", F.col("n_rows").alias("n_ratings"),
        S.half_even((1 - F.try_divide(F.col("n_rows"), cells)) * 100, 4).alias("sparsity_pct"),
        S.half_even(F.try_divide("n_user_rows", "n_users"), 1).alias("ratings_per_user"),
        S.half_even(F.try_divide("n_item_rows", "n_items"), 1).alias("ratings_per_item"))


def sparsity_profile(ratings: DataFrame) -> DataFrame:
    return sparsity_of(key_profile(ratings))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), column).limit(n))


def category_profile(products: DataFrame) -> DataFrame:
    """Distinct categories and empty or missing ones, from one table of category counts."""
    counts = products.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    empty = F.col("category").isNull() | (F.col("category") == "")
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("category").alias("n_categories"),
        F.coalesce(F.sum(F.when(empty, F.col("n"))), F.lit(0)).alias("n_empty")).withColumn(
        "pct_empty", _pct(F.col("n_empty"), F.col("n_rows"), 1))


# -- checks -----------------------------------------------------------------

def _results(one_row: DataFrame, dataset: str, checks) -> DataFrame:
    """One row per check, given as name, SQL test and SQL text over the columns of ``one_row``."""
    rows = ", ".join(f"struct({_text(dataset)} as dataset, {_text(name)} as check, "
                     f"coalesce({passed}, false) as passed, {detail} as detail)"
                     for name, passed, detail in checks)
    return one_row.selectExpr(f"inline(array({rows}))")


def _text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _schema_check(df, expected):
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    return ("schema", "true" if not missing else "false",
            _text(f"absent={missing}; extra={extra}"))


def _missing_check(df):
    nulls = _null_rows(df)
    shown = (f"array_join(transform(filter({nulls}, r -> r.null_count > 0), r -> "
             "format_string('%s null_count=%d null_pct=%.2f', r.column, r.null_count, r.null_pct)), '; ')")
    return ("missing_values", f"array_max(transform({nulls}, r -> r.null_pct)) < {NULL_LIMIT_PCT}D",
            f"coalesce(nullif({shown}, ''), 'null_count=0')")


def _duplicate_check(name, n):
    return name, f"{n} = 0", f"format_string('n_duplicates=%d', {n})"


def schema_check(df: DataFrame, expected, dataset: str) -> DataFrame:
    name, passed, detail = _schema_check(df, expected)
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return _results(rows, dataset, [(name, passed, f"concat({detail}, '; n_rows=', n_rows)")])


# Whole parts of the ratings that the range check counts; any others are out of range.
_FLOORS = (1, 2, 3, 4, 5)


def check_ratings(ratings: DataFrame, expectations=()) -> DataFrame:
    """The seven checks of a ratings table: one scan for row facts, one for keys.

    ``expectations`` are measured in the same scan and added as further checks.
    """
    found = _Measured(ratings, expectations)
    rows = ratings.agg(*_null_measures(ratings), *_range_measures(), *_timestamp_measures(), *found.measures, *[
        F.count(F.when(F.floor("rating") == k, 1)).alias(f"floor_{k}") for k in _FLOORS])
    keys = sparsity_of(key_profile(ratings), keep=True)
    return _results(rows, "ratings", [
        _schema_check(ratings, schemas.RATINGS.names),
        _missing_check(ratings),
        ("rating_range", "n_out_of_range = 0", "concat(format_string('n_out_of_range=%d; rows_by_floor=', n_out_of_range), "
         f"concat_ws(',', {', '.join(f'floor_{k}' for k in _FLOORS)}))"),
        ("timestamp_validity", "n_no_time = 0 and n_out_of_window = 0",
         "format_string('min_date=%s; max_date=%s; n_no_time=%d; n_out_of_window=%d', cast(min_date as string), "
         "cast(max_date as string), n_no_time, n_out_of_window)"),
        *found.checks,
    ]).unionByName(_results(keys, "ratings", [
        _duplicate_check("duplicate_rows", "(n_rows - n_distinct_rows)"),
        _duplicate_check("duplicate_userId+productId", "(n_rows - n_pairs)"),
        ("sparsity", f"sparsity_pct > {SPARSE_ABOVE_PCT}D",
         "format_string('n_users=%d; n_items=%d; n_ratings=%d; sparsity_pct=%.2f; "
         "ratings_per_user=%.1f; ratings_per_item=%.1f', n_users, n_items, n_ratings, sparsity_pct, "
         "ratings_per_user, ratings_per_item)"),
    ]))


def check_products(products: DataFrame, expectations=()) -> DataFrame:
    """The five checks of a product table, and ``expectations`` in the same scans."""
    found = _Measured(products, expectations)
    rows = products.agg(*_null_measures(products), *found.measures)
    # One count per product serves the duplicate check and the uniqueness of the key.
    unique_id = [e for e in found.unique if e.column == "productId"]
    ids = products.groupBy("productId").agg(F.expr("count(1) as c")).agg(
        F.expr("coalesce(sum(c - 1), 0) as n_duplicates"),
        F.expr("coalesce(max(case when productId is not null then c end), 1) as most"))
    top = top_values(products, "category", 5).agg(F.collect_list(F.struct("category", "n")).alias("v"))
    out = _results(rows, "products", [
        _schema_check(products, schemas.PRODUCTS.names), _missing_check(products), *found.checks,
    ]).unionByName(_results(ids, "products", [
        _duplicate_check("duplicate_productId", "n_duplicates"),
        *((e.name, "most <= 1", "'expectation'") for e in unique_id),
    ])).unionByName(_results(price_profile(products), "products", [
        ("price_range", "n_negative = 0",
         "format_string('n_null=%d; null_pct=%.1f; n_negative=%d; n_zero=%d; n_outliers=%d; p50=%.2f; "
         "p95=%.2f', n_null, 100D * try_divide(n_null, n_rows), n_negative, n_zero, n_outliers, p50, p95)"),
    ])).unionByName(_results(category_profile(products).withColumn("top", top.scalar()), "products", [
        ("category_coverage", f"try_divide(n_empty, n_rows) < {EMPTY_CATEGORY_SHARE}D",
         "concat(format_string('n_categories=%d; n_empty=%d; pct_empty=%.1f; top=', n_categories, n_empty, "
         "pct_empty), array_join(transform(top, r -> format_string('%s=%d', r.category, r.n)), ', '))"),
    ]))
    others = [e for e in found.unique if e.column != "productId"]
    if others:
        out = out.unionByName(expect(products, others, "products").select(
            "dataset", F.col("expectation").alias("check"), "passed", F.lit("expectation").alias("detail")))
    return out


def check_all(ratings: DataFrame, products: DataFrame, rating_expectations=(), product_expectations=()) -> DataFrame:
    return check_ratings(ratings, rating_expectations).unionByName(
        check_products(products, product_expectations))


def passed_of_total(results: DataFrame) -> DataFrame:
    return results.groupBy("dataset").agg(
        F.count_if("passed").alias("n_passed"), F.count(F.lit(1)).alias("n_checks"))


def summary_rows(results: DataFrame) -> DataFrame:
    """Results as they are stored: ``detail`` cut to 200 characters."""
    return results.withColumn("detail", F.substring("detail", 1, 200))


# -- expectations -----------------------------------------------------------

@dataclass(frozen=True)
class Expectation:
    name: str
    kind: str                 # exists, not_null, between, rows_between, matches or unique
    column: str | None = None
    low: float | None = None
    high: float | None = None
    pattern: str | None = None
    mostly: float = 1.0


def label(kind: str, column: str | None = None, *bounds) -> str:
    """The name of an expectation, made of its kind, column and bounds."""
    return ":".join([kind, *([column] if column else []), *(["..".join(f"{b:.0f}" for b in bounds)] if bounds else [])])


def _named(kind, column=None, low=None, high=None, **more) -> Expectation:
    bounds = () if low is None else (low, high)
    return Expectation(label(kind, column, *bounds), kind, column, low, high, **more)


def rating_expectations(low_rows=10_000, high_rows=10_000_000) -> tuple:
    """Expectations of a rating table; the bounds on its rows depend on its scale."""
    return (*(_named("exists", c) for c in schemas.RATINGS.names),
            *(_named("not_null", c) for c in ("userId", "productId", "rating")),
            _named("between", "rating", 1.0, 5.0), _named("rows_between", None, low_rows, high_rows),
            _named("matches", "userId", pattern="^[A-Z0-9]+$"))


def product_expectations(low_rows=1_000, high_rows=5_000_000) -> tuple:
    return (*(_named("exists", c) for c in ("productId", "title", "price")), _named("not_null", "productId"),
            _named("unique", "productId"), _named("not_null", "title"),
            _named("between", "price", 0.0, 10000.0, mostly=0.9), _named("rows_between", None, low_rows, high_rows))


RATING_EXPECTATIONS = rating_expectations()
PRODUCT_EXPECTATIONS = product_expectations()


class _Measured:
    """SQL measures of row-level expectations and the tests over them; ``unique`` ones are set apart."""

    def __init__(self, df: DataFrame, expectations):
        self.measures, self.verdicts, self.unique = [], [], []
        for i, e in enumerate(expectations):
            if e.kind == "exists":
                passed = "true" if e.column in df.columns else "false"
            elif e.kind == "rows_between":
                passed = f"n between {e.low} and {e.high}"
            elif e.column not in df.columns:
                passed = "false"
            elif e.kind == "unique":
                self.unique.append(e)
                continue
            else:
                present = _present(df, e.column)
                good = {"not_null": present,
                        "between": f"{present} and try_cast(`{e.column}` as double) between {e.low}D and {e.high}D",
                        "matches": f"{present} and `{e.column}` rlike {_text(e.pattern)}"}[e.kind]
                base = "count(1)" if e.kind == "not_null" else f"count_if({present})"
                self.measures += [F.expr(f"{base} as n{i}"), F.expr(f"count_if({good}) as ok{i}")]
                passed = f"coalesce(try_divide(ok{i}, n{i}) >= {float(e.mostly)}D, true)"
            self.verdicts.append((e.name, passed))

    @property
    def checks(self) -> list:
        return [(name, passed, "'expectation'") for name, passed in self.verdicts]


def expect(df: DataFrame, expectations, dataset: str) -> DataFrame:
    """``dataset, expectation, passed``, matched by name.

    All row-level expectations share one scan; each ``unique`` adds one
    aggregation on its column.  A missing column fails its expectations.
    """
    def rows(one_row, checks):
        return _results(one_row, dataset, checks).select(
            "dataset", F.col("check").alias("expectation"), "passed")

    found = _Measured(df, expectations)
    parts = [rows(df.agg(F.expr("count(1) as n"), *found.measures), found.checks)] if found.verdicts else []
    for e in found.unique:
        repeats = (df.where(_present(df, e.column)).groupBy(e.column).agg(F.expr("count(1) as c"))
                   .agg(F.expr("coalesce(max(c), 1) as most")))
        parts.append(rows(repeats, [(e.name, "most <= 1", "'expectation'")]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

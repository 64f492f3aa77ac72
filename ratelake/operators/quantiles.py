"""Exact quantiles and exact dense ranks without one task holding everything.

Quantiles go down digit by digit: rows are counted by the leading digits of their value, and
only the cells that hold a wanted rank are looked into again, until a cell is small enough to be sorted.  Dense
ranks are counted range by range.  A narrow range, a wide one or infinite values make
no difference, and copies of a value weigh one row however many there are.
"""

import math

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ratelake.functions.scalar import as_col
from ratelake.session import stage

#: Leading cells for each factor of two; at most some 70,000 cells for all finite numbers.
CELLS = 16
#: Cells that a range is cut into from the second level on, and rows of a cell that need no further level.
PARTS, SORTED_ROWS = 1024, 50_000


def leading_cell(v: Column) -> Column:
    """A whole number that never falls when ``v`` grows: sign, exponent and the first bits behind it."""
    size = F.least(F.log2(F.abs(v)) + 1100, F.lit(3000.0))
    return F.floor(F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0.0)) * CELLS).cast("int")


def _rows(df: DataFrame, value, keys, weight) -> DataFrame:
    rows = df.select(*keys, as_col(value).cast("double").alias("_value"), (F.lit(1) if weight is None else as_col(weight)).cast("long").alias("_w"))
    return rows.where(~F.isnan("_value")).dropna(subset=[*keys, "_value"])


def _counted(rows: DataFrame, *by) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("_w").alias("_n"), F.min("_value").alias("_least"), F.max("_value").alias("_most"))


def leading_cells(df: DataFrame, value, keys=(), weight=None) -> DataFrame:
    """``keys, _cell, _n, _least, _most``: rows of each leading cell; sums over some keys are the cells of the rest."""
    rows = _rows(df, value, keys, weight)
    return _counted(rows, *keys, leading_cell(F.col("_value")).alias("_cell"))


def _ends(probabilities: dict) -> list:
    """SQL of the ranks that the quantiles lie at or between, from the number of rows."""
    return [f"{end}({float(p)!r}D * (_total - 1))" for p in probabilities.values() for end in ("floor", "ceil")]


def _here(rank: str) -> str:
    return f"({rank} >= _start AND {rank} < _start + _n)"


def _wanted(cells: DataFrame, keys, probabilities: dict, group=()) -> DataFrame:
    """The cells that hold a wanted rank: where they start, and whether a rank lies inside that their ends don't tell."""
    within = Window.partitionBy(*keys, *group)
    upto = F.sum("_n").over(within.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    base = F.col("_base") if group else F.lit(0)
    total = F.col("_total") if group else F.sum("_n").over(within)
    placed = cells.withColumns({"_total": total, "_start": base + upto - F.col("_n")})
    ranks = _ends(probabilities)
    held = " OR ".join(map(_here, ranks))
    inside = " OR ".join(f"({_here(r)} AND {r} != _start AND {r} != _start + _n - 1)" for r in ranks)
    return placed.where(held).select(*keys, "_total", "_start", "_n", "_least", "_most",
                                     F.expr(f"({inside}) AND _least != _most").alias("_open"))


def _settled(wanted: DataFrame, keys) -> tuple:
    """The wanted cells worked out once, and how many open ones hold more and at most ``SORTED_ROWS`` rows."""
    large = F.col("_n") > SORTED_ROWS
    if keys:
        seen = Observation()
        kept = stage(wanted.observe(seen, F.count_if(F.col("_open") & large).alias("large"),
                                    F.count_if(F.col("_open") & ~large).alias("small")), "wanted")
        return kept, seen.get["large"], seen.get["small"]
    rows = wanted.collect()         # two cells for each probability at most
    if not rows:
        return wanted.where(F.lit(False)), 0, 0
    cells = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in wanted.schema.fields]) for r in rows])
    n_large = sum(r["_open"] and r["_n"] > SORTED_ROWS for r in rows)
    return wanted.sparkSession.range(1).select(F.inline(cells)), n_large, sum(r["_open"] for r in rows) - n_large


def _rows_inside(rows: DataFrame, ranges: DataFrame, keys) -> DataFrame:
    """The rows whose value lies in one of the ranges of their keys, with that range."""
    ranges = ranges.select(*keys, F.col("_start").alias("_base"), "_total", F.col("_least").alias("_from"), F.col("_most").alias("_to"))
    if keys:
        # A key has two ranges for each probability at most.
        return rows.join(ranges, list(keys)).where(F.col("_value").between(F.col("_from"), F.col("_to")))
    lists = ranges.agg(F.collect_list(F.struct(*ranges.columns))).scalar()
    hit = F.filter("_ranges", lambda r: (F.col("_value") >= r["_from"]) & (F.col("_value") <= r["_to"]))
    near = rows.withColumn("_ranges", lists).withColumn("_r", F.get(hit, 0))
    return near.where(F.col("_r").isNotNull()).select("_value", "_w", "_r.*")


def exact_quantiles(df: DataFrame, value, probabilities: dict, keys=(), weight=None, cells: DataFrame | None = None) -> DataFrame:
    """``keys`` and one column per named probability, linearly interpolated; null keys form no group.

    Rows are counted by leading cells, or ``cells`` gives those counts.  Only the cells with a wanted rank are read again, in
    finer parts, as long as one holds more than ``SORTED_ROWS`` rows; the values of what is left are ranked one by one,
    cell by cell.  Each level tells 1,024 parts apart, so six do for any numbers.  ``weight`` counts a row so many times.
    """
    keys = list(keys)
    rows = _rows(df, value, keys, weight)
    if cells is None:
        cells = _counted(rows, *keys, leading_cell(F.col("_value")).alias("_cell"))
    wanted, found, to_sort = _wanted(cells, keys, probabilities), None, 0
    large = F.col("_open") & (F.col("_n") > SORTED_ROWS)
    while True:
        wanted, n_large, n_small = _settled(wanted, keys)
        to_sort += n_small
        known = wanted.where(~large)
        found = known if found is None else found.unionByName(known)
        if not n_large:
            break
        inside = _rows_inside(rows, wanted.where(large), keys)
        width = F.col("_to") - F.col("_from")
        part = F.floor((F.col("_value") - F.col("_from")) / width * PARTS).cast("int")
        finer = _counted(inside, *keys, "_base", "_total", part.alias("_cell"))
        wanted = _wanted(finer, keys, probabilities, ["_base"])
    # Values of the small cells, one by one.
    if to_sort:
        values = _counted(_rows_inside(rows, found.where("_open"), keys), *keys, "_base", "_total", F.col("_value").alias("_cell"))
        found = found.where(~F.col("_open")).unionByName(_wanted(values, keys, probabilities, ["_base"]))

    out = found.groupBy(*keys).agg(F.max("_total").alias("_total"), *[
        F.expr(f"max(CASE WHEN {_here(rank)} THEN CASE WHEN {rank} = _start THEN _least ELSE _most END END)").alias(f"_at{i}")
        for i, rank in enumerate(_ends(probabilities))])
    shares = []
    for i, (name, p) in enumerate(probabilities.items()):
        position, lo, hi = f"({float(p)!r}D * (_total - 1))", f"_at{2 * i}", f"_at{2 * i + 1}"
        share = f"({position} - floor({position}))"
        # Between equal values, and at a value itself, nothing is computed: an infinite value stays as it is.
        shares.append(F.expr(f"CASE WHEN {share} = 0 OR {lo} = {hi} THEN {lo} ELSE {lo} + ({hi} - {lo}) * {share} END").alias(name))
    return out.select(*keys, *shares)


def dense_index(values: DataFrame, column: str, index: str = "index", cell_rows: int = 100_000,
                group_cells: int = 1000) -> DataFrame:
    """Position of each value in the sorted order of distinct ``values`` (from 0); null comes first.

    Values are written in ranges of about ``cell_rows``, however many there are, and ranked range by range.  Where a
    range starts is added up in two steps, over ``group_cells`` ranges and over the groups.  Positions do not depend on
    where the ranges are cut.
    """
    values = stage(values.select(column), "values")
    cells = max(1, math.ceil(values.count() / cell_rows))
    # Written, so that a range keeps its number when a task runs again.
    placed = stage(values.repartitionByRange(cells, column).withColumn("cell", F.spark_partition_id()), "ranges")
    counts = (placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("group", F.floor(F.col("cell") / group_cells)))
    until = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("group").agg(F.sum("n").alias("n"))
    groups = totals.select("group", F.coalesce(F.sum("n").over(until.orderBy("group")), F.lit(0)).alias("before_group"))
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(
        until.partitionBy("group").orderBy("cell")), F.lit(0))).join(groups, "group").select(
        "cell", (F.col("before") + F.col("before_group")).alias("before"))
    local = F.row_number().over(Window.partitionBy("cell").orderBy(column))
    return placed.withColumn("local", local).join(offsets, "cell").select(
        column, (F.col("before") + F.col("local") - 1).cast("bigint").alias(index))

"""Statistical profiling: z-score and IQR outliers, cardinality, freshness.

Global statistics are one-row aggregates used as scalar subqueries: Spark
computes each once and inlines the value into the row filter, so the table is
never cross-joined and no window runs without a partition.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import to_number
from ._common import keys_of, require, written
from .consistency import as_of_ts, lenient_timestamp


def _numbers(df: DataFrame, keys, column: str) -> DataFrame:
    """Keys and ``value`` of the rows whose column is a number (NaN is none)."""
    return df.select(*keys, to_number(column).alias("value")).filter(F.col("value").isNotNull() & ~F.isnan("value"))


def zscore_outliers(df: DataFrame, key_cols, column: str, threshold: float = 3.0) -> DataFrame:
    """Rows with |z| > threshold, sample std (ddof=1); fewer than 3 numeric
    values or zero spread → no outliers.  Columns: keys, value, zscore (3 dp)."""
    require(df, column)
    num = _numbers(df, keys_of(key_cols), column)
    stats = num.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mu"), F.stddev_samp("value").alias("sd"))).scalar()
    z = F.try_divide(F.col("value") - stats["mu"], stats["sd"])  # null, never an error, when sd = 0
    ok = (stats["n"] >= 3) & (stats["sd"] != 0)
    return num.filter(ok & (F.abs(z) > F.lit(float(threshold)))).select(*keys_of(key_cols), "value", F.round(z, 3).alias("zscore"))


def order_statistics(values: DataFrame, places: Sequence[float]) -> tuple[int, list[float | None]]:
    """(n, values at the given shares of the way from the least to the greatest) of the column ``value``, exactly and with
    linear interpolation, as pandas gives them.

    Rows are reduced to counts per value, so a value that many rows hold is one row a task.  The counts are dealt by
    range of value and written; the driver sees one total per range, finds the ranges that hold the wanted ranks, and
    only those are sorted.  No task holds more than one range of the distinct values.
    """
    # +0.0: -0.0 and 0.0 are one value
    counts = values.select((F.col("value") + F.lit(0.0)).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("rows"))
    counts = written(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "value-counts")
    totals = counts.groupBy("part").agg(F.sum("rows").alias("rows"), F.min("value").alias("first")).orderBy("first").collect()
    n = sum(t.rows for t in totals)
    if not n:
        return 0, [None for _ in places]
    at = [share * (n - 1) for share in places]
    ranks = sorted({int(x) for x in at} | {min(int(x) + 1, n - 1) for x in at})
    before, wanted = 0, []  # (range, ranks within it)
    for t in totals:
        inside = [r - before for r in ranks if before <= r < before + t.rows]
        wanted += [(t.part, inside, before)] if inside else []
        before += t.rows
    found = {}
    running = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = counts.where(F.col("part").isin([p for p, _, _ in wanted])).withColumn("upto", F.sum("rows").over(running))
    hits = [((F.col("part") == p) & (F.col("upto") > r) & (F.col("upto") - F.col("rows") <= r), p, r) for p, inside, _ in wanted for r in inside]
    condition = hits[0][0]
    for hit, _, _ in hits[1:]:
        condition = condition | hit
    start = {p: before for p, _, before in wanted}
    for row in sums.where(condition).collect():  # at most one row a rank
        for _, p, r in hits:
            if row.part == p and row.upto - row.rows <= r < row.upto:
                found[start[p] + r] = row.value
    out = []
    for x in at:
        low, share = found[int(x)], x - int(x)
        out.append(low if share == 0 else low + (found[int(x) + 1] - low) * share)
    return n, out


def iqr_fences(df: DataFrame, column: str, multiplier: float = 1.5, approx: bool = False, accuracy: int = 100000):
    """(n, lower fence, upper fence) as a struct column.

    Over the numbers of the column (text that is no number, nulls and NaN are left out).  Exact quartiles come from
    ``order_statistics``, whose jobs run at once; with ``approx`` from ``percentile_approx``, as a scalar subquery, in one
    pass and with memory bounded by ``accuracy``.
    """
    k = F.lit(float(multiplier))
    values = _numbers(df, [], column)
    if not approx:
        n, (low, high) = order_statistics(values, [0.25, 0.75])
        iqr = (high - low) * float(multiplier) if n else None
        fence = lambda x, by: F.lit(x + by if n else None).cast("double")
        return F.struct(F.lit(n).cast("bigint").alias("n"), fence(low, -iqr if n else 0).alias("lo"), fence(high, iqr).alias("hi"))
    stats = values.agg(F.count("value").alias("n"), F.percentile_approx("value", [0.25, 0.75], accuracy).cast("array<double>").alias("q"))
    iqr = F.col("q")[1] - F.col("q")[0]
    return stats.select(
        F.struct(F.col("n").alias("n"), (F.col("q")[0] - k * iqr).alias("lo"), (F.col("q")[1] + k * iqr).alias("hi"))
    ).scalar()


def iqr_bounds(df: DataFrame, key_cols, column: str, multiplier: float = 1.5, approx: bool = False) -> DataFrame:
    """Rows strictly outside [Q1 - k·IQR, Q3 + k·IQR]; fewer than 4 values → none.
    Columns: keys, value, lower_fence, upper_fence (4 dp)."""
    require(df, column)
    f = iqr_fences(df, column, multiplier, approx)
    num = _numbers(df, keys_of(key_cols), column)
    return num.filter((f["n"] >= 4) & ((F.col("value") < f["lo"]) | (F.col("value") > f["hi"]))).select(
        *keys_of(key_cols), "value", F.round(f["lo"], 4).alias("lower_fence"), F.round(f["hi"], 4).alias("upper_fence")
    )


def cardinality(df: DataFrame, column: str, min_distinct=None, max_distinct=None, approx: bool = False) -> DataFrame:
    """One row: distinct_count (non-null), min/max, passed (inclusive)."""
    require(df, column)
    n = F.approx_count_distinct(column) if approx else F.countDistinct(column)
    out = df.agg(n.alias("distinct_count"))
    ok = F.lit(True)
    if min_distinct is not None:
        ok = ok & (F.col("distinct_count") >= min_distinct)
    if max_distinct is not None:
        ok = ok & (F.col("distinct_count") <= max_distinct)
    return out.select(
        F.lit(column).alias("column_name"),
        "distinct_count",
        F.lit(min_distinct).cast("bigint").alias("min_distinct"),
        F.lit(max_distinct).cast("bigint").alias("max_distinct"),
        ok.alias("passed"),
    )


def freshness(df: DataFrame, timestamp_column: str, max_lag_hours: float = 26.0, as_of=None) -> DataFrame:
    """One row: latest_ts, lag_hours (2 dp), passed; no parseable timestamp → fail."""
    require(df, timestamp_column)
    c = F.col(timestamp_column)
    parsed = c if dict(df.dtypes)[timestamp_column].startswith("timestamp") else lenient_timestamp(c)
    latest = df.agg(F.max(parsed).alias("latest_ts"))
    lag = (F.unix_micros(as_of_ts(as_of)) - F.unix_micros(F.col("latest_ts").cast("timestamp"))) / F.lit(3.6e9)
    return latest.select(
        "latest_ts",
        F.round(lag, 2).alias("lag_hours"),
        F.coalesce(lag <= F.lit(float(max_lag_hours)), F.lit(False)).alias("passed"),
    )

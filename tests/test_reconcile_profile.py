import numpy as np
import pandas as pd
import pytest

from tollgate.operators import profile as P
from tollgate.operators import reconcile as R

from .conftest import collect_set


def test_row_count_delta(spark, bronze_work_orders, silver):
    r = R.row_count_delta(bronze_work_orders, silver["work_orders"].promoted, 5.0).first()
    assert (r["source_rows"], r["target_rows"]) == (10, 8)
    assert r["drop_pct"] == 20.0 and not r["passed"]
    empty = spark.createDataFrame([], "x int")
    assert not R.row_count_delta(empty, bronze_work_orders).first()["passed"]
    gain = R.row_count_delta(silver["work_orders"].promoted, bronze_work_orders, 100.0).first()
    assert gain["gain_pct"] == 25.0 and not gain["passed"]


def test_no_new_pks_and_dropped_critical(spark, bronze_parts, silver):
    sp = silver["parts"].promoted
    assert R.no_new_pks(bronze_parts, sp, "part_id").count() == 0
    assert collect_set(R.no_new_pks(sp, bronze_parts, "part_id"), "pk_value") == {"P20", "P21", "P23"}
    dropped = collect_set(R.no_dropped_critical(bronze_parts, sp, "part_id", "is_critical", True), "pk_value")
    assert dropped == {"P20", "P23"}


def test_numeric_sum_match_edges(spark):
    z = spark.createDataFrame([(0.0,), ("x",)], "v string")
    assert R.numeric_sum_match(z, z, "v").first()["passed"]  # both zero, text ignored
    one = spark.createDataFrame([("10.0",)], "v string")
    r = R.numeric_sum_match(z, one, "v").first()
    assert r["diff_pct"] is None and not r["passed"]  # zero source, non-zero target
    near = spark.createDataFrame([("10.0005",)], "v string")
    assert R.numeric_sum_match(one, near, "v", tolerance_pct=0.01).first()["passed"]


def test_zscore_matches_pandas(spark):
    vals = [1.0, 2.0, 2.5, 3.0, 2.2, 1.9, 2.1, 40.0, 2.4, 2.0, 1.8, 2.6]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, v double")
    s = pd.Series(vals)
    z = (s - s.mean()) / s.std()
    want = set(np.flatnonzero((z.abs() > 2.5).values))
    assert collect_set(P.zscore_outliers(df, "k", "v", 2.5), "k") == want
    assert P.zscore_outliers(df.limit(2), "k", "v").count() == 0
    flat = spark.createDataFrame([(i, 1.0) for i in range(5)], "k int, v double")
    assert P.zscore_outliers(flat, "k", "v").count() == 0


def test_iqr_matches_pandas_linear_quartiles(spark):
    vals = [21, 30, 45, 60, 14, 90, 120, 7, 35, 28, 400]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "k int, v double")
    s = pd.Series(vals, dtype=float)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    got = P.iqr_bounds(df, "k", "v").collect()
    assert {r["k"] for r in got} == set(np.flatnonzero(((s < lo) | (s > hi)).values))
    assert got[0]["lower_fence"] == round(lo, 4) and got[0]["upper_fence"] == round(hi, 4)
    assert P.iqr_bounds(df.limit(3), "k", "v").count() == 0


def test_cardinality_and_freshness(spark, bronze_suppliers):
    r = P.cardinality(bronze_suppliers, "country", 2, 6).first()
    assert r["distinct_count"] == 7 and not r["passed"]
    ts = spark.createDataFrame([("2024-01-31 12:00:00",), ("garbage",)], "t string")
    f = P.freshness(ts, "t", 26.0, as_of="2024-02-01 00:00:00").first()
    assert f["lag_hours"] == 12.0 and f["passed"]
    bad = spark.createDataFrame([("garbage",)], "t string")
    assert not P.freshness(bad, "t", as_of="2024-02-01 00:00:00").first()["passed"]


def test_statistics_leave_nan_and_text_out(spark):
    import numpy as np

    numbers = np.random.default_rng(7).normal(size=3000).round(2).tolist() + [50.0]
    rows = [(i, str(v)) for i, v in enumerate(numbers)] + [(10_000 + i, "NaN") for i in range(1500)] + [(20_000, "text"), (20_001, None)]
    df = spark.createDataFrame(rows, "k int, v string")
    q1, q3 = np.percentile(numbers, [25, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    got = P.iqr_bounds(df, "k", "v").collect()
    assert {r["k"] for r in got} == {i for i, v in enumerate(numbers) if v < lo or v > hi}
    assert {r["lower_fence"] for r in got} == {round(lo, 4)}
    z = (np.array(numbers) - np.mean(numbers)) / np.std(numbers, ddof=1)
    assert {r["k"] for r in P.zscore_outliers(df, "k", "v").collect()} == set(np.flatnonzero(np.abs(z) > 3).tolist())


def test_empty_and_zero_inputs_do_not_raise_under_ansi(spark):
    from tollgate.operators import reports as RP

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    empty = spark.createDataFrame([], "supplier_id string, supplier_name string, email string, country string, "
                                      "contract_start_date string, quality_rating string")
    rows = RP.null_profile_suppliers(empty).collect()
    assert all(r["null_rate_pct"] is None and r["dq_status"] == "PASS" for r in rows)
    flat = spark.createDataFrame([(i, 2.0) for i in range(6)], "k int, v double")
    assert P.zscore_outliers(flat, "k", "v").count() == 0


def test_order_statistics_equal_numpy(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from tollgate.operators import profile as P

    rng = np.random.default_rng(2)
    places = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for x in (rng.standard_normal(5001), np.r_[np.full(4000, 7.0), rng.random(2000)], np.array([3.0]), np.array([0.0, -0.0, 1.0, 1.0]), np.arange(8.0)):
        df = spark.createDataFrame([(float(v),) for v in x], "value double").repartition(4)
        n, got = P.order_statistics(df, places)
        assert n == len(x) and np.allclose(got, np.quantile(x, places), rtol=1e-12, atol=1e-12)
    empty = spark.createDataFrame([], "value double")
    assert P.order_statistics(empty, places) == (0, [None] * 6)
    assert P.iqr_bounds(empty.withColumn("k", F.lit(1)), "k", "value").collect() == []
    odd = spark.createDataFrame([(str(i), v) for i, v in enumerate(["1", "2", "3", "4", "999", "nan", "x", None])], "k string, v string")
    assert [r.k for r in P.iqr_bounds(odd, "k", "v").collect()] == ["4"]


def test_quartiles_sort_only_the_ranges_that_hold_them(spark):
    from pyspark.sql import functions as F

    from tollgate.operators import profile as P

    df = spark.range(200_000).select((F.xxhash64("id") % 1_000_003).cast("double").alias("value"))
    seen = []
    collect = type(df).collect

    def spy(self):
        rows = collect(self)
        seen.append((self.columns, len(rows)))
        return rows

    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(df), "collect", spy)
        n, (low, high) = P.order_statistics(df, [0.25, 0.75])
    exact = df.agg(F.percentile("value", [0.25, 0.75])).first()[0]
    assert n == 200_000 and [low, high] == pytest.approx(exact)
    assert max(rows for _, rows in seen) <= int(spark.conf.get("spark.sql.shuffle.partitions"))  # totals of ranges, then four rows

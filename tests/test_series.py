"""Layout independence: halo windows, two-level row index and prefix sums
must equal the single-partition global window on the same rows."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from voltframe.operators import series


def _gappy(spark, n=300, seed=3):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows, h = [], 0
    for i in range(n):
        h += 1 + (rnd.random() < 0.2) * rnd.randint(1, 5)   # gaps
        rows.append((t0 + dt.timedelta(hours=h), float(rnd.randint(0, 400))))
    return spark.createDataFrame(rows, "ts timestamp_ntz, price double")


def _global(df, n):
    w = Window.orderBy("ts")
    return df.select("ts", *[F.lag("price", k).over(w).alias(f"lag_{k}") for k in range(1, n + 1)],
                     *[F.lead("price", k).over(w).alias(f"lead_{k}") for k in range(1, n + 1)])


def test_halo_equals_global_window(spark):
    df = _gappy(spark)
    n = 24
    build = series.combine(series.lags("price", range(1, n + 1), name="lag_{k}"),
                           series.leads("price", range(1, n + 1), name="lead_{k}"))
    expected = _global(df, n)
    for block in (24, 37, 100, 1000):
        got = series.ordered(df, build, reach=n, block_rows=block).select(expected.columns)
        assert got.exceptAll(expected).count() == 0
        assert expected.exceptAll(got).count() == 0


def test_row_index_matches_row_number(spark):
    df = _gappy(spark, 500)
    for width in (3600 * 5, 86400, 86400 * 30):
        got = series.add_row_index(df, "ts", idx="idx", block_width=width)
        exp = df.withColumn("idx", F.row_number().over(Window.orderBy("ts")) - 1)
        assert got.select("ts", "idx").exceptAll(exp.select("ts", F.col("idx").cast("long"))).count() == 0


def test_prefix_sums_match_running_sum(spark):
    df = _gappy(spark, 400)
    got = series.prefix_sums(df, ["price"], "ts", block=F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 7200))
    exp = df.withColumn("price_cum", F.sum("price").over(Window.orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)))
    assert got.select("ts", "price_cum").exceptAll(exp.select("ts", "price_cum")).count() == 0


def test_rolling_mean_needs_full_window(spark):
    rows = [(dt.datetime(2024, 1, 1, h), v) for h, v in enumerate([1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0])]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, price double")
    out = series.ordered(df, series.shifted_rolling_mean("price", 6, "m"), reach=6).orderBy("ts").collect()
    # Rows 6 and 7 see a NULL inside their previous 6 values -> NULL; row 8 sees 3..8
    assert [r["m"] for r in out][6:] == [None, None, 5.5]


def test_expanding_folds_test_starts(spark):
    df = spark.range(20).withColumnRenamed("id", "idx")
    f = series.expanding_folds(df, 20, 5).filter(F.col("role") == "test")
    starts = {r["fold"]: r["s"] for r in f.groupBy("fold").agg(F.min("idx").alias("s")).collect()}
    assert [starts[i] for i in range(5)] == [5, 8, 11, 14, 17]
    sizes = f.groupBy("fold").count().collect()
    assert {r["count"] for r in sizes} == {3}


def test_row_lag_differs_from_time_lag(spark):
    rows = [(dt.datetime(2024, 1, 1, h), float(h)) for h in (0, 1, 3, 4)]   # hour 2 missing (T1)
    df = spark.createDataFrame(rows, "ts timestamp_ntz, price double")
    by_row = series.ordered(df, series.lags("price", [1], name="lag1"), reach=1).orderBy("ts").collect()
    assert [r["lag1"] for r in by_row] == [None, 0.0, 1.0, 3.0]
    gaps = series.axis_gaps(df, "ts").collect()
    assert len(gaps) == 1 and gaps[0]["missing_steps"] == 1


def test_halo_window_is_partitioned_by_block(spark):
    df = _gappy(spark, 50)
    out = series.ordered(df, series.lags("price", [1, 2], name="lag_{k}"), reach=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the raw rows are shuffled by target block, never gathered in one partition
    assert "hashpartitioning(_tgt" in plan
    assert "hashpartitioning(_blk" in plan


def test_multi_series_equals_single_series(spark):
    """Metamorphic: a second series under another key must not change the first."""
    a = _gappy(spark, 120, seed=5).withColumn("sid", F.lit("a"))
    b = _gappy(spark, 90, seed=9).withColumn("sid", F.lit("b"))
    both = a.unionByName(b)
    build = series.combine(series.lags("price", [1, 3], name="lag_{k}"), series.leads("price", [2], name="lead_{k}"))
    multi = series.ordered(both, build, keys=["sid"], reach=3, block_rows=16).filter(F.col("sid") == "a")
    single = series.ordered(a, build, reach=3, block_rows=50)
    cols = ["ts", "price", "lag_1", "lag_3", "lead_2"]
    assert multi.select(cols).exceptAll(single.select(cols)).count() == 0
    assert single.select(cols).exceptAll(multi.select(cols)).count() == 0


def test_attach_totals_is_a_scalar_subquery(spark):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    tot = df.agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"))
    out = series.attach_totals(df, tot, [])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert {(r["s"], r["n"]) for r in out.collect()} == {(20, 5)}

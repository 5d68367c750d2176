"""Distributed exact PERCENTILE_CONT vs a brute-force computation, with one hot group."""
import numpy as np

from parcelkit.operators.percentile import grouped_percentile_cont


def test_percentile_matches_numpy_with_hot_group(spark):
    rng = np.random.default_rng(7)
    rows = [("hot", float(v)) for v in rng.integers(0, 1000, 3000)]
    rows += [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.normal(100, 30, 1200).round(2))]
    rows += [("single", 5.0), ("nulls", None), ("two", 1.0), ("two", 2.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(16)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        for p in (0.5, 0.25, 0.9):
            got = {r["k"]: r["q"] for r in grouped_percentile_cont(df, ["k"], "v", p, "q").collect()}
            groups = {}
            for k, v in rows:
                if v is not None:
                    groups.setdefault(k, []).append(v)
            assert set(got) == set(groups)
            for k, vals in groups.items():
                assert abs(got[k] - float(np.quantile(np.array(vals), p))) < 1e-9, (k, p)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_building_the_plan_starts_no_job_and_plans_no_sort_of_rows(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "cast(id as double) as v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    out = grouped_percentile_cont(df, ["k"], "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(tracker.getJobIdsForGroup("lazy")) == 0
    spark.sparkContext.setJobGroup("rest", "rest")
    assert "rangepartitioning" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_odd_values_and_null_groups(spark):
    rng = np.random.default_rng(3)
    inf = float("inf")
    groups = {None: [1.0, 4.0], "mixed": [-5.0, -0.0, 0.0, 5.0, 1e-300, -1e300], "inf": [-inf, 1.0, 2.0, inf, inf], "tiny": [1e-310 * i for i in range(9)],
              "same": [7.25] * 50, "wide": (10.0 ** rng.uniform(-200, 200, 301)).tolist(), "near": (1e6 + rng.random(500) * 1e-6).tolist(),
              "neg": (-np.exp(rng.normal(10, 3, 400))).tolist(), "cents": (rng.integers(0, 10 ** 8, 700) / 100).tolist()}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("none", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for p in (0.0, 0.1, 0.5, 0.999, 1.0):
        got = {r["k"]: r["q"] for r in grouped_percentile_cont(df, ["k"], "v", p, "q").collect()}
        assert set(got) == set(groups)
        for k, vs in groups.items():
            s, at = sorted(vs), p * (len(vs) - 1)
            lo, hi = s[int(np.floor(at))], s[int(np.ceil(at))]
            want = lo if lo == hi else lo + (hi - lo) * (at - np.floor(at)) if np.isfinite([lo, hi]).all() else None
            assert want is None or got[k] == want, (k, p)

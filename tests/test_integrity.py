"""Key enforcement and profiling operators."""
import os


from parcelkit.operators import integrity as I
from parcelkit.sources.tsv import tsv_scan


def test_drop_null_keys_and_quarantine(spark):
    df = spark.createDataFrame([("1", "a"), (None, "b"), ("2", None)], "acct string, v string")
    assert sorted(r[0] for r in I.drop_null_keys(df, ["acct"]).collect()) == ["1", "2"]
    assert I.null_key_rows(df, ["acct"]).count() == 1
    # a key column missing from the file drops every row
    assert I.drop_null_keys(df, ["acct", "bld_num"]).count() == 0


def test_dedupe_keep_first_by_order_columns(spark):
    df = spark.createDataFrame([("1", "b", "x"), ("1", None, "y"), ("1", "a", "z"), ("2", "c", "w")],
                               "acct string, v string, w string")
    got = {r["acct"]: (r["v"], r["w"]) for r in I.dedupe_keep_first(df, ["acct"], order_cols=["v", "w"]).collect()}
    assert got == {"1": (None, "y"), "2": ("c", "w")}


def test_dedupe_keep_first_in_file_order_across_splits(spark, tmpdir_path):
    """5,000 rows over 50 keys, file split into many tasks: the first row in the file wins."""
    path = os.path.join(tmpdir_path, "t.txt")
    with open(path, "w") as f:
        f.write("acct\tseq\n")
        for i in range(5000):
            f.write(f"{i % 50:05d}\t{i:06d}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = tsv_scan(spark, tmpdir_path, "t")
        assert df.rdd.getNumPartitions() > 5
        got = {r["acct"]: r["seq"] for r in I.dedupe_keep_first(df, ["acct"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"{k:05d}": f"{k:06d}" for k in range(50)}


def test_reject_orphans_keeps_null_keys(spark):
    parent = spark.createDataFrame([("1",), ("2",)], "acct string")
    child = spark.createDataFrame([("1", "a"), ("3", "b"), (None, "c"), ("2", "d"), ("3", "e")],
                                  "acct string, v string")
    kept = sorted(r["v"] for r in I.reject_orphans(child, parent).collect())
    orphans = sorted(r["v"] for r in I.orphan_rows(child, parent).collect())
    assert kept == ["a", "c", "d"] and orphans == ["b", "e"]
    assert len(kept) + len(orphans) == child.count()
    cov = I.fk_coverage(child, parent, child_name="c", parent_name="p").first()
    assert (cov["child_rows"], cov["null_key_rows"], cov["orphan_rows"], cov["distinct_orphan_keys"]) == (5, 1, 2, 1)


def test_fk_coverage_sorts_no_keys(spark):
    """Composite key, repeated and NULL parent keys, a parent too large to broadcast: hashed, neither side sorted."""
    parent = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", None), ("4", "d")], "p string, q string")
    child = spark.createDataFrame([("1", "a"), ("1", "b"), ("1", "b"), ("2", None), ("4", "d"), ("5", "e")], "x string, y string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cov = I.fk_coverage(child, parent, ("x", "y"), ("p", "q"), "c", "p")
        row = cov.first()
        plan = cov._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert tuple(row)[3:] == (6, 1, 3, 2)
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_key_profile(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("1", "b"), (None, "a")], "acct string, n string")
    r = I.key_profile(df, ["acct", "n"], "t").first()
    assert (r["row_count"], r["null_key_rows"], r["distinct_keys"], r["duplicate_rows"], r["is_unique"]) == \
           (4, 1, 2, 1, False)


def test_table_counts_and_length_report(spark):
    a = spark.createDataFrame([("1",), ("22",)], "x string")
    b = spark.createDataFrame([("333",)], "x string")
    assert {r[0]: r[1] for r in I.table_counts({"a": a, "b": b}).collect()} == {"a": 2, "b": 1}
    rep = I.length_overflow_report(a.unionByName(b), {"x": 2}, "ab").first()
    assert (rep["column_name"], rep["declared_size"], rep["max_length"], rep["over_length_rows"]) == ("x", 2, 3, 1)


def test_key_profile_approx(spark):
    df = spark.range(20000).selectExpr("cast(id % 5000 as string) as acct", "cast(id % 3 as string) as n")
    exact = I.key_profile(df, ["acct", "n"]).first()["distinct_keys"]
    approx = I.key_profile(df, ["acct", "n"], approx=True).first()["distinct_keys"]
    assert exact == 15000 and abs(approx - exact) / exact < 0.05


def test_plans_of_the_loader_operators(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t.txt")
    with open(path, "w") as f:
        f.write("acct\tseq\tv\n" + "".join(f"{i % 7}\t{i}\tx\n" for i in range(50)))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    kept = plan(I.dedupe_keep_first(tsv_scan(spark, tmpdir_path, "t"), ["acct"]))
    assert "SortAggregate" not in kept and "HashAggregate" in kept
    parent = spark.createDataFrame([("1",)], "acct string")
    child = tsv_scan(spark, tmpdir_path, "t")
    assert "coalesce(acct" not in plan(I.orphan_rows(child, parent)) and "isnull(acct" not in plan(I.orphan_rows(child, parent))


def test_orphans_of_keys_of_several_columns(spark):
    parent = spark.createDataFrame([("1", "a"), ("2", None)], "p string, q string")
    child = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", None, 3), (None, None, 4), ("2", "a", 5)], "x string, y string, n int")
    assert sorted(r.n for r in I.reject_orphans(child, parent, ("x", "y"), ("p", "q")).collect()) == [1, 3, 4]
    assert sorted(r.n for r in I.orphan_rows(child, parent, ("x", "y"), ("p", "q")).collect()) == [2, 5]


def test_keep_first_with_null_keys_and_a_hot_key(spark):
    rows = [(None, None, "a", 2), (None, None, "b", 1), ("k", None, "c", 5), ("k", None, "d", 4), ("x", "y", "e", 1)]
    rows += [("hot", "hot", f"{i:05d}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "p string, q string, v string, n int").repartition(7)
    got = {(r.p, r.q): r.v for r in I.dedupe_keep_first(df, ["p", "q"], order_cols=["n"]).collect()}
    assert got == {(None, None): "b", ("k", None): "d", ("x", "y"): "e", ("hot", "hot"): "00000"}


def test_keep_first_by_order_columns_is_one_pass(spark):
    df = spark.range(50).selectExpr("cast(id % 7 as string) as p", "cast(id as string) as v")
    plan = I.dedupe_keep_first(df, ["p"], order_cols=["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan and plan.count("Range (") == 1
    assert "WindowGroupLimit" in plan          # a task sends on one row of a key


def test_marked_rows_of_long_and_decimal_orders(spark, monkeypatch):
    from pyspark.sql import functions as F

    from parcelkit.operators import integrity
    places = [0, 1, 7, 8, 63, 64, 127, 32767, 32768, 40000, (1 << 33) + 5, (1 << 62) + 63, (1 << 62) + 64]
    kept = set(places[::2]) | {63, 64}
    for kind in ("long", "decimal(38,0)"):
        for most in (1 << 14, 0):           # broadcast or not
            monkeypatch.setattr(integrity, "BROADCAST_MARKS", most)
            df = spark.createDataFrame([(str(p),) for p in places], "p string").withColumn("_row_order", F.col("p").cast(kind))
            marks = integrity.row_marks(df.where(F.col("p").isin([str(p) for p in kept])))
            n = marks.agg(F.sum("_n"), F.count(F.lit(1))).first()
            assert n[0] == len(kept)
            assert {int(r["p"]) for r in integrity.marked_rows(df, marks, n[1]).collect()} == kept

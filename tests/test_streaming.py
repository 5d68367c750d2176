"""Incremental drops: later drops never overwrite a key that is already loaded."""
import os

from parcelkit.streaming.drops import stream_drops


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_second_drop_keeps_existing_keys(spark, tmpdir_path):
    landing, target, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "table", "ckpt"))
    _write(f"{landing}/real_acct/drop1.txt", "acct\tval\n 1 \ta\n2\tb\n2\tb-dup\n\tnull-key\n")
    q = stream_drops(spark, landing, "real_acct", ["acct", "val"], ["acct"], target, ckpt)
    q.awaitTermination(120)
    got = {r["acct"]: r["val"] for r in spark.read.parquet(target).collect()}
    assert got == {"1": "a", "2": "b"}

    _write(f"{landing}/real_acct/drop2.txt", "acct\tval\n2\tchanged\n3\tc\n")
    q = stream_drops(spark, landing, "real_acct", ["acct", "val"], ["acct"], target, ckpt)
    q.awaitTermination(120)
    got = {r["acct"]: r["val"] for r in spark.read.parquet(target).collect()}
    assert got == {"1": "a", "2": "b", "3": "c"}


def test_header_by_name_parents_and_tables_without_key(spark, tmpdir_path):
    landing, target, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "table", "ckpt"))
    parent = os.path.join(tmpdir_path, "parent")
    spark.createDataFrame([("1",), ("2",)], "acct string").write.parquet(parent)
    _write(f"{landing}/owners/a.txt", "val\tacct\nx\t1\ny\t9\n")
    _write(f"{landing}/owners/b.txt", "acct\textra\tval\n2\tq\tz\n")
    stream_drops(spark, landing, "owners", ["acct", "val"], ["acct"], target, ckpt,
                 parents=[(["acct"], parent, ["acct"])]).awaitTermination(120)
    assert {r["acct"]: r["val"] for r in spark.read.parquet(target).collect()} == {"1": "x", "2": "z"}

    for k in (1, 2):
        _write(f"{landing}/t_pp_e/drop{k}.txt", f"a\tb\nx\t{k}\nx\t{k}\n")
        stream_drops(spark, landing, "t_pp_e", ["a", "b"], [], target + "2", ckpt + "2").awaitTermination(120)
    assert sorted(tuple(r) for r in spark.read.parquet(target + "2").select("a", "b").collect()) == [
        ("x", "1"), ("x", "1"), ("x", "2"), ("x", "2")]


def test_a_first_batch_that_died_is_repeated(spark, tmpdir_path):
    landing, target, ckpt = (os.path.join(tmpdir_path, x) for x in ("landing", "table", "ckpt"))
    _write(f"{landing}/real_acct/drop1.txt", "acct\tval\n1\ta\n")
    os.makedirs(f"{target}/_temporary/0")                     # what a write that dies leaves behind
    stream_drops(spark, landing, "real_acct", ["acct", "val"], ["acct"], target, ckpt).awaitTermination(120)
    _write(f"{landing}/real_acct/drop2.txt", "acct\tval\n1\tb\n2\tc\n")
    stream_drops(spark, landing, "real_acct", ["acct", "val"], ["acct"], target, ckpt).awaitTermination(120)
    assert {r["acct"]: r["val"] for r in spark.read.parquet(target).collect()} == {"1": "a", "2": "c"}


def test_whole_rows_are_not_shuffled_to_find_the_new_ones(spark, tmpdir_path):
    from parcelkit.operators.integrity import ORDER_COL
    from parcelkit.streaming.drops import first_new_rows
    rows = spark.createDataFrame([("a", "1", 5), ("a", "2", 3), ("b", "3", 1), ("c", "4", 0), ("d", "5", 7)], f"k string, v string, {ORDER_COL} long")
    for i, held in enumerate((None, [], ["a"], ["b", "c", "d"], ["a", "b", "c", "d", "e"])):
        old = None if held is None else spark.createDataFrame([(k,) for k in held], "k string")
        out = first_new_rows(rows, rows.select("k", ORDER_COL), old, ["k"], f"{tmpdir_path}/{i}")
        want = {k: v for k, v in (("a", "2"), ("b", "3"), ("c", "4"), ("d", "5")) if k not in (held or [])}
        assert sorted((r.k, r.v) for r in out.collect()) == sorted(want.items())
        assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()

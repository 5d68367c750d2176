"""Loader round trip: derived tables written as dirty tab-separated text, loaded, compared."""
import os

from pyspark.sql import functions as F

from parcelkit.fixtures import Tables
from parcelkit.plans.load import load_tables
from pyspark.sql import types as T

from parcelkit.sources.codebook import column

SF = "/root/testdata/sf0.001"


def _write_tsv(df, path, header):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\t".join(header) + "\r\n")
        for r in df.collect():
            f.write("\t".join("" if r[c] is None else f" {r[c]} " for c in header) + "\r\n")


def test_load_tables_round_trip(spark, tmpdir_path):
    t = Tables(spark, SF)
    root, out = os.path.join(tmpdir_path, "drop"), os.path.join(tmpdir_path, "clean")
    ra = t["real_acct"].where(F.col("acct") != "0000000000003")        # orphan parent row removed
    br = t["building_res"]                                               # holds duplicate keys
    _write_tsv(ra.select("acct", "state_class", "tot_mkt_val"), os.path.join(root, "a", "real_acct.txt"),
               ["acct", "state_class", "tot_mkt_val"])
    _write_tsv(br.select("acct", "bld_num", "heat_ar"), os.path.join(root, "b", "building_res.txt"),
               ["acct", "bld_num", "heat_ar"])
    _write_tsv(br.select("acct", "heat_ar"), os.path.join(root, "c", "building_other.txt"), ["acct", "heat_ar"])
    codebook = {
        "real_acct": T.StructType([column("acct", 13, False), column("state_class", 1, True),
                      column("tot_mkt_val", 20, True), column("not_in_file", 5, True)]),
        "building_res": T.StructType([column("acct", 13, False), column("bld_num", 10, False),
                         column("heat_ar", 10, True)]),
        "building_other": T.StructType([column("acct", 13, False), column("bld_num", 10, False),
                           column("heat_ar", 10, True)]),
    }
    rep = {r["table_name"]: r for r in load_tables(spark, root, codebook, out).collect()}

    n_ra = ra.count()
    assert rep["real_acct"]["rows_kept"] == n_ra and rep["real_acct"]["duplicate_rows"] == 0
    # every state class ("A1", "B2", ...) is longer than the declared size 1: reported, loaded whole
    assert rep["real_acct"]["over_length_columns"] == f"state_class:{n_ra}"
    assert rep["building_res"]["over_length_columns"] == ""
    loaded = spark.read.parquet(os.path.join(out, "real_acct"))
    assert loaded.columns == ["acct", "state_class", "tot_mkt_val", "not_in_file"]
    assert loaded.where(F.col("not_in_file").isNotNull()).count() == 0
    # blanks became NULL, surrounding spaces stripped
    blanks = ra.where(F.col("tot_mkt_val") == "").count()
    assert loaded.where(F.col("tot_mkt_val").isNull()).count() == blanks
    assert loaded.where(F.col("acct").startswith(" ")).count() == 0

    keys = br.select("acct", "bld_num").distinct()
    orphan_keys = keys.where(F.col("acct") == "0000000000003").count()
    b = rep["building_res"]
    assert b["rows_read"] == br.count()
    assert b["duplicate_rows"] == br.count() - keys.count()
    assert b["orphan_rows"] == orphan_keys
    assert b["rows_kept"] == keys.count() - orphan_keys
    # file order: the first heat_ar of each key is kept
    first = {}
    for r in br.select("acct", "bld_num", "heat_ar").collect():
        first.setdefault((r["acct"], r["bld_num"]), r["heat_ar"] or None)
    got = {(r["acct"], r["bld_num"]): r["heat_ar"] for r in spark.read.parquet(os.path.join(out, "building_res")).collect()}
    assert all(got[k] == first[k] for k in got)

    # primary-key column missing from the header: nothing loads, the table is reported
    assert rep["building_other"]["rows_kept"] == 0 and rep["building_other"]["missing_key_columns"] == "bld_num"


def test_table_without_key_gets_row_id(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "drop")
    os.makedirs(root)
    with open(os.path.join(root, "t_pp_e.txt"), "w") as f:
        f.write("a\tb\nx\t1\nx\t1\n\t\n")
    cb = {"t_pp_e": T.StructType([column("a", None, True), column("b", None, True)])}
    rep = load_tables(spark, root, cb, os.path.join(tmpdir_path, "out")).first()
    # no key: duplicates stay; the whitespace-only line is skipped by the CSV reader (documented difference)
    assert rep["rows_kept"] == 2 and rep["duplicate_rows"] == 0
    got = spark.read.parquet(os.path.join(tmpdir_path, "out", "t_pp_e"))
    assert got.columns == ["a", "b", "row_id"] and got.select("row_id").distinct().count() == 2


def test_parents_first():
    from parcelkit.catalog import parents_first
    order = parents_first(["fixtures", "building_res", "t_business_detail", "real_acct", "t_business_acct"])
    assert order.index("real_acct") < order.index("building_res")
    assert order.index("t_business_acct") < order.index("t_business_detail")


def test_load_tables_from_codebook_folder(spark, tmpdir_path):
    cb = os.path.join(tmpdir_path, "codebook")
    os.makedirs(cb)
    with open(os.path.join(cb, "owners_columns.csv"), "w") as f:
        f.write("Column Name,Data Type,Size,Allow Null,Description,Source Page\n"
                "acct,varchar,13,NO,Account,1\nln_num,varchar,10,NO,Line,1\nname,varchar,5,,Name,1\n"
                "All records are sorted,,,,,1\n")
    root = os.path.join(tmpdir_path, "drop", "Real_acct_owner")
    os.makedirs(root)
    with open(os.path.join(root, "owners.txt"), "w") as f:
        f.write("acct\tln_num\tname\textra\n1\t1\tALICE SMITH\tq\n1\t1\tdup\tq\n2\t1\tBOB\tq\n\t1\tnokey\tq\n")
    rep = load_tables(spark, os.path.join(tmpdir_path, "drop"), cb, os.path.join(tmpdir_path, "out")).first()
    assert (rep["table_name"], rep["rows_read"], rep["null_key_rows"], rep["duplicate_rows"], rep["rows_kept"]) == \
           ("owners", 4, 1, 1, 2)
    assert rep["unexpected_columns"] == "extra" and rep["over_length_columns"] == "name:1"
    got = {r["acct"]: r["name"] for r in spark.read.parquet(os.path.join(tmpdir_path, "out", "owners")).collect()}
    assert got == {"1": "ALICE SMITH", "2": "BOB"}


def _drop(tmpdir_path, **files):
    root = os.path.join(tmpdir_path, "drop")
    for name, text in files.items():
        path = os.path.join(root, name.replace("__", "/") + ".txt")
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    return root


BOOK = {"real_acct": T.StructType([column("acct"), column("v")]),
        "owners": T.StructType([column("acct"), column("ln_num"), column("name")])}


def test_children_of_an_absent_parent_are_rejected(spark, tmpdir_path):
    root = _drop(tmpdir_path, owners="acct\tln_num\tname\n1\t1\tA\n2\t1\tB\n")
    rep = load_tables(spark, root, BOOK, os.path.join(tmpdir_path, "out")).first()
    assert (rep["rows_read"], rep["orphan_rows"], rep["rows_kept"]) == (2, 2, 0)
    assert rep["status"] == "ok; parent not loaded: real_acct"
    # a parent that an earlier run loaded counts
    out = os.path.join(tmpdir_path, "out2")
    spark.createDataFrame([("1", "x")], "acct string, v string").write.parquet(os.path.join(out, "real_acct"))
    rep = load_tables(spark, root, BOOK, out).first()
    assert (rep["status"], rep["orphan_rows"], rep["rows_kept"]) == ("ok", 1, 1)


def test_a_duplicate_file_fails_only_its_table(spark, tmpdir_path):
    root = _drop(tmpdir_path, a__real_acct="acct\tv\n1\tx\n", b__owners="acct\tln_num\tname\n1\t1\tA\n",
                 c__owners="acct\tln_num\tname\n1\t2\tB\n", d__other="q\n1\n", e__other="q\n2\n")
    rep = {r["table_name"]: r for r in load_tables(spark, root, BOOK, os.path.join(tmpdir_path, "out")).collect()}
    assert set(rep) == {"real_acct", "owners"} and rep["real_acct"]["rows_kept"] == 1
    assert rep["owners"]["status"].startswith("error: more than one file")


def test_part_files_with_other_column_orders(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "drop", "real_acct")
    os.makedirs(root)
    for k, text in enumerate(("acct\tv\nA\tk1\n", "v\tacct\nk2\tB\n", "acct\tw\nC\tz\n", "")):
        with open(os.path.join(root, f"part-{k}.csv"), "w") as f:
            f.write(text)
    rep = load_tables(spark, os.path.dirname(root), BOOK, os.path.join(tmpdir_path, "out")).first()
    got = {r["acct"]: r["v"] for r in spark.read.parquet(os.path.join(tmpdir_path, "out", "real_acct")).collect()}
    assert got == {"A": "k1", "B": "k2", "C": None} and rep["unexpected_columns"] == "w"


def test_kept_rows_of_a_dirty_drop(spark, tmpdir_path):
    """Duplicates whose first row differs, missing keys, orphans, a NULL foreign key."""
    root = _drop(tmpdir_path, real_acct="acct\tv\n1\tfirst\n 1 \tsecond\n2\tx\n\tno key\n",
                 owners="name\tln_num\tacct\nA\t1\t1\nB\t1\t1\nC\t1\t9\nD\t\t1\nE\t2\t2\n")
    out = os.path.join(tmpdir_path, "out")
    load_tables(spark, root, BOOK, out)
    read = lambda t: sorted(map(tuple, spark.read.parquet(os.path.join(out, t)).collect()))
    assert read("real_acct") == [("1", "first"), ("2", "x")]
    assert read("owners") == [("1", "1", "A"), ("2", "2", "E")]


def test_children_of_a_parent_that_failed_are_orphans(spark, tmpdir_path):
    """An older copy of the parent in the output folder does not stand in for one that fails in this run."""
    root = _drop(tmpdir_path, a__real_acct="acct\tv\n1\tx\n", b__real_acct="acct\tv\n2\ty\n", owners="acct\tln_num\tname\n1\t1\tA\n")
    out = os.path.join(tmpdir_path, "out")
    spark.createDataFrame([("1", "x")], "acct string, v string").write.parquet(os.path.join(out, "real_acct"))
    rep = {r["table_name"]: r for r in load_tables(spark, root, BOOK, out).collect()}
    assert rep["real_acct"]["status"].startswith("error") and rep["owners"]["status"] == "ok; parent not loaded: real_acct"
    assert (rep["owners"]["rows_read"], rep["owners"]["orphan_rows"], rep["owners"]["rows_kept"]) == (1, 1, 0)


def test_files_without_a_header_are_reported(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "drop", "real_acct")
    os.makedirs(root)
    for k, text in enumerate(("\n\nacct\tv\nA\t1\n", " \n\n", "acct\tv\nB\t2\n")):
        with open(os.path.join(root, f"part-{k}.csv"), "w") as f:
            f.write(text)
    rep = load_tables(spark, os.path.dirname(root), BOOK, os.path.join(tmpdir_path, "out")).first()
    assert (rep["status"], rep["rows_kept"]) == ("ok; files without a header: 1", 2)


def test_the_checkpoint_folder_is_kept_without_changing_the_setting():
    from parcelkit import session

    class Context:
        applicationId, master, folder = "app-x", "local[2]", None

        def getCheckpointDir(self):
            return self.folder and "file:" + self.folder + "/uuid"

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

            @staticmethod
            def set(key, value):
                raise AssertionError("spark.checkpoint.dir cannot be changed")
    first = session.ensure_checkpoint_dir(Session())
    assert first and session.ensure_checkpoint_dir(Session()) == first == Context.folder or Session.sparkContext.folder == first


def _shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found = {}
    for d in dirs:
        for folder, _, names in os.walk(d.getPath()):
            for n in names:
                if n.startswith("shuffle_"):
                    try:
                        found[n] = os.path.getsize(os.path.join(folder, n))
                    except FileNotFoundError:
                        pass
    return found


def test_only_keys_are_shuffled_and_their_files_go(spark, tmpdir_path):
    """Repeated keys and orphans that are too many to broadcast: whole rows stay where they are read."""
    import random
    import threading
    import time
    rng = random.Random(1)
    wide = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=2000)) for _ in range(3000)]
    lines = [f"{k % 2000}\t{k % 2}\t{w}" for k, w in enumerate(wide)]
    root = _drop(tmpdir_path, owners="acct\tln_num\tname\n" + "\n".join(lines) + "\n",
                 real_acct="acct\tv\n" + "".join(f"{k}\tx\n" for k in range(0, 2000, 3)))
    out = os.path.join(tmpdir_path, "out")
    before, peak, stop = set(_shuffle_files(spark)), [0], threading.Event()
    new = lambda: sum(size for n, size in _shuffle_files(spark).items() if n not in before)

    def watch():
        while not stop.is_set():
            peak[0] = max(peak[0], new())
            time.sleep(0.02)
    threshold, parts = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.files.minPartitionNum"
    was = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        rep = {r["table_name"]: r for r in load_tables(spark, root, BOOK, out).collect()}
    finally:
        stop.set()
        watcher.join()
        spark.conf.set(threshold, was)
    assert (rep["owners"]["duplicate_rows"], rep["owners"]["orphan_rows"], rep["owners"]["rows_kept"]) == (1000, 1333, 667)
    first = {k: wide[k] for k in range(0, 2000, 3)}
    assert {int(r["acct"]): r["name"] for r in spark.read.parquet(os.path.join(out, "owners")).collect()} == first
    assert 0 < peak[0] < 1_000_000          # the rows kept alone are 1.3 MB that hardly compress
    for _ in range(100):
        if not new():
            break
        time.sleep(0.1)
    assert not new()
    assert spark.conf.get(parts, None) is None      # the session's settings are as before


def test_compressed_part_files(spark, tmpdir_path):
    """More rows in a task than it has bytes: the first file's last rows still come before the second file's first."""
    import bz2
    import gzip
    task = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(task)
    for ending, opened in ((".gz", gzip.open), (".bz2", bz2.open)):
        root = os.path.join(tmpdir_path, ending[1:], "real_acct")
        os.makedirs(root)
        with opened(os.path.join(root, f"part-0.csv{ending}"), "wt") as f:
            f.write("acct\tv\n" + "same\tx\n" * 70_000 + "late\tfirst file\n")
        with opened(os.path.join(root, f"part-1.csv{ending}"), "wt") as f:
            f.write("v\tacct\nsecond file\tlate\nsecond file\tmore\n")
        out = os.path.join(tmpdir_path, "out" + ending)
        spark.conf.set(task, "8k")
        try:
            rep = load_tables(spark, os.path.dirname(root), BOOK, out).first()
        finally:
            spark.conf.set(task, was)
        assert (rep["status"], rep["rows_read"], rep["duplicate_rows"], rep["rows_kept"]) == ("ok", 70_003, 70_000, 3)
        got = {r["acct"]: r["v"] for r in spark.read.parquet(os.path.join(out, "real_acct")).collect()}
        assert got == {"same": "x", "late": "first file", "more": "second file"}


def test_the_written_drop_is_compressed(spark, tmpdir_path, monkeypatch):
    from parcelkit import fixtures
    monkeypatch.setattr(fixtures, "DROP_ROWS", 1000)
    t = Tables(spark, SF)
    root = os.path.join(tmpdir_path, "drop")
    cols = fixtures.write_text_drop(t, ["real_acct"], root)["real_acct"]
    files = [f for f in os.listdir(os.path.join(root, "real_acct")) if f.startswith("part-")]
    assert len(files) > 1 and all(f.endswith(".gz") for f in files)
    book = {"real_acct": T.StructType([column(c) for c in cols])}
    rep = load_tables(spark, root, book, os.path.join(tmpdir_path, "out")).first()
    assert rep["rows_kept"] == t["real_acct"].count()


def test_over_length_values_are_counted_where_all_rows_are_orphans(spark, tmpdir_path):
    root = _drop(tmpdir_path, owners="acct\tln_num\tname\n1\t1\tABC\n2\t1\tB\n")
    book = BOOK | {"owners": T.StructType([column("acct"), column("ln_num"), column("name", 2, True)])}
    rep = load_tables(spark, root, book, os.path.join(tmpdir_path, "out")).first()
    assert (rep["rows_read"], rep["orphan_rows"], rep["over_length_columns"]) == (2, 2, "name:1")


def test_a_foreign_key_beside_the_primary_key(spark, tmpdir_path, monkeypatch):
    """It is the first row's foreign key that counts; a NULL one violates nothing."""
    from parcelkit.catalog import KeySpec
    from parcelkit.plans import load
    monkeypatch.setitem(load.KEYS, "owners", KeySpec(("ln_num",), ((("acct",), "real_acct", ("acct",)),)))
    root = _drop(tmpdir_path, real_acct="acct\tv\n1\tx\n",
                 owners="acct\tln_num\tname\n1\ta\tA\n9\ta\tB\n9\tb\tC\n1\tb\tD\n\tc\tE\n")
    out = os.path.join(tmpdir_path, "out")
    rep = {r["table_name"]: r for r in load_tables(spark, root, BOOK, out).collect()}["owners"]
    assert (rep["duplicate_rows"], rep["orphan_rows"], rep["rows_kept"]) == (2, 1, 2)
    assert sorted(r["name"] for r in spark.read.parquet(os.path.join(out, "owners")).collect()) == ["A", "E"]


def test_marks_wait_for_other_tables(spark, tmpdir_path):
    """The session's limit for a broadcast does not fail a table while others are loaded (without AQE it counts)."""
    root = _drop(tmpdir_path, real_acct="acct\tv\n1\tx\n1\ty\n2\tz\n")
    limits = {"spark.sql.adaptive.enabled": "false", "spark.sql.broadcastTimeout": "0"}
    was = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        rep = load_tables(spark, root, BOOK, os.path.join(tmpdir_path, "out")).first()
        assert spark.conf.get("spark.sql.broadcastTimeout") == "0"
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert (rep["status"], rep["duplicate_rows"], rep["rows_kept"]) == ("ok", 1, 2)

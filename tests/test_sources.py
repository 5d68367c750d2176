"""Readers: tab-separated text, codebook, ZIP archives, download-page links."""
import io
import os
import zipfile

from parcelkit.sources.archives import archive_manifest, archive_scan, member_table
from parcelkit.sources.codebook import read_codebook, with_key
from parcelkit.sources.pages import page_links
from parcelkit.sources.tsv import (clean_cells, find_table_files, missing_key_columns, project_to_schema, raw_scan, table_files,
                                   tsv_scan)


def _write(path, data: bytes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_tsv_ragged_crlf_quotes_nul_utf8(spark, tmpdir_path):
    body = (b"acct\tname\tval\r\n"
            b"1\tshort\r\n"                      # short row -> NULL padded
            b"2\ttoo\tmany\textra\r\n"           # extra cell dropped
            b"\r\n"                              # blank line skipped
            b"3\t\"a b\tx\"y\"\r\n"              # stray quotes kept literally
            b"4\ta\x00b\xff\t  \xc2\xa0 \r\n")  # NUL removed, bad byte replaced, NBSP/space cell -> NULL
    _write(os.path.join(tmpdir_path, "sub", "t.txt"), body)
    rows = {r["acct"]: (r["name"], r["val"]) for r in tsv_scan(spark, tmpdir_path, "t").collect()}
    assert rows["1"] == ("short", None)
    assert rows["2"] == ("too", "many")
    assert rows["3"] == ('"a b', 'x"y"')
    assert rows["4"] == ("ab�", None)
    assert len(rows) == 4


def test_clean_cells_twice(spark):
    df = spark.createDataFrame([("  a ",), (" ",), ("x\u0000",), (None,)], "v string")
    once = clean_cells(df)
    assert [r[0] for r in once.collect()] == ["a", None, "x", None]
    assert once.collect() == clean_cells(once).collect()


def test_header_drift(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "h.txt"), b"acct\tbogus\tv\n1\tq\tw\n")
    df, unexpected = project_to_schema(raw_scan(spark, tmpdir_path, "h"), ["acct", "v", "missing"])
    assert df.columns == ["acct", "v", "missing"] and unexpected == ["bogus"]
    assert tuple(df.first()) == ("1", "w", None)
    assert missing_key_columns(spark, tmpdir_path, "h", ["acct", "bld_num"]) == ["bld_num"]


def test_dirty_codebook(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "cb", "t_columns.csv"),
           b"Column Name,Data Type,Size,Allow Null,Description,Source Page\n"
           b"acct,varchar,13 NO,Account,Number,9\n"
           b"name,,40,,Name,9\n"
           b"acct,varchar,13,NO,dup,9\n"
           b"All records of the file,,,,,9\n"
           b"____,,,,,9\n"
           b"val,char,x,NO,Value,9\n")
    cb = read_codebook(spark, os.path.join(tmpdir_path, "cb"))
    cols = cb["t"]
    assert [c.name for c in cols] == ["acct", "name", "val"]
    assert cols[0].metadata["size"] is None and cols[1].metadata == {"data_type": "varchar", "size": 40, "comment": "Name"}
    assert cols[2].nullable is False
    st = with_key(cols, pk=("acct",))
    assert st["acct"].nullable is False and st["val"].nullable and st["name"].metadata["size"] == 40


def _zip(members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return buf.getvalue()


def test_archives(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dl")
    _write(os.path.join(root, "Real_acct_owner.zip"), _zip([("real_acct.txt", "acct\tv\n1\ta\n2\tb\n"),
                                                             ("../evil.txt", "x")]))
    _write(os.path.join(root, "broken.zip"), b"not a zip at all")
    inner = _zip([("parcels.dbf", "dbf-bytes")])
    _write(os.path.join(root, "GIS_Public.zip"), _zip([("GIS_Public/Parcels.zip", inner), ("readme.txt", "r\n")]))
    members = archive_scan(spark, root)
    man = {r["archive"].split("/dl/")[-1]: r for r in archive_manifest(members).collect()}
    assert man["Real_acct_owner.zip"]["extracted_files"] == 1 and man["Real_acct_owner.zip"]["skipped_members"] == 1
    assert man["Real_acct_owner.zip"]["category"] == "pdata"
    assert man["Real_acct_owner.zip"]["destination"] == "pdata/Real_acct_owner"
    assert man["GIS_Public.zip"]["destination"] == "gis_data/GIS_Public"
    assert man["broken.zip"]["error"] == "BadZipFile"
    nested = [k for k in man if k == "GIS_Public.zip!GIS_Public/Parcels.zip"]
    assert nested and man[nested[0]]["category"] == "gis"
    lines = sorted((r["line_no"], r["line"]) for r in member_table(members, "real_acct.txt").collect())
    assert lines == [(1, "acct\tv"), (2, "1\ta"), (3, "2\tb")]
    only = archive_scan(spark, root, pattern="Real_*.zip", lines=False)
    assert {os.path.basename(r["archive"]) for r in only.collect()} == {"Real_acct_owner.zip"}


def test_damaged_member_and_odd_names(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "dl")
    data = bytearray(_zip([("good.txt", "a\n"), ("bad.txt", "b" * 50), ("a:b.txt", "c\n"), ("c:/x.txt", "d\n")]))
    at = data.find(b"b" * 50)
    data[at] ^= 255                                       # its checksum no longer fits
    _write(os.path.join(root, "x.zip"), bytes(data))
    rows = archive_scan(spark, root).collect()
    assert {r["member"]: (r["unsafe"], r["error"]) for r in rows if r["line"] is None} == {
        "bad.txt": (False, "BadZipFile"), "c:/x.txt": (True, None)}
    assert {r["line"] for r in rows if r["member"] in ("good.txt", "a:b.txt")} == {"a", "c"}
    one = archive_manifest(archive_scan(spark, root)).first()
    assert (one["extracted_files"], one["skipped_members"], one["error"]) == (2, 1, "BadZipFile")


def test_page_links_resolution(spark):
    html = ('<html><a href="/data/Real_2025.zip">a</a><A HREF=\'sub/GIS.ZIP?x=1\'>b</A>'
            '<a href="https://cdn.example.org/x.zip#f">c</a><a href="ftp://h/y.zip">d</a>'
            '<a href="//other.example.com/z.zip">e</a><a href="/data/Real_2025.zip">dup</a>'
            '<a href="../up/u.zip">f</a><a href="page.html">g</a><a href="/../../r.zip?a=1&amp;b=2">h</a>'
            '<script>var s = "<a href=\'/hidden.zip\'>";</script><!-- <a href="/old.zip"> --></html>')
    pages = spark.createDataFrame([(1, "https://host.example.com/dir/index.html", html)],
                                  "page_id long, url string, html string")
    got = sorted((r["link"], r["file_name"]) for r in page_links(pages).collect())
    assert got == sorted([
        ("https://host.example.com/data/Real_2025.zip", "Real_2025.zip"),
        ("https://host.example.com/dir/sub/GIS.ZIP?x=1", "GIS.ZIP"),
        ("https://cdn.example.org/x.zip#f", "x.zip"),
        ("https://other.example.com/z.zip", "z.zip"),
        ("https://host.example.com/up/u.zip", "u.zip"),
        ("https://host.example.com/r.zip?a=1&b=2", "r.zip"),
    ])


def test_page_links_equal_urljoin_at_any_depth(spark):
    from urllib.parse import urljoin
    base = "http://h.org/a/b/c/d/e/f/g/x.html"
    hrefs = ["../" * n + "z.zip" for n in range(12)] + ["./z.zip", "q/../z.zip", "../../q/./r/../../z.zip", "/a/../../z.zip",
             "z.zip?p=/../x", "z.zip#/../x", "..zip/../z.zip", "...zip", "m/..", "zip/.", "/zip/a/.."]
    html = "".join(f'<a href="{h}">x</a>' for h in hrefs)
    df = spark.createDataFrame([(1, base, html)], "page_id long, url string, html string")
    assert {r["link"] for r in page_links(df, "").collect()} == {urljoin(base, h) for h in hrefs}


def test_archive_table_header_per_member(spark, tmpdir_path):
    from parcelkit.sources.archives import archive_table
    root = os.path.join(tmpdir_path, "z")
    _write(os.path.join(root, "a.zip"), _zip([("owners.txt", "acct\tname\n1\tx\n2\ty\n")]))
    _write(os.path.join(root, "b.zip"), _zip([("sub/owners.txt", "name\tacct\textra\nz\t3\tq\nshort\n")]))
    rows = sorted(tuple(r) for r in archive_table(archive_scan(spark, root), "owners", ["acct", "name"]).collect()
                  if r[0] is not None)
    assert rows == [("1", "x"), ("2", "y"), ("3", "z")]


def test_part_files_that_begin_with_blank_lines_lose_nothing(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "t", "part-0.txt"), b"\r\n \r\nacct\tv\r\n1\ta\r\n")
    _write(os.path.join(tmpdir_path, "t", "part-1.txt"), b"acct\tv\n2\tb\n")
    _write(os.path.join(tmpdir_path, "t", "part-2.txt"), b"\n\nv\tacct\n\nc\t3\n")
    _write(os.path.join(tmpdir_path, "t", "part-3.txt"), b"\n \n")
    _write(os.path.join(tmpdir_path, "t", "part-4 [x].txt"), b"acct\tacct\t\n4\td\te\n")
    df = tsv_scan(spark, tmpdir_path, "t", ["acct", "v", "acct0"])
    assert sorted((r["acct"] or r["acct0"], r["v"]) for r in df.collect()) == [("1", "a"), ("2", "b"), ("3", "c"), ("4", None)]
    files = table_files(spark, {"t": find_table_files(spark, tmpdir_path)[0]["t"]})["t"]
    assert [p.rsplit("/", 1)[1] for p in files.blank] == ["part-3.txt"] and len(files.groups) == 3
    # places follow the file order
    order = [r["acct"] or r["acct0"] for r in df.orderBy("_row_order").collect()]
    assert order == ["1", "2", "3", "4"]


def test_headers_of_many_files_cost_one_job(spark, tmpdir_path):
    for k in range(300):
        _write(os.path.join(tmpdir_path, "many", f"part-{k:05d}.txt"), b"acct\tv\n%d\tx\n" % k if k % 2 else b"v\tacct\ny\t%d\n" % k)
    paths = find_table_files(spark, tmpdir_path)[0]["many"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    files = table_files(spark, {"many": paths})["many"]
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("rest", "rest")
    assert sorted(map(len, files.groups.values())) == [150, 150] and jobs <= 5      # a listing and the stages of one query, not one a file
    got = raw_scan(spark, tmpdir_path, "many", files=files).collect()
    assert {r["acct"]: r["v"] for r in got} == {str(k): "x" if k % 2 else "y" for k in range(300)}


def _odd_archives(root):
    import struct
    rng = __import__("random").Random(3)
    text = "".join(f"{i}\t{rng.random()}\n" for i in range(40_000))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("stored.txt", "a\r\nb\rc\n\nd", zipfile.ZIP_STORED)
        z.writestr("deflated.txt", text, zipfile.ZIP_DEFLATED)
        z.writestr("same.txt", "x" * 9_000_000 + "\n", zipfile.ZIP_DEFLATED)     # inflates a thousandfold
        z.writestr("bzip.txt", text, zipfile.ZIP_BZIP2)
        z.writestr("lzma.txt", "no\n", zipfile.ZIP_LZMA)
        z.writestr("empty.txt", "")
        z.writestr("bad utf8.txt", b"ok\n\xff\xfe\n")
        z.writestr("dir/", "")
    _write(os.path.join(root, "a b%20.zip"), buf.getvalue())
    data = bytearray(buf.getvalue())
    data[data.find(b"a\r\nb")] ^= 1                                                 # a checksum that no longer fits
    struct.pack_into("<H", data, data.find(b"deflated.txt") - 30 + 6, 1)            # an encrypted member
    _write(os.path.join(root, "sub", "damaged.zip"), bytes(data))
    _write(os.path.join(root, "cut.zip"), buf.getvalue()[:-30])
    _write(os.path.join(root, "empty.zip"), b"")                                    # Spark lists no file without bytes
    nested = _zip([("in.txt", "1\n2\n"), ("../up.txt", "x"), ("deeper.zip", _zip([("q.txt", "q")]))])
    _write(os.path.join(root, "gis", "Gis_Public.ZIP".lower()), _zip([("n.zip", nested), ("broken.zip", b"no zip"), ("r.txt", "r\n")]))


def test_ranged_reads_equal_whole_archives(spark, tmpdir_path):
    from parcelkit.sources.archives import _whole_archives, archive_index
    _odd_archives(tmpdir_path)
    for lines in (True, False):
        ranged, whole = ([tuple(r) for r in f(spark, tmpdir_path, None, lines).collect()] for f in (archive_scan, _whole_archives))
        assert sorted(ranged, key=str) == sorted(whole, key=str)
    rows = archive_scan(spark, tmpdir_path).collect()
    by = lambda a, m: [r for r in rows if r["archive"].endswith(a) and r["member"] == m]
    assert [r["line"] for r in sorted(by("a b%20.zip", "stored.txt"), key=lambda r: r["line_no"])] == ["a", "b", "c", "", "d"]
    assert len(by("a b%20.zip", "deflated.txt")) == len(by("a b%20.zip", "bzip.txt")) == 40_000
    assert len(by("a b%20.zip", "same.txt")[0]["line"]) == 9_000_000
    assert [r["error"] for r in by("a b%20.zip", "lzma.txt")] == ["NotImplementedError"]
    assert [(r["line"], r["error"]) for r in by("a b%20.zip", "empty.txt")] == [(None, None)]
    assert [r["line"] for r in by("a b%20.zip", "bad utf8.txt")] == ["ok", "��"]
    assert {r["error"] for r in by("damaged.zip", "stored.txt")} == {None, "BadZipFile"}
    assert [r["error"] for r in by("damaged.zip", "deflated.txt")] == ["RuntimeError"] and len(by("damaged.zip", "bzip.txt")) == 40_000
    assert {r["archive"].rsplit("/", 1)[1]: r["error"] for r in rows if r["member"] is None} == {
        "cut.zip": "BadZipFile", "gis_public.zip!broken.zip": "BadZipFile"}
    assert [r["line"] for r in by("gis_public.zip!n.zip", "in.txt")] == ["1", "2"] and by("gis_public.zip!n.zip", "../up.txt")[0]["unsafe"]
    index = archive_index(spark, tmpdir_path)
    assert "line" not in index.columns and index.where("member = 'deflated.txt'").count() == 2


def test_an_archive_is_read_by_as_many_tasks_as_it_has_members(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "one.zip"), _zip([(f"m{i}.txt", f"{i}\n" * 50) for i in range(12)]))
    scan = archive_scan(spark, tmpdir_path)
    per_task = scan.selectExpr("spark_partition_id() as p", "member").distinct().groupBy("p").count().collect()
    assert len(per_task) >= 10 and max(r["count"] for r in per_task) <= 2


def test_clean_scan_of_plain_and_odd_lines(spark, tmpdir_path):
    """Trimmed at any white space, then NULs deleted (what they kept from the edge stays), whatever the line holds beside."""
    from parcelkit.sources.tsv import WHITE_SPACE
    lines = ["1\t plain  \tx", "2\t\0 x\0\t y ", "3\t\xa0z\u3000\t \x0b ", "4\t \x1cq\t\u00e9 ", "5\tshort", "6\ta\tb\textra\tmore", " 7 \t\"q\t\0"]
    with open(os.path.join(tmpdir_path, "t.txt"), "w", encoding="utf-8", newline="") as f:
        f.write("acct\tv\tw\r\n" + "".join(f"{x}\r\n" for x in lines))
    want = {}
    for x in lines:
        cells = [c.strip(WHITE_SPACE).replace("\0", "") or None for c in x.split("\t")] + [None, None]
        want[cells[0]] = (cells[1], cells[2])
    got = {r["acct"]: (r["v"], r["w"]) for r in tsv_scan(spark, tmpdir_path, "t").collect()}
    assert got == want
    some = raw_scan(spark, tmpdir_path, "t", ordered=True, clean=True, only=["v", "none"])
    assert some.columns == ["v", "_row_order"]
    assert sorted(r["v"] for r in some.collect()) == sorted(v for v, _ in want.values())

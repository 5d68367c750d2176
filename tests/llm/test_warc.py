import base64
import hashlib
from collections import defaultdict

import pytest
import zstandard
from pyarrow import fs as pafs

from parcelkit.llm import warc
from parcelkit.llm.common import work_path


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://a.org/x", "<p>same</p>"), (2, "http://b.org/x", "<p>same</p>"), (3, None, "<p>other ü</p>"),
            (4, "http://c.org/a b\r\nX: y", None), (5, "u", ""), (None, "http://n.org", "<p>same</p>"), (6, "http://l.org", "long \r\n\r\n" * 90000),
            (None, None, "alone"), (2, "http://b.org/x", "<p>same</p>")]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, payload string")


def digest(b):
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 12])
def test_round_trip(spark, pages, min_bytes):
    index = warc.write_archives(pages, work_path(spark, "w"), min_bytes=min_bytes, frame_bytes=300, bundle_bytes=1 << 20)
    got = warc.read_archives(spark, index).collect()
    rows = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = defaultdict(lambda: None)
    for i, b in rows:
        if i is not None:
            first[b] = i if first[b] is None else min(i, first[b])
    want = []
    for i, b in rows:
        again = len(b) >= min_bytes and first[b] is not None and i != first[b]
        want.append((i, len(b), digest(b), "revisit" if again else "response", first[b] if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert {r.url for r in got} >= {None, "http://c.org/a%20b%0D%0AX:%20y"}


def test_index_reaches_single_records(spark, pages):
    index = warc.write_archives(pages, work_path(spark, "w"), frame_bytes=200)
    for r in index.collect():
        headers, block = warc.read_record(r.path, r.frame, r.offset)
        assert headers["WARC-Record-ID"] == warc._name(r.page_id) and len(block) == int(headers["Content-Length"])
    path = index.first().path
    fs, inner = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(inner) as f:
        frames = warc.read_seek_table(f)
        f.seek(0)
        raw = f.read()
    # any Zstandard reader takes the bundle: frames one after the other, the seek table is skippable
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(whole) == sum(size for _, _, size in frames) and whole.startswith(b"WARC/1.1\r\n")


def test_no_pages(spark, pages):
    index = warc.write_archives(pages.where("false"), work_path(spark, "w"))
    assert index.count() == 0 and warc.read_archives(spark, index).count() == 0

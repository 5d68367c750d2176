import random
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pytest

from parcelkit.sources.pages import anchor_hrefs, page_links

SCHEMA = "page_id long, url string, html string"


class Anchors(HTMLParser):
    """What the standard library's parser sees (the last of repeated attributes)."""

    def __init__(self, text):
        super().__init__()
        self.out = []
        self.feed(text)

    def handle_starttag(self, tag, attrs):
        if tag == "a" and "href" in dict(attrs):
            self.out.append((dict(attrs)["href"] or "").strip())


@pytest.mark.parametrize("html, hrefs", [
    ('<a title="a>b" href="one.zip">', ["one.zip"]),
    ('<a data-href="no.zip" href="two.zip">', ["two.zip"]),
    ('<a href="x&#38;y&#x26;z&amp;w.zip">', ["x&y&z&w.zip"]),
    ('<a href="q?a=1&copy=2&lt;&bogus;.zip">', ["q?a=1&copy=2<&bogus;.zip"]),
    ("<a\nhref = 'a\"b.zip'\n>", ['a"b.zip']),
    ("<A HREF=bare.zip/x>", ["bare.zip/x"]),
    ("<a href>", [""]), ("<a href=>", [""]), ('<a href="">', [""]),
    ('<abbr href="no.zip"><a-b href="no.zip"></a href="no.zip">', []),
    ('<!-- <a href="no.zip"> --><a href="1.zip"><!--><a href="2.zip"><!---><a href="3.zip"><!--x--!><a href="4.zip">',
     ["1.zip", "2.zip", "3.zip", "4.zip"]),
    ('<!DOCTYPE html><?xml version="1"?><a href="1.zip">', ["1.zip"]),
    ('<script>"<a href=no.zip>"</scriptx></script ><a href="1.zip"><STYLE><a href=no.zip></Style><a href=2.zip>', ["1.zip", "2.zip"]),
    ('<script>never ends <a href="no.zip">', []),
    ('<a href="first.zip" href="last.zip">', ["last.zip"]),
    ('1 < 2 <a/href="1.zip"/><<a href=2.zip>< a href=no.zip>', ["1.zip", "2.zip"]),
    ('<a href="unfinished.zip', []), ("", []), ("<", []), ("<a", []), ("<a href", []), ("<!--", []),
])
def test_tokeniser_states(html, hrefs):
    assert list(anchor_hrefs(html)) == hrefs


def _page(rng):
    def value():
        v = "".join(rng.choice(["f.zip", "a", "/", "../", "./", "?q=1", "#t", "&amp;", "&#38;", "&#x41;", " ", ">", "=", "Ü", ".ZIP", "//h.org/",
                                "http://x.net/", "ftp:", "&eacute;", "&quot;"]) for _ in range(rng.randint(1, 6)))
        kind = rng.random()
        if kind < .45:
            return f'"{v}"'
        if kind < .9:
            return f"'{v}'"
        return "".join(c for c in v if c not in " >='\"") or "e.zip"

    def tag():
        name = rng.choice(["a", "a", "a", "A", "b", "img", "abbr", "area"])
        attrs = [rng.choice(["href", "href", "HREF", "data-href", "title", "hreflang", "x"]) + rng.choice(["=", " = ", "=\n"]) + value()
                 for _ in range(rng.randint(0, 3))] + [rng.choice(["", "disabled", "href"])] * (rng.random() < .2)
        return f"<{name} {rng.choice([' ', chr(10), chr(9)]).join(attrs)}{rng.choice(['', ' '])}>"

    parts = [lambda: "text & more ", tag, tag, tag, lambda: f"</{rng.choice(['a', 'b'])}>", lambda: f"<!-- {tag()} -->",
             lambda: f"<script>var x = '{tag()}';</script>", lambda: f"<style>{tag()}</style>", lambda: "<!DOCTYPE html>"]
    return "".join(rng.choice(parts)() for _ in range(rng.randint(0, 25)))


def test_generated_pages_equal_the_standard_parser(spark):
    rng = random.Random(11)
    rows = [(i, f"https://host{i % 7}.org/a/b{i}/c.html?x=1", _page(rng)) for i in range(1500)]
    want = set()
    for i, url, text in rows:
        for href in Anchors(text).out:
            if ".zip" in href.lower() and urlsplit(link := urljoin(url, href)).scheme in ("http", "https"):
                want.add((i, url, link, urlsplit(link).path.rsplit("/", 1)[-1] or urlsplit(link).netloc))
    got = [tuple(r) for r in page_links(spark.createDataFrame(rows + rows[:50], SCHEMA)).collect()]
    assert len(want) > 300 and len(got) == len(set(got)) and set(got) == want


def test_odd_pages(spark):
    rows = [(1, None, '<a href="x.zip"><a href="http://h.org/y.zip">'), (2, "http://h.org/", None), (None, "http://h.org/", '<a href="z.zip">'),
            (3, "http://h.org", '<a href="http://[broken/.zip"><a href="?.zip">'), (4, "http://h.org/", "<p>" * 200_000 + '<a href="l.zip">')]
    got = {(r.page_id, r.link, r.file_name) for r in page_links(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "http://h.org/y.zip", "y.zip"), (None, "http://h.org/z.zip", "z.zip"), (3, "http://h.org?.zip", "h.org"),
                   (4, "http://h.org/l.zip", "l.zip")}
    assert page_links(spark.createDataFrame([], SCHEMA)).collect() == []

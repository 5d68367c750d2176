"""Download-page link scan over a table of crawled pages (``page_id, url, html``).

Pages are read by a tokeniser with the states of an HTML parser: text, comment, declaration, tag, attribute name,
attribute value (double-, single- or unquoted) and raw text (``script``, ``style``). Only what a parser would see as an
anchor's ``href`` counts: not a ``>`` inside a quoted title, not ``data-href``, not markup in comments or scripts.
References such as ``&amp;`` and ``&#38;`` in the value are decoded.

For every href that contains ``pattern`` (case-insensitive, anywhere — the source looks for ``.zip``), it is resolved
against the page's URL, http/https links are kept, and the file name is the last segment of the link's path (the host
when there is none). Distinct per page. Pages are tokenised in Arrow batches, one page at a time, wherever their rows lie.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from html.entities import html5
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------------
SPACE = " \t\n\f\r"
RAW_TEXT = ("script", "style")       # what follows such a tag is text up to its end tag
SCHEMES = ("http", "https")

# what may end the text state: a comment, another declaration, an end tag, a start tag
_MARK = re.compile(rf"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<slash>/?)(?P<tag>[A-Za-z][^{SPACE}/>]*))")
_COMMENT_END = re.compile(r"--!?>")
# the next state inside a tag: its end, or an attribute with its value, if it has one
_ATTRIBUTE = re.compile(
    rf"[{SPACE}/]*(?:(?P<end>>)|(?P<name>[^{SPACE}/>][^{SPACE}/>=]*)"
    rf"(?P<equals>[{SPACE}]*=[{SPACE}]*(?:\"(?P<double>[^\"]*)\"|'(?P<single>[^']*)'|(?P<bare>(?![\"'])[^{SPACE}>]*)|(?P<open>[\"'])))?)")
_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|([A-Za-z][A-Za-z0-9]*)(;|=)?)")


def _decoded(value: str) -> str:
    """An attribute's value with its character references decoded: named ones without a semicolon only as a whole word
    that no ``=`` follows, as in a query string."""
    def one(m: re.Match) -> str:
        name, end = m.group(1), m.group(2)
        if name is None or end == ";" or (end is None and name in html5):
            return _html.unescape(m.group())
        return m.group()
    return _REFERENCE.sub(one, value) if "&" in value else value


def _tag_end(text: str, at: int, wanted: str | None) -> tuple[int, str | None, bool]:
    """From behind a tag's name: where the tag ends (-1: it does not), the value of its attribute ``wanted`` (the last
    one, '' if it has no value) and whether the tag closes itself."""
    value = None
    while True:
        m = _ATTRIBUTE.match(text, at)
        if m is None or m["open"] is not None:
            return -1, None, False
        if m["end"]:
            return m.end(), value, text[m.end() - 2] == "/"
        if wanted is not None and m["name"].lower() == wanted:
            value = next((v for v in (m["double"], m["single"], m["bare"]) if v is not None), "")
        at = m.end()


def anchor_hrefs(text: str) -> Iterator[str]:
    """The ``href`` of every anchor of a page, in order, decoded and stripped. An unfinished tag ends the page."""
    at = 0
    while m := _MARK.search(text, at):
        if m["comment"]:
            rest = text[m.end():m.end() + 2]
            if rest[:1] == ">" or rest == "->":             # an empty comment
                at = text.index(">", m.end()) + 1
                continue
            end = _COMMENT_END.search(text, m.end())
            if not end:
                return
            at = end.end()
            continue
        if m["other"]:
            at = text.find(">", m.end()) + 1
            if not at:
                return
            continue
        name = m["tag"].lower()
        opens = not m["slash"]
        at, href, closed = _tag_end(text, m.end(), "href" if opens and name == "a" else None)
        if at < 0:
            return
        if href is not None:
            yield _decoded(href).strip()
        if opens and not closed and name in RAW_TEXT:
            end = re.compile(rf"</{name}(?=[{SPACE}/>])", re.IGNORECASE).search(text, at)
            if not end:
                return
            at = end.start()


def _links(base: str, text: str, pattern: str) -> dict[str, str]:
    """Link -> file name of one page."""
    out = {}
    for href in anchor_hrefs(text):
        if pattern in href.lower():
            try:
                link = urljoin(base, href)
                parts = urlsplit(link)
            except ValueError:                              # no address (a broken IPv6 host)
                continue
            if parts.scheme in SCHEMES:
                out[link] = parts.path.rsplit("/", 1)[-1] or parts.netloc
    return out


def page_links(pages: DataFrame, pattern: str = ".zip") -> DataFrame:
    """``page_id, url, link, file_name`` for each distinct matching link of each page (sort where it is shown).

    A page without html has no links; without a url only absolute links resolve.
    """
    wanted = pattern.lower()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                at, links, names = [], [], []
                for i, (url, text) in enumerate(zip(part.column("url").to_pylist(), part.column("html").to_pylist())):
                    for link, name in _links(url or "", text or "", wanted).items():
                        at.append(i)
                        links.append(link)
                        names.append(name)
                index = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("page_id").take(index), part.column("url").take(index),
                                                  pa.array(links, pa.string()), pa.array(names, pa.string())],
                                                 ["page_id", "url", "link", "file_name"])

    from ..session import ship_package
    ship_package(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    narrow = pages.select("page_id", "url", F.col("html"))
    found = narrow.mapInArrow(run, f"page_id {kind}, url string, link string, file_name string")
    return found.distinct()         # pages that are listed twice

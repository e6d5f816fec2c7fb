from __future__ import annotations

import base64
import hashlib
import json
import time
from collections import Counter
from html.parser import HTMLParser
from urllib.parse import urljoin

from orderflow.llm import warc
from orderflow.llm.common import pick
from orderflow.llm.queries import op9_warc

FOLDER = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html lang="de"><head><title>Ein &amp; anderer
Titel</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><!-- <p>hidden</p> --><p>Erster <b>Absatz</b> &lt;x&gt;<br>Zeile</p><a href='/b?x=1&amp;y=2'>hin</a>
<img alt=1 src=../bild.png><a href="http://[broken">x</a><p>unclosed"""


def labelled(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_text_links_and_title_of_a_page():
    assert warc.plain_text(PAGE) == "Ein & anderer Titel\nErster Absatz <x>\nZeile\nhin x\nunclosed"
    found = warc.links(PAGE, "https://example.org/a/b/")
    assert [x["url"] for x in found] == [
        "https://example.org/b?x=1&y=2",
        "https://example.org/a/bild.png",
        "http://[broken",
    ]
    for address in ("https://example.org/a/b?q=/c", "http://example.org", "about:blank", "x"):
        for value in ("/", "/a;p?q#f", "//other/x", "/a/../b", "c/./d", "?q", "#f", "", "mailto:x", "https://z/y"):
            assert warc.links(f'<a href="{value}">', address)[0]["url"] == urljoin(address, value)
    assert warc.plain_text("") == "" and warc.links("", "about:blank") == []


def test_links_of_scripts_and_noscript_and_no_data_src():
    page = """<script src="/a.js">var x = '<a href="/no">';</script><!-- <img src="/no"> --><style>a{}</style>
    <noscript><img src='/b.png'></noscript><img data-src="/no" src="/c.png"><iframe data-src="/no"></iframe>
    <template><a href=/d>d</a></template><img/src=/e.png><a :href="no" href="/f">f</a>"""
    found = [(x["path"], x["url"]) for x in warc.links(page, "http://x.org/")]
    assert found == [
        ("script@/src", "http://x.org/a.js"),
        ("img@/src", "http://x.org/b.png"),
        ("img@/src", "http://x.org/c.png"),
        ("a@/href", "http://x.org/d"),
        ("img@/src", "http://x.org/e.png"),
        ("a@/href", "http://x.org/f"),
    ]


def test_a_quoted_angle_does_not_end_a_tag():
    assert warc.plain_text('<p title="1 > 0">Hi</p><div data-x=\'a>b\' y = "<i>">there</div>') == "Hi\nthere"
    assert warc.plain_text("<p title=\"open>Hi <b>you</b>, it's 1 = 1") == "Hi you, it's 1 = 1"
    found = warc.links('<a title="a > b" href="/x">x</a><a title="x href=/no" href=/y>y</a><a x="1"href="/z">z</a>', "http://x.org/")
    assert [x["url"] for x in found] == ["http://x.org/x", "http://x.org/y", "http://x.org/z"]
    made = warc.response_record("1", "http://x.org/", '<html data-a="b>c" lang=fr><title data-x=">">T</title><script a=">">x</script>')
    meta, text = warc.derived_records(made["headers"], made["block"])
    assert json.loads(meta["block"])["title"] == "T" and text["block"] == "T"
    assert warc.header(text["headers"], "WARC-Identified-Content-Language") == "fr"


def test_relative_links_start_from_the_base():
    page = '<a href="before">b</a><base target=x href="../sub/"><base href="/no/"><a href="c">c</a><a href="/d">d</a>'
    urls = [x["url"] for x in warc.links(page, "http://x.org/a/b/page")]
    assert urls == ["http://x.org/a/sub/before", "http://x.org/a/sub/c", "http://x.org/d"]
    urls = [x["url"] for x in warc.links('<base href="https://y.org/p/"><a href="/d">d</a><img src=e>', "about:blank")]
    assert urls == ["https://y.org/d", "https://y.org/p/e"]


def test_form_targets_and_image_lists():
    page = """<form method=post action="/send"><a action=/no>x</a><form href=/no action=go>
    <img src=a.png srcset="a.png 1x, b,c.png 2x,d.png"><source srcset='/e 100w'><img srcset=", "><form>"""
    assert [(x["path"], x["url"]) for x in warc.links(page, "http://x.org/p/")] == [
        ("form@/action", "http://x.org/send"),
        ("form@/action", "http://x.org/p/go"),
        ("img@/src", "http://x.org/p/a.png"),
        ("img@/srcset", "http://x.org/p/a.png"),
        ("img@/srcset", "http://x.org/p/b,c.png"),
        ("img@/srcset", "http://x.org/p/d.png"),
        ("source@/srcset", "http://x.org/e"),
    ]


def test_odd_markup_takes_time_in_proportion():
    for piece in ("<a ", '<a x="', "<a x='", "<a href", '<p t="">', "<a =", "<a x=1 ", "<", '="', "<!--", "<a href='"):
        page = piece * (200_000 // len(piece))
        started = time.perf_counter()
        warc.links(page, "http://x.org/")
        warc.plain_text(page)
        assert time.perf_counter() - started < 5, piece


def test_records_name_their_source():
    made = warc.response_record("7", "https://example.org/\r\nX: y", PAGE)
    meta, text = warc.derived_records(made["headers"], made["block"])
    get = warc.header
    payload = PAGE.encode()
    assert get(made["headers"], "WARC-Payload-Digest") == labelled(payload)
    assert get(made["headers"], "warc-target-uri") == "https://example.org/ X: y"
    for record in (meta, text):
        assert get(record["headers"], "WARC-Refers-To") == get(made["headers"], "WARC-Record-ID")
        assert get(record["headers"], "WARC-Target-URI") == get(made["headers"], "WARC-Target-URI")
        assert get(record["headers"], "WARC-Refers-To-Payload-Digest") == labelled(payload)
        assert get(record["headers"], "WARC-Block-Digest") == labelled(record["block"].encode())
        assert get(record["headers"], "Content-Length") == str(len(record["block"].encode()))
    assert get(meta["headers"], "WARC-Concurrent-To") == get(text["headers"], "WARC-Record-ID")
    assert get(text["headers"], "WARC-Identified-Content-Language") == "de"
    envelope = json.loads(meta["block"])
    assert envelope["title"] == "Ein & anderer Titel"
    assert envelope["source-headers"] == [[h["name"], h["value"]] for h in made["headers"]]
    assert envelope["http-status"] == "HTTP/1.1 200 OK"
    assert ["Content-Length", str(len(payload))] in envelope["http-headers"]
    assert envelope["text-digest"] == labelled(text["block"].encode())


def test_written_files_read_back_the_same(spark, tmp_path):
    rows = [(1, "https://a.example/", PAGE), (2, None, None), (3, "b:c", "no markup\r\n\r\nWARC/1.1\r\nat all 漢字🙂"), (3, "b:c", ""), (None, "", "<p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    source = warc.responses(pages, "page_id", "url", "html")
    records = source.unionByName(warc.derivatives(source, "page_id"))
    made = Counter(json.dumps([r.type, [list(h) for h in r.headers], r.block]) for r in records.collect())
    assert sum(made.values()) == 15
    for compression in ("none", "gzip"):
        path = str(tmp_path / compression)
        warc.write_warc(records.repartition(2), path, compression)
        files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        back = warc.read_warc(files).collect()
        assert Counter(json.dumps([r.type, [list(h) for h in r.headers], r.block]) for r in back) == made
    again = warc.derivatives(warc.read_warc(files).withColumnRenamed("place", "page_id"), "page_id")
    assert again.count() == 10


class Text(HTMLParser):
    """Characters outside of scripts and styles, by the standard parser."""

    def __init__(self):
        super().__init__()
        self.hidden, self.seen = 0, []

    def handle_starttag(self, tag, attributes):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.seen.append(data)


def test_given_pages_against_the_standard_parser(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = op9_warc(spark, FOLDER).collect()
    assert Counter((r.page_id, r.type) for r in rows) == Counter((p, t) for p in pages for t in ("metadata", "conversion"))
    for page in pages.values():
        parser = Text()
        parser.feed(page.html)
        assert "".join(warc.plain_text(page.html).split()) == "".join("".join(parser.seen).split())
    for r in rows:
        assert r.source_digest == labelled(pages[r.page_id].html.encode())
        assert r.target_uri == pages[r.page_id].url
    assert len({r.record_id for r in rows}) == len(rows)


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    source = warc.responses(odd_documents, "doc_id", "source", "text")
    assert source.columns == ["doc_id", "type", "headers", "block"]
    texts = [tuple(r) for r in pick(odd_documents, i="doc_id", t="text").collect()]
    found = [(r.doc_id, warc.split_response(r.block)[2]) for r in source.collect()]
    assert found == [(i, t or "") for i, t in texts]
    assert warc.derivatives(source, "doc_id").count() == 2 * len(texts)
    assert warc.derivatives(warc.responses(no_documents, "doc_id", "source", "text"), "doc_id").count() == 0

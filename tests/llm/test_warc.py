import base64
import gzip
import hashlib
import json
import uuid
from html.parser import HTMLParser

import pytest

from topicloom.llm import warc as W
from topicloom.llm.catalog import QUERIES
from topicloom.llm.staging import folder

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>A &amp; B</title><style>p{}</style><script>var t="</p>";</script></head>
<body><!-- gone --><nav><a href="/x?a=1&amp;b=2">X</a></nav><p>One <b>two</b>&nbsp;three</p><div>x &lt; y</div><script>no</script></body></html>"""


def derived(record):
    return {k: W.parse(r) for k, _, r in W.derive(record)}


def test_links_headers_and_digests():
    name, record = W.respond(1, "http://a.example/é", PAGE)
    found = derived(record)
    headers, block, _ = found["conversion"]
    assert block.decode() == "X\nOne two three\nx < y"
    for kind in ("conversion", "metadata"):
        h, b, _ = found[kind]
        assert W.get(h, "WARC-Type") == kind and W.get(h, "WARC-Refers-To") == name
        assert W.get(h, "WARC-Target-URI") == W.get(h, "WARC-Refers-To-Target-URI") == "http://a.example/é"
        assert W.get(h, "WARC-Date") == W.get(h, "WARC-Refers-To-Date") == W.DATE
        assert W.get(h, "WARC-Block-Digest") == W.digest(b)
    meta = json.loads(found["metadata"][1])
    assert meta["conversion"] == W.get(headers, "WARC-Record-ID")
    assert meta["title"] == "A & B" and meta["links"] == ["/x?a=1&b=2"]
    assert meta["payload"]["stated"] == meta["payload"]["computed"] == W.digest(PAGE.encode())
    assert ["WARC-Record-ID", name] in meta["source"]["warc"] and meta["source"]["status"] == "HTTP/1.1 200 OK"


def response(head, body):
    block = head.encode() + b"\r\n\r\n" + body
    return W.assemble([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:1>"), ("Content-Type", "application/http")], block)


@pytest.mark.parametrize("head, body, text", [
    ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1", "<p>é</p>".encode("latin-1"), "é"),
    ("HTTP/1.1 200 OK\r\nContent-Encoding: gzip", gzip.compress(b"<p>zip</p>"), "zip"),
    ("HTTP/1.1 200 OK\r\nContent-Encoding: gzip", b"<p>not zip</p>", "not zip"),
    ("HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked", b"4\r\n<p>a\r\n5\r\nb</p>\r\n0\r\n\r\n", "ab"),
    ("HTTP/1.1 200 OK\r\nContent-Type: text/plain; charset=nonsense", b" kept  as is ", " kept  as is "),
    ("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-Long: a\r\n b", b"", ""),
    ("HTTP/1.1 200 OK", b"<p>a < b and <!-- open", "a < b and"),
    ("HTTP/1.1 200 OK\r\nContent-Type: image/png", b"\x89PNG", None),
])
def test_bodies(head, body, text):
    found = derived(response(head, body))
    assert (found["conversion"][1].decode() if "conversion" in found else None) == text
    assert "metadata" in found


@pytest.mark.parametrize("record", [None, b"", b"junk", W.respond(1, "u", PAGE)[1][:-5], W.assemble([("WARC-Type", "request")], b"x"), b"WARC/1.1\r\nContent-Length: x\r\n\r\n"])
def test_what_is_no_response_yields_nothing(record):
    assert W.derive(record) == []


ROWS = [(1, "http://a.example/", PAGE), (2, None, "<p>x\r\n\r\ny</p>"), (3, "http://b.example/\r\nInjected: 1", None), (None, "u", ""), (4, "u", "<p>" + "long " * 100_000), (5, "v", "same"), (5, "v", "same")]


def test_files_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id bigint, url string, html string, record string")
    sources = W.responses(pages)
    path = folder(spark)
    W.write_files(W.derivatives(sources), path)
    read = W.read_files(spark, path).collect()
    assert len(read) == 2 * len(ROWS)
    expected = {}
    for page_id, url, html in ROWS:
        name, record = W.respond(page_id, url, html)
        for kind, own, data in W.derive(record):
            expected[own] = (kind, name, W.parse(data)[1].decode())
    assert {r.record_id: (r.kind, r.refers_to, r.block) for r in read} == expected


def test_empty_table_and_damage(spark, tmp_path):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    path = folder(spark)
    W.write_files(W.derivatives(W.responses(none)), path)
    assert W.read_files(spark, path).count() == 0
    data = W.derive(W.respond(1, "u", PAGE)[1])[0][2] + W.END.encode()
    (tmp_path / "a.warc").write_bytes(data.replace(b"three", b"seven"))
    with pytest.raises(Exception, match="does not agree"):
        W.read_files(spark, str(tmp_path)).collect()


def test_head_without_end_tag():
    shown = {
        "<html><head><title>T</title><body><p>All the text</p></body></html>": "All the text",
        "<html><head><meta charset=utf-8><title>a <p> b</title><script>'</head><p>'</script>\n<p>One<p>Two": "One\nTwo",
        "<head><title>T</title>Bare text": "Bare text",
        "<head><style>p {}</style><link href=x><body>Text <code></head></code>more": "Text more",
        "<head><title>T</title><style>x</style> lost </head><body>Kept": "Kept",
        "<header>Top</header><head>": "Top",
    }
    assert {page: W.plain_text(page) for page in shown} == shown


def test_ids_are_name_based_uuids():
    for parts in (("response", "1", "", "x"), ("metadata", "é|")):
        assert W.record_id(*parts) == f"<urn:uuid:{uuid.uuid5(W.SPACE, '|'.join(parts))}>"


@pytest.mark.parametrize("size", [1, 7, 100, 10**9])
def test_records_from_pieces(size):
    made = [r for page in (PAGE, "", "a\r\n\r\n\r\n\r\nb\r\n", "\r\n") for _, _, r in W.derive(W.respond(1, "u", page)[1])]
    data = b"".join(r + W.END.encode() for r in made)
    pieces = [(1, data[k : k + size]) for k in range(0, len(data), size)]
    assert [W.assemble([h for h in headers if h[0] != "Content-Length"], block) for headers, block in W._records(pieces)] == made
    for cut in ([(1, data[:-20])], [(1, data[:-20]), (2, data)], [(1, b"junk" + data)]):
        with pytest.raises(ValueError, match="no record"):
            list(W._records(cut))


def test_plain_and_gzip_files_by_any_name(spark, tmp_path):
    records = [r + W.END.encode() for _, _, r in W.derive(W.respond(1, "u", PAGE)[1])]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "c.gzip").write_bytes(b"".join(records))
    assert sorted(r.kind for r in W.read_files(spark, str(tmp_path)).collect()) == ["conversion"] * 3 + ["metadata"] * 3


class Shown(HTMLParser):
    """The visible text of a page by the parser of the standard library, as words."""

    def __init__(self):
        super().__init__()
        self.hidden, self.words, self.links, self.title, self.in_title = 0, [], 0, [], False

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript", "template", "head")
        self.in_title |= tag == "title"
        self.links += tag == "a" and any(k == "href" for k, _ in attrs)

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript", "template", "head")
        self.in_title &= tag != "title"

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.hidden:
            self.words.append(data)


def test_query_against_a_second_derivation(spark):
    """Every page of the table: its words, title, links and digests made anew by other means, without the module."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op10_warc_derivatives"](spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        page = pages[r.page_id].html or ""
        data = page.encode()
        shown = Shown()
        shown.feed(page)
        own = "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(['response', str(r.page_id), pages[r.page_id].url or '', own]))}>"
        assert (r.response_id, r.payload_digest, r.payload_bytes, r.digest_agrees, r.linked) == (name, own, len(data), True, True)
        assert (r.url, r.n_links) == (pages[r.page_id].url, shown.links)
        assert (r.title or "") == " ".join("".join(shown.title).split())
        assert r.metadata_id == f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'metadata|' + name)}>"
        text = W.plain_text(page)
        assert "".join(text.split()) == "".join("".join(shown.words).split())
        assert (r.text_chars, r.text_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())

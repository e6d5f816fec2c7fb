"""WARC records: responses, and the metadata and plain-text records derived from them.

``responses`` makes response records of a table of pages. ``derivatives`` turns
each into two linked records: a metadata record, whose JSON block holds the
response's own headers, its HTTP headers, title, links and figures, and a
conversion record with its plain text. Both name the response in
WARC-Refers-To and repeat its target, date and payload digest, so that either
can be traced to its source and checked against it.

Records are rows with their header fields in order, so that any of them can be
looked up; ``record_text`` gives a record as it stands in a file, and
``write_warc`` writes files of whole records in parallel.

Results are defined as follows. A null page is an empty one; a null address is
``about:blank``. Record ids follow from role, address, page id and content, so
that a repeated task gives the same ones and equal pages of different ids keep
their own; equal rows share theirs. Pages without markup are text as they are,
broken markup is read as far as it goes. An empty table gives no record.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from orderflow.llm.common import bounded_groups, pick, ship, type_of

# The format's version, line ends, and the names of its header fields.
VERSION = "WARC/1.1"
LINE_END = "\r\n"
RECORD_END = "\r\n\r\n"

#: Names records are derived from; any address will do, as long as it stays.
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:records")
DATE = "2026-01-01T00:00:00Z"

HEADERS = ArrayType(
    StructType([StructField("name", StringType()), StructField("value", StringType())])
)

_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
#: The rest of a tag, to which a ">" in a quoted value still belongs.
_REST = r"[^<>=]*+(?:=(?:\s*+(?:\"[^\"]*+\"|'[^']*+'))?+[^<>=]*+)*+"
#: Attributes of a tag before the one looked for, and that one's value in one of three groups.
_BEFORE = r"(?:[^<>=]*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'<>]++))*?[^<>=]*?(?<![^\s/\"'])"
_VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
#: Comments, and what scripts and styles hold; their opening tags are group 1.
_NO_MARKUP = re.compile(rf"<!--.*?(?:-->|\Z)|(<(script|style)\b{_REST}>).*?(?:</\2\s*>|\Z)", re.I | re.S)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|li"
    rf"|main|nav|ol|p|pre|section|table|td|th|title|tr|ul|head|body|html)\b{_REST}>",
    re.I,
)
_TAG = re.compile(rf"<[/!?]?[a-zA-Z!?]{_REST}>")
_TITLE = re.compile(rf"<title\b{_REST}>(.*?)(?:</title|\Z)", re.I | re.S)
_LANG = re.compile(rf"<html\b{_BEFORE}lang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_ORIGIN = re.compile(r"https?://[^/?#\s]+")
_LINK = re.compile(
    rf"<(?:(a|area|base|link|img|script|iframe|source)\b{_BEFORE}(?:xlink:)?(href|src)|(form)\b{_BEFORE}(action)){_VALUE}", re.I
)
_SRCSET = re.compile(rf"<(img|source)\b{_BEFORE}(srcset){_VALUE}", re.I)
#: An address of a list of images, behind which its width or density may stand.
_CANDIDATE = re.compile(r"[\s,]*([^\s,]\S*)([^,]*)")


def digest(data: bytes) -> str:
    """A labelled digest as the format writes it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join(parts))}>"


def without_hidden(page: str) -> str:
    """A page without comments, scripts and the like."""
    return _HIDDEN.sub(" ", page)


def plain_text(page: str, shown: str | None = None) -> str:
    """The visible text of a page, one line per block; ``shown`` is the page without the hidden."""
    # Line ends of the markup are spaces; blocks and breaks make the lines.
    text = " ".join((without_hidden(page) if shown is None else shown).split())
    text = _BREAK.sub("\n", text)
    lines = html.unescape(_TAG.sub("", text)).split("\n")
    return "\n".join(filter(None, (" ".join(line.split()) for line in lines)))


def _absolute(value: str, address: str, origin: str | None) -> str:
    """``urljoin`` but for links that need none and addresses it refuses."""
    if origin and value[:1] == "/" and value[1:2] != "/" and "/." not in value:
        return origin + value
    if not value.startswith(("http://", "https://")):
        try:
            return urljoin(address, value)
        except ValueError:
            pass
    return value


def _candidates(value: str) -> list[str]:
    """The addresses of a ``srcset``; commas within an address belong to it, at its end they don't."""
    return [found.rstrip(",") for found, _ in _CANDIDATE.findall(value)]


def links(page: str, address: str) -> list[dict[str, str]]:
    """Links of a page as absolute addresses, in their order, those of scripts and noscript too.

    Relative ones start from the page's first ``base``, if it has any. Forms give
    their target, images the addresses of their ``srcset``, too.
    """
    shown = _NO_MARKUP.sub(lambda m: m[1] or " ", page)
    matches = [(m.start(), m[1] or m[3], m[2] or m[4], *m.groups("")[4:]) for m in _LINK.finditer(shown)]
    if "srcset" in shown or "SRCSET" in shown:
        matches = sorted([*matches, *((m.start(), *m.groups("")) for m in _SRCSET.finditer(shown))])
    found = []
    for _, tag, attribute, *values in matches:
        tag, attribute, value = tag.lower(), attribute.lower(), html.unescape("".join(values)).strip()
        targets = _candidates(value) if attribute == "srcset" else [value]
        found.extend((f"{tag}@/{attribute}", target) for target in targets)
    bases = [value for path, value in found if path == "base@/href"]
    if bases:
        address = _absolute(bases[0], address, None)
    origin = _ORIGIN.match(address)
    origin = origin and origin[0]
    return [{"path": path, "url": _absolute(value, address, origin)} for path, value in found if path[:5] != "base@"]


def _clean(value: str) -> str:
    """A header value can't hold line ends or other control characters."""
    if value.isprintable():
        return value.strip()
    return re.sub(r"[\x00-\x1f\x7f]+", " ", value).strip()


def _record(kind: str, fields: list[tuple[str, str]], block: str) -> dict:
    data = block.encode("utf-8", "surrogatepass")
    fields = [
        ("WARC-Type", kind),
        *fields,
        ("WARC-Block-Digest", digest(data)),
        ("Content-Length", str(len(data))),
    ]
    headers = [{"name": name, "value": _clean(value)} for name, value in fields]
    return {"type": kind, "headers": headers, "block": block}


def header(headers: list[dict], name: str) -> str | None:
    """The first value of a header field, whatever its case."""
    return next((h["value"] for h in headers if h["name"].lower() == name.lower()), None)


def response_record(key: str, address: str | None, page: str | None, date: str = DATE) -> dict:
    """The response record of a page, with the HTTP header it would come with."""
    address, page = _clean(address or "") or "about:blank", page or ""
    payload = page.encode("utf-8", "surrogatepass")
    http = LINE_END.join(
        ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    )
    fields = [
        ("WARC-Record-ID", record_id("response", address, key, digest(payload))),
        ("WARC-Date", date),
        ("WARC-Target-URI", address),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest(payload)),
    ]
    return _record("response", fields, http + RECORD_END + page)


def split_response(block: str) -> tuple[str, list[dict], str]:
    """Status line, HTTP headers and payload of a response's block."""
    head, _, payload = block.partition(RECORD_END)
    status, *lines = head.split(LINE_END)
    parts = [line.partition(":") for line in lines]
    return status, [{"name": n.strip(), "value": v.strip()} for n, _, v in parts], payload


def derived_records(headers: list[dict], block: str) -> list[dict]:
    """The metadata and the conversion record of a response."""
    status, http, page = split_response(block)
    source = header(headers, "WARC-Record-ID") or ""
    address = header(headers, "WARC-Target-URI") or "about:blank"
    date = header(headers, "WARC-Date") or DATE
    payload = header(headers, "WARC-Payload-Digest") or digest(page.encode("utf-8", "surrogatepass"))
    title, lang = _TITLE.search(page), _LANG.search(page)
    shown = without_hidden(page)
    text = plain_text(page, shown)
    language = [("WARC-Identified-Content-Language", lang[1].lower())] if lang else []
    own = {kind: record_id(kind, source, payload) for kind in ("metadata", "conversion")}

    def fields(kind: str, content: str, other: str) -> list[tuple[str, str]]:
        return [
            ("WARC-Record-ID", own[kind]),
            ("WARC-Refers-To", source),
            ("WARC-Concurrent-To", own[other]),
            ("WARC-Date", date),
            ("WARC-Target-URI", address),
            ("Content-Type", content),
            # The digest of the response's payload: what was converted, not what came out.
            ("WARC-Refers-To-Payload-Digest", payload),
        ]

    envelope = {
        "source-headers": [[h["name"], h["value"]] for h in headers],
        "http-status": status,
        "http-headers": [[h["name"], h["value"]] for h in http],
        "payload-digest": payload,
        "title": " ".join(html.unescape(_TAG.sub("", title[1])).split()) if title else None,
        "links": links(page, address),
        "text-digest": digest(text.encode("utf-8", "surrogatepass")),
        "text-characters": len(text),
    }
    metadata = json.dumps(envelope, ensure_ascii=False, separators=(",", ":"))
    return [
        _record("metadata", fields("metadata", "application/json", "conversion"), metadata),
        _record("conversion", [*fields("conversion", "text/plain; charset=utf-8", "metadata"), *language], text),
    ]


def _schema(id_col: str, kind) -> StructType:
    return StructType(
        [
            StructField(id_col, kind),
            StructField("type", StringType()),
            StructField("headers", HEADERS),
            StructField("block", StringType()),
        ]
    )


def _records(rows: DataFrame, schema: StructType, make) -> DataFrame:
    """Records that ``make`` gives for each row: the id column first, then its arguments."""

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            sizes = batch.column(batch.num_columns - 1).to_pylist()
            for low, high in bounded_groups(len(s) if s else 0 for s in sizes):
                part = batch.slice(low, high - low)
                columns = [part.column(i).to_pylist() for i in range(1, part.num_columns)]
                made = [(i, r) for i, values in enumerate(zip(*columns)) for r in make(*values)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array([i for i, _ in made], pa.int64())),
                        *[pa.array([r[f] for _, r in made], t) for f, t in zip(("type", "headers", "block"), arrow.types[1:])],
                    ],
                    schema=arrow,
                )

    ship(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def responses(df: DataFrame, id_col: str, url_col: str, html_col: str, date: str = DATE) -> DataFrame:
    """A response record per page: its id, ``type``, ``headers`` and ``block``."""
    rows = pick(df, id=id_col, url=url_col, html=html_col)
    rows = rows.select("id", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("url").cast("string"), F.col("html").cast("string"))
    return _records(rows, _schema(id_col, type_of(df, id_col)), lambda key, url, page: [response_record(key, url, page, date)])


def derivatives(records: DataFrame, id_col: str) -> DataFrame:
    """Metadata and conversion records of the response records among ``records``."""
    rows = pick(records, id=id_col, type="type", headers="headers", block="block")
    rows = rows.where("type = 'response'").select("id", "headers", F.coalesce("block", F.lit("")))
    return _records(rows, _schema(id_col, type_of(records, id_col)), lambda headers, block: derived_records(headers or [], block))


def header_value(name: str):
    """The value of a header field of a record row."""
    return F.get(F.filter("headers", lambda h: F.lower(h["name"]) == name.lower()), F.lit(0))["value"]


def record_text():
    """A record row as it stands in a file, but for the line ends that close it."""
    lines = F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"], F.lit(LINE_END)))
    return F.concat(F.lit(VERSION + LINE_END), F.array_join(lines, ""), F.lit(LINE_END), F.col("block"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Files of whole records, as many as the rows have partitions."""
    records.select(record_text().alias("value")).write.option("lineSep", RECORD_END).option(
        "compression", compression
    ).text(path)


def parse_warc(data: bytes) -> list[dict]:
    """Records of a file's bytes, by their stated lengths."""
    found, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8").split(LINE_END)
        if version != VERSION:
            raise ValueError(f"no record at byte {at}")
        parts = [line.partition(": ") for line in lines]
        headers = [{"name": n, "value": v} for n, _, v in parts]
        start = end + 4
        stop = start + int(header(headers, "Content-Length"))
        found.append({"type": header(headers, "WARC-Type"), "headers": headers, "block": data[start:stop].decode("utf-8", "surrogatepass")})
        at = stop + 4
    return found


def read_warc(df: DataFrame) -> DataFrame:
    """Records of whole files as ``binaryFile`` reads them; a file is a task's work, so keep files small."""
    schema = StructType([StructField("path", StringType()), StructField("place", LongType()), *_schema("x", StringType()).fields[1:]])

    def run(batches):
        import gzip

        from pyspark.sql.pandas.types import to_arrow_schema

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                rows = [{"path": path, "place": i, **r} for i, r in enumerate(parse_warc(data))]
                yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))

    ship(df.sparkSession)
    return df.select("path", "content").mapInArrow(run, schema)

"""WARC derivatives: each response record gives a linked metadata record and a plain-text conversion record.

Records are rows: a header (ordered name and value pairs) and a block.  Ids are name-based UUIDs of the source record
and the kind, so a repeated run gives the same records.  Both derivatives refer to their response
(`WARC-Refers-To`, target uri and date), the metadata record lists the response's header fields and digests and the
conversion's id, and the conversion carries its own block digest and the source's payload digest.  All of it is
row-local: a response and its derivatives never leave their partition.

Defined results: a null or empty html gives a response with an empty block and a conversion with an empty text; a null
url is written as no `WARC-Target-URI`; control characters in a url are percent-encoded, so a header cannot be forged;
a null id is named after the block alone; repeated rows give equal records each; no rows, no records; columns beyond
id, url, html and the header columns asked for are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from covlens.llm.batches import slices

_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:covlens:warc")
_HIDDEN = re.compile(r"(?i)<!--|<!\[CDATA\[|<(script|style|noscript|template|svg|head)\b")
_CLOSE = {name: re.compile(rf"(?i)</{name}\s*>") for name in ("script", "style", "noscript", "template", "svg", "head", "title")}
_BREAK = re.compile(r"(?i)</?(?:p|div|br|hr|h[1-6]|li|ul|ol|tr|table|section|article|header|footer|nav|aside|main"
                    r"|blockquote|pre|form|dl|dt|dd|figure|figcaption|title|body|html)\b[^>]*>")
_TAG = re.compile(r"<!?/?[a-zA-Z][^>]*>")
_TITLE = re.compile(r"(?i)<title\b[^>]*>")
_HTML = re.compile(r"(?i)<html\b")
_LANG = re.compile(r"""(?i)\b(?=lang\s*=\s*["']?([A-Za-z-]+))""")

SCHEMA = ("page_id bigint, record_type string, record_id string, refers_to string, target_uri string, "
          "headers array<struct<name:string,value:string>>, block binary, record binary")


def digest(data: bytes) -> str:
    """`sha1:` and the Base32 of the SHA-1, as digests are written in web archives."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, source: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind}|{source}')}>"


def _visible(html: str) -> str:
    """Without comments, CDATA and elements that are not shown, each replaced by a line end; one that is never closed
    stays, but an unclosed script or style hides the rest.  One forward pass: a closing mark that was not found once is
    not looked for again, and the next `>` is looked for once, so unclosed marks cost no second scan."""
    out, done, at, gt, unclosed = [], 0, 0, -1, set()

    def closing(name: str, start: int) -> int:
        """End of the first closing mark from `start` on, or -1."""
        if name in unclosed:
            return -1
        if name in _CLOSE:
            m = _CLOSE[name].search(html, start)
            end = m.end() if m else -1
        else:
            k = html.find(name, start)
            end = k + len(name) if k >= 0 else -1
        if end < 0:
            unclosed.add(name)
        return end

    while m := _HIDDEN.search(html, at):
        at = m.end()
        if m[1]:
            name = m[1].lower()
            if gt < at and gt != len(html):
                gt = html.find(">", at)
                gt = len(html) if gt < 0 else gt
            end = closing(name, gt + 1) if gt < len(html) else -1
            if end < 0 and name in ("script", "style"):
                end = len(html)
        else:
            end = closing("-->" if m[0] == "<!--" else "]]>", at)
        if end >= 0:
            out += [html[done:m.start()], "\n"]
            done = at = end
    return "".join([*out, html[done:]])


def _sub_tags(pattern: re.Pattern, by: str, html: str) -> str:
    """pattern.sub, not tried beyond the last `>`, where no tag can end."""
    cut = html.rfind(">") + 1
    return pattern.sub(by, html[:cut]) + html[cut:]


def _title(html: str) -> str | None:
    """The first title's content.  Later openings cannot be closed where the first is not."""
    opening = _TITLE.search(html, 0, html.rfind(">") + 1)
    closed = _CLOSE["title"].search(html, opening.end()) if opening else None
    return html[opening.end():closed.start()] if closed else None


def _language(html: str) -> str | None:
    """The last lang attribute of the first html tag that has one."""
    at = 0
    while tag := _HTML.search(html, at):
        at = html.find(">", tag.end())
        at = len(html) if at < 0 else at
        found = [m[1] for m in _LANG.finditer(html, tag.end(), at)]
        if found:
            return found[-1].lower()
    return None


def plain_text(html: str) -> str:
    """The text a reader sees: no comments, scripts, styles or head; block elements end lines; references decoded;
    white space within a line collapsed; no empty lines.  Linear in the page, whatever is left unclosed in it."""
    text = _sub_tags(_TAG, "", _sub_tags(_BREAK, "\n", _visible(html)))
    lines = (" ".join(x.split()) for x in entities.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def _safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def derive(page_id: int | None, url: str | None, html: str | None, date: str,
           extra: Sequence[tuple[str, str]] = ()) -> list[tuple]:
    """(type, id, refers-to, target uri, headers, block) of the response, metadata and conversion records of a page."""
    body = (html or "").encode()
    uri = None if url is None else _safe(url)
    target = [("WARC-Target-URI", uri)] if uri else []
    payload = digest(body)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body)
    block = http + body
    ids = {k: record_id(k, f"{page_id}|{url}|{payload}") for k in ("response", "metadata", "conversion")}

    def headers(kind: str, content: str, data: bytes, more: list[tuple[str, str]]) -> list[tuple[str, str]]:
        return [("WARC-Type", kind), ("WARC-Record-ID", ids[kind]), ("WARC-Date", date), *target, *more,
                ("WARC-Block-Digest", digest(data)), ("Content-Type", content), ("Content-Length", str(len(data)))]

    source = headers("response", "application/http; msgtype=response", block, [("WARC-Payload-Digest", payload)])
    refers = [("WARC-Refers-To", ids["response"]), *([("WARC-Refers-To-Target-URI", uri)] if uri else []),
              ("WARC-Refers-To-Date", date)]
    text = plain_text(html or "")
    title, lang = _title(html or ""), _language(html or "")
    fields = [("source-" + k.lower(), v) for k, v in source] + [(f"source-{k.lower()}", _line(v)) for k, v in extra]
    fields += [("title", _line(entities.unescape(_sub_tags(_TAG, "", title))))] if title is not None else []
    fields += [("language", lang)] if lang else []
    fields += [("conversion", ids["conversion"]), ("conversion-payload-digest", digest(text.encode()))]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    conv = text.encode()
    return [
        ("response", ids["response"], None, uri, source, block),
        ("metadata", ids["metadata"], ids["response"], uri,
         headers("metadata", "application/warc-fields", meta, [*refers, ("WARC-Concurrent-To", ids["conversion"])]), meta),
        ("conversion", ids["conversion"], ids["response"], uri,
         headers("conversion", "text/plain; charset=utf-8", conv, [*refers, ("WARC-Source-Payload-Digest", payload)]), conv),
    ]


def _line(value: str) -> str:
    return " ".join(value.split())


def build(pages: DataFrame, date: str, kinds: Sequence[str] = ("metadata", "conversion"), key: str = "page_id",
          url: str = "url", html: str = "html", header_columns: Sequence[str] = (), compress: bool = False) -> DataFrame:
    """The records of `kinds` for every page.  `record` is the record as it stands in a file (a gzip member with
    `compress`): the column's values one after the other are a valid file.  `date` is the capture's WARC-Date;
    `header_columns` are source headers to keep in the metadata record."""
    chosen, extra = set(kinds), list(header_columns)
    select = [pages[key].cast("bigint").alias("_key"), pages[url].alias("_url"), pages[html].alias("_html")]
    select += [pages[c].cast("string").alias(f"_x{i}") for i, c in enumerate(extra)]
    pairs = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_html"):
                out = []
                for k, u, h, *x in zip(*(c.to_pylist() for c in part.columns)):
                    for kind, rid, refers, uri, headers, block in derive(
                            k, u, h, date, [(n, v) for n, v in zip(extra, x) if v is not None]):
                        if kind in chosen:
                            raw = _record(headers, block)
                            out.append((k, kind, rid, refers, uri, [{"name": a, "value": b} for a, b in headers], block,
                                        gzip.compress(raw, 6, mtime=0) if compress else raw))
                cols = [*zip(*out)] if out else [()] * 8
                kinds_ = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pairs, pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds_)],
                    ["page_id", "record_type", "record_id", "refers_to", "target_uri", "headers", "block", "record"])

    return pages.select(*select).mapInArrow(run, SCHEMA)

"""WARC derivative builder: metadata and plain-text conversion records linked to the responses they were made from.

A page is read in Arrow batches, in time that grows with its length whatever is left unclosed in it; records are put together
in DataFrame functions.  Both are a map over the rows.  Record ids are named by what a record holds, so a task that runs twice
gives the same ids; captures that are equal in every respect share them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import adding, decoded, small

EOL = "\r\n"
CAPTURED = "2024-01-01T00:00:00Z"
# What leaves no text: comments, and these elements with all inside them.
_HIDDEN = re.compile(r"<(?:(!--)|(script|style|title)\b)", re.IGNORECASE | re.ASCII)
_CLOSERS = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE | re.ASCII) for name in ("script", "style", "title")}
_SPACE = re.compile(r"[ \t\r\n\f\x0B]+")
# Tags that break a line, and all other tags; used where a ">" follows only.
_BREAKS = re.compile(
    r"</?(?:p|div|br|hr|li|ul|ol|dl|dt|dd|h[1-6]|tr|td|th|table|section|article|header|footer|nav|main|aside|pre|blockquote|head|body|html)\b[^>]*>",
    re.IGNORECASE | re.ASCII,
)
_TAGS = re.compile(r"<[/!?A-Za-z][^>]*>")
_OPENERS = {name: re.compile(rf"<{name}\b", re.IGNORECASE | re.ASCII) for name in ("a", "html", "title")}
_LANG = re.compile(r"\blang\s*+=\s*+[\"']?([A-Za-z-]+)", re.IGNORECASE | re.ASCII)
_HREF = re.compile(r"\bhref\s*+=\s*+[\"']([^\"'>]*)", re.IGNORECASE | re.ASCII)
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}  # the ampersand last


def digest(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """Name-based URN: the MD5 of the parts, with the version and variant of a name-based UUID."""
    h = F.md5(F.concat_ws("|", *parts).cast("binary"))
    pieces = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)),
              F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _unescaped(text: str) -> str:
    for entity, character in ENTITIES.items():
        text = text.replace(entity, character)
    return text


def _one_line(text: str) -> str:
    return _SPACE.sub(" ", text).strip(" ")


def _untagged(text: str, breaks: str | None = None) -> str:
    """``text`` without tags; what follows the last ``>`` holds none, however many begin there."""
    end = text.rfind(">") + 1
    head = text[:end]
    return _TAGS.sub("", head if breaks is None else _BREAKS.sub(breaks, head)) + text[end:]


def shown(page: str) -> str:
    """``page`` with a space for each comment, script, style sheet and title that is closed; unclosed ones stay."""
    out, at, open_for_good = [], 0, set()
    for mark in _HIDDEN.finditer(page):
        kind = (mark[1] or mark[2]).lower()
        if mark.start() < at or kind in open_for_good:
            continue
        if kind == "!--":
            end = page.find("-->", mark.end()) + 3
        else:
            close = _CLOSERS[kind].search(page, mark.end())
            end = close.end() if close else 2
        if end < 3:
            open_for_good.add(kind)  # nor is any later one closed
            continue
        out += [page[at : mark.start()], " "]
        at = end
    return "".join(out) + page[at:]


def plain_text(visible: str) -> str:
    """Text of a page's visible part: a line per block, white space collapsed, empty lines dropped."""
    text = _unescaped(_untagged(_SPACE.sub(" ", visible), "\n"))
    return re.sub(r" ?\n[ \n]*", "\n", re.sub(" +", " ", text)).strip(" \n")


def title_of(page: str) -> str:
    """Text of the first title that is closed; empty if none is."""
    mark = _OPENERS["title"].search(page)
    begin = page.find(">", mark.end()) + 1 if mark else 0
    close = _CLOSERS["title"].search(page, begin) if begin else None
    return _one_line(_unescaped(_untagged(page[begin : close.start()]))) if close else ""


def _in_tags(page: str, name: str, attribute: re.Pattern) -> Iterator[str]:
    """Values of an attribute in tags of one name; a tag that nothing closes reaches to the end of the page."""
    at = limit = 0
    while mark := _OPENERS[name].search(page, at):
        if mark.end() > limit:
            limit = page.find(">", mark.end())
            limit = len(page) if limit < 0 else limit
        found = attribute.search(page, mark.end(), limit)
        if found:
            yield found[1]
        at = found.end() if found else limit


def read_page(page: str) -> tuple[str, str, list[str], str]:
    """Title, language, links in page order, and text."""
    visible = shown(page)
    links = [_one_line(_unescaped(x)) for x in _in_tags(visible, "a", _HREF)]
    return title_of(page), next(_in_tags(page, "html", _LANG), ""), links, plain_text(visible)


def _read(responses: DataFrame) -> DataFrame:
    """``responses`` with ``title, language, links, text`` in place of the payload."""
    kept = [c for c in responses.columns if c != "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = list(zip(*map(read_page, decoded(batch.column("payload"))), strict=True)) if batch.num_rows else [()] * 4
            kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
            made = [pa.array(f, kind) for f, kind in zip(found, kinds, strict=True)]
            yield pa.record_batch([*[batch.column(c) for c in kept], *made], names=[*kept, "title", "language", "links", "text"])

    return responses.mapInArrow(run, adding(responses.select(*kept).schema, "title string, language string, links array<string>, text string"))


def _listed(name: str, values: Column) -> Column:
    return F.array_join(F.transform(values, lambda x: F.concat(F.lit(name), x, F.lit(EOL))), "")


def responses(pages: DataFrame, url: str = "url", html: str = "html", captured: str = CAPTURED) -> DataFrame:
    """Response records of raw pages: ``(row, target, captured, http, payload, response_id, payload_digest)``.

    Null URLs and pages are empty.
    """
    got = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    shaped = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html]).alias("row"),
        F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("target"), F.lit(captured).alias("captured"), got.alias("payload"),
        digest(got).alias("payload_digest"),
    )
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(EOL * 2))
    return shaped.withColumn("http", http).withColumn(
        "response_id", record_id(F.lit("response"), F.col("target"), F.col("captured"), F.col("payload_digest"))
    )


def derivatives(captures: DataFrame) -> DataFrame:
    """Two records per response of ``captures`` (the shape of ``responses``): ``metadata``, then ``conversion``.

    Columns: ``row, record_type, record_id, refers_to, target, captured, content_type, content, block_digest, n_bytes,
    source_payload_digest, n_links, record``.  ``record`` is the whole WARC record without its closing blank lines.  Both
    name the response's id, target and date in WARC-Refers-To headers.  Metadata is a list of fields: the response's HTTP
    headers and digest, title, language and outgoing links, in the order of the page.  The conversion is the page's text.

    Empty payloads give records too, with no text and no links.  Line ends inside URLs are escaped, so that no header
    breaks.  Repeated responses give repeated records; an empty table gives none.
    """
    target = F.replace(F.replace("target", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    fields = F.concat(
        F.lit("title: "), "title", F.lit(f"{EOL}language: "), "language",
        F.lit(f"{EOL}source-payload-digest: "), F.col("payload_digest"), F.lit(EOL),
        _listed("source-header: ", F.split(F.regexp_replace("http", r"(\r\n)+$", ""), r"\r\n")), _listed("outlink: ", F.col("links")),
    )
    read = _read(captures).withColumn("target", target)
    made = read.select(
        "row", "target", "captured", "payload_digest", "response_id", F.size("links").alias("n_links"),
        F.explode(F.array(
            F.struct(F.lit("metadata").alias("kind"), F.lit("application/warc-fields").alias("type"), fields.alias("content")),
            F.struct(F.lit("conversion").alias("kind"), F.lit("text/plain; charset=utf-8").alias("type"), F.col("text").alias("content")),
        )).alias("d"),
    ).select("*", "d.kind", "d.type", "d.content", digest(F.col("d.content")).alias("block_digest"))
    named = made.withColumn("record_id", record_id(F.col("kind"), F.col("response_id"), F.col("block_digest")))
    size = F.octet_length("content")
    headers = F.concat_ws(
        EOL, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "kind"), F.concat(F.lit("WARC-Record-ID: "), "record_id"),
        F.concat(F.lit("WARC-Date: "), "captured"), F.concat(F.lit("WARC-Target-URI: "), "target"),
        F.concat(F.lit("WARC-Refers-To: "), "response_id"), F.concat(F.lit("WARC-Refers-To-Target-URI: "), "target"),
        F.concat(F.lit("WARC-Refers-To-Date: "), "captured"), F.concat(F.lit("WARC-Block-Digest: "), "block_digest"),
        F.concat(F.lit("Content-Type: "), "type"), F.concat(F.lit("Content-Length: "), size.cast("string")), F.lit(EOL),
    )
    return named.select(
        "row", F.col("kind").alias("record_type"), "record_id", F.col("response_id").alias("refers_to"), "target", "captured",
        F.col("type").alias("content_type"), "content", "block_digest", size.cast("bigint").alias("n_bytes"),
        F.col("payload_digest").alias("source_payload_digest"), F.col("n_links").cast("bigint").alias("n_links"),
        F.concat(headers, "content").alias("record"),
    )


def write(records: DataFrame, folder: str) -> None:
    """The records as WARC files in ``folder``, one per task: each record followed by two line ends."""
    records.select("record").write.option("lineSep", EOL * 2).text(folder)

"""Derivatives of WARC responses: a metadata record and a plain-text conversion for each.

Both refer to the response by its record id, keep its target and date, and carry digests of
their own blocks. The metadata record holds the source's HTTP headers, its digests, the title
and the links; the conversion record holds the text of the page.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstar.llm.common import bounded_batches

EPOCH = "1970-01-01T00:00:00Z"
RESPONSE = "record_id string, target_uri string, date string, block binary"
RECORD = (
    "record_id string, record_type string, refers_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, source_payload_digest string, "
    "headers string, block binary"
)

# the rest of a tag: a > in a quoted value does not end it, unless the quote is never closed
_REST = r"(?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>)"
# what has no text of its own, up to its end or that of the page
_HIDDEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(script|style|template|noscript)\b{_REST}.*?(?:</\1\s*>|\Z)",
    re.IGNORECASE | re.DOTALL,
)
_BREAKS = re.compile(
    rf"<\s*/?\s*(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|header|footer|nav|title|head|"
    rf"body|blockquote|pre|hr|dt|dd|main|aside|form|option)\b{_REST}",
    re.IGNORECASE,
)
_TAG = re.compile(rf"<[!/?a-zA-Z]{_REST}")
_BLANKS = re.compile(r"[^\S\n]+")
_TITLE = re.compile(rf"<title\b{_REST}(.*?)</title\s*>", re.IGNORECASE | re.DOTALL)
_LINKING = re.compile(rf"<(a|link|img|script|iframe|area)\b({_REST})", re.IGNORECASE)
_ATTRIBUTE = re.compile(
    r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.DOTALL
)
_CHARSET = re.compile(r"charset=[\"']?([\w.:-]+)", re.IGNORECASE)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(source: str, kind: str) -> str:
    """A record id that depends on the source and the kind only, so a rerun gives it again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{kind}')}>"


def page_text(markup: str) -> str:
    """Text of a page: a line for each block, without tags, scripts, styles and comments."""
    text = _BREAKS.sub("\n", _HIDDEN.sub(" ", markup))
    text = _BLANKS.sub(" ", html.unescape(_TAG.sub("", text)))
    return "\n".join(line for line in (x.strip() for x in text.split("\n")) if line)


def page_links(markup: str) -> list[dict[str, str]]:
    """Every ``href`` and ``src`` of the tags that link to something, in their order."""
    return [
        {"tag": tag[1].lower(), "attr": found[1].lower(), "url": html.unescape(found[2] or found[3] or found[4] or "")}
        for tag in _LINKING.finditer(markup)
        for found in _ATTRIBUTE.finditer(tag[2])
        if found[1].lower() in ("href", "src") and found[0] != found[1]
    ]


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in their order, and payload of a response block.

    A block that does not begin as HTTP is all payload.
    """
    if not block.startswith(b"HTTP/"):
        return "", [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    first, *lines = head.decode("latin-1").split("\r\n")
    pairs = [line.partition(":") for line in lines if line]
    return first, [(name.strip(), value.strip()) for name, _, value in pairs], payload


def derive(record_id: str, target: str | None, date: str | None, block: bytes) -> list[tuple]:
    status, headers, payload = http_parts(block)
    kind = next((v for k, v in headers if k.lower() == "content-type"), "")
    charset = _CHARSET.search(kind)
    try:
        markup = payload.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:  # a name that no codec has
        markup = payload.decode("utf-8", "replace")
    source_digest = digest(payload)
    title = _TITLE.search(markup)
    facts = {
        "source": {
            "record_id": record_id,
            "block_digest": digest(block),
            "payload_digest": source_digest,
            "payload_length": len(payload),
            "status": status,
            "headers": [list(h) for h in headers],
        },
        "title": html.unescape(title[1]).strip() if title else None,
        "links": page_links(markup),
    }
    made = [
        ("metadata", "application/json", json.dumps(facts, ensure_ascii=False).encode()),
        ("conversion", "text/plain; charset=utf-8", page_text(markup).encode("utf-8", "replace")),
    ]
    out = []
    for record_type, content_type, data in made:
        own = derived_id(record_id, record_type)
        named = [
            ("WARC-Type", record_type),
            ("WARC-Record-ID", own),
            ("WARC-Refers-To", record_id),
            ("WARC-Target-URI", target),
            ("WARC-Date", date),
            ("WARC-Block-Digest", digest(data)),
            ("Content-Type", content_type),
            ("Content-Length", str(len(data))),
        ]
        text = "\r\n".join(f"{k}: {v}" for k, v in named if v is not None)
        out.append(
            (own, record_type, record_id, target, date, content_type, len(data), digest(data),
             source_digest, text, data)
        )
    return out


def derivatives(responses: DataFrame) -> DataFrame:
    """Two records for each response (``record_id``, ``target_uri``, ``date``, ``block``).

    A NULL or empty block gives records of an empty page; a NULL target or date is left out of
    the headers. A response without a record id cannot be referred to and gives no records.
    Repeated responses give repeated records with equal ids. Pages are text in the charset of
    their content type, UTF-8 where there is none; bytes that do not fit become U+FFFD.
    """
    bounded_batches(responses.sparkSession)
    names = [part.split()[0] for part in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, held = [], 0
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                record_id, target, date, block = row
                made += derive(record_id, target, date, block or b"")
                held += len(made[-1][-1]) + len(made[-2][-1])
                if held > 1 << 23:
                    yield _batch(made, names)
                    made, held = [], 0
            if made:
                yield _batch(made, names)

    rows = responses.filter(F.col("record_id").isNotNull())
    return rows.select("record_id", "target_uri", "date", "block").mapInArrow(run, RECORD)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    special = {"block": pa.binary(), "content_length": pa.int64()}
    kinds = [special.get(n, pa.string()) for n in names]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names
    )


def response_id(page_id: Column, url: Column) -> Column:
    """A record id made of the page's id and address."""
    h = F.md5(F.concat_ws("|", page_id.cast("string"), url))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", *[F.substring(h, at, n) for at, n in cuts]),
        F.lit(">"),
    )


def responses_of(pages: DataFrame) -> DataFrame:
    """Raw pages (``page_id``, ``url``, ``html``) as response records, ``page_id`` kept."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(F.coalesce(F.col("html"), F.lit(""))).cast("string"),
        F.lit("\r\n\r\n"),
    ).cast("binary")
    return pages.select(
        "page_id",
        response_id(F.col("page_id"), F.col("url")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(EPOCH).alias("date"),
        F.concat(head, body).alias("block"),
    )


def write_records(records: DataFrame, path: str) -> None:
    """Write records as gzip-compressed text, WARC records one after another in each file.

    Every block made here is UTF-8 text. The last line break of a record is the writer's.
    """
    whole = F.concat(
        F.lit("WARC/1.0\r\n"),
        "headers",
        F.lit("\r\n\r\n"),
        F.decode("block", "UTF-8"),
        F.lit("\r\n"),
    )
    writer = records.select(whole.alias("value")).write
    writer.option("compression", "gzip").option("lineSep", "\r\n").text(path)

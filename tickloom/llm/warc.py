"""WARC derivative builder.

From every `response` record come two linked records: `metadata` (title, links, source headers and
digests as warc-fields) and `conversion` (the page as plain text). Both carry the response's record id
in WARC-Refers-To and keep its target URI and date. Record ids are computed from what they
stand for, so a repeated run gives the same ids.

A narrow map over the responses: no exchange, memory follows the longest page.

Defined cases: a null or empty page gives a response without payload, an empty conversion and a
metadata record without title; repeated rows give repeated records with the same ids; a block that is
no HTTP message is taken as payload without headers; an empty table gives an empty result; input
columns named like a result give way.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.llm.lean import lean

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"

# Elements whose content is no text, and elements that begin a new line.
HIDDEN = ("script", "style", "noscript", "template")
LINE = frozenset(
    "address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li "
    "main nav ol p pre section table td th title tr ul".split()
)

_HIDDEN = re.compile(r"<!--|<(" + "|".join(HIDDEN) + r")\b", re.I)
_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)[^<>]*>|<[!?][^<>]*>")
_TITLE = re.compile(r"<title[^<>]*>([^<]*)", re.I)
_LINK = re.compile(r"""<a\s[^<>]*?href\s*=\s*(?:"([^"<>]*)"|'([^'<>]*)')""", re.I)
_SPACE = re.compile(r"[ \t\r\f\v ]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


def visible(page: str) -> str:
    """The page without comments and elements that hold no text; one that is never closed runs to the end."""
    out, at, low = [], 0, None
    while m := _HIDDEN.search(page, at):
        out.append(page[at : m.start()])
        close = f"</{m[1].lower()}" if m[1] else "-->"
        low = page.lower() if low is None or len(low) != len(page) else low
        end = low.find(close, m.end()) if len(low) == len(page) else page.find(close, m.end())
        if end < 0:
            return "".join(out)
        at = page.find(">", end) + 1 or len(page)
    out.append(page[at:])
    return "".join(out)


def plain_text(page: str) -> str:
    marked = _TAG.sub(lambda m: "\n" if (m[1] or "").lower() in LINE else "", visible(page))
    lines = (_SPACE.sub(" ", x).strip() for x in html.unescape(marked).split("\n"))
    return "\n".join(x for x in lines if x)


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and payload of an HTTP message."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", [], block
    status, *lines = head.decode("utf-8", "replace").split("\r\n")
    return status, [(k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines)], payload


RECORD = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, content_type string, "
    "content_length long, block_digest string, payload_digest string, block binary"
)
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def _record(kind: str, rid: str, refers: str | None, uri: str, date: str, content: str, block: bytes, payload: bytes) -> tuple:
    return kind, rid, refers, uri, date, content, len(block), digest(block), digest(payload), block


def response(page: str, uri: str, date: str = DATE) -> tuple:
    payload = page.encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    rid = record_id("response", uri, date, digest(payload))
    return _record("response", rid, None, uri, date, "application/http; msgtype=response", head.encode() + payload, payload)


def derive(source: dict) -> Iterator[tuple]:
    """The metadata and the conversion record of a response."""
    status, headers, payload = http_parts(source["block"] or b"")
    page = payload.decode("utf-8", "replace")
    rid, uri, date = source["record_id"] or "", source["target_uri"] or "", source["warc_date"] or DATE
    seen = visible(page)
    title = _TITLE.search(seen)
    text = plain_text(page).encode()
    conversion = record_id("conversion", rid)
    fields = [("source-record", rid), ("source-block-digest", source["block_digest"] or digest(source["block"] or b"")),
              ("source-payload-digest", source["payload_digest"] or digest(payload))]
    fields += [("source-status", status)] if status else []
    fields += [(f"source-header-{k}", v) for k, v in headers]
    fields += [("title", " ".join(html.unescape(title[1]).split()))] if title else []
    fields += [("conversion-record", conversion), ("text-digest", digest(text))]
    fields += [("outlink", html.unescape(a or b).replace("\n", " ").replace("\r", " ")) for a, b in _LINK.findall(seen)]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    yield _record("metadata", record_id("metadata", rid), rid, uri, date, "application/warc-fields", meta, meta)
    yield _record("conversion", conversion, rid, uri, date, "text/plain; charset=utf-8", text, text)


def _map(df: DataFrame, taken: list[str], make) -> DataFrame:
    """Columns of `df` not named like a record's, and the records that `make(row)` gives, in order."""
    fields = StructType.fromDDL(RECORD).fields
    kept = [c for c in df.columns if c not in [f.name for f in fields]]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_"))
    frame = df.select(row.alias("_row"), F.struct(*[F.col(f"`{c}`") for c in taken]).alias("_in"))
    out = StructType([frame.schema["_row"], *fields])

    @lean
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                made = [(r, x) for r, row in enumerate(part.column(1).to_pylist()) for x in make(row)]
                columns = [pa.array([x[c] for _, x in made], _KINDS[f.dataType.simpleString()]) for c, f in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array([r for r, _ in made], pa.int64())), *columns], names=out.names)

    return frame.mapInArrow(run, out).select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], *[f.name for f in fields])


def responses(pages: DataFrame, url: str = "url", page: str = "html", date: str = DATE) -> DataFrame:
    """A `response` record for each page; the page and its address are left out of the other columns."""
    made = _map(pages, [url, page], lambda row: [response(row[page] or "", row[url] or "", date)])
    return made.drop(*{url, page} - set(StructType.fromDDL(RECORD).names))


def derivatives(records: DataFrame) -> DataFrame:
    """The metadata and conversion records of all `response` records; other records are passed over."""
    taken = ["record_id", "target_uri", "warc_date", "block_digest", "payload_digest", "block"]
    return _map(records.where(F.col("warc_type") == "response"), taken, derive)


def write(records: DataFrame, path: str) -> None:
    """Records with UTF-8 blocks as .warc text files, a file for each partition."""
    def line(name: str, column: str):
        return F.when(F.col(column).isNotNull(), F.concat(F.lit(name + ": "), F.col(column).cast("string"), F.lit("\r\n"))).otherwise("")

    head = F.concat(
        F.lit(VERSION + "\r\n"), line("WARC-Type", "warc_type"), line("WARC-Record-ID", "record_id"), line("WARC-Refers-To", "refers_to"),
        line("WARC-Target-URI", "target_uri"), line("WARC-Date", "warc_date"), line("WARC-Block-Digest", "block_digest"),
        line("WARC-Payload-Digest", "payload_digest"), line("Content-Type", "content_type"), line("Content-Length", "content_length"))
    # a record ends with two empty lines; the writer adds the last line feed
    text = F.concat(head, F.lit("\r\n"), F.decode("block", "utf-8"), F.lit("\r\n\r"))
    records.select(text.alias("value")).write.option("lineSep", "\n").text(path)


def parse(data: bytes) -> Iterator[tuple]:
    """Records of a WARC file."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        gap = data.index(b"\r\n\r\n", start)
        pairs = (x.partition(":") for x in data[start:gap].decode("utf-8", "replace").split("\r\n")[1:])
        h = {k.strip().lower(): v.strip() for k, _, v in pairs}
        size = int(h.get("content-length", 0))
        block = data[gap + 4 : gap + 4 + size]
        yield (h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"),
               h.get("content-type"), size, h.get("warc-block-digest"), h.get("warc-payload-digest"), block)
        at = gap + 4 + size


def unzipped(data: bytes) -> bytes:
    """The content of a gzip file of any number of members (WARC files have one a record); other data as it is."""
    out = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out) if out else data


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under `path`, whatever their names, also gzip-compressed ones. A file is one task's work and
    fits into its memory; names that begin with `_` or `.` are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return _map(files, ["content"], lambda row: parse(unzipped(bytes(row["content"])))).drop("content")

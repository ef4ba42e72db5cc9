"""WARC derivatives: metadata and plain-text conversion records of responses.

Every response record gives two linked records. The metadata record
(``application/warc-fields``) keeps what the response said of itself: the
source record's own WARC headers, HTTP status and headers, title, out-links,
payload digest. The conversion record (``text/plain``) is the page's visible
text. Both refer to the response by ``WARC-Refers-To``, with its target URI and
date, keep its IP, its concurrent and warcinfo ids and its payload digest (the
one that the source states; else that of the body without transfer coding), and
carry digests of their own blocks. Record ids are name-based UUIDs of the
source's id and the kind, so a rerun, or a task run twice, makes the same records.

One narrow pass over the responses; no shuffle.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .html_text import Page

SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, names that are URLs
#: Stands for a date that is not known, as a record must have one.
EPOCH = "1970-01-01T00:00:00Z"
#: Bytes that a payload's content coding may give; a larger one is kept as it came.
MAX_PAYLOAD = 256 << 20
#: Bytes that are read or decompressed at once, and records that are made at once.
CHUNK, ROWS = 1 << 20, 200
RESPONSE = "record_id string, target_uri string, date string, ip string, headers map<string,string>, block binary"
DERIVED = (
    "source_id string, record_type string, record_id string, refers_to string, target_uri string, date string, ip string, content_type string, "
    "block_digest string, refers_to_payload_digest string, content_length long, source_headers map<string,string>, block binary"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data, usedforsecurity=False).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, '|'.join('' if p is None else str(p) for p in parts))}>"


def responses(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", date: Column | str = EPOCH) -> DataFrame:
    """Response records of stored pages: ``key`` and the columns of ``RESPONSE``.
    ``date``: a column of dates as WARC writes them, or one date for all. A null
    page has an empty payload, a null URL an empty target, a null date
    ``EPOCH``. The id comes from key, URL and payload, so repeated rows repeat
    their record; an empty table gives none."""
    when = F.coalesce(date, F.lit(EPOCH)) if isinstance(date, Column) else F.lit(date)
    page = pages.select(
        F.col(key).alias("key"), F.col(key).cast("string").alias("key_text"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("body"), when.alias("date")
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                b = whole.slice(a, ROWS)
                keys, urls, bodies = (b.column(c).to_pylist() for c in ("key_text", "url", "body"))
                ids = [record_id(k, u, hashlib.sha1(x, usedforsecurity=False).hexdigest()) for k, u, x in zip(keys, urls, bodies)]
                headers = [[("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", digest(x))] for x in bodies]
                blocks = [head % len(x) + x for x in bodies]
                columns = [b.column("key"), pa.array(ids, pa.string()), b.column("url"), b.column("date"), pa.nulls(len(ids), pa.string()), pa.array(headers, pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "record_id", "target_uri", "date", "ip", "headers", "block"])

    kind = dict(page.dtypes)["key"]
    return page.mapInArrow(make, f"key {kind}, {RESPONSE}").withColumnRenamed("key", key)


def unchunked(body: bytes) -> bytes:
    """A body without its chunked transfer coding; one that is not so coded
    after all comes back as it is, one that breaks off gives what there is."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at : end if end >= 0 else len(body)].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9a-fA-F]{1,15}", size):
            return b"".join(out) if out else body
        n = int(size, 16)
        if not n or end < 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 2 + n + 2
        if at >= len(body):
            return b"".join(out)


def decoded(body: bytes, coding: str, limit: int = MAX_PAYLOAD) -> bytes:
    """A body without its content coding; as it came if the coding is unknown or
    not the one stated, or gives more than ``limit`` bytes."""
    out = body
    for one in reversed([c.strip() for c in coding.lower().split(",") if c.strip()]):
        if one in ("gzip", "x-gzip"):
            kinds = (31,)
        elif one == "deflate":
            kinds = (15, -15)
        elif one == "identity":
            continue
        else:
            return body
        for bits in kinds:
            plain = _inflated(out, bits, limit)
            if plain is not None:
                out = plain
                break
        else:
            return body
    return out


def _inflated(data: bytes, bits: int, limit: int) -> bytes | None:
    out, size = [], 0
    try:
        while data:
            one = zlib.decompressobj(bits)
            while not one.eof and data:
                part = one.decompress(data, CHUNK)
                data = one.unconsumed_tail
                out.append(part)
                size += len(part)
                if size > limit:
                    return None
            data = one.unused_data if bits == 31 and one.unused_data[:2] == b"\x1f\x8b" else b""
    except zlib.error:
        return None
    return b"".join(out)


def split_http(block: bytes) -> tuple[int | None, list[tuple[str, str]], bytes]:
    """Status, headers and body, without transfer coding, of an HTTP response; (None, [], block) if it is none."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")
    status = lines[0].split(" ")
    headers = [(a.strip(), b.strip()) for a, _, b in (x.partition(":") for x in lines[1:]) if a.strip()]
    if any(a.lower() == "transfer-encoding" and "chunked" in b.lower() for a, b in headers):
        body = unchunked(body)
    return int(status[1]) if len(status) > 1 and status[1].isdigit() else None, headers, body


def _decode(body: bytes, headers: list[tuple[str, str]]) -> str:
    kind = next((b for a, b in headers if a.lower() == "content-type"), "")
    named = re.search(r"charset=[\"']?([\w.:-]+)", kind, re.I) or re.search(r"<meta[^>]+charset=[\"']?([\w.:-]+)", body[:2048].decode("latin-1"), re.I)
    try:
        return body.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _line(name: str, value: object) -> str:
    clean = re.sub(r"[\r\n]+", " ", str(value))
    return f"{name}: {clean}\r\n"


def derived_records(rid: str | None, block: bytes, source: Mapping[str, str]) -> Iterator[tuple]:
    """(kind, type, block, payload digest) of the metadata and the conversion record of a response."""
    status, headers, body = split_http(block)
    stated = {k.lower(): v for k, v in source.items()}.get("warc-payload-digest")
    own = digest(body)
    payload = stated or own
    coding = ",".join(b for a, b in headers if a.lower() == "content-encoding")
    page = Page(_decode(decoded(body, coding) if coding else body, headers))
    fields = [_line("source-record-id", rid or ""), *[_line(f"source-warc-{k.lower().removeprefix('warc-')}", v) for k, v in sorted(source.items())]]
    fields += [_line("source-status", status if status is not None else ""), *[_line(f"source-header-{a.lower()}", v) for a, v in headers]]
    fields += [_line("source-payload-digest", payload), _line("title", page.title), *[_line("outlink", x) for x in page.links]]
    yield "metadata", "application/warc-fields", "".join(fields).encode("utf-8", "replace"), payload
    yield "conversion", "text/plain; charset=utf-8", page.visible().encode("utf-8", "replace"), payload


def derive(source: DataFrame, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Two rows (columns of ``DERIVED``, after the columns ``keep``) for every
    response record of ``source`` (columns of ``RESPONSE``).

    Null blocks count as empty, null headers as none; very long blocks are read
    whole, one at a time. Repeated records give repeated rows, an empty table
    none. A column of ``keep`` whose name a derived column has gets underscores
    behind its name."""
    kept = [f"k{i}" for i in range(len(keep))]
    rows = source.select(*[F.col(c).alias(k) for c, k in zip(keep, kept)], "record_id", "target_uri", "date", "ip", "headers", "block")
    names = [c.split()[0] for c in DERIVED.split(", ")]
    types = [pa.string()] * 10 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, ROWS):
                b = whole.slice(a, ROWS)
                out: list[list] = [[] for _ in names]
                for i in range(b.num_rows):
                    rid, uri, date, ip, headers, block = (b.column(c)[i].as_py() for c in ("record_id", "target_uri", "date", "ip", "headers", "block"))
                    for kind, mime, data, payload in derived_records(rid, block or b"", dict(headers or ())):
                        row = (rid, kind, record_id(rid, kind), rid, uri, date, ip, mime, digest(data), payload, len(data), headers or [], data)
                        for to, v in zip(out, row):
                            to.append(v)
                twice = pa.array([i // 2 for i in range(2 * b.num_rows)], pa.int32())
                columns = [b.column(k).take(twice) for k in kept] + [pa.array(v, t) for v, t in zip(out, types)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, *names])

    kinds = dict(rows.dtypes)
    found = rows.mapInArrow(make, ", ".join([*[f"{k} {kinds[k]}" for k in kept], DERIVED]))
    taken, titles = {n.lower() for n in names}, []
    for c in keep:
        while c.lower() in taken:
            c += "_"
        taken.add(c.lower())
        titles.append(c)
    return found.select(*[F.col(k).alias(c) for c, k in zip(titles, kept)], *names)


#: Headers of the source that its derived records share.
_SHARED = ("WARC-Concurrent-To", "WARC-Warcinfo-ID")


def serialize(derived: DataFrame, *, to: str = "record") -> DataFrame:
    """``derived`` with ``to``: each record as a gzip member of a WARC 1.1 file;
    members written one after the other are such a file."""

    @F.pandas_udf("binary")
    def pack(record: pd.DataFrame) -> pd.Series:
        out = []
        for r in record.itertuples(index=False):
            source = {k.lower(): (k, v) for k, v in dict(r.source_headers if r.source_headers is not None else {}).items()}
            head = "WARC/1.1\r\n" + _line("WARC-Type", r.record_type) + _line("WARC-Record-ID", r.record_id) + _line("WARC-Refers-To", r.refers_to or "")
            head += _line("WARC-Target-URI", r.target_uri or "") + _line("WARC-Date", r.date or EPOCH)
            head += _line("WARC-Refers-To-Target-URI", r.target_uri or "") + _line("WARC-Refers-To-Date", r.date or EPOCH)
            head += _line("WARC-IP-Address", r.ip) if r.ip else ""
            head += "".join(_line(n, source[n.lower()][1]) for n in _SHARED if n.lower() in source)
            head += _line("WARC-Block-Digest", r.block_digest) + _line("WARC-Refers-To-Payload-Digest", r.refers_to_payload_digest)
            head += _line("Content-Type", r.content_type) + _line("Content-Length", len(r.block))
            out.append(gzip.compress(head.encode("utf-8", "replace") + b"\r\n" + bytes(r.block) + b"\r\n\r\n", mtime=0))
        return pd.Series(out, dtype=object)

    names = ("record_type", "record_id", "refers_to", "target_uri", "date", "ip", "content_type", "block_digest", "refers_to_payload_digest", "source_headers", "block")
    return derived.withColumn(to, pack(F.struct(*names)))


def _plain(data: memoryview) -> Iterator[bytes]:
    """What a WARC file says, piece by piece: gzip members one after the other,
    or plain text. A damaged member gives what it can; the next one follows."""
    at = 0
    while at < len(data):
        if bytes(data[at : at + 2]) != b"\x1f\x8b":
            yield bytes(data[at : at + CHUNK])
            at += CHUNK
            continue
        one, begin = zlib.decompressobj(31), at
        try:
            while not one.eof and at < len(data):
                part = data[at : at + CHUNK]
                at += len(part)
                piece = one.decompress(part, CHUNK)
                while piece or one.unconsumed_tail:
                    yield piece
                    piece = one.decompress(one.unconsumed_tail, CHUNK) if one.unconsumed_tail else b""
            at -= len(one.unused_data)
        except zlib.error:
            following = _MEMBER.search(data, begin + 2)
            at = following.start() if following else len(data)


_MEMBER = re.compile(rb"\x1f\x8b\x08")


class _Reader:
    def __init__(self, pieces: Iterator[bytes]) -> None:
        self.pieces, self.held = pieces, bytearray()

    def more(self) -> bool:
        piece = next(self.pieces, None)
        if piece is None:
            return False
        self.held += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to ``mark``, which is left out; None at the end."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                return None
        out = bytes(self.held[:at])
        del self.held[: at + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip_blank(self) -> bool:
        while True:
            n = 0
            while n < len(self.held) and self.held[n] in b"\r\n":
                n += 1
            del self.held[:n]
            if self.held:
                return True
            if not self.more():
                return False


def parse(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a WARC file, gzipped by record, as a
    whole or not at all. Holds one record beside the file, and reads each byte once."""
    reader = _Reader(_plain(memoryview(data)))
    while reader.skip_blank():
        head = reader.until(b"\r\n\r\n")
        if head is None:
            return
        headers = {a.strip(): b.strip() for a, _, b in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
        size = next((v for k, v in headers.items() if k.lower() == "content-length"), "0")
        yield headers, reader.take(int(size) if size.isdigit() else 0)


def read_responses(files: DataFrame) -> DataFrame:
    """Response records (columns of ``RESPONSE``) of WARC files read by Spark's
    ``binaryFile`` source; other record types are skipped. A task holds one file
    as it is stored and one record; the rows go on in small batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 4 + [pa.map_(pa.string(), pa.string()), pa.binary()]
        names = ["record_id", "target_uri", "date", "ip", "headers", "block"]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            for i in range(b.num_rows):
                content = b.column("content")[i].as_buffer()
                rows, size = [], 0
                for h, block in parse(memoryview(content) if content is not None else b""):
                    low = {k.lower(): v for k, v in h.items()}
                    if low.get("warc-type") != "response":
                        continue
                    rows.append((low.get("warc-record-id"), low.get("warc-target-uri"), low.get("warc-date"), low.get("warc-ip-address"), list(h.items()), block))
                    size += len(block)
                    if len(rows) >= ROWS or size > 16 * CHUNK:
                        yield made(rows)
                        rows, size = [], 0
                if rows:
                    yield made(rows)

    return files.select("content").mapInArrow(run, RESPONSE)

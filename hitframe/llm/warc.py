"""WARC archives with revisit records and a two-level capture index."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hitframe.session import scratch_path
from hitframe.sources.stages import materialise

from .common import for_python

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# captures per compressed block of the index; one directory entry each
BLOCK = 1024

_URL = re.compile(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^@/?#]*@)?([^:/?#]*)(:\d+)?([^#]*)", re.I | re.S)


def url_key(url: str | None) -> str:
    """Reversed host, then port, path and query: ``com,example,www)/path?query``.

    Captures of one site and of its hosts lie side by side in this order. The scheme,
    the user and the fragment are left out. Null gives the empty key, and a text
    that is no URL is its own key.
    """
    if url is None:
        return ""
    found = _URL.match(url)
    if not found:
        return url
    host, port, rest = found.groups()
    return ",".join(reversed(host.lower().split("."))) + (port or "") + ")" + (rest or "/")


def _open(path: str):
    """File system and path of a shared place; any that the Arrow library can open."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    page: int | None, url: str | None, payload: bytes, first: int | None, is_first: bool, date: str
) -> bytes:
    """One capture as a gzip member of its own; a revisit holds the headers alone."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if is_first else http
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if is_first else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if not is_first:
        fields += [f"WARC-Refers-To: <urn:x-page:{first}>", f"WARC-Profile: {REVISIT}"]
    squeeze = zlib.compressobj(6, wbits=31)
    whole = "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return squeeze.compress(whole) + squeeze.flush()


@dataclass
class Capture:
    """A record as read from an archive. ``payload`` is null for a revisit."""

    page: int | None
    record_type: str
    refers_to: int | None
    digest: str
    payload_bytes: int
    payload: bytes | None


def parse_record(member: bytes) -> Capture:
    """Read one record; a response whose payload does not match its digest is an error."""
    whole = zlib.decompress(member, wbits=31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record does not end where its length says")
    number = lambda f: int(m[1]) if (m := re.match(r"<urn:x-page:(-?\d+)>", fields.get(f, ""))) else None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"damaged payload in record {fields['WARC-Record-ID']}")
    return Capture(
        number("WARC-Record-ID"),
        kind,
        number("WARC-Refers-To"),
        digest,
        size,
        payload if kind == "response" else None,
    )


def _first_captures(pages: DataFrame, key: str, html: Column, min_bytes: int) -> DataFrame:
    """Every page with the smallest id among pages of equal payload.

    Payloads below the limit stand for themselves, those of rows without an id too.
    """
    size = F.octet_length(html)
    grouped = pages.where(size >= min_bytes) if min_bytes > 0 else pages
    grouped = grouped.withColumn("_group", F.sha2(html, 256))
    firsts = grouped.groupBy("_group").agg(F.min(key).alias("_first"))
    found = grouped.join(firsts, "_group").drop("_group")
    if min_bytes > 0:
        found = found.unionByName(pages.where(size < min_bytes).withColumn("_first", F.col(key)))
    return found


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write one archive per task; return ``(url_key, page, file, offset, length)``.

    Of pages with equal payload the smallest id is a response, the others revisit
    it. A task writes under a name of its own and its rows reach the returned table
    only when it commits, so what a lost or repeated task has written is never
    referred to.
    """
    for_python(pages.sparkSession)
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = _first_captures(
        pages.select(F.col(key).alias("_page"), F.col(url).alias("_url"), payload.alias("_html")),
        "_page",
        F.col("_html"),
        min_bytes,
    ).select("_page", "_url", "_html", "_first", F.col("_page").eqNullSafe(F.col("_first")).alias("_is_first"))

    def run(batches):
        import pyarrow as pa

        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or fs.open_output_stream(f"{base}/{name}", compression=None)
            found = []
            for page, address, text, first, is_first in zip(*[c.to_pylist() for c in batch.columns]):
                member = record(page, address, text.encode(), first, is_first, date)
                out.write(member)
                found.append((url_key(address), page, name, at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["url_key", "page", "file", "offset", "length"],
            )
        if out:
            out.close()

    captures = rows.mapInArrow(run, "url_key string, page long, file string, offset long, length long")
    return materialise(captures, "captures")


@dataclass(frozen=True)
class CaptureIndex:
    """Where the sorted shards lie, and the first key of each.

    There is one entry per shard, so their number is that of the tasks that wrote
    the index, not that of the captures.
    """

    folder: str
    archives: str
    shards: tuple[str, ...]
    firsts: tuple[tuple, ...]


def _order(key: str, page: int | None) -> tuple:
    return (key, page is not None, page or 0)


def build_index(captures: DataFrame, folder: str, archives: str, block: int = BLOCK) -> CaptureIndex:
    """Sort the captures by key and write shards of compressed blocks.

    Level one of a shard is its blocks of ``block`` captures; level two, at its end,
    the sparse directory with the first key and the place of every block.
    """
    for_python(captures.sparkSession, 4096)
    ordered = captures.repartitionByRange("url_key", "page").sortWithinPartitions("url_key", "page")

    def run(batches):
        import pyarrow as pa

        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        name, at, out = f"{uuid.uuid4().hex}.cdx", 0, None
        directory, waiting = [], []

        def flush(lines: list) -> None:
            nonlocal at
            packed = zlib.compress(json.dumps(lines).encode())
            out.write(packed)
            directory.append([lines[0][0], lines[0][1], at, len(packed)])
            at += len(packed)

        for batch in batches:
            waiting += map(list, zip(*[c.to_pylist() for c in batch.columns]))
            while len(waiting) >= block:
                out = out or fs.open_output_stream(f"{base}/{name}", compression=None)
                flush(waiting[:block])
                waiting = waiting[block:]
        if waiting:
            out = out or fs.open_output_stream(f"{base}/{name}", compression=None)
            flush(waiting)
        if out:
            packed = zlib.compress(json.dumps(directory).encode())
            out.write(packed + len(packed).to_bytes(8, "big"))
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (name, directory[0][0])] + [pa.array([directory[0][1]], pa.int64())],
                names=["shard", "url_key", "page"],
            )

    shards = ordered.select("url_key", "page", "file", "offset", "length").mapInArrow(
        run, "shard string, url_key string, page long"
    )
    found = sorted(
        (_order(r["url_key"], r["page"]), r["shard"]) for r in materialise(shards, "shards").collect()
    )
    return CaptureIndex(folder, archives, tuple(s for _, s in found), tuple(k for k, _ in found))


class _Reader:
    """Range reads of one task: a few open files, directories and blocks at a time."""

    def __init__(self, index: CaptureIndex):
        self.index = index
        self.handle = lru_cache(maxsize=64)(self._handle)
        self.directory = lru_cache(maxsize=8)(self._directory)
        self.block = lru_cache(maxsize=8)(self._block)

    def _handle(self, folder: str, name: str):
        fs, base = _open(folder)
        return fs.open_input_file(f"{base}/{name}")

    def _range(self, folder: str, name: str, offset: int, length: int) -> bytes:
        file = self.handle(folder, name)
        file.seek(offset)
        return file.read(length)

    def _directory(self, shard: str) -> tuple[list[tuple], list[list]]:
        size = self.handle(self.index.folder, shard).size()
        packed = int.from_bytes(self._range(self.index.folder, shard, size - 8, 8), "big")
        entries = json.loads(
            zlib.decompress(self._range(self.index.folder, shard, size - 8 - packed, packed))
        )
        return [_order(*e[:2]) for e in entries], entries

    def _block(self, shard: str, offset: int, length: int) -> tuple[list[tuple], list[list]]:
        lines = json.loads(zlib.decompress(self._range(self.index.folder, shard, offset, length)))
        return [_order(*line[:2]) for line in lines], lines

    def captures(self, key: str, page: int | None) -> Iterator[Capture]:
        """All records of one key: shard, then block, then line by binary search."""
        wanted = _order(key, page)
        # equal keys may begin in the shard and the block before
        shard = max(0, bisect_left(self.index.firsts, wanted) - 1)
        for name in self.index.shards[shard : bisect_right(self.index.firsts, wanted)]:
            firsts, entries = self.directory(name)
            first = max(0, bisect_left(firsts, wanted) - 1)
            for _, _, offset, length in entries[first : bisect_right(firsts, wanted)]:
                keys, lines = self.block(name, offset, length)
                for line in lines[bisect_left(keys, wanted) : bisect_right(keys, wanted)]:
                    yield parse_record(self._range(self.index.archives, *line[2:]))


def read_captures(
    lookups: DataFrame,
    index: CaptureIndex,
    key: str = "page_id",
    url: str = "url",
    with_payload: bool = False,
) -> DataFrame:
    """The records of the given ``(url, page)`` pairs, each pair once.

    Lookups are put in the order of the index first, so a task reads few blocks and
    each of them once. Pairs without a record give no row.
    """
    for_python(lookups.sparkSession, 4096)
    schema = T.StructType(
        [
            T.StructField(key, T.LongType()),
            T.StructField("payload_bytes", T.LongType()),
            T.StructField("payload_digest", T.StringType()),
            T.StructField("record_type", T.StringType()),
            T.StructField("refers_to", T.LongType()),
        ]
    )
    if with_payload:
        schema.add("payload", T.BinaryType())
    keyed = _with_key(lookups.select(F.col(key).alias("_page"), F.col(url).alias("_url")))
    ordered = keyed.repartitionByRange("_key", "_page").sortWithinPartitions("_key", "_page")

    def run(batches):
        import pyarrow as pa

        reader, last = _Reader(index), None
        for batch in batches:
            rows = []
            for wanted in zip(*[c.to_pylist() for c in batch.columns]):
                if wanted == last:
                    continue
                last = wanted
                rows += [
                    (c.page, c.payload_bytes, c.digest, c.record_type, c.refers_to, c.payload)
                    for c in reader.captures(*wanted)
                ]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            columns = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)][: len(schema)], names=schema.names
            )

    return ordered.select("_key", "_page").mapInArrow(run, schema)


def _with_key(rows: DataFrame) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keys = pa.array([url_key(u) for u in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([keys, batch.column(0)], names=["_key", "_page"])

    return rows.mapInArrow(run, "_key string, _page long")


def archive_pages(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> DataFrame:
    """Write all pages as WARC records, index them, and read every one back.

    Null html counts as empty; empty payloads are equal to each other and are
    written like any others. A null id ranks after all others. Rows that repeat an
    id and url come back as often as they were written. Other columns are not read;
    an empty table gives an empty result.
    """
    spark = pages.sparkSession
    archives, index = scratch_path(spark, "warc"), scratch_path(spark, "cdx")
    captures = write_archives(pages, archives, key, url, html, min_bytes)
    return read_captures(pages, build_index(captures, index, archives), key, url)

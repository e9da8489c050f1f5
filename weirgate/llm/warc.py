"""WARC archives of web pages with a two-level capture index.

Writing: equal payloads of at least ``REVISIT_FROM`` bytes are stored once, as
the response with the smallest page id; the others become revisit records that
refer to it.  Payloads that very many pages share are known to every task, so that
their pages need not meet.  Each task writes archives of its own, one gzip member a
record.

Index: capture lines are keyed by the URL with its host reversed (and the page
id), range-sorted, and written in compressed blocks of ``LINES`` lines.  The
sparse directory has one row a block, its first and last key and where it lies.

Reading: the directory and the keys to look up are cut into the same slices by
at most `MOST_SLICES` keys of the directory, and each task reads its slice of both
in order.  A key finds its block by the slice's part of the directory, is
binary-searched in the block's lines, and the record is fetched by a range read of
its archive.  The driver holds the cuts only, whatever the number of pages.

Files are written under names that no other attempt uses and count only if the
table of captures, itself written by Spark, names them; a repeated task leaves
files nobody reads.  They live in the folder given, by default in the one that
the cluster shares (any store that ``pyarrow.fs`` opens by URI).

Defined results: a null payload is an empty one; a null URL is stored as
``about:blank``; a null page id is kept (its record is never referred to; equal
payloads whose ids are all null are all responses); rows that repeat the
smallest id of a payload are all responses; extra columns are ignored; an empty
table gives no rows and no files.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

REVISIT_FROM = 100
LINES = 1000
#: Captures of a reading task's slice, about, and slices at most.
TASK_CAPTURES, MOST_SLICES = 10_000, 4096
#: Records fetched at once.
AT_ONCE = 200
#: Bytes after which a task starts another archive; gap up to which two range reads become one.
ARCHIVE_BYTES, READ_GAP = 1 << 30, 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def surt(url: str | None) -> str:
    """The URL with its host reversed: com,example,www)/path?query, lower-cased up to the path."""
    if not url:
        return ")/"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:  # a malformed host or port stays as it is written
        return f"!{url.strip()}"
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    shown = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    return f"{','.join(reversed(host.split('.')))}{shown}){rest}"


def capture_key(url: str | None, page_id: int | None) -> str:
    clean = surt(url).replace("\t", "%09").replace("\n", "%0A").replace("\r", "%0D")
    return f"{clean} {'-' if page_id is None else format(page_id + (1 << 63), '020d')}"


def _record_id(page_id: int | None) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}').urn}>" if page_id is not None else f"<{uuid.uuid4().urn}>"


def _clean(value: object) -> str:
    return str(value).replace("\r", "%0D").replace("\n", "%0A")


def archive_info(date: str) -> bytes:
    """The warcinfo record that begins an archive, uncompressed."""
    block = b"software: weirgate\r\nformat: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {_record_id(None)}\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str, refers_url: str | None = None) -> bytes:
    """One WARC/1.1 record, uncompressed."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", url or "about:blank"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to)), ("WARC-Refers-To-Target-URI", refers_url or "about:blank"), ("WARC-Refers-To-Date", date), ("Refers-To-Page", refers_to)]
    block = http + (payload if refers_to is None else b"")
    fields += [("Payload-Length", len(payload)), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    if page_id is not None:
        fields.append(("Page", page_id))
    head = "".join(f"{k}: {_clean(v)}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> dict:
    """Header fields of a record (lower-cased names) and, under ``payload``, its body's payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    block = rest[: int(out["content-length"])]
    out["payload"] = block.partition(b"\r\n\r\n")[2]
    return out


def _files(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _gzip(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Archives:
    """Where the archives, the captures and the sparse directory are."""

    root: str
    captures: DataFrame
    directory: DataFrame


def write(pages: DataFrame, root: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "2026-01-01T00:00:00Z") -> Archives:
    """Archives and index of ``pages``."""
    spark = pages.sparkSession
    shared.text_session(spark)
    root = root or shared.scratch(spark, "warc")
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"), F.sha2(body, 256).alias("digest"))
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("n"))
    firsts = narrow.where(F.col("n") >= REVISIT_FROM).groupBy("digest").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1")
    firsts = shared.durable(firsts.select("digest", "c", F.col("f.page_id").alias("first"), F.col("f.url").alias("first_url")), "firsts")
    # payloads with a thousandth of all copies, so at most a thousand, are told to every task; their pages are dealt at random
    copies = firsts.agg(F.sum("c")).first()[0] or 0
    common = firsts.where(F.col("c") * 1000 >= copies).select(F.col("digest").alias("common"), F.col("first").alias("common_first"), F.col("first_url").alias("common_url"))
    rows = rows.join(F.broadcast(common), F.col("digest") == F.col("common"), "left")
    key = F.when(F.col("common").isNotNull(), F.concat(F.lit("common "), F.xxhash64("page_id", "url").cast("string"))).otherwise(F.col("digest"))
    told = rows.withColumn("key", key).join(firsts.select(F.col("digest").alias("key"), "first", "first_url"), "key", "left")
    first = F.coalesce("common_first", "first")
    told = told.select("page_id", "url", "payload", "digest", F.when((first != F.col("page_id")) | F.col("page_id").isNull(), first).alias("refers_to"), F.coalesce("common_url", "first_url").alias("first_url"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(root)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                lines = {"key": [], "file": [], "offset": [], "length": []}
                for page_id, url, payload, digest, refers_to, first_url in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        files.create_dir(f"{base}/archives", recursive=True)
                        name, at = f"archives/{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                        info = _gzip(archive_info(date))
                        out.write(info)
                        at = len(info)
                    data = _gzip(record(page_id, url, payload, digest, refers_to, date, first_url))
                    out.write(data)
                    for k, v in zip(lines, (capture_key(url, page_id), name, at, len(data)), strict=True):
                        lines[k].append(v)
                    at += len(data)
                yield pa.RecordBatch.from_arrays([pa.array(lines["key"], pa.string()), pa.array(lines["file"], pa.string()), pa.array(lines["offset"], pa.int64()), pa.array(lines["length"], pa.int64())], names=list(lines))
        finally:
            if out is not None:
                out.close()

    captures = shared.durable(told.mapInArrow(store, "key string, file string, offset long, length long"), "captures")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        files, base = _files(root)
        out, name, at = None, f"index/{uuid.uuid4().hex}.cdx.gz", 0
        directory: list[tuple] = []

        def flush(block: list[tuple]) -> None:
            nonlocal out, at
            if out is None:
                files.create_dir(f"{base}/index", recursive=True)
                out = files.open_output_stream(f"{base}/{name}", compression=None)
            data = _gzip("".join(f"{k}\t{f}\t{o}\t{n}\n" for k, f, o, n in block).encode())
            out.write(data)
            directory.append((block[0][0], block[-1][0], name, at, len(data)))
            at += len(data)

        for batch in batches:
            held += zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)
            while len(held) >= LINES:
                flush(held[:LINES])
                held = held[LINES:]
        if held:
            flush(held)
        if out is not None:
            out.close()
        first, last, file, offset, length = zip(*directory, strict=True) if directory else ((), (), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(first, pa.string()), pa.array(last, pa.string()), pa.array(file, pa.string()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())], names=["first", "last", "file", "offset", "length"])

    lined = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    directory = shared.durable(lined.mapInArrow(index, "first string, last string, file string, offset long, length long"), "directory")
    return Archives(root, captures, directory)


class Reader:
    """Looks keys up in blocks of the index, and reads records by range."""

    def __init__(self, root: str):
        self.files, self.base = _files(root)
        self.open: dict[str, object] = {}
        self.block, self.keys, self.lines = None, [], []

    def _range(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.files.open_input_file(f"{self.base}/{name}")
        return self.open[name].read_at(length, offset)

    def places(self, key: str, blocks: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of each capture with this key in ``blocks``."""
        for block in blocks:
            if block != self.block:
                self.lines = [x.split("\t") for x in zlib.decompress(self._range(*block), 31).decode().split("\n")[:-1]]
                self.keys, self.block = [x[0] for x in self.lines], block
            i = bisect.bisect_left(self.keys, key)
            while i < len(self.keys) and self.keys[i] == key:
                yield self.lines[i][1], int(self.lines[i][2]), int(self.lines[i][3])
                i += 1

    def records(self, places: list[tuple[str, int, int]]) -> Iterator[dict]:
        """The records at ``places``, neighbours in an archive by one read."""
        places = sorted(places)
        i = 0
        while i < len(places):
            name, start, length = places[i]
            end, j = start + length, i + 1
            while j < len(places) and places[j][0] == name and places[j][1] - end <= READ_GAP and end - start < 1 << 23:
                end, j = max(end, places[j][1] + places[j][2]), j + 1
            data = self._range(name, start, end - start)
            for _, offset, n in places[i:j]:
                yield parsed(zlib.decompress(data[offset - start : offset - start + n], 31))
            i = j


def lookup(archives: Archives, wanted: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The captures of the (page id, URL) pairs ``wanted``: page_id, url,
    record_type, refers_to, payload_digest and payload_bytes of the full payload,
    and payload (empty for a revisit)."""
    spark, root = wanted.sparkSession, archives.root
    shared.text_session(spark)

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([capture_key(u, p) for p, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], pa.string())], names=["key"])

    asked = wanted.select(F.col(id_col).cast("long"), url_col).mapInArrow(keys, "key string").distinct()
    slices = max(1, min(MOST_SLICES, -(-archives.directory.count() * LINES // TASK_CAPTURES)))
    firsts = archives.directory.select("first").repartitionByRange(slices, "first").groupBy(F.spark_partition_id()).agg(F.min("first").alias("first"))
    cuts = spark.sparkContext.broadcast(sorted({r.first for r in firsts.collect()})[1:])  # fewer than MOST_SLICES keys

    def sliced(batches):
        """Keys and blocks by slice; a block is in every slice that its keys reach."""
        for batch in batches:
            low, high = ([bisect.bisect_right(cuts.value, k) for k in batch.column(i).to_pylist()] for i in (0, 1))
            which = [i for i, (a, b) in enumerate(zip(low, high, strict=True)) for _ in range(a, b + 1)]
            rows = batch.take(pa.array(which, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([x for a, b in zip(low, high, strict=True) for x in range(a, b + 1)], pa.int32()), *rows.columns], names=["slice", "key", "last", "file", "offset", "length"])

    keyed = asked.select("key", F.col("key").alias("last"), F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("offset"), F.lit(None).cast("long").alias("length"))
    both = archives.directory.withColumnRenamed("first", "key").unionByName(keyed).mapInArrow(sliced, "slice int, key string, last string, file string, offset long, length long")
    both = both.repartitionByRange(slices, "slice").sortWithinPartitions("slice", "key", F.col("file").asc_nulls_last(), "offset")

    def read(batches):
        reader, slice_, blocks, places = Reader(root), None, [], []
        for batch in batches:
            for at, key, last, *block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != slice_:
                    slice_, blocks = at, []
                blocks = [x for x in blocks if x[0] >= key]
                if block[0] is not None:
                    blocks.append((last, tuple(block)))
                    continue
                for place in reader.places(key, [x for _, x in blocks]):
                    places.append(place)
                    if len(places) >= AT_ONCE:
                        yield _told(reader.records(places))
                        places = []
        yield _told(reader.records(places))

    return both.mapInArrow(read, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def _told(records: Iterator[dict]) -> pa.RecordBatch:
    cols: list[list] = [[] for _ in range(7)]
    for r in records:
        if r["warc-type"] == "response":
            digest, size = hashlib.sha256(r["payload"]).hexdigest(), len(r["payload"])
        else:
            digest, size = r["warc-payload-digest"].removeprefix("sha256:"), int(r["payload-length"])
        row = (r.get("page"), r["warc-target-uri"], r["warc-type"], r.get("refers-to-page"), digest, size, r["payload"])
        for c, v in zip(cols, row, strict=True):
            c.append(v)
    number = lambda x: pa.array([None if v is None else int(v) for v in x], pa.int64())
    return pa.RecordBatch.from_arrays(
        [number(cols[0]), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()), number(cols[3]), pa.array(cols[4], pa.string()), number(cols[5]), pa.array(cols[6], pa.binary())],
        names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"],
    )

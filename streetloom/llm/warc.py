"""WARC archives of pages, and a two-level capture index over them.

Archives are files of gzip members, one for each record, written by Spark's text sink: the value column holds
the member's bytes, and the line separator is the empty gzip member, so a file is a plain sequence of members
that any WARC reader takes, on any file system that Spark writes, committed task by task.

The index has one line for each capture, ``key json``, sorted by key: the URL with its host reversed
(``org,example)/path``), so that captures of a site lie together. Lines are packed into gzip blocks of
``BLOCK_LINES``, written by the same sink; a sparse directory keeps the first key, file and place of each block. A
lookup searches the directory by halving, reads the one or few blocks that may hold the key, and then
only the records' byte ranges: for one url by seeking from the driver (``CaptureIndex``), for a table of urls in tasks
(``look_up``, ``read_records``), where the directory is searched in parts of at most ``DIRECTORY_ROWS`` blocks.

Of records with equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest page id is a response, the
others are revisits that refer to it and hold no payload. Defined results: a null html is the empty payload;
rows that share the smallest id and the payload are all responses; a row without id revisits one with id, and is a
response if no equal payload has an id; a null url leaves its header out, has the empty key, and is found under it;
control characters and spaces in a url are percent-encoded. Only the three named columns are used.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetloom.llm.common import map_batches, texts_of
from streetloom.session import checkpointed

MIN_REVISIT = 100
BLOCK_LINES = 1000
ARCHIVE_RECORDS = 20_000  # at most, of one archive file
ARCHIVE_BYTES, MOST_BYTES = 64 << 20, 1 << 30  # of payloads in an archive file: about, and at most
DIRECTORY_ROWS = 500_000  # blocks of a directory part that tasks search
MAX_BROADCAST_RANGES = 2_000_000  # records whose ranges go to the archives, rather than the archives to them
MAX_BROADCAST_DIGESTS = 1_000_000
DATE = "1970-01-01T00:00:00Z"  # of all records, unless the caller gives one
_EMPTY_MEMBER = "\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
_PAGE = "urn:page:"


def _member(content: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


def _members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, bytes) of every gzip member that is not empty."""
    at, view = 0, memoryview(content)
    while at < len(content):
        reader = zlib.decompressobj(31)
        parts, place = [], at
        while not reader.eof:
            piece = view[place : place + (1 << 16)]
            if not piece:
                raise ValueError("archive ends inside a record")
            parts.append(reader.decompress(piece))
            place += len(piece)
        end = place - len(reader.unused_data)
        body = b"".join(parts)
        if body:
            yield at, end - at, body
        at = end


def url_key(url: str | None) -> str:
    """Reversed host, port if it has one, then path and query: ``org,example:8080)/a?b``."""
    if not url:
        return ""
    cleaned = quote(url, safe="%/:=&?~#+!$,;'@()*[]|")
    try:
        parts = urlsplit(cleaned)
        host = (parts.netloc.rpartition("@")[2] or "").lower()
    except ValueError:
        return cleaned.lower()
    if not host:
        return cleaned
    name, colon, port = host.partition(":")
    reversed_host = ",".join(reversed(name.split(".")))
    return f"{reversed_host}{colon}{port}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _record(page_id: object, url: str | None, kind: str, refers_to: object, payload: bytes, digest: str, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    name = f"{_PAGE}{page_id}" if page_id is not None else f"urn:sha256:{digest}"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]|"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{_PAGE}{refers_to}>")
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(content: bytes) -> dict:
    """Headers and payload of one record, checked against its lengths and its digest."""
    head, _, rest = content.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/") or rest[int(fields["Content-Length"]) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("the payload is not what was written")

    def page(name: str) -> int | None:
        text = fields.get(name, "").strip("<>")
        return int(text.removeprefix(_PAGE)) if text.startswith(_PAGE) else None

    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields.get("WARC-Target-URI"),
        "record_type": kind,
        "refers_to": page("WARC-Refers-To"),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def _write_members(df: DataFrame, path: str, per_file: int) -> None:
    """A column ``member`` as files of gzip members."""
    lines = df.select(F.col("member").cast("string").alias("value"))
    options = {"lineSep": _EMPTY_MEMBER, "encoding": "ISO-8859-1", "maxRecordsPerFile": str(per_file)}
    lines.write.options(**options).text(path)


def _members_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), "content")


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE
) -> None:
    """One record for each row of ``pages``, in archives under ``path``."""
    read = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).alias("url"),
        F.coalesce(html, F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    large = F.octet_length("html") >= MIN_REVISIT
    again = (
        read.where(large)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("many"))
        .where("many > 1")
        .select("_digest", "first")
    )
    # only payloads that repeat are joined; without a small table of them, adaptive execution splits a hot one
    again = checkpointed(again)
    if again.count() <= MAX_BROADCAST_DIGESTS:
        again = F.broadcast(again)
    placed = read.join(again, F.col("digest") == F.col("_digest"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    placed = placed.select("page_id", "url", "html", "digest", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = ("page_id", "url", "digest", "refers_to", "revisit")
        rows = zip(*(batch.column(n).to_pylist() for n in names), texts_of(batch.column("html")), strict=True)
        made = [
            _member(_record(page, where, "revisit" if again_ else "response", first, payload, digest, date))
            for page, where, digest, first, again_, payload in rows
        ]
        return pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    mean, most = read.agg(F.avg(F.octet_length("html")), F.max(F.octet_length("html"))).first()
    per_file = min(ARCHIVE_RECORDS, ARCHIVE_BYTES // int(mean or 1) if mean else ARCHIVE_RECORDS, MOST_BYTES // max(most or 1, 1))
    _write_members(map_batches(placed, work, "member binary"), path, max(1, per_file))


def _names(fields: str) -> list[str]:
    return [f.split()[0] for f in fields.split(", ")]


_FIELDS = "archive string, offset bigint, length bigint, page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Place and fields of every record under ``path``; payloads are checked and left in the files."""
    names = _names(_FIELDS)
    types = [pa.string() if f.endswith("string") else pa.int64() for f in _FIELDS.split(", ")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for file, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist(), strict=True):
            for offset, length, body in _members(content):
                found = parse_record(body)
                rows.append((file, offset, length, *(found[n] for n in names[3:])))
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return map_batches(_members_of(spark, path), work, _FIELDS)


def write_index(records: DataFrame, path: str, block_lines: int = BLOCK_LINES) -> None:
    """Blocks under ``path``/blocks and their directory under ``path``/directory.

    Rows are dealt by ranges of (key, archive, offset), so captures of one hot key may lie in many blocks.
    """
    spark = records.sparkSession

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([keys, *batch.columns[1:]], _names(_ENTRY))

    entries = map_batches(records.select("url", *_names(_ENTRY)[1:]), keyed, _ENTRY)
    entries = entries.repartitionByRange("key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []
        for batch in batches:
            for row in batch.to_pylist():
                waiting.append(row.pop("key") + " " + json.dumps(row, separators=(",", ":")))
                if len(waiting) == block_lines:
                    yield _block(waiting)
                    waiting = []
        if waiting:
            yield _block(waiting)

    _write_members(entries.mapInArrow(blocks, "member binary"), f"{path}/blocks", 1 << 30)

    def places(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            {"first_key": body[: body.index(b" ")].decode(), "file": file, "offset": offset, "length": length}
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content").to_pylist(), strict=True)
            for offset, length, body in _members(content)
        ]
        return pa.RecordBatch.from_pylist(rows, pa.schema([("first_key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    found = map_batches(_members_of(spark, f"{path}/blocks"), places, "first_key string, file string, offset bigint, length bigint")
    found.write.parquet(f"{path}/directory")


def _block(lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([_member("\n".join(lines).encode())], pa.binary())], ["member"])


_ENTRY = "key string, archive string, offset bigint, length bigint, page_id bigint, record_type string, payload_digest string"


def _entries(body: bytes) -> Iterator[dict]:
    for line in body.decode().split("\n"):
        key, _, rest = line.partition(" ")
        yield {"key": key, **json.loads(rest)}


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """All captures that the index lists."""
    schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _ENTRY.split(", ")])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [e for content in batch.column("content").to_pylist() for _, _, body in _members(content) for e in _entries(body)]
        return pa.RecordBatch.from_pylist(rows, schema)

    return map_batches(_members_of(spark, f"{path}/blocks"), work, _ENTRY)


def _directory_parts(directory: DataFrame) -> Iterator[tuple[list[tuple], str | None]]:
    """Rows (first_key, file, offset, length) in order, in parts of about ``DIRECTORY_ROWS``, and the key that the next
    part begins with."""
    rows = directory.select("first_key", "file", "offset", "length")
    parts = -(-rows.count() // DIRECTORY_ROWS)
    if parts <= 1:
        yield sorted(tuple(r) for r in rows.collect()), None
        return
    ranged = checkpointed(rows.repartitionByRange(parts, *rows.columns).withColumn("part", F.spark_partition_id()))
    begins = sorted((r["first"], r["part"]) for r in ranged.groupBy("part").agg(F.min("first_key").alias("first")).collect())
    for (_, part), after in zip(begins, [*begins[1:], (None, None)], strict=True):
        yield sorted(tuple(r) for r in ranged.where(F.col("part") == part).select(*rows.columns).collect()), after[0]


def _wanted_blocks(keys: DataFrame, blocks: list[tuple]) -> dict[str, list[tuple[int, int]]]:
    """Places, by file, of the blocks that may hold a key: from the one before the first that begins with it."""
    shared = keys.sparkSession.sparkContext.broadcast([b[0] for b in blocks])

    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        firsts, found = shared.value, set()
        for key in batch.column("key").to_pylist():
            found.update(range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key)))
        return pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], ["block"])

    places: dict[str, list[tuple[int, int]]] = {}
    for row in map_batches(keys, search, "block bigint").distinct().collect():  # no more than the part has
        _, file, offset, length = blocks[row["block"]]
        places.setdefault(file, []).append((offset, length))
    return places


def look_up(spark: SparkSession, path: str, urls: DataFrame, url: str = "url") -> DataFrame:
    """Index entries of all captures of the urls, each once, however often a url is asked. Searches when called."""

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.string())], ["key"])

    keys = checkpointed(map_batches(urls.select(F.col(url).alias("url")), keyed, "key string").distinct())
    types = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _ENTRY.split(", ")])

    def read(shared) -> DataFrame:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                view = memoryview(content.as_buffer())
                for offset, length in shared.value.get(file, ()):
                    rows += _entries(zlib.decompress(view[offset : offset + length], 31))
            return pa.RecordBatch.from_pylist(rows, types)

        return map_batches(_members_of(spark, f"{path}/blocks"), work, _ENTRY)

    found = None
    for blocks, after in _directory_parts(spark.read.parquet(f"{path}/directory")):
        own = F.col("key") >= (blocks[0][0] if blocks else "")
        places = _wanted_blocks(keys.where(own if after is None else own & (F.col("key") <= after)), blocks)
        shared = spark.sparkContext.broadcast(places)
        part = checkpointed(read(shared).join(keys, "key", "left_semi"))
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    return found


def read_records(spark: SparkSession, captures: DataFrame, path: str) -> DataFrame:
    """Place and fields of the records that index entries name, read by their byte ranges alone."""
    names = _names(_FIELDS)
    types = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _FIELDS.split(", ")])
    place = F.struct("offset", "length")
    ranges = captures.groupBy("archive").agg(F.array_sort(F.collect_list(place)).alias("ranges"))  # records of one archive
    if captures.count() <= MAX_BROADCAST_RANGES:
        ranges = F.broadcast(ranges)
    files = _members_of(spark, path).join(ranges, F.col("file") == F.col("archive")).select("file", "content", "ranges")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for file, content, places in zip(batch.column("file").to_pylist(), batch.column("content"), batch.column("ranges").to_pylist(), strict=True):
            view = memoryview(content.as_buffer())
            for at in places:
                found = parse_record(zlib.decompress(view[at["offset"] : at["offset"] + at["length"]], 31))
                rows.append({"archive": file, **at, **{n: found[n] for n in names[3:]}})
        return pa.RecordBatch.from_pylist(rows, types)

    return map_batches(files, work, _FIELDS)


def read_range(spark: SparkSession, file: str, offset: int, length: int) -> bytes:
    """One byte range of a file on any file system that Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(file)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        stream.seek(offset)
        return bytes(stream.readNBytes(length))
    finally:
        stream.close()


class CaptureIndex:
    """Lookups of single urls from the driver: the directory is searched where it lies, blocks and records are read by range."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.directory = spark.read.parquet(f"{path}/directory")

    def captures(self, url: str | None) -> list[dict]:
        """Index entries of one url, in the order of the index."""
        key, found = url_key(url), []
        # the last block that begins before the key may end with it
        before = self.directory.where(F.col("first_key") < key).agg(F.max(F.struct("first_key", "file", "offset", "length")).alias("last"))
        blocks = [tuple(r["last"]) for r in before.collect() if r["last"]]
        blocks += [tuple(r) for r in self.directory.where(F.col("first_key") == key).select("first_key", "file", "offset", "length").collect()]
        for _, file, offset, length in blocks:
            body = zlib.decompress(read_range(self.spark, file, offset, length), 31)
            found += [e for e in _entries(body) if e["key"] == key]
        return sorted(found, key=lambda e: (e["archive"], e["offset"]))

    def read(self, capture: dict) -> dict:
        """The record of an index entry, read by its range alone."""
        return parse_record(zlib.decompress(read_range(self.spark, capture["archive"], capture["offset"], capture["length"]), 31))

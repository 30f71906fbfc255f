"""WARC archives with a two-level capture index.

Writing: each task streams its pages into a gzip-per-record WARC file; of pages
with equal payloads of ``REVISIT_FROM`` bytes or more, one is stored and the
others become revisit records that refer to it by its URL, and by its page id in
a field of ours. Record ids are UUIDs of the record's place, so no two are alike.

Index: captures are keyed by reversed-host URL and page id, sorted by range over
all tasks, and packed ``LINES`` at a time into compressed blocks. An index part
ends with its sparse directory (first key, offset and length of each block);
the parts' first keys make a small top level.

Lookup: keys are routed to parts by binary search over the top level, to blocks
by binary search over the part's directory, to lines by binary search in the
block; records are then fetched by range reads, neighbours in one read.

Defined results: NULL html is an empty payload; a NULL or malformed URL is
keyed by its escaped text ("-" for NULL); a NULL page id sorts first and, in a
group with ids, is a revisit; rows that repeat the id of the stored page are
stored again; a group without ids is stored whole; an empty table gives no
files and no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm.filestore import attempt_name, create, open_file
from capstream.session import shared_path

REVISIT_FROM, LINES, LEVEL = 1000, 2048, 4
FOOTER = "<8sQQ"  # magic, offset and length of the directory
MAGIC = b"CAPINDX1"
#: A new archive file is begun beyond this size; neighbouring records are read up to this many bytes at once.
FILE_BYTES, READ_BYTES = 1 << 30, 4 << 20


def surt(url: str | None) -> str:
    """Reversed-host key: ``https://b.example.com:8080/x?q#f`` -> ``com,example,b:8080)/x?q``."""
    if url is None:
        return "-"
    try:
        p = urlsplit(url.strip())
        host, port = (p.hostname or ""), p.port
    except ValueError:
        host, port = "", None
    if not host:
        return quote(url.strip(), safe="!$&'()*+,/:;=?@[]~%")
    host = ",".join(reversed(host.rstrip(".").split(".")))
    host += f":{port}" if port not in (None, {"http": 80, "https": 443}.get(p.scheme)) else ""
    return quote(f"{host}){p.path or '/'}" + (f"?{p.query}" if p.query else ""), safe="!$&'()*+,/:;=?@[]~%")


def capture_key(url: str | None, page_id: int | None) -> str:
    """The index key: reversed-host URL, a space, the page id in a form that sorts by number (NULL first)."""
    return f"{surt(url)} " + ("-" if page_id is None else f"{page_id + 2**63:020d}")


def _header(fields: list[tuple[str, str]]) -> bytes:
    return "\r\n".join(["WARC/1.1", *[f"{k}: {v}" for k, v in fields], "", ""]).encode()


def _member(head: list[tuple[str, str]], block: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(_header([*head, ("Content-Length", str(len(block)))])) + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _record_id(place: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>"


def _target(url: str | None) -> str:
    return "about:blank" if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]~%")


DATE = "2024-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha1: str, refers_to: int | None, refers_url: str | None, place: str) -> bytes:
    """One gzip member; a revisit keeps the HTTP head of the full payload and no body. ``place``: the file and the offset it goes to."""
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(place)),
            ("WARC-Target-URI", _target(url)), ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode())]
    if page_id is not None:
        head += [("X-Page-ID", str(page_id))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Target-URI", _target(refers_url)),
                 ("WARC-Refers-To-Date", DATE), ("X-Refers-To-Page-ID", str(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _member(head, http + (payload if refers_to is None else b""))


def parse_record(data: bytes) -> dict:
    """Fields of one member: type, page_id, url, digest (hex), payload_bytes (of the full payload), refers_to, payload."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"]
    number = lambda name: int(fields[name]) if name in fields else None
    return {"type": fields["WARC-Type"], "record_id": fields["WARC-Record-ID"], "page_id": number("X-Page-ID"), "url": fields["WARC-Target-URI"],
            "digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(), "payload_bytes": int(size),
            "refers_to": number("X-Refers-To-Page-ID"), "payload": payload if fields["WARC-Type"] == "response" else None}


def write_archives(df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write WARC files under ``folder``; returns the path of the captures table (key, file, offset, length)."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html")).select(
        "page_id", "url", "html", F.octet_length("html").cast("long").alias("size"), F.sha1("html").alias("sha1"))
    # a row per repeated payload, summed before the shuffle; a hot payload is a skewed join, split at run time
    kept = (pages.where(F.col("size") >= REVISIT_FROM).groupBy("sha1").agg(F.max(F.struct("page_id", "url")).alias("k"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and k.page_id is not null").select("sha1", F.col("k.page_id").alias("keep"), F.col("k.url").alias("keep_url")))
    again = F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep"))
    rows = (pages.join(kept, "sha1", "left").withColumn("refers_to", again)
            .select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "size", "sha1", "refers_to", "keep_url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at = None, "", 0
        for b in batches:
            cols = [b.column(i).to_pylist() for i in (0, 1, 3, 4, 5, 6)]
            keys, files, offsets, lengths = [], [], [], []
            for i, (page, url, size, sha1, refers, refers_url) in enumerate(zip(*cols, strict=True)):
                if out is None:
                    out, path = create(folder, attempt_name("pages", ".warc.gz"))
                    info = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(path)), ("WARC-Date", DATE),
                                    ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    at = len(info)
                data = record(page, url, b.column(2)[i].as_py(), size, sha1, refers, refers_url, f"{path}#{at}")
                out.write(data)
                keys.append(capture_key(url, page))
                files.append(path)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()),
                                              pa.array(lengths, pa.int64())], names=["key", "file", "offset", "length"])
        if out is not None:
            out.close()

    captures = f"{folder}/captures"
    rows.mapInArrow(write, "key string, file string, offset long, length long").write.parquet(captures)
    return captures


def write_index(spark: SparkSession, captures: str, folder: str) -> str:
    """Sort the captures by key into index parts; returns the path of the top level (first_key, path of each part)."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, at, block, directory = None, "", 0, [], []

        def flush() -> None:
            nonlocal at, block
            data = zlib.compress("\n".join(block).encode(), 6)
            directory.append((block[0].rsplit(" ", 1)[0], at, len(data)))
            out.write(data)
            at, block = at + len(data), []

        for b in batches:
            for key, file, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    out, path = create(folder, attempt_name("index", ".idx"))
                block.append(f"{key} " + base64.urlsafe_b64encode(json.dumps([file, offset, length]).encode()).decode())
                if len(block) == LINES:
                    flush()
        if out is not None:
            if block:
                flush()
            data = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(data + struct.pack(FOOTER, MAGIC, at, len(data)))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0]]), pa.array([path])], names=["first_key", "path"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = f"{folder}/top"
    (spark.read.parquet(captures).repartitionByRange(n, "key").sortWithinPartitions("key", "file", "offset")
     .mapInArrow(write, "first_key string, path string").write.parquet(top))
    return top


class IndexPart:
    """One index part: its directory in memory, blocks by range reads (the last few kept)."""

    def __init__(self, path: str):
        self.f = open_file(path)
        size = self.f.size()
        magic, at, length = struct.unpack(FOOTER, self.f.read_at(24, size - 24))
        if magic != MAGIC:
            raise ValueError(f"{path} is not an index part")
        self.directory = json.loads(zlib.decompress(self.f.read_at(length, at)))
        self.first = [d[0].encode() for d in self.directory]
        self.blocks: dict[int, tuple[list[bytes], list[bytes]]] = {}

    def block(self, i: int) -> tuple[list[bytes], list[bytes]]:
        """Keys and values of block ``i``."""
        if i not in self.blocks:
            if len(self.blocks) > 3:
                del self.blocks[next(iter(self.blocks))]
            _, at, length = self.directory[i]
            lines = [x.rsplit(b" ", 1) for x in zlib.decompress(self.f.read_at(length, at)).split(b"\n")]
            self.blocks[i] = [x[0] for x in lines], [x[1] for x in lines]
        return self.blocks[i]

    def search(self, low: bytes, high: bytes) -> Iterator[tuple[str, str, int, int]]:
        """(key, file, offset, length) of all captures with ``low`` <= key <= ``high``, in key order."""
        i = max(0, bisect_left(self.first, low) - 1)
        while i < len(self.first) and self.first[i] <= high:
            keys, values = self.block(i)
            for j in range(bisect_left(keys, low), bisect_right(keys, high)):
                yield keys[j].decode(), *json.loads(base64.urlsafe_b64decode(values[j]))
            i += 1

    def close(self) -> None:
        self.f.close()


def lookup(spark: SparkSession, top: str, queries: DataFrame, by_page: bool = True) -> DataFrame:
    """Captures (``key, file, offset, length``) of every row of ``queries`` (``url`` and, if ``by_page``, ``page_id``)."""
    parts = sorted(((r.first_key.encode(), r.path) for r in spark.read.parquet(top).collect()))  # a row per index part
    firsts, paths = [p[0] for p in parts], [p[1] for p in parts]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, low, high = [], [], []
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                a = capture_key(*row) if by_page else f"{surt(row[0])} "
                z = a if by_page else a + "~"
                for p in range(max(0, bisect_left(firsts, a.encode()) - 1), bisect_right(firsts, z.encode())):
                    part.append(p)
                    low.append(a)
                    high.append(z)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(low, pa.string()), pa.array(high, pa.string())],
                                             names=["part", "low", "high"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, -1
        for b in batches:
            found: list[tuple] = []
            for p, low, high in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != at:
                    if part is not None:
                        part.close()
                    part, at = IndexPart(paths[p]), p
                found += part.search(low.encode(), high.encode())
            cols = list(zip(*found, strict=True)) if found else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)],
                                             names=["key", "file", "offset", "length"])
        if part is not None:
            part.close()

    names = ["url", "page_id"] if by_page else ["url"]
    routed = queries.select(*names).distinct().mapInArrow(route, "part int, low string, high string")
    return (routed.repartitionById(max(1, len(parts)), "part").sortWithinPartitions("part", "low")
            .mapInArrow(search, "key string, file string, offset long, length long"))


def fetch(captures: DataFrame, per_record, schema: str) -> DataFrame:
    """Read each capture's record by range reads; ``per_record(parse_record(...))`` gives the row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    target = to_arrow_schema(StructType.fromDDL(schema))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, name = None, None
        for b in batches:
            rows, todo = [], list(zip(*(c.to_pylist() for c in b.columns), strict=True))
            i = 0
            while i < len(todo):
                file, start, length = todo[i]
                j, end = i + 1, start + length
                while j < len(todo) and todo[j][0] == file and start <= todo[j][1] <= end and todo[j][1] + todo[j][2] - start <= READ_BYTES:
                    end = max(end, todo[j][1] + todo[j][2])
                    j += 1
                if file != name:
                    if f is not None:
                        f.close()
                    f, name = open_file(file), file
                data = f.read_at(end - start, start)
                rows += [per_record(parse_record(data[o - start:o - start + n])) for _, o, n in todo[i:j]]
                i = j
            yield pa.RecordBatch.from_pylist(rows, target)
        if f is not None:
            f.close()

    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, as the rows are few bytes for much work
    return (captures.select("file", "offset", "length").repartition(n, "file").sortWithinPartitions("file", "offset")
            .mapInArrow(read, schema))


def archive(df: DataFrame, folder: str | None = None, **columns: str) -> str:
    """Write archives and index of ``df``; returns the index's top level for ``lookup``."""
    spark = df.sparkSession
    folder = folder or shared_path(spark, "warc")
    return write_index(spark, write_archives(df, f"{folder}/data", **columns), f"{folder}/index")

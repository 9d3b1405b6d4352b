"""Web archives with a two-level capture index.

``write_archives`` writes one WARC record a row into gzip files, a member a record.  Rows of equal payload
are stored once: the row with the largest id is the response, the others are revisits that name it and
keep the HTTP header with the payload's length, and its digest.  Which row that is follows from one
aggregate over payload digests; the answer goes back to the rows by a join on (digest, salt), so a
payload that most rows share is spread over ``SALTS`` tasks.

Every task writes files of its own and names them in what it returns, so a task that runs again
leaves a file that nothing names; such files are removed at the end.

``build_index`` sorts the captures by (reversed-host URL key, id) over ``files`` index files.  An index file is
a chain of zlib blocks of ``BLOCK`` lines; its directory holds the first key, offset and length of every
block, a line for ``BLOCK`` captures.  ``lookup`` deals the asked keys to the index files by the files' first
and last keys (the only thing sent to every task: two keys a file, ``MOST_FILES`` files at most), reads
a file's directory once, finds a key's first block by binary search and reads only the blocks that
can hold it.  ``read_records`` sorts the captures found by place and reads each record by its range.

The URL key: lower-case host with its labels reversed (``com,example,www``), without scheme, user, default
port and fragment, then ``)``, path and query as given.  Different URLs can share a key; a lookup compares
the URL itself unless told to go by key.

Defined cases: a null payload is empty; a null URL is a record without target, found by asking for null.
Rows without id: an id counts as smaller than any other, and a revisit may refer to none; such rows are
told apart by their URL.  Rows equal in id, URL and payload are records of the same type.  Ties in id: the
smallest URL (null first) is the response.  Line breaks in ids and URLs are percent-escaped in a record.
Empty table: no archive, no row.  Other columns are not stored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.store import file_system
from ..session import default_parallelism, scratch_path
from .common import as_bytes, slices

BLOCK, MOST_FILES, ROWS_A_FILE, ARCHIVE, SALTS = 1000, 4096, 1 << 20, 1 << 30, 32
CAPTURE = ("key string, id string, url string, date string, type string, digest string, file string, "
           "offset long, length long")
_FIELDS = [f.split()[0] for f in CAPTURE.split(", ")]
_END = b"\r\n"


def url_key(url: str | None) -> str:
    """The sort key of a URL: reversed host, then the rest."""
    if url is None:
        return ""
    rest = url.split("#", 1)[0]
    scheme, mark, tail = rest.partition("://")
    if not mark:
        return rest
    cut = min((i for i in (tail.find(c) for c in "/?") if i >= 0), default=len(tail))
    host, path = tail[:cut].rpartition("@")[2].lower(), tail[cut:]
    name, colon, port = host.rpartition(":")
    if colon and port.isdigit():
        host = name if port == {"http": "80", "https": "443"}.get(scheme.lower()) else host
    name, colon, port = host.partition(":") if not host.startswith("[") else (host, "", "")
    return ",".join(reversed(name.split("."))) + colon + port + ")" + (path or "/")


def digest32(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(ident: str | None, url: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([ident, url, digest]))}>"


def _header(fields: list[tuple[str, str | None]]) -> bytes:
    # a line break in a value would begin a new field
    return b"WARC/1.1\r\n" + b"".join(
        f"{k}: {v}".replace("\r", "%0D").replace("\n", "%0A").encode() + _END for k, v in fields if v is not None) + _END


def record(ident: str | None, url: str | None, payload: bytes, date: str, *, of: tuple | None = None) -> bytes:
    """One WARC record; ``of``: (id, url) of the response that this one revisits."""
    digest = digest32(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if of else http + payload
    fields = [("WARC-Type", "revisit" if of else "response"), ("WARC-Record-ID", _record_id(ident, url, digest)),
              ("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Block-Digest", f"sha1:{digest32(block)}"), ("X-Row-Id", ident)]
    if of:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _record_id(*of, digest)), ("WARC-Refers-To-Target-URI", of[1]),
                   ("WARC-Refers-To-Date", date), ("X-Refers-To-Row-Id", of[0])]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + _END * 2


def parse(raw: bytes) -> dict:
    """Fields of a record (names in lower case), with ``payload`` (None for a revisit) and ``payload_bytes``.

    Raises where the block's or the payload's digest does not agree with its content."""
    head, _, body = raw.partition(_END * 2)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out = dict((k.lower(), v) for k, _, v in (line.partition(": ") for line in lines[1:]))
    block = body[:int(out["content-length"])]
    if digest32(block) != out["warc-block-digest"].removeprefix("sha1:"):
        raise ValueError(f"damaged record {out['warc-record-id']}")
    http, _, payload = block.partition(_END * 2)
    size = next(int(x.partition(b":")[2]) for x in http.split(_END) if x.lower().startswith(b"content-length:"))
    out["payload_bytes"], out["payload"] = size, None
    if out["warc-type"] == "response":
        if len(payload) != size or digest32(payload) != out["warc-payload-digest"].removeprefix("sha1:"):
            raise ValueError(f"damaged payload {out['warc-record-id']}")
        out["payload"] = payload
    return out


# ------------------------------------------------------------------ writing

@dataclass
class Archive:
    """Folders of an archive: ``root/data`` and ``root/index``; captures and index files as tables."""

    root: str
    captures: str
    index: str


def _typed(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """id, url, payload, and the response (rid, rurl) where the row is a revisit."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    mark = F.struct(F.sha1(F.encode("payload", "UTF-8")).alias("sha"), F.octet_length("payload").alias("size"))
    # the largest id, and of several such rows the smallest URL: min of the URL within max of the id
    narrow = rows.select(mark.alias("m"), "id", "url").groupBy("m", "id").agg(
        F.min(F.struct(F.col("url").isNotNull(), "url")).alias("u"), F.count("*").alias("n"))
    top = (narrow.groupBy("m").agg(F.max(F.struct(F.struct(F.col("id").isNotNull(), "id"), "u")).alias("r"),
                                   F.sum("n").alias("n"))
           .where("n > 1"))  # a payload of its own needs no answer
    salt = F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")
    top = top.select("m", F.col("r.col1.id").alias("rid"), F.col("r.u.url").alias("rurl"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    out = rows.withColumns({"m": mark, "salt": salt}).join(top.withColumn("found", F.lit(True)), ["m", "salt"], "left")
    same = F.col("id").eqNullSafe(F.col("rid")) & F.col("url").eqNullSafe(F.col("rurl"))
    again = F.coalesce(F.col("found"), F.lit(False)) & ~same
    return out.select(F.col("id").cast("string").alias("id"), "url", "payload", again.alias("again"),
                      F.col("rid").cast("string").alias("rid"), "rurl")


def _writer(root: str, date: str, most: int):
    """Task function: rows to records in files of this task; yields the captures."""
    def run(batches):
        client, base = file_system(f"{root}/data")
        client.create_dir(base, recursive=True)
        out, name, at = None, None, 0
        try:
            for batch in batches:
                for part in slices(batch, 2):
                    found = []
                    payloads = as_bytes(part.column(2)).to_pylist()
                    for ident, url, again, rid, rurl, payload in zip(
                            *(part.column(i).to_pylist() for i in (0, 1, 3, 4, 5)), payloads):
                        if out is None or at >= most:
                            if out is not None:
                                out.close()
                            name, at = f"part-{uuid.uuid4().hex}.warc.gz", 0
                            out = client.open_output_stream(f"{base}/{name}", compression=None)
                        raw = gzip.compress(record(ident, url, payload, date, of=(rid, rurl) if again else None),
                                            6, mtime=0)
                        out.write(raw)
                        found.append((url_key(url), ident, url, date, "revisit" if again else "response",
                                      digest32(payload), name, at, len(raw)))
                        at += len(raw)
                    columns = list(zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64() if f in ("offset", "length") else pa.string())
                         for f, c in zip(_FIELDS, columns)], names=_FIELDS)
        finally:
            if out is not None:
                out.close()

    return run


def _remove_unnamed(folder: str, named: set[str]) -> None:
    """Remove what tasks that ran again, or were lost, left in the folder."""
    client, base = file_system(folder)
    for f in client.get_file_info(pafs.FileSelector(base, allow_not_found=True)):
        if f.base_name not in named:
            client.delete_file(f.path)


def _index_writer(root: str, block: int):
    """Task function: sorted captures to one index file; yields it with its first and last key."""
    def run(batches):
        client, base = file_system(f"{root}/index")
        name, lines, directory, at, rows = f"{uuid.uuid4().hex}.idx", [], [], 0, 0
        first = last = None
        client.create_dir(base, recursive=True)
        with client.open_output_stream(f"{base}/{name}", compression=None) as out:
            def flush():
                nonlocal at, lines
                raw = zlib.compress("\n".join(json.dumps(r) for r in lines).encode(), 6)
                out.write(raw)
                directory.append((lines[0][0], at, len(raw)))
                at, lines = at + len(raw), []

            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns)):
                    first, last, rows = (r[0] if first is None else first), r[0], rows + 1
                    lines.append(r)
                    if len(lines) >= block:
                        flush()
            if lines:
                flush()
        if first is None:
            client.delete_file(f"{base}/{name}")
            return
        with client.open_output_stream(f"{base}/{name}.dir", compression=None) as out:
            out.write(zlib.compress("\n".join(json.dumps(d) for d in directory).encode()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (name, first, last, rows, len(directory))],
            names=["file", "first", "last", "rows", "blocks"])

    return run


def build_index(spark: SparkSession, captures: DataFrame, root: str, *, files: int | None = None,
                block: int = BLOCK) -> DataFrame:
    """Index the captures under ``root/index``; a row for each index file."""
    n = captures.count()
    files = files or min(MOST_FILES, max(default_parallelism(spark), -(-n // ROWS_A_FILE)))
    at = scratch_path(spark, "warc-index")
    order = ["key", "id", "file", "offset"]
    (captures.select(*_FIELDS).repartitionByRange(files, *order).sortWithinPartitions(*order)
     .mapInArrow(_index_writer(root, block), "file string, first string, last string, rows long, blocks long")
     .write.parquet(at))
    out = spark.read.parquet(at)
    _remove_unnamed(f"{root}/index", {x for r in out.select("file").collect() for x in (r.file, f"{r.file}.dir")})
    return out


def write_archives(spark: SparkSession, pages: DataFrame, root: str, *, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", date: str = "1970-01-01T00:00:00Z", most: int = ARCHIVE) -> DataFrame:
    """Write the rows as WARC records under ``root/data``; the captures."""
    at = scratch_path(spark, "warc-captures")
    (_typed(pages, id_col, url_col, payload_col)
     .mapInArrow(_writer(root, date, most), CAPTURE).write.parquet(at))
    out = spark.read.schema(CAPTURE).parquet(at)
    # an archive file holds ``most`` bytes or a task's rows, so their names are few
    _remove_unnamed(f"{root}/data", {r.file for r in out.select("file").distinct().collect()})
    return out


# ------------------------------------------------------------------ reading

class _IndexFile:
    """A block directory in memory; blocks by range reads, the last one kept."""

    def __init__(self, client, path: str):
        self.source = client.open_input_file(path)
        with client.open_input_stream(f"{path}.dir", compression=None) as f:
            self.directory = [json.loads(x) for x in zlib.decompress(f.read()).decode().split("\n")]
        self.keys = [d[0] for d in self.directory]
        self.held: tuple[int, list, list] = (-1, [], [])
        self.reads = 0

    def block(self, i: int) -> tuple[list, list]:
        if self.held[0] != i:
            _, at, size = self.directory[i]
            raw = self.source.read_at(size, at)
            rows = [json.loads(x) for x in zlib.decompress(raw).decode().split("\n")]
            self.held = (i, rows, [r[0] for r in rows])
            self.reads += 1
        return self.held[1:]

    def find(self, key: str) -> Iterator[list]:
        # a key can begin in the block before the first block that begins with it
        i = max(0, bisect.bisect_left(self.keys, key) - 1)
        while i < len(self.directory) and self.keys[i] <= key:
            rows, keys = self.block(i)
            yield from rows[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)]
            i += 1


def lookup(spark: SparkSession, root: str, index: DataFrame, urls: DataFrame, *, url_col: str = "url",
           by_key: bool = False) -> DataFrame:
    """The captures of the asked URLs (``by_key``: of all URLs of the same key); each asked URL once."""
    files = sorted((r["first"], r["last"], r["file"]) for r in index.collect())  # MOST_FILES at most
    firsts = [f[0] for f in files]

    def deal(batches):
        for b in batches:
            url, key, where = [], [], []
            for u in b.column(0).to_pylist():
                k = url_key(u)
                i = max(0, bisect.bisect_left(firsts, k) - 1)
                while i < len(files) and files[i][0] <= k:
                    if k <= files[i][1]:
                        url.append(u), key.append(k), where.append(i)
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), pa.array(key, pa.string()),
                                              pa.array(url, pa.string())], names=["n", "key", "url"])

    def find(batches):
        client, base = file_system(f"{root}/index")
        number, index_file = None, None
        for b in batches:
            found = []
            for n, key, url in zip(*(c.to_pylist() for c in b.columns)):
                if n != number:
                    number, index_file = n, _IndexFile(client, f"{base}/{files[n][2]}")
                for row in index_file.find(key):
                    if by_key or row[2] == url:
                        found.append(row)
                        if len(found) >= 10_000:
                            yield _batch(found)
                            found = []
            if found:
                yield _batch(found)

    asked = urls.select(F.col(url_col).cast("string").alias("url")).distinct()
    dealt = asked.mapInArrow(deal, "n int, key string, url string")
    if by_key:
        dealt = dealt.groupBy("n", "key").agg(F.min("url").alias("url"))
    if not files:
        return spark.createDataFrame([], CAPTURE)
    at = scratch_path(spark, "warc-found")  # read twice where it is sorted by place
    (dealt.repartitionById(len(files), F.col("n")).sortWithinPartitions("n", "key")
     .mapInArrow(find, CAPTURE).write.parquet(at))
    return spark.read.schema(CAPTURE).parquet(at)


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64() if f in ("offset", "length") else pa.string()) for f, c in zip(_FIELDS, zip(*rows))],
        names=_FIELDS)


RECORD = ("id string, url string, date string, type string, payload_bytes long, payload_digest string, "
          "refers_to string, payload binary")


def read_records(spark: SparkSession, root: str, captures: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records at the captures' places, each read by its range and checked against its digests."""
    names = [f.split()[0] for f in RECORD.split(", ")]
    kinds = [pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string() for n in names]

    def run(batches):
        client, base = file_system(f"{root}/data")
        name, source, held, size = None, None, [], 0
        for b in batches:
            for file, at, length in zip(*(c.to_pylist() for c in b.columns)):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, client.open_input_file(f"{base}/{file}")
                r = parse(gzip.decompress(source.read_at(length, at)))
                held.append((r.get("x-row-id"), r.get("warc-target-uri"), r["warc-date"], r["warc-type"],
                             r["payload_bytes"], r["warc-payload-digest"].removeprefix("sha1:"),
                             r.get("x-refers-to-row-id"), r["payload"] if with_payload else None))
                size += r["payload_bytes"] if with_payload else 0
                if size >= 16 << 20 or len(held) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    n = max(default_parallelism(spark), 1)
    # by place: records that lie together are read together, and a large file by several tasks
    return (captures.select("file", "offset", "length").repartitionByRange(4 * n, "file", "offset")
            .sortWithinPartitions("file", "offset").mapInArrow(run, RECORD))

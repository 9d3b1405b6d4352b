"""Objects below a prefix as a Spark data source: batch scan, stream and sink.

Every object is a row (object_key, path, length, modificationTime, content), whatever its name: names
that Spark's file sources pass over (``_x``, ``.x``, ``x._COPYING_``) are objects like others.

*Scan.*  The partitions are key ranges: a folder and a range of the names in it, with all that lies
below them.  They are found by splitting: the root is one range; a range of several names is cut into
ranges of about equally many names, one that holds a single folder is replaced by that folder's names, in
rounds, until there are ``splits`` ranges; then only those of over ``WIDE`` names, and up to twice ``splits``
those of a few folders, are cut, until ``PROBES`` folders were looked at.  A folder is listed once, however many
ranges it is cut into.  The driver's planning process holds the ranges and the names in the folders being cut, never
a list of all objects; the tasks list their own ranges.  So one deep, or one wide, folder is dealt to many
tasks.  A wide folder beyond the first ``PROBES`` is read by one task.

*Stream.*  An offset is (modification time, key) of the newest object taken, and a batch holds the objects
after the last offset up to the new one.  A batch lists only folders that changed since the last one where
the store tells a folder's time (others are listed again), and reads new objects only.  The driver goes through
the folders one after the other and keeps ``KNOWN`` names at most; what lies in other folders is listed again.  Objects count once
they are ``settle`` seconds old, so none of one time stamp comes too late; one that appears with an older
time stamp (moved in, clocks apart) is not taken: ``unaccounted_objects`` finds it.  The position is also kept
in a file, as a new run does not learn its start from Spark before it must name an end.

*Sink.*  Every task puts its rows at ``<root>/<key>`` and tells the number, bytes and checksum of what it put
(tasks that ran again do not count twice).  A repeated put of a key replaces the object by the same content.
Where a file system shows half-written files they are written aside and renamed; a failed write removes what
lies aside.  The commit writes the totals to ``report``.

Options: ``root``; ``content`` (false: a listing), ``names`` (all, visible, hidden), ``decode`` (none, suffix: gunzip
``*.gz``, gzip: gunzip all; what cannot be decoded to UTF-8 is a null content), ``splits``, ``settle``, ``position``;
for the sink ``gzip``, ``report``.  Empty objects and checksum files of the local file system are passed over.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import posixpath
import re
import stat
import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter,
                                    DataSourceStreamReader, InputPartition, WriterCommitMessage)

from ..functions.codec import gunzip_bytes
from ..functions.store import file_system
from ..session import default_parallelism, scratch_path

FORMAT = "stored_objects"
SCHEMA = "object_key string, path string, length long, modificationTime timestamp, content binary"
PROBES, SPLITS, WIDE, BATCH_BYTES, BATCH_ROWS = 500, 256, 10_000, 16 << 20, 5000
#: Names of folders that a stream keeps from one batch to the next, and files looked at in one call.
KNOWN, LOOKS = 500_000, 1000
#: Folder below a root for half-written objects; it is no object.
ASIDE = "_shroud-aside-"


def is_hidden(key: str) -> bool:
    """Whether Spark's file sources pass over the key."""
    return any(n.startswith(("_", ".")) or n.endswith("._COPYING_") for n in key.split("/"))


def _time(info: pafs.FileInfo) -> int:
    return info.mtime_ns or 0


def names(client: pafs.FileSystem, base: str, folder: str,
          holds: Callable[[str], bool] | None = None) -> list[tuple[str, bool, bool]]:
    """(name, folder, file) of what lies directly in a folder, by name; only names that ``holds`` takes are kept.
    On a local file system nothing is looked at but the names."""
    local = client.type_name == "local"  # hides its checksum files itself

    def own(name: str, file: bool) -> bool:
        return not (name.startswith(ASIDE) or holds and not holds(name) or local and file and _is_checksum(name))

    if local:
        try:
            with os.scandir(f"{base}/{folder}".rstrip("/") or "/") as inside:
                return sorted((i.name, i.is_dir(), file) for i in inside if own(i.name, file := i.is_file()))
        except FileNotFoundError:
            return []
    return sorted((i.base_name, i.type == pafs.FileType.Directory, i.is_file) for i in
                  client.get_file_info(pafs.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=True))
                  if own(i.base_name, i.is_file))


def _is_checksum(name: str) -> bool:
    return re.fullmatch(r"\..*\.crc", name) is not None


def entries(client: pafs.FileSystem, base: str, folder: str,
            holds: Callable[[str], bool] | None = None) -> Iterator[pafs.FileInfo]:
    """What lies directly in a folder, by name; only names that ``holds`` takes."""
    at = f"{base}/{folder}".rstrip("/")
    if client.type_name == "local":  # many tasks share a folder: each looks at its own files, some at a time
        found = names(client, base, folder, holds)
        for i in range(0, len(found), LOOKS):
            yield from client.get_file_info([f"{at}/{n}" for n, _, _ in found[i:i + LOOKS]])
        return
    found = client.get_file_info(pafs.FileSelector(at, allow_not_found=True))
    yield from sorted((i for i in found if not i.base_name.startswith(ASIDE) and (holds is None or holds(i.base_name))),
                      key=lambda i: i.base_name)


@dataclass(frozen=True)
class KeyRange(InputPartition):
    """The names from ``low`` up to, not with, ``high`` in a folder, and all below them."""

    folder: str
    low: str = ""
    high: str | None = None
    start: tuple = (-1, "")
    end: tuple | None = None

    def holds(self, name: str) -> bool:
        return name >= self.low and (self.high is None or name < self.high)

    def within(self, at: tuple) -> bool:
        return at > self.start and (self.end is None or at <= self.end)


def split_keys(client: pafs.FileSystem, base: str, splits: int = SPLITS, probes: int = PROBES,
               wide: int = WIDE) -> list[KeyRange]:
    """Key ranges that together hold every object once: about ``splits``, and more where a range is ``wide``."""
    # with a range come the names in it, where its folder has been listed
    done, todo, looked = [], [(KeyRange(""), None)], 0
    while todo and looked < probes:
        r, own = todo.pop(0)  # in rounds: every range is looked at before its parts are
        looked += 1
        if own is None:
            own = names(client, base, r.folder)
        enough = len(done) + len(todo) + 1 >= splits
        if len(own) == 1 and own[0][1]:
            todo.append((KeyRange(f"{r.folder}/{own[0][0]}".lstrip("/")), None))
        elif len(own) < 2 or enough and len(own) <= wide and (
                len(own) > 8 or len(done) + len(todo) > 2 * splits or all(file for _, _, file in own)):
            done.append(r)
        else:
            parts = max(len(own) if len(own) <= 8 else 2, -(-len(own) // wide), (splits - len(done) - len(todo)) // (len(todo) + 1))
            cuts = sorted({len(own) * i // min(parts, len(own)) for i in range(min(parts, len(own)))})
            edges = [r.low, *(own[c][0] for c in cuts[1:]), r.high]
            for a, b, start, end in zip(edges, edges[1:], cuts, [*cuts[1:], len(own)]):
                p, some = KeyRange(r.folder, a, b), own[start:end]
                if any(folder for _, folder, _ in some):
                    todo.append((p, some))
                else:  # ranges of files alone are as small as a listing makes them
                    done.append(p)
    return done + [r for r, _ in todo]


def walk(client: pafs.FileSystem, base: str, keys: KeyRange) -> Iterator[tuple[str, pafs.FileInfo]]:
    """(key, file) of the non-empty objects of a key range, a folder at a time."""
    stack = [(keys.folder, keys.holds if keys.low or keys.high is not None else None)]
    while stack:
        folder, holds = stack.pop()
        for i in entries(client, base, folder, holds):
            key = f"{folder}/{i.base_name}".lstrip("/")
            if i.type == pafs.FileType.Directory:
                stack.append((key, None))
            elif i.is_file and i.size:
                yield key, i


class _Options:
    def __init__(self, options: dict):
        self.root = options["root"].rstrip("/")
        local = re.match(r"^(?:file:)?/+(.*)$", self.root)
        self.shown = f"file:/{local.group(1)}" if local else self.root  # as Spark's file sources name it
        self.content = options.get("content", "true") == "true"
        self.names = options.get("names", "all")
        self.decode = options.get("decode", "none")
        self.splits = int(options.get("splits", SPLITS))
        self.settle = float(options.get("settle", "1"))
        self.position, self.report = options.get("position"), options.get("report")
        self.gzip = options.get("gzip", "false") == "true"
        if self.names not in ("all", "visible", "hidden") or self.decode not in ("none", "suffix", "gzip"):
            raise ValueError("names: all, visible or hidden; decode: none, suffix or gzip")

    def read(self, keys: KeyRange) -> Iterator[pa.RecordBatch]:
        client, base = file_system(self.root)
        held, size = [], 0
        for key, info in walk(client, base, keys):
            if not keys.within((_time(info), key)) or self.names != "all" and is_hidden(key) != (self.names == "hidden"):
                continue
            body = None
            if self.content:
                with client.open_input_stream(f"{base}/{key}", compression=None) as f:
                    body = f.read()
                if self.decode == "gzip" or self.decode == "suffix" and key.endswith(".gz"):
                    body = gunzip_bytes(body)
            held.append((key, f"{self.shown}/{key}", info.size, _time(info) // 1000, body))
            size += len(body or b"")
            if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.timestamp("us", "UTC"), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["object_key", "path", "length", "modificationTime", "content"])


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = _Options(options)

    def partitions(self) -> list[KeyRange]:
        return split_keys(*file_system(self.options.root), self.options.splits)

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        return self.options.read(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = _Options(options)
        self.client, self.base = file_system(self.options.root)
        self.known: dict[str, tuple[int, tuple[str, ...]]] = {}  # folder: time, folders in it
        self.last = self._stored()

    def _stored(self) -> tuple:
        if self.options.position:
            client, path = file_system(self.options.position)
            if client.get_file_info(path).is_file:
                with client.open_input_stream(path, compression=None) as f:
                    return tuple(json.loads(f.read()))
        return -1, ""

    def initialOffset(self) -> dict:
        return {"time": -1, "key": ""}

    def _inside(self, folder: str) -> Iterator[tuple[str, bool, int, int]]:
        """(key, folder, size of a file, time) of what lies directly in a folder, in no order."""
        if self.client.type_name == "local":
            try:
                with os.scandir(f"{self.base}/{folder}".rstrip("/") or "/") as inside:
                    for i in inside:
                        try:
                            at = i.stat()
                        except FileNotFoundError:  # gone meanwhile
                            continue
                        file = stat.S_ISREG(at.st_mode)
                        if not (i.name.startswith(ASIDE) or file and _is_checksum(i.name)):
                            yield (f"{folder}/{i.name}".lstrip("/"), stat.S_ISDIR(at.st_mode),
                                   at.st_size if file else 0, at.st_mtime_ns)
            except FileNotFoundError:
                return
        else:
            for i in entries(self.client, self.base, folder):
                yield (f"{folder}/{i.base_name}".lstrip("/"), i.type == pafs.FileType.Directory,
                       i.size if i.is_file else 0, _time(i))

    def _still(self, folders: list[str]) -> Iterator[tuple[str, int]]:
        """(folder, time) of those of some folders that are there."""
        for n in range(0, len(folders), LOOKS):
            own = folders[n:n + LOOKS]
            for f, i in zip(own, self.client.get_file_info([f"{self.base}/{f}" for f in own])):
                if i.type == pafs.FileType.Directory:
                    yield f, _time(i)

    def _newest(self, until: int) -> tuple:
        best, seen, held = self.last, {}, 0
        todo = [iter([("", 0)])]  # folders are taken one by one, never all of a wide folder's at once

        def keep(folder: str, when: int, inside: tuple[str, ...]) -> None:
            nonlocal held
            if held + 1 + len(inside) <= KNOWN:
                seen[folder] = (when, inside)
                held += 1 + len(inside)

        def listed(folder: str, when: int) -> Iterator[tuple[str, int]]:
            nonlocal best
            inside = []
            for key, is_folder, size, at in self._inside(folder):
                if is_folder:
                    if inside is not None:
                        inside.append(key)
                        if held + len(inside) >= KNOWN:  # more than is kept: listed again next time
                            inside = None
                    yield key, at
                elif size and at <= until:
                    best = max(best, (at, key))
            # files come and go only with the folder's time; it must have been quiet when it was listed
            if inside is not None and when and when < until:
                keep(folder, when, tuple(inside))

        while todo:
            folder, when = next(todo[-1], (None, 0))
            if folder is None:
                todo.pop()
                continue
            old = self.known.get(folder)
            if when and old and old[0] == when:
                keep(folder, *old)
                todo.append(self._still(old[1]))
            else:
                todo.append(listed(folder, when))
        self.known = seen
        return best

    def latestOffset(self) -> dict:
        until = time.time_ns()
        time.sleep(self.options.settle)
        at, key = self._newest(until)
        return {"time": at, "key": key}

    def partitions(self, start: dict, end: dict) -> list[KeyRange]:
        a, b = (start["time"], start["key"]), (end["time"], end["key"])
        self.last = max(self.last, b)
        if self.options.position:
            client, path = file_system(self.options.position)
            client.create_dir(posixpath.dirname(path), recursive=True)
            with client.open_output_stream(path, compression=None) as f:
                f.write(json.dumps(self.last).encode())
        return [KeyRange(r.folder, r.low, r.high, a, b)
                for r in split_keys(self.client, self.base, self.options.splits)]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        return self.options.read(partition)

    def __getstate__(self) -> dict:  # tasks only read
        return {"options": self.options}

    def __setstate__(self, state: dict) -> None:
        self.options = state["options"]


@dataclass
class Put(WriterCommitMessage):
    """What a task put: objects, their stored bytes, and the sum of their checksums."""

    objects: int = 0
    bytes: int = 0
    checksum: int = 0

    def add(self, key: str, body: bytes, stored: int) -> None:
        self.objects += 1
        self.bytes += stored
        mark = hashlib.sha256(key.encode() + b"\0" + body).digest()[:16]
        self.checksum = (self.checksum + int.from_bytes(mark)) % (1 << 128)

    def __add__(self, other: Put) -> Put:
        return Put(self.objects + other.objects, self.bytes + other.bytes, (self.checksum + other.checksum) % (1 << 128))


class _Sink:
    """Rows (object_key, content) to objects."""

    def __init__(self, options: dict):
        self.options = _Options(options)
        self.aside = f"{ASIDE}{uuid.uuid4().hex}"

    def put(self, batches: Iterator[pa.RecordBatch]) -> Put:
        client, base = file_system(self.options.root)
        local, made, done = client.type_name == "local", set(), Put()
        for batch in batches:
            for key, body in zip(batch.column("object_key"), batch.column("content")):
                key, body = key.as_py(), body.as_py() or b""
                if not key or ".." in key.split("/"):
                    raise ValueError(f"not an object key: {key!r}")
                # object stores show an object once it is complete
                at = f"{base}/{self.aside}/{uuid.uuid4().hex}" if local else f"{base}/{key}"
                for folder in {posixpath.dirname(f"{base}/{key}"), posixpath.dirname(at)} - made:
                    client.create_dir(folder, recursive=True)
                    made.add(folder)
                # no time stamp within: a repeated put writes the same bytes
                raw = gzip.compress(body, mtime=0) if self.options.gzip else body
                with client.open_output_stream(at, compression=None) as out:
                    out.write(raw)
                if local:
                    client.move(at, f"{base}/{key}")
                done.add(key, body, len(raw))
        return done

    def clear(self) -> None:
        client, base = file_system(self.options.root)
        if client.get_file_info(f"{base}/{self.aside}").type == pafs.FileType.Directory:
            client.delete_dir(f"{base}/{self.aside}")

    def finish(self, messages: list, name: str = "") -> None:
        self.clear()
        total = sum((m for m in messages if m is not None), Put())
        if self.options.report:
            client, path = file_system(self.options.report + name)
            client.create_dir(posixpath.dirname(path), recursive=True)
            with client.open_output_stream(path, compression=None) as out:
                out.write(json.dumps({"objects": total.objects, "bytes": total.bytes,
                                      "checksum": f"{total.checksum:032x}"}).encode())


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.sink = _Sink(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Put:
        return self.sink.put(iterator)

    def commit(self, messages: list) -> None:
        self.sink.finish(messages)

    def abort(self, messages: list) -> None:
        self.sink.clear()


class _StreamWriter(DataSourceStreamArrowWriter):
    """As the batch sink; a batch that runs again puts the same objects and replaces its report."""

    def __init__(self, options: dict):
        self.sink = _Sink(options)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Put:
        return self.sink.put(iterator)

    def commit(self, messages: list, batchId: int) -> None:
        self.sink.finish(messages, f"/batch={batchId}.json")

    def abort(self, messages: list, batchId: int) -> None:
        self.sink.clear()


class StoredObjects(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(dict(self.options))


def _register(spark) -> None:
    if not getattr(spark, "_has_stored_objects", False):
        spark.dataSource.register(StoredObjects)
        spark._has_stored_objects = True


def reader_of(spark, root: str, stream: bool = False, **options):
    """A (stream) reader of the objects below ``root``."""
    _register(spark)
    r = (spark.readStream if stream else spark.read).format(FORMAT).option("root", root)
    for k, v in {"splits": 4 * default_parallelism(spark), **options}.items():
        r = r.option(k, str(v).lower() if isinstance(v, bool) else v)
    return r


def store(df, root: str, *, gzip: bool = False) -> dict:
    """Put the rows (object_key string, content binary); objects, bytes and checksum of what was put."""
    spark = df.sparkSession
    _register(spark)
    report = scratch_path(spark, "stored")
    (df.select("object_key", "content").write.format(FORMAT).mode("append").option("root", root)
     .option("gzip", str(gzip).lower()).option("report", report).save())
    client, path = file_system(report)
    with client.open_input_stream(path, compression=None) as f:
        return json.loads(f.read())


def found(keys, root: str):
    """(object_key, length, modificationTime) of those of ``keys`` (object_key) that are stored: a look at
    each key, whatever else lies below the root."""
    def look(batches):
        client, base = file_system(root)
        for b in batches:
            own = b.column(0).to_pylist()
            infos = client.get_file_info([f"{base}/{k}" for k in own])
            rows = [(k, i.size, _time(i) // 1000) for k, i in zip(own, infos) if i.is_file]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.timestamp("us", "UTC")))],
                    names=["object_key", "length", "modificationTime"])

    return keys.select("object_key").mapInArrow(look, "object_key string, length long, modificationTime timestamp")

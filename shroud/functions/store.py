"""The file system of an object root, for tasks that read or write single objects."""

from __future__ import annotations

import re

import pyarrow as pa
from pyarrow import fs as pafs


def file_system(root: str) -> tuple[pafs.FileSystem, str]:
    """(client, path of the root without a closing slash).

    ``/x``, ``file:/x`` and ``file:///x`` are local; other schemes are what Arrow
    knows (``s3``, also named ``s3a``, ``gs``, ``abfs``, ``hdfs``).  Unknown schemes raise."""
    local = re.match(r"^(?:file:)?/+(.*)$", root)
    if local:
        return pafs.LocalFileSystem(), "/" + local.group(1).rstrip("/")
    client, path = pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", root))
    return client, path.rstrip("/")


def reachable(root: str) -> bool:
    """Whether tasks can open objects below the root by themselves."""
    try:
        file_system(root)
    except (pa.ArrowException, OSError, ImportError):
        return False
    return True


def place(path: str, clients: dict) -> tuple[pafs.FileSystem, str]:
    """(client, path within it) of one object; ``clients`` keeps a client for each store."""
    store = re.match(r"^(?!file:)[A-Za-z0-9+.-]+://[^/]+", path)
    if not store:
        return file_system(path)
    if store.group() not in clients:
        clients[store.group()] = file_system(store.group())
    client, base = clients[store.group()]
    return client, base + path[store.end():]

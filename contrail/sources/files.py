"""Files of any store that an address names, read and written within tasks."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

from pyarrow import fs


def located(address: str) -> tuple[fs.FileSystem, str]:
    """The store of an address and the path in it; an address without a scheme is a local path."""
    if "://" in address or address.startswith("file:"):
        return fs.FileSystem.from_uri(address if "://" in address else "file://" + address.removeprefix("file:"))
    return fs.LocalFileSystem(), os.path.abspath(address)


def listed(address: str, ending: str = "") -> list[str]:
    """Paths of the files below an address, or the file that it names, in order; none if there is nothing."""
    store, path = located(address)
    info = store.get_file_info(path)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        return []
    found = store.get_file_info(fs.FileSelector(path, recursive=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.path.endswith(ending) and not f.base_name.startswith(("_", ".")))


def put(address: str, name: str, content: bytes) -> None:
    """Writes a file as a whole: under another name first, so that a task that runs twice leaves one whole file."""
    store, path = located(address)
    store.create_dir(path, recursive=True)
    rough = f"{path}/.{name}-{uuid.uuid4()}"
    with store.open_output_stream(rough) as out:
        out.write(content)
    store.move(rough, f"{path}/{name}")


def content(address: str) -> bytes:
    """A file's bytes."""
    store, path = located(address)
    with store.open_input_file(path) as file:
        return file.read()


def hashed(address: str) -> tuple[str, int] | None:
    """SHA-256 and size of a file, read piece by piece; none if it is missing."""
    store, path = located(address)
    if store.get_file_info(path).type != fs.FileType.File:
        return None
    digest, size = hashlib.sha256(), 0
    with store.open_input_stream(path) as file:
        while piece := file.read(1 << 20):
            digest.update(piece)
            size += len(piece)
    return digest.hexdigest(), size


def lines(address: str) -> Iterator[str]:
    """The lines of a file, one at a time."""
    store, path = located(address)
    with store.open_input_stream(path) as file:
        rest = b""
        while piece := file.read(1 << 20):
            *whole, rest = (rest + piece).split(b"\n")
            yield from (x.decode() for x in whole)
        if rest:
            yield rest.decode()

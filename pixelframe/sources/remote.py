"""Listing, reading and writing files from inside a task."""

from __future__ import annotations

import re
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs

#: Files up to this size are read whole, with one request.
SMALL_BYTES = 4 << 20


class TaskStorage:
    """File access for one task; keeps one client per scheme and host."""

    def __init__(self) -> None:
        self._clients: dict[str, tuple[pafs.FileSystem, str]] = {}
        self._made = ""

    def _resolve(self, uri: str) -> tuple[pafs.FileSystem, str, str]:
        # Spark says file:/x and s3a://, the client file:///x and s3://.
        uri = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", uri)).rstrip("/")
        host = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/]*)?", uri).group(0)
        if host not in self._clients:
            # Names are taken as they stand; the client wants a URI, where a space is %20.
            asked = quote(uri, safe=":/?=&@,+~") if "://" in uri else uri
            client, inner = pafs.FileSystem.from_uri(asked)
            self._clients[host] = (client, uri.removesuffix(inner))
        client, prefix = self._clients[host]
        return client, prefix, uri.removeprefix(prefix)

    def list_files(self, directory: str) -> list[tuple[str, int]]:
        """(path, length) of every file below ``directory``; none if it is missing."""
        client, prefix, inner = self._resolve(directory)
        selector = pafs.FileSelector(inner, recursive=True, allow_not_found=True)
        return [
            (prefix + info.path, info.size)
            for info in client.get_file_info(selector)
            if info.type == pafs.FileType.File
        ]

    def children(self, directory: str) -> list[tuple[str, int, bool]]:
        """(path, length, is a directory) of the files and directories right in ``directory``."""
        client, prefix, inner = self._resolve(directory)
        selector = pafs.FileSelector(inner, allow_not_found=True)
        return [
            (prefix + info.path, info.size or 0, info.type == pafs.FileType.Directory)
            for info in client.get_file_info(selector)
            if info.type in (pafs.FileType.File, pafs.FileType.Directory)
        ]

    def waits(self, path: str) -> bool:
        """Whether requests wait on a network; for the machine's own files threads cost more than they save."""
        return not isinstance(self._resolve(path)[0], pafs.LocalFileSystem)

    def open(self, path: str) -> pa.NativeFile | None:
        """A file to be read at any place, None if there is no such file; a small one is fetched at once."""
        client, _, inner = self._resolve(path)
        try:
            file = client.open_input_file(inner)
            if file.size() > SMALL_BYTES:
                return file
            with file:
                return pa.BufferReader(file.read_buffer())
        except FileNotFoundError:
            return None

    def write(self, path: str, content: bytes | pa.Buffer) -> None:
        """Write a file, replacing what an earlier attempt of the task left."""
        client, _, inner = self._resolve(path)
        directory = path.rsplit("/", 1)[0]
        if directory != self._made:
            client.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            self._made = directory
        with client.open_output_stream(inner) as stream:
            stream.write(content)

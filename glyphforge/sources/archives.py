"""ZIP archives as a data source (S16, T21): members are read by many tasks, and written as an archive a task.

A partition is a range of an archive's central directory. The driver reads no more of an archive than its end record; a
task walks the directory, decodes the names in its range, and reads the bytes of these members alone.
"""

from __future__ import annotations

import bz2
import io
import json
import lzma
import os
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "archive string, member string, size long, content binary"
_ARROW = pa.schema([("archive", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("content", pa.binary())])
#: Bytes of contents in a batch, and members in one.
BATCH_BYTES, BATCH_ROWS = 32 << 20, 10_000
#: Least members of a partition that reads contents.
MEMBERS = 1000
#: Partitions of an archive at most, each of which passes over the entries before its own; beyond, partitions have more members.
RANGES = 64

# Fixed values of the format: signatures and layouts of its records.
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
_END_LAYOUT, _END64_LAYOUT, _LOCATOR64_LAYOUT = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL"
_ENTRY_LAYOUT, _LOCAL_LAYOUT = "<4s6H3L5H2L", "<4s5H3L2H"
_UTF8, _ENCRYPTED = 0x800, 0x1


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme, or with file:, is local."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str) -> list[tuple[str, int]]:
    """Path and size of an archive, or of all .zip files below a folder."""
    files, inner = store(path)
    info = files.get_file_info(inner)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = files.get_file_info(fs.FileSelector(inner, recursive=True))
    head = path[: len(path) - len(inner)] if path.endswith(inner) else "file:" if path.startswith("file:") else ""
    return sorted((head + f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.lower().endswith(".zip"))


@dataclass
class Directory:
    """Where an archive's central directory is, and how many entries it has."""

    at: int
    size: int
    entries: int
    shift: int  # bytes that stand before the archive proper


def directory(f: io.RawIOBase, size: int) -> Directory:
    tail = min(size, (1 << 16) + 22 + 20)
    f.seek(size - tail)
    data = f.read(tail)
    k = data.rfind(_END)
    if k < 0:
        raise ValueError("not a ZIP archive: no end record")
    _, _, _, _, entries, length, at, _ = struct.unpack_from(_END_LAYOUT, data, k)
    end = size - tail + k
    if k >= 20 and data[k - 20 : k - 16] == _LOCATOR64:
        _, _, place, _ = struct.unpack_from(_LOCATOR64_LAYOUT, data, k - 20)
        f.seek(place)
        record = f.read(struct.calcsize(_END64_LAYOUT))
        if record[:4] == _END64:
            *_, entries, length, at = struct.unpack(_END64_LAYOUT, record)
            end = place
    return Directory(end - length, length, entries, end - length - at)


@dataclass
class Member:
    name: str
    size: int
    packed: int
    method: int
    flags: int
    crc: int
    at: int


def repair_name(name: bytes, utf8: bool) -> str:
    """Names are UTF-8 if marked so, else cp949, else cp437."""
    if utf8:
        return name.decode("utf-8", "replace")
    try:
        return name.decode("cp949")
    except UnicodeError:
        return name.decode("cp437")


def safe(name: str) -> bool:
    """Whether a member is a file that stays in the target folder."""
    return not (name.endswith("/") or name.startswith("/") or ".." in name.split("/") or name[1:2] == ":")


def members(f: io.RawIOBase, d: Directory, first: int, last: int) -> Iterator[Member]:
    """Entries first to last - 1 of the directory; those before are passed over by their lengths."""
    f.seek(d.at)
    fixed = struct.calcsize(_ENTRY_LAYOUT)
    reader = io.BufferedReader(f, 1 << 20)
    for k in range(last):
        head = reader.read(fixed)
        if head[:4] != _ENTRY:
            raise ValueError("not a ZIP archive: the directory ends early")
        _, _, _, flags, method, _, _, crc, packed, size, n, extra, comment, _, _, _, at = struct.unpack(_ENTRY_LAYOUT, head)
        rest = reader.read(n + extra + comment)
        if k < first:
            continue
        more = rest[n : n + extra]
        while len(more) >= 4:
            kind, length = struct.unpack_from("<2H", more)
            if kind == 1:  # sizes and place that need 64 bits, those alone, in this order
                wide = iter(struct.unpack_from(f"<{length // 8}Q", more, 4))
                size = next(wide) if size == 0xFFFFFFFF else size
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                at = next(wide) if at == 0xFFFFFFFF else at
            more = more[4 + length :]
        yield Member(repair_name(rest[:n], bool(flags & _UTF8)).replace("\\", "/"), size, packed, method, flags, crc, at + d.shift)
    reader.detach()


def content(f: io.RawIOBase, m: Member) -> bytes:
    if m.flags & _ENCRYPTED:
        raise ValueError(f"member {m.name} is encrypted")
    f.seek(m.at)
    head = f.read(struct.calcsize(_LOCAL_LAYOUT))
    if head[:4] != _LOCAL:
        raise ValueError(f"member {m.name} has no header")
    *_, n, extra = struct.unpack(_LOCAL_LAYOUT, head)
    f.seek(m.at + len(head) + n + extra)
    data = f.read(m.packed)
    if m.method == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15)
    elif m.method == zipfile.ZIP_BZIP2:
        data = bz2.decompress(data)
    elif m.method == zipfile.ZIP_LZMA:
        _, size = struct.unpack_from("<2H", data)
        kind = lzma._decode_filter_properties(lzma.FILTER_LZMA1, data[4 : 4 + size])
        data = lzma.LZMADecompressor(lzma.FORMAT_RAW, filters=[kind]).decompress(data[4 + size :])
    elif m.method != zipfile.ZIP_STORED:
        raise ValueError(f"member {m.name} is packed by unknown method {m.method}")
    if zlib.crc32(data) != m.crc:
        raise ValueError(f"member {m.name} is damaged")
    return data


@dataclass
class Range(InputPartition):
    archive: str
    directory: Directory
    first: int
    last: int


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.contents = str(options.get("contents", "false")).lower() == "true"
        self.members = int(options.get("members", MEMBERS))

    def partitions(self) -> list[Range]:
        out = []
        for path, size in listed(self.path):
            files, inner = store(path)
            with files.open_input_file(inner) as f:
                d = directory(f, size)
            step = max(self.members, -(-d.entries // RANGES))
            out += [Range(path, d, k, min(k + step, d.entries)) for k in range(0, d.entries, step)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        files, inner = store(partition.archive)
        rows: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            names, sizes, data = zip(*rows, strict=True)
            return pa.record_batch([pa.array([partition.archive] * len(rows), pa.string()), pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], schema=_ARROW)

        with files.open_input_file(inner) as names, files.open_input_file(inner) as data:
            for m in members(names, partition.directory, partition.first, partition.last):
                if not safe(m.name):
                    continue
                if rows and (held + m.size > BATCH_BYTES or len(rows) >= BATCH_ROWS):
                    yield batch()
                    rows, held = [], 0
                rows.append((m.name, m.size, content(data, m) if self.contents else None))
                held += m.size if self.contents else 0
        if rows:
            yield batch()


@dataclass
class Part(WriterCommitMessage):
    path: str
    members: int


class ArchiveWriter(DataSourceArrowWriter):
    """An archive for each task, complete or absent: written under a hidden name, and given its own when all tasks are done."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.run = options["path"], overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        files, inner = store(self.path)
        files.create_dir(inner, recursive=True)
        name = f"{inner}/.{self.run}-{uuid.uuid4().hex}.tmp"
        n = 0
        with files.open_output_stream(name) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for batch in iterator:
                for member, data in zip(batch.column("member").to_pylist(), batch.column("content").to_pylist(), strict=True):
                    info = zipfile.ZipInfo(member)  # a fixed date, so that reruns write the same bytes
                    info.compress_type = zipfile.ZIP_DEFLATED
                    z.writestr(info, data or b"")
                    n += 1
        return Part(name, n)

    def commit(self, messages: list[Part | None]) -> None:
        files, inner = store(self.path)
        old = [f.path for f in files.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if f.path.lower().endswith(".zip")] if self.overwrite else []
        parts = [m for m in messages if m is not None and m.members]
        for k, part in enumerate(parts):
            files.move(part.path, f"{inner}/part-{k:05d}-{self.run}.zip")
        for path in old:
            files.delete_file(path)
        for m in messages:
            if m is not None and not m.members:
                files.delete_file(m.path)
        with files.open_output_stream(f"{inner}/_MANIFEST") as out:
            out.write(json.dumps([{"archive": f"part-{k:05d}-{self.run}.zip", "members": p.members} for k, p in enumerate(parts)]).encode())

    def abort(self, messages: list[Part | None]) -> None:
        files, inner = store(self.path)
        for f in files.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
            if os.path.basename(f.path).startswith(f".{self.run}-"):
                files.delete_file(f.path)


class ArchiveSource(DataSource):
    """Format zip_members: read options contents (false) and members (of a partition); write columns member and content."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options, overwrite)

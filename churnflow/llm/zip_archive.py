"""Members of ZIP files by byte range: the directories at the end of the file, nothing extracted."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

from churnflow.llm.files import RangeReader

STORED = 0
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF  # the value is in the ZIP64 record or field


class ZipError(ValueError):
    pass


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    encrypted: bool
    compressed: int
    size: int
    header: int

    def start(self, file: RangeReader) -> int:
        """Where the member's bytes begin: its local header has name and extra lengths of its own."""
        local = file.read(self.header, 30)
        if local[:4] != _LOCAL:
            raise ZipError(f"no local header of {self.name} at {self.header}")
        name, extra = struct.unpack("<HH", local[26:30])
        return self.header + 30 + name + extra


def _directory(file: RangeReader) -> tuple[int, int, int]:
    """Offset, length and number of entries of the central directory."""
    tail_size = min(file.size, 22 + _FULL16)
    tail = file.read(file.size - tail_size, tail_size)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack("<H", tail[at + 20 : at + 22])[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise ZipError("no end of central directory")
    disk, first_disk, here, entries, length, offset = struct.unpack("<4H2I", tail[at + 4 : at + 20])
    end = file.size - tail_size + at
    if end >= 20 and _FULL16 in (disk, first_disk, here, entries) or _FULL32 in (length, offset):
        locator = file.read(end - 20, 20) if end >= 20 else b""
        if locator[:4] == _LOCATOR64:
            _, place, disks = struct.unpack("<IQI", locator[4:])
            record = file.read(place, 56)
            if record[:4] != _END64 or disks > 1:
                raise ZipError("no ZIP64 end of central directory, or several disks")
            disk, first_disk, here, entries, length, offset = struct.unpack("<2I4Q", record[16:])
    if disk or first_disk or here != entries:
        raise ZipError("an archive over several disks")
    return offset, length, entries


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Size, compressed size and header offset, those that are full taken from the ZIP64 extra field."""
    while len(extra) >= 4:
        kind, length = struct.unpack("<HH", extra[:4])
        if kind == 1:
            field = extra[4 : 4 + length]
            wide = []
            for value in values:
                if value == _FULL32:
                    if len(field) < 8:
                        raise ZipError("a ZIP64 field is too short")
                    value, field = struct.unpack("<Q", field[:8])[0], field[8:]
                wide.append(value)
            return wide
        extra = extra[4 + length :]
    return values


def members(file: RangeReader, chunk: int = 1 << 20) -> Iterator[Member]:
    """Entries of the central directory, which is read in parts of ``chunk`` bytes."""
    place, left, entries = _directory(file)
    data = b""

    def need(n: int) -> None:
        nonlocal data, place, left
        while len(data) < n:
            part = min(left, max(chunk, n - len(data)))
            if not part:
                raise ZipError("the central directory ends early")
            data += file.read(place, part)
            place, left = place + part, left - part

    for _ in range(entries):
        need(46)
        if data[:4] != _ENTRY:
            raise ZipError("no central directory entry where one should be")
        flags, method = struct.unpack("<HH", data[8:12])
        compressed, size, name, extra, comment = struct.unpack("<2I3H", data[20:34])
        header = struct.unpack("<I", data[42:46])[0]
        need(46 + name + extra + comment)
        size, compressed, header = _wide(data[46 + name : 46 + name + extra], [size, compressed, header])
        title = data[46 : 46 + name].decode("utf-8" if flags & 0x800 else "cp437")
        data = data[46 + name + extra + comment :]
        yield Member(title, method, bool(flags & 1), compressed, size, header)


def stored_range(file: RangeReader, member: Member) -> tuple[int, int]:
    """Offset and length in the file of a member that is neither compressed nor encrypted."""
    if member.method != STORED or member.encrypted or member.compressed != member.size:
        raise ZipError(f"{member.name} is not stored as it is")
    return member.start(file), member.size

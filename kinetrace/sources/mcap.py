"""Messages of mcap files, by the public format: records of an opcode and a length, some of them in
compressed chunks.

A file is read twice: once for when each wanted message was logged and where it stands, then in that
order, with the few chunks at hand that the order needs at a time. A task so holds an index of its
file's messages and some chunks, not the messages.
"""

from __future__ import annotations

import struct
from collections import OrderedDict
from collections.abc import Iterator
from pathlib import Path

#: Fixed values of the format: its magic bytes and the opcodes that are read here.
MAGIC = b"\x89MCAP0\r\n"
FOOTER, SCHEMA, CHANNEL, MESSAGE, CHUNK, CHUNK_INDEX, DATA_END = 0x02, 0x03, 0x04, 0x05, 0x06, 0x08, 0x0F
HELD_CHUNKS = 8


class McapError(ValueError):
    """A file doesn't follow the format, or uses what isn't installed here."""


def text(data: bytes, at: int) -> tuple[str, int]:
    (n,) = struct.unpack_from("<I", data, at)
    return data[at + 4 : at + 4 + n].decode(), at + 4 + n


def records(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(opcode, start, stop) of the records in a chunk."""
    at = 0
    while at + 9 <= len(data):
        op, n = struct.unpack_from("<BQ", data, at)
        at += 9
        if at + n > len(data):
            raise McapError("a record is cut off")
        yield op, at, at + n
        at += n


def file_records(f) -> Iterator[tuple[int, int, int]]:
    """(opcode, start, stop) of the top records of an open file, whose bodies are left unread."""
    f.seek(0)
    if f.read(8) != MAGIC:
        raise McapError("the file doesn't start as mcap does")
    at, end = 8, f.seek(0, 2)
    while at + 9 <= end:
        f.seek(at)
        head = f.read(9)
        if head[:8] == MAGIC:
            return
        op, n = struct.unpack("<BQ", head)
        at += 9
        if at + n > end:
            raise McapError("a record is cut off")
        yield op, at, at + n
        at += n


def unpacked(body: bytes) -> bytes:
    """The records of a chunk."""
    (size,) = struct.unpack_from("<Q", body, 16)
    how, at = text(body, 28)
    (n,) = struct.unpack_from("<Q", body, at)
    raw = body[at + 8 : at + 8 + n]
    if how == "zstd":
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=size)
    elif how == "lz4":
        try:
            import lz4.frame
        except ImportError as e:
            raise McapError("lz4 chunks need the lz4 library on the executors") from e
        raw = lz4.frame.decompress(raw)
    elif how:
        raise McapError(f"unknown compression {how!r}")
    if len(raw) != size:
        raise McapError("a chunk has another size than it says")
    return raw


def summary(path: str | Path) -> tuple[dict[int, tuple[str, str]], list[tuple[int, int, int]]] | None:
    """(channels, chunks as (start of the body, stop, earliest time) in the file's order) by the summary at
    the file's end; None where it doesn't cover all messages."""
    with open(path, "rb") as f:
        size = f.seek(0, 2)
        if size < 2 * len(MAGIC) + 29:
            return None
        f.seek(size - len(MAGIC) - 29)
        foot = f.read(29)
        op, _, at, _, _ = struct.unpack("<BQQQI", foot)
        if op != FOOTER or not 0 < at < size:
            return None
        f.seek(at)
        data = f.read(size - len(MAGIC) - 29 - at)
        types: dict[int, str] = {}
        channels: dict[int, tuple[str, str]] = {}
        chunks = []
        for op, a, b in records(data):
            if op == SCHEMA:
                types[struct.unpack_from("<H", data, a)[0]] = text(data, a + 2)[0]
            elif op == CHANNEL:
                number, schema = struct.unpack_from("<HH", data, a)
                channels[number] = text(data, a + 4)[0], types.get(schema, "")
            elif op == CHUNK_INDEX:
                earliest, _, start, length, n = struct.unpack_from("<QQQQI", data, a)
                (indexes,) = struct.unpack_from("<Q", data, a + 36 + n)
                chunks.append((start, length, indexes, earliest))
        if not chunks or not channels:
            return None
        chunks.sort()
        # Chunks must follow each other without a gap, from the head's records to the end of the data.
        for (start, length, indexes, _), (following, *_) in zip(chunks, chunks[1:]):
            if start + length + indexes != following:
                return None
        for op, a, _ in file_records(f):
            if op == CHUNK:
                break
            if op == MESSAGE:
                return None
        f.seek(chunks[-1][0] + sum(chunks[-1][1:3]))
        if a - 9 != chunks[0][0] or f.read(1) != bytes([DATA_END]):
            return None
        return channels, [(start + 9, start + length, earliest) for start, length, _, earliest in chunks]


class Scan:
    """An open file's channels and an index of its wanted messages: (log time, chunk start, place within it
    or -1, chunk stop). With `chunks` only these are read, and `channels` must name what they use."""

    def __init__(self, f, topics: list[str] | None, channels: dict | None = None, chunks: list[tuple[int, int]] | None = None, lo: int | None = None, hi: int | None = None):
        self.f, self.topics, self.lo, self.hi = f, topics, lo, hi
        self.types: dict[int, str] = {}
        self.channels = dict(channels or {})
        self.index: list[tuple[int, int, int, int, str]] = []
        for op, start, stop in [(CHUNK, a, b) for a, b in chunks] if chunks else file_records(f):
            if op == CHUNK:
                data = unpacked(self.body(start, stop))
                for inner, a, b in records(data):
                    self.note(inner, data[a : b if inner != MESSAGE else a + 22], start, stop, a)
            elif op in (SCHEMA, CHANNEL):
                self.note(op, self.body(start, stop), -1, -1, start)
            elif op == MESSAGE:
                self.note(op, self.body(start, start + 22), start, stop, -1)
        self.index.sort()

    def body(self, start: int, stop: int) -> bytes:
        self.f.seek(start)
        return self.f.read(stop - start)

    def note(self, op: int, data: bytes, start: int, stop: int, at: int) -> None:
        if op == SCHEMA:
            (number,) = struct.unpack_from("<H", data)
            self.types[number] = text(data, 2)[0]
        elif op == CHANNEL:
            number, schema = struct.unpack_from("<HH", data)
            self.channels[number] = text(data, 4)[0], self.types.get(schema) or self.channels.get(number, ("", ""))[1]
        elif op == MESSAGE:
            channel, _, logged = struct.unpack_from("<HIQ", data)
            if channel not in self.channels:
                raise McapError(f"a message of an unknown channel {channel}")
            topic = self.channels[channel][0]
            inside = (self.lo is None or logged >= self.lo) and (self.hi is None or logged < self.hi)
            if inside and (self.topics is None or topic in self.topics):
                self.index.append((logged, start, at, stop, topic))

    def messages(self) -> Iterator[tuple[tuple[int, int], tuple[str, str, int, bytes]]]:
        held: OrderedDict[int, bytes] = OrderedDict()
        for logged, start, at, stop, _ in self.index:
            if at < 0:
                data, a, b = self.body(start, stop), 0, stop - start
            else:
                if start not in held:
                    held[start] = unpacked(self.body(start, stop))
                    if len(held) > HELD_CHUNKS:
                        held.popitem(last=False)
                held.move_to_end(start)
                data, a = held[start], at
                b = a + struct.unpack_from("<Q", data, a - 8)[0]
            topic, kind = self.channels[struct.unpack_from("<H", data, a)[0]]
            yield (start, at), (topic, kind, logged, data[a + 22 : b])


def times(path: str | Path, topics: list[str] | None = None, channels: dict | None = None, chunks: list[tuple[int, int]] | None = None) -> Iterator[tuple[str, int]]:
    """(topic, log time) of each wanted message."""
    with open(path, "rb") as f:
        for logged, *_, topic in Scan(f, topics, channels, chunks).index:
            yield topic, logged


def placed(path: str | Path, topics: list[str] | None = None, channels: dict | None = None, chunks: list[tuple[int, int]] | None = None, lo: int | None = None, hi: int | None = None) -> Iterator[tuple[tuple[int, int], tuple[str, str, int, bytes]]]:
    """(place, message) of the messages with lo <= log time < hi, in order of time and place."""
    with open(path, "rb") as f:
        yield from Scan(f, topics, channels, chunks, lo, hi).messages()


def read(path: str | Path, topics: list[str] | None = None) -> Iterator[tuple[str, str, int, bytes]]:
    """(topic, type, log time, payload) in order of the log time, then of the file."""
    for _, message in placed(path, topics):
        yield message

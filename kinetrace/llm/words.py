"""Words of whole texts in numpy: blocks of documents, and parts of long ones, cut into words at once.

A byte's class says what it is: part of a word, a sign between words, or a break, which also ends the
piece that n-grams may not leave. All signs and breaks are ASCII, so UTF-8 bytes are cut where characters
would be. A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from .common import BASE, mix, prefix_hash, range_hash, utf8

#: Bytes of text that are cut into words together.
BLOCK = 8 << 20
WORD, SIGN, BREAK = 0, 1, 2

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def classes(sign: bytes, breaks: bytes = b"") -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(sign)] = SIGN
    out[list(breaks)] = BREAK
    return out


def fingerprints(col: pa.Array, beyond: int = 0) -> np.ndarray:
    """64-bit fingerprints of strings, without the last `beyond` bytes of each."""
    data, at = utf8(col)
    return range_hash(prefix_hash(data), at[:-1], at[1:] - beyond)


def chained(words: list[np.ndarray]) -> np.ndarray:
    """Fingerprints of n-grams from those of their words, one array a place."""
    out = words[0]
    for k, own in enumerate(words[1:], 2):
        out = mix(out * np.uint64(BASE) + own + np.uint64(k))
    return out


@dataclass
class Unit:
    """A text, or a part of a long one: its bytes from `begin` on, `context` words of them counted by the part before."""

    tag: object
    data: np.ndarray
    context: int = 0
    first: bool = True
    last: bool = True


@dataclass
class Block:
    data: np.ndarray  #: the words' bytes, lower-cased, one space after each
    at: np.ndarray  #: where each word starts in data, and where the last one ends
    unit: np.ndarray  #: for each word the number of its unit
    piece: np.ndarray  #: equal for words of one piece
    units: list[Unit]
    group: object = None
    bounds: np.ndarray = field(init=False)  #: the first word of each unit, and the number of words

    def __post_init__(self):
        self.bounds = np.searchsorted(self.unit, np.arange(len(self.units) + 1))

    def __len__(self) -> int:
        return len(self.unit)

    def word_array(self) -> pa.Array:
        """The words, each with the space after it."""
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(self.at), pa.py_buffer(self.data)])

    def ids(self) -> tuple[np.ndarray, pa.Array]:
        """An id for each word, equal for equal words and for no others, and the word of each id."""
        if not len(self):
            return np.zeros(0, np.int64), pa.array([], pa.large_binary())
        coded = self.word_array().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def counted(self, n: int) -> np.ndarray:
        """Where n-grams start that lie in one piece and end in a word no earlier part has counted."""
        last = len(self) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        ok = self.piece[:last] == self.piece[n - 1 :]
        context = np.fromiter((u.context for u in self.units), np.int64, len(self.units))
        if context.any():
            ok &= np.arange(n - 1, len(self)) >= (self.bounds[:-1] + context)[self.unit[n - 1 :]]
        return np.flatnonzero(ok)


def cut(units: list[Unit], kind: np.ndarray, group: object = None) -> Block:
    sizes = [len(u.data) for u in units]
    edges = np.cumsum([0, *sizes])
    raw = np.concatenate([u.data for u in units]) if units else np.zeros(0, np.uint8)
    what = kind[raw]
    inside = what == WORD
    joined = np.zeros(len(raw) + 1, bool)  # whether a word goes on from one byte to the next
    joined[1:-1] = inside[1:] & inside[:-1]
    joined[edges] = False
    starts = np.flatnonzero(inside & ~joined[:-1])
    stops = np.flatnonzero(inside & ~joined[1:]) + 1
    unit = np.searchsorted(edges, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(what == BREAK), starts) + unit
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(stops - starts + 1, out=at[1:])
    data = np.full(int(at[-1]), 32, np.uint8)
    room = np.ones(len(data), bool)
    room[at[1:] - 1] = False
    data[room] = LOWER[raw[inside]]
    return Block(data, at, unit, piece, list(units), group)


def parts(tag: object, data: np.ndarray, kind: np.ndarray, limit: int, overlap: int) -> Iterator[Unit]:
    """A text of over `limit` bytes in parts that end between words; each starts with the `overlap` words
    before it."""
    begin, done, context = 0, 0, 0
    while True:
        end = min(done + limit, len(data))
        while end < len(data) and kind[data[end]] == WORD:
            ahead = np.flatnonzero(kind[data[end : end + limit]] != WORD)
            end = end + int(ahead[0]) if len(ahead) else min(end + limit, len(data))
        yield Unit(tag, data[begin:end], context, done == 0, end == len(data))
        if end == len(data):
            return
        begin, context, reach = end, 0, 1024
        while overlap and context < overlap and begin > 0:  # the last words before the cut
            low = max(0, end - reach)
            inside = kind[data[low:end]] == WORD
            starts = np.flatnonzero(inside & ~np.concatenate([[low > 0], inside[:-1]])) + low
            if len(starts) >= overlap or low == 0:
                context = min(overlap, len(starts))
                begin = int(starts[-context]) if context else end
                break
            reach *= 4
        done = end


def blocks(batches: Iterator[pa.RecordBatch], text: int, kind: np.ndarray, tags: Callable[[pa.RecordBatch], list], limit: int = BLOCK, overlap: int = 0, groups: Callable[[pa.RecordBatch], list] | None = None) -> Iterator[Block]:
    """All texts of `batches`, in order, in blocks of about `limit` bytes; null counts as empty. With
    `groups`, which names a group for each row, a block holds one group's texts."""
    held: dict[object, list[Unit]] = {}
    size: dict[object, int] = {}
    for batch in batches:
        raw, offsets = utf8(batch.column(text))
        owned = {g: len(own) for g, own in held.items()}
        of = groups(batch) if groups else [None] * batch.num_rows
        for i, (tag, group) in enumerate(zip(tags(batch), of)):
            data = raw[offsets[i] : offsets[i + 1]]
            own = held.setdefault(group, [])
            for unit in [Unit(tag, data)] if len(data) <= limit else parts(tag, data, kind, limit, overlap):
                if own and size[group] + len(unit.data) > limit:
                    yield cut(own, kind, group)
                    own.clear()
                    owned[group] = size[group] = 0
                own.append(unit)
                size[group] = size.get(group, 0) + len(unit.data)
        for group, own in held.items():  # a row that waits for the next batch would hold all bytes of this one
            k = owned.get(group, 0)
            own[k:] = [Unit(u.tag, u.data.copy(), u.context, u.first, u.last) for u in own[k:]]
    for group, own in held.items():
        if own:
            yield cut(own, kind, group)

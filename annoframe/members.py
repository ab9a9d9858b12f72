"""Text in gzip members that tell their sizes: one ordinary ``.gz`` file, which can also be read from any place of its text."""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right

#: Bytes of text in a member, about.
MEMBER_BYTES = 1 << 20
LEVEL = 4
#: A gzip header with an extra field ``AF`` that holds the bytes of the member and of its text.
_HEAD = struct.Struct("<4sIBBH2sHII")
_MAGIC = b"\x1f\x8b\x08\x04"


def member(text: bytes) -> bytes:
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS)
    body = pack.compress(text) + pack.flush()
    head = _HEAD.pack(_MAGIC, 0, 0, 255, 12, b"AF", 8, _HEAD.size + len(body) + 8, len(text))
    return head + body + struct.pack("<II", zlib.crc32(text), len(text))


class Members:
    """The text of a packed file. ``start`` is the place of a member in the text and in the file; those before it are not looked at
    unless asked for."""

    def __init__(self, stream, start: tuple[int, int] = (0, 0)):
        self.stream, self.size = stream, stream.size()
        self.known = [tuple(start)]
        self.held: tuple[int, bytes] = (-1, b"")

    def _sizes(self, at: int) -> tuple[int, int]:
        head = self.stream.read_at(_HEAD.size, at)
        if len(head) < _HEAD.size or head[:4] != _MAGIC or head[12:14] != b"AF":
            raise ValueError(f"no gzip member that tells its sizes at byte {at}")
        return _HEAD.unpack(head)[-2:]

    def _text(self, at: int, size: int) -> bytes:
        if self.held[0] != at:
            self.held = (at, zlib.decompress(self.stream.read_at(size, at), zlib.MAX_WBITS | 16))
        return self.held[1]

    def places(self) -> list[tuple[int, int]]:
        """Where each member starts, in the text and in the file, and at last where both end."""
        text, at = self.known[-1]
        while at < self.size:
            size, length = self._sizes(at)
            text, at = text + length, at + size
            self.known.append((text, at))
        return self.known

    def read_at(self, n: int, lo: int) -> bytes:
        if lo < self.known[0][0]:
            self.known = [(0, 0)]
        i, out = bisect_right(self.known, (lo, self.size)) - 1, []
        while self.known[i][0] < lo + n and self.known[i][1] < self.size:
            text, at = self.known[i]
            size, length = self._sizes(at)
            if text + length > lo:
                out.append(self._text(at, size)[max(0, lo - text) : lo + n - text])
            if i + 1 == len(self.known):
                self.known.append((text + length, at + size))
            i += 1
        return b"".join(out)

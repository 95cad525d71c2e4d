"""Memoised encoding of texts by the pieces between spaces.

Byte-level BPE splits a text by a pattern first. No match of that pattern spans the border
between a character that isn't white space and a space behind it, and none looks past it,
so the pieces between such borders can be encoded one by one and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# Remembered pieces per Python worker; about 200 bytes each.
CACHE_PIECES = 800_000

_TOUCHING_SPACES = re.compile(r"\s\s")
_BORDER = re.compile(r"(?<=\S)(?= )")


def split_pieces(text: str) -> list[str]:
    """Pieces whose encodings, one after another, are the text's.

    The first is literal; each further one is given without the space it starts with.
    """
    if not _TOUCHING_SPACES.search(text):
        return text.split(" ")
    first, *rest = _BORDER.split(text)
    return [first, *(piece[1:] for piece in rest)]


class Memo:
    """Remembers what a function gives for each key.

    Memory is bounded: keys are kept in two generations, and the older is dropped
    when the younger is full.
    """

    def __init__(self, function: Callable, size: int):
        self._half = max(1, size // 2)
        self._known = _Generation(function, {})

    def of(self, keys: Iterable) -> list:
        if len(self._known) > self._half:
            self._known = _Generation(self._known.function, dict(self._known))
        return list(map(self._known.__getitem__, keys))


class _Generation(dict):
    def __init__(self, function: Callable, older: dict):
        super().__init__()
        self.function, self._older = function, older

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


class PieceCache:
    """Remembers the encoding of each piece of the texts; ``encode`` never gives None."""

    def __init__(self, encode: Callable[[str], bytes], size: int = CACHE_PIECES):
        self._firsts = Memo(encode, size // 4)
        self._rest = Memo(lambda piece: encode(" " + piece), size)

    def encode(self, text: str) -> list[bytes]:
        """The encodings of a text's pieces, in order."""
        pieces = split_pieces(text)
        return self._firsts.of(pieces[:1]) + self._rest.of(pieces[1:])

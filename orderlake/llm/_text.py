"""Cutting texts where no tokenizer token can cross, and bounded caches over the pieces."""

from __future__ import annotations

from array import array


def space_chunks(text: str) -> list[str]:
    """Cut ``text`` before every U+0020 that a non-space character follows.

    The patterns that precede byte-level merges always begin a word at such a
    space, so the words of the text are the words of its chunks, in order.
    Joining the chunks gives the text.
    """
    parts = text.split(" ")
    out = [parts[0]] if parts[0] else []
    if "" not in parts[1:] and not any(p[0].isspace() for p in parts[1:]):
        out += [" " + p for p in parts[1:]]
        return out
    for p in parts[1:]:
        if p and not p[0].isspace() or not out:
            out.append(" " + p)
        else:  # further white space: stays with what stands before
            out[-1] += " " + p
    return out


def is_word(chunk: str) -> bool:
    """Whether ``chunk`` is ASCII letters, a space before them or not."""
    return chunk.isascii() and (chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha()) or chunk.isalpha())


class PieceCache(dict):
    """piece -> the piece's numbers as little-endian 32-bit bytes, by ``numbers(piece)``.

    When ``limit`` pieces are held, they become the older half, from which
    pieces that are met again move back, and the half before is dropped; pieces
    over ``longest`` characters are not held. Only speed depends on either.
    """

    def __init__(self, numbers, limit: int = 500_000, longest: int = 64):
        super().__init__()
        self._numbers, self._limit, self._longest = numbers, limit, longest
        self._older: dict = {}

    def __missing__(self, piece) -> bytes:
        out = self._older.get(piece)
        if out is None:
            out = self._numbers(piece)
            if not isinstance(out, bytes):
                out = array("I", out).tobytes()
        if len(piece) <= self._longest:
            if len(self) >= self._limit:
                self._older = dict(self)
                self.clear()
            self[piece] = out
        return out

    def of(self, pieces) -> bytes:
        return b"".join(map(self.__getitem__, pieces))

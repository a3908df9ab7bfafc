"""Words of many texts at once, as places in one array of bytes."""

from __future__ import annotations

import numpy as np

from tracetally.llm.common import ship

ship(__name__)

WORD, BLANK, BREAK = 0, 1, 2
LOWER = bytes(at + 32 if 65 <= at <= 90 else at for at in range(256))


def kinds(blank: bytes, breaks: bytes = b"") -> np.ndarray:
    """The kind of each byte: what separates words, what separates pieces, and all others."""
    table = np.full(256, WORD, np.uint8)
    table[list(blank)] = BLANK
    table[list(breaks)] = BREAK
    return table


class Layout:
    """The words of ``texts``, A to Z in lower case, each with one space before it in ``line``.

    ``first`` and ``stop`` are the words' places in ``line``, ``begin`` those in their own text,
    ``text`` the numbers of their texts, ``piece`` those of their pieces: breaks and ends of texts
    end a piece.
    """

    def __init__(self, texts: list[bytes], table: np.ndarray):
        edge = b"\n"
        raw = np.frombuffer(edge + edge.join(texts).translate(LOWER) + edge, np.uint8)
        kind = table[raw]
        inside = kind == WORD
        turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, stops = turns[::2], turns[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        offsets = 1 + np.concatenate([[0], np.cumsum(sizes + 1)])
        self.text = np.searchsorted(offsets, starts, "right") - 1
        self.begin = starts - offsets[self.text]
        ended = np.cumsum(kind == BREAK, dtype=np.int64)
        self.piece = ended[starts] + self.text
        kept = inside
        kept[starts - 1] = True
        lengths = stops - starts
        self.stop = np.cumsum(lengths + 1)
        self.first = self.stop - lengths
        line = raw[kept]
        line[self.first - 1] = 0x20
        self.line = line

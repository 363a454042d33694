"""Texts in units that tokenizers treat one by one, and tables of what is known of a unit.

A text is cut before a blank that stands between a character which is no blank
and one which is no white space. A byte-level pre-tokenizer starts a new token
there whatever comes before; pieces of a vocabulary in which a blank only
opens a piece end there too (``opens_pieces_only`` asks a vocabulary). So the
tokens of a text are those of its units, and units, unlike texts, repeat.

Tables of units are kept by a task, in bounded memory: ``TABLE_BYTES`` and what
one slice of texts adds. A table over its bound starts anew. Results don't
depend on it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

TABLE_BYTES = 1 << 27
ENTRY_BYTES = 160  # of an entry besides its characters
SLICE_CHARS = 1 << 21
ODD = re.compile(r"^ | \s| $")


def units(text: str) -> list[str]:
    """The units of ``text``; all but the first lack their opening blank."""
    parts = text.split(" ")
    if not ODD.search(text):
        return parts
    found = [parts[0]]
    before = parts[0]
    for part in parts[1:]:
        if before and part and not part[0].isspace():
            found.append(part)
        else:
            found[-1] += " " + part
        before = part
    return found


def slices(texts: list[str | None], chars: int | None = None) -> Iterator[slice]:
    """Slices of ``texts`` of about ``chars`` characters, at least one text in each."""
    chars = chars or SLICE_CHARS
    start = held = 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > start and held + size > chars:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(texts):
        yield slice(start, len(texts))


class Bounded:
    """Bytes that a table of units holds, and whether it has to start anew."""

    def __init__(self, limit: int | None = None) -> None:
        self.limit = limit or TABLE_BYTES
        self.held = 0

    def full(self) -> bool:
        return self.held > self.limit

    def add(self, keys: list[str], bytes_per_char: int = 2) -> None:
        self.held += sum(map(len, keys)) * bytes_per_char + ENTRY_BYTES * len(keys)

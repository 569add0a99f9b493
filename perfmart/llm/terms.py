"""Terms of texts: maximal runs of ASCII letters, digits and all other characters beyond ASCII, A-Z as a-z."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from perfmart.llm.bytewords import INSIDE, LOWER

#: A text's terms are listed for pieces of about this many bytes, so that a very long text needs little memory.
PIECE_BYTES = 1 << 20
#: What a byte becomes: itself in lower case where it belongs to a term, else a blank.
SPACED = bytes(int(LOWER[b]) if INSIDE[b] else 32 for b in range(256))


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, piece by piece; nothing for a null."""
    text = text or b""
    at = 0
    while at < len(text):
        piece = text[at : at + PIECE_BYTES].translate(SPACED)
        at += len(piece)
        while at < len(text) and piece[-1] != 32:  # the piece ends inside a term
            more = text[at : at + PIECE_BYTES].translate(SPACED)
            blank = more.find(b" ")
            more = more[: blank + 1] if blank >= 0 else more
            piece, at = piece + more, at + len(more)
        yield piece.split()


def encoded(column: pa.Array) -> Iterator[bytes | None]:
    """The texts of a column as UTF-8 bytes."""
    wide = pa.types.is_large_string(column.type)
    return (t.as_py() for t in column.cast(pa.large_binary() if wide else pa.binary()))

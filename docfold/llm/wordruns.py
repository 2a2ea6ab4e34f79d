"""Words of UTF-8 texts as Python byte strings, a bounded run at a time."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle

from docfold.llm import textcore

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN_BYTES = 1 << 20


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of every row; null counts as empty."""
    data, offs = textcore.raw(column)
    view = memoryview(data)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        yield bytes(view[a:b])


def runs(text: bytes, table: bytes, limit: int = RUN_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, in order, in lists of about `limit` bytes. `table` (256 bytes) folds letters and turns what
    separates words into white space; a cut is made at a space only, so no word is ever split."""
    text = text.translate(table)
    if len(text) <= limit:
        yield text.split()
        return
    a = 0
    while a < len(text):
        b = a + limit
        if b < len(text):
            cut = text.rfind(b" ", a, b)
            b = cut if cut > a else text.find(b" ", b)
            b = len(text) if b < 0 else b
        yield text[a:b].split()
        a = b


def folding(separators: bytes) -> bytes:
    """A translate table that lower-cases A-Z and turns `separators` into spaces."""
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    return bytes(32 if b in separators else lower[b] for b in range(256))

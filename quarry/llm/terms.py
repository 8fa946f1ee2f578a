"""Terms of UTF-8 text: maximal runs of letters (and digits), with A-Z folded to a-z.

The patterns name single ASCII bytes as separators and keep every byte from 0x80 on, so a text can be cut as bytes:
one table turns separators into spaces and folds A-Z, and splitting at spaces gives the terms.
"""

from __future__ import annotations

import pyarrow as pa


def fold_table(separators: list[range]) -> bytes:
    table = bytearray(range(256))
    table[65:91] = range(97, 123)
    for r in separators:
        table[r.start:r.stop] = b" " * len(r)
    return bytes(table)


#: Everything below 0x80 but letters; everything but letters and digits; white space only.
LETTERS = fold_table([range(0x00, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)])
LETTERS_DIGITS = fold_table([range(0x00, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80)])
WORDS = fold_table([range(0x09, 0x0E)])


def split(text: bytes | None, table: bytes) -> list[bytes]:
    return text.translate(table).split() if text else []


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(name).to_pylist()
